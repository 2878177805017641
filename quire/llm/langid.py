"""Language identification by the nearest of several centroids per language.

A text becomes a vector of hashed character n-grams: UTF-8 bytes of the lower-cased
whole text, ASCII non-letters as spaces, pairs and triples of bytes, log-scaled counts
times inverse document frequency, unit length.  Per language, spherical k-means from
k-means++ starts gives several centroids, each of which holds at least ``LEAST`` of the language's
documents, so that outliers don't become centroids of their own.  The language of the
centroid with the largest cosine is predicted; a text whose cosine is far below what the
centroid's own documents have is rejected.

The classifier (centroids, document frequencies, rejection thresholds) is fitted on the
documents of the smallest hashes of their ids, ``FIT`` divided by the number of languages of each, at least
``EACH``: the sample is bounded by the larger of ``FIT`` and ``EACH`` times the number of
languages, whatever the size of the table, and no language is left out.  Predictions read
whole texts of all documents.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and is
rejected; without labelled rows every document is ``und``; very long texts are counted whole, in
segments; of centroids with equal cosines the first one counts, by the order of their languages; repeated rows
are predicted alike; null ids pass through; an empty table gives an empty result; a null
language is not learned; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import small_batches, uniform

#: Documents the classifier is fitted on, of a language at least, size of the vectors, centroids per language.
FIT, EACH, DIM, CENTROIDS = 1_500, 20, 4_096, 3
#: Share of a language's documents that a centroid holds, at least, and starts of the clustering.
LEAST, STARTS = 0.05, 4
#: Rejected below this share of the cosine that all but one in a hundred of a centroid's own documents reach.
FAR = 0.5
UNKNOWN = "und"
BROADCAST_LANGS = 50_000
SEGMENT, ROWS = 1 << 20, 128

_LETTER = regex.compile(r"\p{L}")
_SPACED = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def ngram_counts(text: str | None) -> np.ndarray:
    """Counts of hashed byte pairs and triples."""
    out = np.zeros(DIM, np.int64)
    data = np.frombuffer(b" " + (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPACED) + b" ", np.uint8)
    for at in range(0, len(data) - 1, SEGMENT):
        b = data[at : at + SEGMENT + 2].astype(np.uint32)
        pairs = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA6B)
        triples = pairs[:-1] + b[2:] * np.uint32(0xC2B2AE35) + np.uint32(0x27D4EB2F)
        for h, own in ((pairs, SEGMENT), (triples, SEGMENT)):
            h = h[:own]
            h = (h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
            out += np.bincount(h >> np.uint32(20), minlength=DIM)
    return out


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray  # unit rows
    langs: list[str]  # of each centroid
    least: np.ndarray  # cosine under which a text is rejected, of each centroid

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts, dtype=np.float32)
        x *= self.idf
        norm = np.linalg.norm(x, axis=-1, keepdims=True)
        norm[norm == 0] = 1
        x /= norm
        return x


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def clusters(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Spherical k-means, the best of ``STARTS`` k-means++ starts; centroids that hold too few rows are left out."""
    rng, best, most = np.random.default_rng(seed), None, -np.inf
    least = max(2, int(LEAST * len(x))) if len(x) > 2 * k else 1
    for _ in range(STARTS):
        c = x[rng.integers(len(x), size=1)]
        while len(c) < min(k, len(x)):
            far = np.maximum(0, 1 - (x @ c.T).max(1)).astype(float)
            if far.sum() <= 0:
                break
            c = np.concatenate([c, x[[rng.choice(len(x), p=far / far.sum())]]])
        for turn in range(rounds + 1):
            near = (x @ c.T).argmax(1)
            held = np.bincount(near, minlength=len(c))
            few = held < least
            if few.any() and len(c) > 1:  # its rows go to the other centroids
                c = c[np.arange(len(c)) != held.argmin()]
                near = (x @ c.T).argmax(1)
            c = np.array([unit(x[near == i].mean(0)) if (near == i).any() else c[i] for i in range(len(c))])
        total = (x @ c.T).max(1).sum()
        if total > most:
            best, most = c, total
    return best


def fit(rows: list[tuple[str, bytes]]) -> Model | None:
    if not rows:
        return None
    rows.sort()
    langs = np.array([r[0] for r in rows])
    counts = np.stack([np.frombuffer(r[1], "<u2") for r in rows])
    rows.clear()  # the raw counts are not needed twice
    idf = np.log((1 + len(counts)) / (1 + np.count_nonzero(counts, axis=0))).astype(np.float32) + 1
    model = Model(idf, np.empty((0, DIM), np.float32), [], np.empty(0))
    centroids, names, least = [], [], []
    for lang in sorted(set(langs.tolist())):
        own = model.vectors(counts[langs == lang])
        c = clusters(own, CENTROIDS)
        cosine = own @ c.T
        near = cosine.argmax(1)
        for i in range(len(c)):
            mine = cosine[near == i, i]
            least.append(FAR * float(np.quantile(mine, 0.01)) if len(mine) else 0.0)
        centroids.append(c)
        names += [lang] * len(c)
    return Model(idf, np.concatenate(centroids).astype(np.float32), names, np.array(least))


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Fits on a bounded sample of the rows with non-null language, spread evenly over the languages."""
    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    n_langs = sizes.count()
    if not n_langs:
        return None
    each = max(EACH, FIT // n_langs)
    # Twice as many as are wanted, by the hash; then exactly those of the smallest hashes that have a letter.
    share = F.lit(2.0 * each) / F.col("n")
    sizes = F.broadcast(sizes) if n_langs <= BROADCAST_LANGS else sizes
    some = rows.join(sizes, "lang").where(uniform("id", seed=11) < share).where(F.col("text").rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy(uniform("id", seed=11), "id", F.xxhash64("text"))
    picked = some.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)

    def run(batches):
        for b in batches:
            counts = [np.minimum(ngram_counts(t), 65_535).astype("<u2").tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.binary())], ["lang", "counts"])

    found = picked.select("lang", "text").mapInArrow(run, "lang string, counts binary").toArrow()
    return fit(list(zip(found.column(0).to_pylist(), found.column(1).to_pylist())))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds lang_pred, score (cosine with the nearest centroid, 0 to 1) and rejected; drops nothing but other columns than the id's."""
    small_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                b = batch.slice(at, ROWS)
                langs, scores, rejected = judge(b.column(1).to_pylist(), model)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], ["id", "lang_pred", "score", "rejected"]
                )

    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model | None, text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """The rows, with all their columns, whose text is not rejected; ``lang_col`` becomes the prediction where it is null."""

    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for i in range(0, batch.num_rows, ROWS):
                b = batch.slice(i, ROWS)
                langs, _, rejected = judge(b.column(at).to_pylist(), model)
                if lang_col is not None:
                    k = batch.schema.get_field_index(lang_col)
                    b = b.set_column(k, b.schema.field(k), pc.coalesce(b.column(k), pa.array(langs, b.schema.field(k).type)))
                yield b.filter(pa.array([not r for r in rejected], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def judge(texts: list[str | None], model: Model | None) -> tuple[list, list, list]:
    known = [i for i, t in enumerate(texts) if model is not None and t and _LETTER.search(t)]
    langs, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
    if known:
        cosine = model.vectors(np.stack([ngram_counts(texts[i]) for i in known])) @ model.centroids.T
        for i, row in zip(known, cosine):
            c = int(row.argmax())
            langs[i], scores[i] = model.langs[c], float(min(1.0, max(0.0, row[c])))
            rejected[i] = bool(row[c] < model.least[c])
    return langs, scores, rejected


def held_in(id_col: Column, folds: int = 5) -> Column:
    """Rows that may be learned from: those whose crc32 of the id as text is no multiple of ``folds``."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds != 0, F.lit(True))
