"""Keyword, vector and hybrid search over a table of documents or blocks.

Terms are lower-case runs of letters and digits, CJK characters one by one.  Scores are
BM25 with k1 = 1.2 and b = 0.75 over an inverted index that is a DataFrame; vectors are
ranked exactly by cosine.  A hybrid search normalises the scores of each list of
candidates from 0 to 1 and adds them by weight; a document that one list lacks has 0 there.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.sources.scratch import written

K1, B = 1.2, 0.75
TOKEN = r"(?U)[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]|[\p{L}\p{N}&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}]]+"


def tokens(text: Column) -> Column:
    """Terms in order; full-width letters and digits count as their half-width forms."""
    wide = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
    narrow = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))
    return F.regexp_extract_all(F.lower(F.translate(F.coalesce(text, F.lit("")), wide, narrow)), F.lit(TOKEN), F.lit(0))


def inverted_index(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(term, key, tf, length)"""
    terms = docs.select(key, tokens(F.col(text)).alias("t")).withColumn("length", F.size("t"))
    return terms.select(key, "length", F.explode("t").alias("term")).groupBy("term", key, "length").agg(F.count(F.lit(1)).alias("tf"))


def terms_of(spark, query: str) -> list[str]:
    """The different terms of a query, in order."""
    return spark.range(1).select(F.array_distinct(tokens(F.lit(query))).alias("t")).first().t


def bm25(docs: DataFrame, query: str, key: str, text: str) -> DataFrame:
    """(key, score) of documents that hold a term of the query.

    Texts are read and cut into terms once: what is kept of each is its length and the
    numbers of the query's terms, as a scratch table, from which totals and scores follow.
    """
    terms = terms_of(docs.sparkSession, query)
    if not terms:
        return docs.select(key, F.lit(0.0).alias("score")).where(F.lit(False))
    names = [f"tf{i}" for i in range(len(terms))]
    cut = docs.select(F.col(key).alias(key), tokens(F.col(text)).alias("t"))
    cut = cut.select(key, F.size("t").alias("length"), F.filter("t", lambda x: x.isin(*terms)).alias("t"))
    number = lambda term: F.size(F.filter("t", lambda x: x == term))
    counts = cut.select(key, "length", *(number(w).alias(n) for w, n in zip(terms, names)))
    counts = written(counts, "term-counts")
    n, mean, *df = counts.agg(F.count(F.lit(1)), F.avg("length"), *(F.count_if(F.col(c) > 0) for c in names)).first()
    score = F.lit(0.0)
    for c, d in zip(names, df):
        idf = math.log(1 + (n - d + 0.5) / (d + 0.5))
        tf = F.col(c).cast("double")
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.lit(mean or 1.0)))
    return counts.where(F.greatest(*names, F.lit(0)) > 0).select(key, score.alias("score"))


def field_search(docs: DataFrame, query: str, key: str, boosts: dict[str, float]) -> DataFrame:
    """Weighted sum of the fields' scores; at least one field must match."""
    parts = [bm25(docs, query, key, f).select(key, (F.col("score") * b).alias("score")) for f, b in boosts.items()]
    all_ = parts[0]
    for p in parts[1:]:
        all_ = all_.unionByName(p)
    return all_.groupBy(key).agg(F.sum("score").alias("score"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def top(df: DataFrame, k: int, key: str, score: str = "score") -> DataFrame:
    return df.orderBy(F.desc(score), key).limit(k)


def nearest(docs: DataFrame, vector: list[float], key: str, embedding: str, k: int) -> DataFrame:
    """(key, score) of the ``k`` vectors with the largest cosine."""
    wanted = F.array(*map(F.lit, vector))
    return top(docs.select(key, cosine(F.col(embedding), wanted).alias("score")).where("score is not null"), k, key)


def hybrid(keyword: DataFrame, vector: DataFrame, key: str, k: int, keyword_boost: float = 0.5, vector_boost: float = 0.5) -> DataFrame:
    """(key, score, keyword_score, vector_score): both lists cut to ``k``, scaled and added."""
    def scaled(df: DataFrame, name: str) -> DataFrame:
        cut = top(df.select(key, "score"), k, key)
        all_ = Window.partitionBy(F.lit(0))  # k rows
        low, high = F.min("score").over(all_), F.max("score").over(all_)
        return cut.select(key, F.when(high > low, (F.col("score") - low) / (high - low)).otherwise(F.lit(1.0)).alias(name))

    both = scaled(keyword, "keyword_score").join(scaled(vector, "vector_score"), key, "full").fillna(0.0, ["keyword_score", "vector_score"])
    total = (F.col("keyword_score") * keyword_boost + F.col("vector_score") * vector_boost) / (keyword_boost + vector_boost)
    return top(both.select(key, total.alias("score"), "keyword_score", "vector_score"), k, key)


def search_documents(docs: DataFrame, query: str, key: str = "doc_id", k: int = 10, keyword_boost: float = 0.5, vector_boost: float = 0.5, dim: int = 384) -> DataFrame:
    """Documents with title, abstract, full_text and embedding; the title counts twice."""
    words = field_search(docs, query, key, {"title": 2 * keyword_boost, "abstract": keyword_boost, "full_text": keyword_boost})
    return hybrid(words, nearest(docs, hash_vector(query, dim), key, "embedding", k), key, k, keyword_boost, vector_boost)


def search_blocks(blocks: DataFrame, query: str, doc_id: str | None = None, key: str = "block_id", k: int = 10, keyword_boost: float = 0.5, vector_boost: float = 0.5, dim: int = 384) -> DataFrame:
    """Blocks with text, block_type and embedding; a block type that is the query counts half."""
    if doc_id is not None:
        blocks = blocks.where(F.col("doc_id") == doc_id)
    words = bm25(blocks, query, key, "text").select(key, (F.col("score") * keyword_boost).alias("score"))
    kind = blocks.where(F.col("block_type") == query).select(key, F.lit(keyword_boost * 0.5).alias("score"))
    words = words.unionByName(kind).groupBy(key).agg(F.sum("score").alias("score"))
    return hybrid(words, nearest(blocks, hash_vector(query, dim), key, "embedding", k), key, k, keyword_boost, vector_boost)


# ---- vectors of texts ----


def hash_vector(text: str | None, dim: int = 384) -> list[float]:
    """Signed counts of the words' BLAKE2b hashes, of unit length; zeros for a text without words."""
    out = np.zeros(dim)
    for word in (text or "").split():
        h = hashlib.blake2b(word.encode(), digest_size=8).digest()
        out[int.from_bytes(h[:4], "little") % dim] += -1.0 if h[4] & 1 else 1.0
    norm = math.sqrt(float(out @ out))
    return (out / norm if norm else out).tolist()


class Embedder:
    """Texts to vectors of one length.  Instances travel to executors, so they must pickle."""

    dimension: int

    def embed(self, texts: list[str | None]) -> list[list[float]]:
        raise NotImplementedError


class HashEmbedder(Embedder):
    def __init__(self, dimension: int = 384):
        if dimension <= 0:
            raise ValueError("the dimension must be positive")
        self.dimension = dimension

    def embed(self, texts: list[str | None]) -> list[list[float]]:
        return [hash_vector(t, self.dimension) for t in texts]


#: Makers of embedders by kind: (dimension) to an embedder.  ``auto`` takes a remote one if one was registered.
EMBEDDERS: dict[str, Callable[[int], Embedder]] = dict.fromkeys(("hash", "local", "none"), HashEmbedder)
REMOTE = ("openai", "oa")


def register_embedder(kind: str, make: Callable[[int], Embedder]) -> None:
    EMBEDDERS[kind.strip().lower()] = make


def embedder(kind: str = "auto", dimension: int = 384) -> Embedder:
    """By kind; services outside the cluster have no client here and must be registered first."""
    name = kind.strip().lower()
    if name in ("auto", ""):
        name = next((r for r in REMOTE if r in EMBEDDERS), "hash")
    if name in EMBEDDERS:
        return EMBEDDERS[name](dimension)
    if name in REMOTE:
        raise RuntimeError(f"register a maker for embedder {kind!r} first")
    raise ValueError(f"unknown embedder {kind!r}")


def embed(df: DataFrame, text: str, by: Embedder | int = 384, out: str = "embedding") -> DataFrame:
    """Adds vectors, in Arrow batches (the JVM has no BLAKE2b); a number is the dimension of hash vectors."""
    made = HashEmbedder(by) if isinstance(by, int) else by

    @F.pandas_udf("array<double>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(made.embed([None if t is None else str(t) for t in s]), index=s.index, dtype=object)

    return df.withColumn(out, vectors(F.col(text)))


def embedding_text(docs: DataFrame, blocks: DataFrame, most: int = 120) -> DataFrame:
    """(doc_id, text): title, abstract, then blocks by what they are, each text once.

    Order: the first claim, other claims, summary, examples, the rest; at most ``most``
    blocks.  ``docs``: doc_id, title, abstract; ``blocks``: doc_id, pos, text, block_type,
    section, subsection, example_id, claim_no.
    """
    claim = F.col("block_type").startswith("claim") | (F.col("section") == "claims")
    rank = (
        F.when(F.coalesce(claim, F.lit(False)) & (F.col("claim_no") == 1), 2).when(F.coalesce(claim, F.lit(False)), 3)
        .when(F.col("subsection") == "summary", 4).when(F.coalesce("example_id", F.lit("")) != "", 5).otherwise(6)
    )
    parts = blocks.select("doc_id", rank.alias("rank"), F.col("pos").cast("long").alias("pos"), F.trim("text").alias("text"))
    for i, c in enumerate(("title", "abstract")):
        parts = parts.unionByName(docs.select("doc_id", F.lit(i).alias("rank"), F.lit(0).cast("long").alias("pos"), F.trim(c).alias("text")))
    once = parts.where("text <> ''").groupBy("doc_id", "text").agg(F.min(F.struct("rank", "pos")).alias("at"))
    budget = Window.partitionBy("doc_id", F.col("at.rank") < 2).orderBy("at")
    kept = once.withColumn("n", F.row_number().over(budget)).where((F.col("at.rank") < 2) | (F.col("n") <= most))
    return kept.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), "\n").alias("text"))
