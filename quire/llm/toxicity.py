"""Toxicity by Levenshtein automata over a lexicon trie, with scores of the context.

Lexicon: words and word beginnings that are met far more often in documents labelled
toxic than in others.  Words of the text are matched by the intersection of the trie
with the Levenshtein automaton of each entry: a state is the set of (node, edits) pairs
reached, and its transitions are computed when first met and kept, so a word costs one
lookup for each letter until no entry is in reach.  Entries of five letters may have one
edit, of nine letters two; where the training documents show that misspelt matches of an
entry also occur in clean texts, it is matched exactly only.

Context: every hit has a tone, the sum of the weights of the words in its window and of three
marks: that it stands between quotation marks, after a word that reports speech, near a
word of the second person.  The weights are learned: the log odds of a word's (or mark's)
presence about hits in toxic and in clean documents, shrunk towards a prior that is zero
for words.  A hit of negative tone counts as quoted, one of positive tone as an address.
A logistic model over the counts of exact, misspelt, quoted and addressing hits gives the
score; its prior weights hold where the training documents say nothing, so that a term in
quotation scores far less than the same term in abuse.

The classifier is fitted on at most ``FIT`` labelled documents, those of the smallest hashes
of their ids; scores read whole texts of all documents.

Defined results: a null or empty text has no hits and gets the score of a clean text; very long
texts are read whole; of entries equally near to a word the first by letters is its hit;
without labelled rows the lexicon is empty; of repeated labels of one id the largest
counts; null labels and ids are not learned from; repeated rows score alike; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import sliced, small_batches, uniform, written

#: Documents the classifier is fitted on, entries of the lexicon, words about a hit that are its context, words of the context with a weight.
FIT, LEXICON, CONTEXT, CONTEXT_WORDS = 20_000, 5_000, 6, 1_000
#: Documents that a prior weight of the context counts as, and the evidence (log odds times root of documents) that a word's weight needs.
PRIOR_DOCS, EVIDENCE = 8, 4.0
#: An entry is met in so many toxic documents at least, in this share of them, and so many times as often as in clean ones.
LEAST, SHARE, RATIO = 4, 0.01, 20.0
STEM = range(4, 8)

# Words that report speech, and words that address the reader.
REPORTING = frozenset("said says wrote writes quote quoted quotes quoting called term word phrase sagte schrieb dit écrit dijo escribió".split())
ADDRESS = frozenset("you your youre u du dich dir dein sie ihr tu te toi vous ton tú usted ustedes".split())
#: Marks of a context and their prior weights.
QUOTED, REPORTED, ADDRESSED = "<quoted>", "<reported>", "<addressed>"
TONE = {QUOTED: -2.0, REPORTED: -2.0, ADDRESSED: 1.0}
QUOTES = "\"“”„«»‹›"

_TOKEN = re.compile(rf"[^\W\d_]+|[{QUOTES}]")


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """The trie of the lexicon, traversed by the sets of Levenshtein states of all entries together.

    A state is a frozenset of (node, errors): the letters read so far lead to the node with
    that many edits.  ``limits`` gives each entry's edits; an entry that ends in ``*``
    matches every word that begins with it, without edits.
    """

    def __init__(self, limits: dict[str, int]):
        self.child: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.most: list[int] = [-1]  # edits allowed to the entries below
        for entry, k in sorted(limits.items()):
            word, node = entry.rstrip("*"), 0
            self.most[0] = max(self.most[0], k)
            for c in word:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.term.append(None)
                    self.stem.append(None)
                    self.most.append(-1)
                node = self.child[node][c]
                self.most[node] = max(self.most[node], k)
            (self.stem if entry.endswith("*") else self.term)[node] = entry
        self.limits = limits
        self.start = self._closed({0: 0})
        self.steps: dict[tuple[frozenset, str], frozenset] = {}
        self.ends: dict[frozenset, tuple[str, int] | None] = {}

    def _closed(self, least: dict[int, int]) -> frozenset:
        """With nodes reached by leaving out letters of an entry."""
        todo = list(least.items())
        while todo:
            node, e = todo.pop()
            if least[node] < e:
                continue
            for n in self.child[node].values():
                if e + 1 <= self.most[n] and least.get(n, 9) > e + 1:
                    least[n] = e + 1
                    todo.append((n, e + 1))
        return frozenset((n, e) for n, e in least.items() if e <= self.most[n])

    def _step(self, state: frozenset, c: str) -> frozenset:
        least: dict[int, int] = {}
        for node, e in state:
            if e + 1 <= self.most[node]:  # a letter too many
                least[node] = min(least.get(node, 9), e + 1)
            for letter, n in self.child[node].items():
                cost = e + (letter != c)
                if cost <= self.most[n]:
                    least[n] = min(least.get(n, 9), cost)
        return self._closed(least)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest entry and its edits, exact ones first; None if none is near enough."""
        state, steps, stem = self.start, self.steps, None
        for c in word:
            key = (state, c)
            state = steps.get(key)
            if state is None:
                if len(steps) > 200_000:
                    steps.clear()
                state = steps[key] = self._step(key[0], c)
            if not state:
                return stem
            if stem is None:
                stem = next(((self.stem[n], 0) for n, e in state if e == 0 and self.stem[n]), None)
        if state not in self.ends:
            found = [(e, self.term[n]) for n, e in state if self.term[n] and e <= self.limits[self.term[n]]]
            self.ends[state] = min(found)[::-1] if found else None
        end = self.ends[state]
        return end if end and end[1] == 0 or stem is None else stem


FEATURES = ("exact", "misspelt", "quoted", "address")
PRIOR = np.array([-3.0, 5.0, 4.0, 0.5, 1.0])


def contexts(text: str | None, automaton: Automaton):
    """(entry, edits, words and marks of the context) of every hit of a whole text."""
    tokens = _TOKEN.findall((text or "").lower())
    near = {w: m for w in set(tokens) if (m := automaton.match(w))}
    if not near:
        return
    for i, w in enumerate(tokens):
        if w not in near:
            continue
        before, after = tokens[max(0, i - CONTEXT) : i], tokens[i + 1 : i + 1 + CONTEXT]
        around = {t for t in before + after if t not in near and t not in QUOTES}
        if any(t in QUOTES for t in before) and any(t in QUOTES for t in after):
            around.add(QUOTED)
        if any(t in REPORTING for t in before[-3:]):
            around.add(REPORTED)
        if any(t in ADDRESS for t in before + after):
            around.add(ADDRESSED)
        yield *near[w], around


def hits(text: str | None, automaton: Automaton, tone: dict[str, float] = TONE) -> tuple[np.ndarray, list[tuple[str, int]]]:
    """Counts by context, and the hits, of a whole text."""
    counts, found = np.zeros(len(FEATURES)), []
    for entry, edits, around in contexts(text, automaton):
        told = sum(sorted(tone[t] for t in around if t in tone))
        if told <= -1:
            counts[2] += 1
        else:
            counts[min(edits, 1)] += 1
            counts[3] += told >= 1
        found.append((entry, edits))
    return counts, found


def tones(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Weights of the context from (word or mark, toxic, clean) documents, of so many with a hit."""
    found = dict(TONE)
    if min(toxic, clean) < LEAST:
        return found
    strength = {}
    for word, t, c in counts:
        odds = np.log((t + 1) / (toxic + 2)) - np.log((c + 1) / (clean + 2))
        strength[word] = abs(odds) * (t + c) ** 0.5
        if word in TONE or (t + c >= LEAST and strength[word] >= EVIDENCE):
            found[word] = float(((t + c) * odds + PRIOR_DOCS * TONE.get(word, 0)) / (t + c + PRIOR_DOCS))
    most = sorted((w for w in found if w not in TONE), key=lambda w: (-strength[w], w))[:CONTEXT_WORDS]
    return {w: found[w] for w in [*TONE, *most]}


@dataclass
class Model:
    automaton: Automaton
    weights: np.ndarray
    tone: dict[str, float]

    def score(self, counts: np.ndarray) -> np.ndarray:
        z = self.weights[0] + strength(counts) @ self.weights[1:]
        return 1 / (1 + np.exp(-z))


def strength(counts: np.ndarray) -> np.ndarray:
    """Counts of hits as evidence: the first one counts most."""
    return counts / (counts + 0.25)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge towards ``PRIOR`` by Newton's method; hit weights stay at zero or above."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + ridge * (w - PRIOR)
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        w = w - np.linalg.solve(h, g)
        w[1:] = np.maximum(w[1:], 0)
    return w


def _signatures(batches):
    """Adds the smallest hashes of the shingles of five words under two seeds, which near copies mostly share."""
    for b in batches:
        first, second = [], []
        for text in b.column(0).to_pylist():
            w = (text or "").lower().encode("utf-8", "surrogatepass").split()
            shingles = {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
            for seed, out in ((1, first), (2, second)):
                out.append(min(xxhash.xxh64_intdigest(s, seed) for s in shingles) >> 1)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first, pa.int64()), pa.array(second, pa.int64())], ["text", "toxic", "s1", "s2"])


def _word_counts(batches):
    toxic, clean = Counter(), Counter()
    for b in batches:
        for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            (toxic if label else clean).update({w for w in _TOKEN.findall((text or "").lower()) if len(w) > 2})
    names = list(toxic | clean)
    for i in range(0, len(names), 50_000):
        some = names[i : i + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.string()), pa.array([toxic[w] for w in some], pa.int64()), pa.array([clean[w] for w in some], pa.int64())], ["word", "toxic", "clean"]
        )


def lexicon(sample: DataFrame) -> dict[str, int]:
    """Entries with the edits they allow, from (text, toxic) rows."""
    n_toxic, n_clean = sample.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    counts = sample.mapInArrow(_word_counts, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    stems = counts.select(
        F.explode(F.transform(F.sequence(F.lit(STEM[0]), F.lit(STEM[-1])), lambda k: F.when(F.length("word") > k, F.substring("word", F.lit(1), k)))).alias("stem"),
        "word", "toxic", "clean",
    ).where("stem is not null")
    stems = stems.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.count_if(F.col("toxic") > 1).alias("kinds")).where("kinds >= 8")
    odds = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    pick = lambda df, name, least: (
        df.withColumn("odds", odds).where((F.col("toxic") >= least) & (F.col("odds") >= RATIO)).orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), name).limit(LEXICON).select(name, "toxic").collect()
    )
    least = max(LEAST, int(SHARE * n_toxic))
    words = [r[0] for r in pick(counts, "word", least)]
    found = sorted(r[0] for r in pick(stems, "stem", 4 * least))
    shortest = [s for s in found if not any(s != t and s.startswith(t) for t in found)]
    plain = [w for w in words if not any(w.startswith(s) for s in shortest)]
    return {w: edits_allowed(w) for w in plain} | {f"{s}*": 0 for s in shortest}


def _matcher(limits: dict[str, int], tone: dict[str, float]):
    def run(batches):
        automaton = Automaton(limits)
        for b in sliced(batches):
            rows = [hits(t, automaton, tone) for t in b.column(0).to_pylist()]
            fuzzy = [sorted({e for e, k in found if k}) for _, found in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([c.tolist() for c, _ in rows], pa.list_(pa.float64())), pa.array(fuzzy, pa.list_(pa.string()))], ["toxic", "counts", "fuzzy"]
            )

    return run


def _around(limits: dict[str, int]):
    """Documents in which a word or mark stands about a hit; the empty word stands for any hit."""

    def run(batches):
        automaton, toxic, clean = Automaton(limits), Counter(), Counter()
        for b in sliced(batches):
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                (toxic if label else clean).update({t for _, _, around in contexts(text, automaton) for t in (*around, "")})
        words = sorted(toxic | clean)
        for i in range(0, len(words), 50_000):
            some = words[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([toxic[w] for w in some], pa.int64()), pa.array([clean[w] for w in some], pa.int64())], ["word", "toxic", "clean"])

    return run


def learned_tone(sample: DataFrame, limits: dict[str, int]) -> dict[str, float]:
    """The weights of the context, from (text, toxic) rows."""
    counts = sample.select("text", "toxic").mapInArrow(_around(limits), "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = written(counts, "toxic-context")
    any_ = counts.where("word = ''").first()
    if any_ is None:
        return dict(TONE)
    n = F.col("toxic") + F.col("clean")
    odds = F.log((F.col("toxic") + 1) / F.lit(any_.toxic + 2)) - F.log((F.col("clean") + 1) / F.lit(any_.clean + 2))
    marks = counts.where(F.col("word").isin(*TONE))
    most = counts.where((F.col("word") != "") & ~F.col("word").isin(*TONE) & (n >= LEAST)).orderBy(F.desc(F.abs(odds) * F.sqrt(n)), "word").limit(CONTEXT_WORDS)
    return tones([tuple(r) for r in marks.unionByName(most).collect()], any_.toxic, any_.clean)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fits on at most ``FIT`` of the documents that ``labels`` (id, label) covers."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))
    n = known.count()
    if n > FIT:
        known = known.where(uniform("id", seed=29) < 1.2 * FIT / n)
    known = known.orderBy(F.xxhash64("id", F.lit(29)), "id").limit(FIT)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = picked.join(F.broadcast(known), "id").select("text", "toxic")  # at most FIT ids
    # Near copies count once: else every word of a toxic text that was often copied would look toxic.
    # The one of the smallest hash stands for them.
    sample = sample.mapInArrow(_signatures, "text string, toxic int, s1 long, s2 long")
    for key in ("s1", "s2"):
        first = F.min(F.struct(F.xxhash64("text"), "text", "s2")).alias("x")
        sample = sample.groupBy(key, "toxic").agg(first).select("toxic", "x.text", "x.s2")
    sample = written(sample.select("text", "toxic"), "toxic-sample")
    limits = lexicon(sample)
    tone = learned_tone(sample, limits)
    for attempt in range(2):  # the second time with misspellings only where they are safe
        rows = sample.select("text", "toxic").mapInArrow(_matcher(limits, tone), "toxic int, counts array<double>, fuzzy array<string>").toPandas()
        if attempt == 0:
            seen, clean = Counter(), Counter()
            for label, fuzzy in zip(rows["toxic"], rows["fuzzy"]):
                seen.update(fuzzy)
                if not label:
                    clean.update(fuzzy)
            unsafe = {e for e in clean if clean[e] > 1 and clean[e] > 0.1 * seen[e]}
            if not unsafe:
                break
            limits = {e: 0 if e in unsafe else k for e, k in limits.items()}
            tone = learned_tone(sample, limits)
    if rows.empty:
        return Model(Automaton(limits), PRIOR, tone)
    x, y = np.stack(rows["counts"]), rows["toxic"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # sums don't depend on the order in which rows came
    return Model(Automaton(limits), logistic(strength(x[order]), y[order]), tone)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, exact, misspelt, quoted, address) of every whole text."""
    small_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    limits, weights, tone = model.automaton.limits, model.weights, model.tone

    def run(batches):
        own = Model(Automaton(limits), weights, tone)
        for b in sliced(batches):
            counts = np.stack([hits(t, own.automaton, tone)[0] for t in b.column(1).to_pylist()]) if b.num_rows else np.empty((0, len(FEATURES)))
            columns = [pa.array(counts[:, i].astype(np.int64)) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own.score(counts)), *columns], ["id", "score", *FEATURES])

    id_type = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {id_type}, score double, " + ", ".join(f"{f} long" for f in FEATURES))


def held_out(id_col: Column, folds: int = 3) -> Column:
    """Rows that are not learned from: those whose crc32 of the id as text is 1 modulo ``folds``."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 1, F.lit(False))
