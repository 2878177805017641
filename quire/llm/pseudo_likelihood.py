"""Masked pseudo-likelihood: every token is predicted from the tokens on both sides.

Tokens are the words of the whole text, in lower case (ASCII).  Their counts are taken
over all documents.  The ``VOCAB`` most frequent words are dealt into classes of nearly
equal mass, the most frequent ones into classes of their own; every other word belongs
to one of ``RARE`` classes by the hash of its ending.

    log p(word | both sides) = log p(class | both sides) + log p(word | class, both sides)

Both terms come from a window network written in numpy: embeddings of the two words
before and the two words after, weighted by place, are summed, then tanh; the masked word
itself is no input.  Every word of the vocabulary has an embedding of its own, other
words that of their class.  The first term is a softmax over classes; the second one a
product of binary decisions down a tree over the words of the class, whose biases start
at the corpus counts.  Words beyond the vocabulary are predicted within their class by
their exact corpus counts, which stay a distributed table and are joined to the different
words of each text.  A document's score is the sum over its words.

Training reads every word of every document once: documents are dealt by a hash of their
rows into ``ROUNDS`` parts and each part into shards, whose number follows from the number of words alone (``shards``).
In a round every shard trains from the same weights on its documents, in the order of
their hashes, and the weights are averaged by the number of windows, ``FAN`` at a time in the
order of the shards, so that the driver receives one set of them.  What a shard sends are its changes, of tables
the rows that it met.  So the trained network
doesn't depend on how the input is partitioned.

Defined results: a null text, or one without words, has no tokens, sum 0 and a null mean;
very long texts are scored whole; words of equal count enter the vocabulary in the order of
their bytes; repeated rows score alike; null ids pass through; an empty table gives an empty
result; other columns are ignored.  Scores of the same documents, partitioned otherwise,
differ by rounding of 32-bit numbers only.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import release, sliced, small_batches, written

VOCAB, CLASSES, RARE = 32_768, 64, 32
SIDE, HIDDEN, ROUNDS, MINIBATCH, RATE, TABLE_RATE = 2, 32, 3, 4_096, 0.004, 0.05
#: Words counted, and words scored, at once by a task; words kept in a cache; weights averaged at once, averages sent to the driver.
HELD, WINDOWS, CACHED, FAN, AVERAGES = 250_000, 2_048, 100_000, 16, 1
#: Shards of a round unless they are many or few words: words of a shard, at most and about at least.
SHARDS, SHARD_MOST, SHARD_LEAST = 32, 16_000_000, 65_536
OUT = CLASSES + RARE
#: Weights of which a minibatch meets some rows only.
TABLES = (0, 5, 6)
PAD = OUT  # the class beyond either end of a text


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def rare_class(word: bytes) -> int:
    return CLASSES + zlib.crc32(word[-2:]) % RARE


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents of the column text."""

    def run(batches):
        counts: Counter = Counter()

        def rows():
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()

        for b in sliced(batches):
            for text in b.column(0).to_pylist():
                counts.update(words(text))
                if len(counts) > HELD:
                    yield from rows()
        if counts:
            yield from rows()

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary(dict):
    """Word to its index in the arrays; other words get the index of their rare class.

    ``logp``: log p(word | class) by the counts; of other words without their own count.
    ``inputs``: rows of the embeddings.  ``lo``, ``hi``: the indices that a word's class
    holds.  ``odds``: log odds of the tree's decisions by the counts; a decision is
    named by the first index of its right side.
    """

    def __init__(self, known: list[tuple[bytes, int]], rare: dict[int, int]):
        mass = np.sqrt([n for _, n in known])
        cut = np.minimum((np.cumsum(mass) - mass) / max(mass.sum(), 1) * CLASSES, CLASSES - 1).astype(int) if known else np.empty(0, int)
        total = np.bincount(cut, [n for _, n in known], CLASSES) if known else np.ones(CLASSES)
        self.size = len(known)
        self.classes = np.concatenate([cut, np.arange(CLASSES, OUT)])
        beyond = np.array([rare.get(c, 1) for c in range(CLASSES, OUT)], float)
        self.logp = np.concatenate([np.log(np.array([n for _, n in known]) / total[cut]) if known else [], -np.log(beyond)])
        self.inputs = np.concatenate([OUT + 1 + np.arange(len(known)), np.arange(CLASSES, OUT)])
        own = np.arange(len(known), len(known) + RARE)
        self.lo = np.concatenate([np.searchsorted(cut, cut), own])
        self.hi = np.concatenate([np.searchsorted(cut, cut, "right"), own + 1])
        self.odds = np.zeros(max(1, len(known)), np.float32)
        mass = np.concatenate([[0], np.cumsum([n for _, n in known])])
        for _, mid, _, lo, hi in decisions(np.arange(len(known)), self.lo, self.hi):
            self.odds[mid] = np.log((mass[hi] - mass[mid]) / (mass[mid] - mass[lo]))
        super().__init__((w, i) for i, (w, _) in enumerate(known))

    def __missing__(self, word: bytes) -> int:
        if len(self) > VOCAB + CACHED:
            for w in [w for w, i in self.items() if i >= self.size]:
                del self[w]
        i = self[word] = self.size + rare_class(word) - CLASSES
        return i

    def __reduce__(self):
        known = {w: i for w, i in self.items() if i < self.size}
        return _restored, (known, dict(vars(self)))


def _restored(known: dict, held: dict) -> Vocabulary:
    v = Vocabulary([], {})
    vars(v).update(held)
    v.update(known)
    return v


def decisions(words: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Level by level down the trees: (places in ``words``, decision, whether right, range of indices)."""
    at = np.flatnonzero(hi[words] - lo[words] > 1)
    words, lo, hi = words[at], lo[words[at]], hi[words[at]]
    while len(at):
        mid = (lo + hi) // 2
        right = words >= mid
        yield at, mid, right, lo, hi
        lo, hi = np.where(right, mid, lo), np.where(right, hi, mid)
        on = hi - lo > 1
        at, words, lo, hi = at[on], words[on], lo[on], hi[on]


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the corpus counts; ``VOCAB`` words and ``RARE`` totals come to the driver."""
    known = [(bytes(w), n) for w, n in counts.orderBy(F.desc("n"), "word").limit(VOCAB).collect()]
    rest = counts
    if len(known) == VOCAB:
        w, n = known[-1]
        rest = counts.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > F.lit(w))))
        end = F.expr(f"{CLASSES} + crc32(substring(word, greatest(octet_length(word) - 1, 1), 2)) % {RARE}").cast("int")
        rare = dict(map(tuple, rest.groupBy(end.alias("c")).agg(F.sum("n")).collect()))
    else:
        rare = {}
    return Vocabulary(known, rare)


class Network:
    """Weighted sum of side embeddings, tanh, softmax over classes, a tree of decisions over a class's words."""

    def __init__(self, seed: int = 7, inputs: int = OUT + 1, odds: np.ndarray | None = None):
        rng = np.random.default_rng(seed)
        f = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        gates = 1 + f(2 * SIDE, HIDDEN)
        self.w = [f(inputs, HIDDEN), gates, np.zeros(HIDDEN, np.float32), f(HIDDEN, OUT), np.zeros(OUT, np.float32)]
        if odds is not None:
            self.w += [np.zeros((len(odds), HIDDEN), np.float32), odds.astype(np.float32)]

    def hidden(self, sides: np.ndarray) -> np.ndarray:
        e, g = self.w[:2]
        h = e.take(sides[0], 0)
        h *= g[0]
        for k in range(1, 2 * SIDE):
            x = e.take(sides[k], 0)
            x *= g[k]
            h += x
        h += self.w[2]
        return np.tanh(h, out=h)

    def log_probs(self, sides: np.ndarray, target: np.ndarray, words: np.ndarray | None = None, v: Vocabulary | None = None) -> np.ndarray:
        """log p(target class | sides), with ``words`` that of the words in their classes, too.

        ``sides`` has a row for each place of the window.
        """
        out = np.empty(len(target), np.float32)
        by = ordered(target if words is None else words)  # decisions are met by neighbours then
        for i in range(0, len(target), WINDOWS):
            some = by[i : i + WINDOWS]
            t = target[some]
            h = self.hidden(sides[:, some])
            z = self._logits(h)
            own = z[np.arange(len(t)), t]
            np.exp(z, out=z)
            own = own - np.log(z @ np.ones(OUT, np.float32))
            if words is not None:
                for at, mid, right, _, _ in decisions(words[some], v.lo, v.hi):
                    x = np.einsum("ij,ij->i", self.w[5].take(mid, 0), h if len(at) == len(h) else h.take(at, 0)) + self.w[6].take(mid)
                    x[right] *= -1
                    own[at] -= np.maximum(x, 0) + np.log(1 + np.exp(-np.abs(x)))
            out[some] = own
        return out

    def _logits(self, h: np.ndarray) -> np.ndarray:
        """Logits whose exponentials are finite: the largest is subtracted where the weights allow large ones."""
        z = h @ self.w[3]
        z += self.w[4]
        if np.abs(self.w[3]).sum(0).max() + np.abs(self.w[4]).max() > 80:
            z -= z.max(1, keepdims=True)
        return z

    def sparse_gradients(self, sides: np.ndarray, target: np.ndarray, words: np.ndarray | None = None, v: Vocabulary | None = None) -> list:
        """Gradients of the mean loss; those of tables as (rows, gradients of the rows).

        Windows are taken in the order of their words: those of a decision follow each other then, on every level.
        """
        if words is not None:
            by = ordered(words)
            sides, target, words = sides[:, by], target[by], words[by]
        n = np.float32(len(target))
        e, g = self.w[:2]
        around = [e.take(some, 0) for some in sides]
        h = around[0] * g[0]
        for x, gate in zip(around[1:], g[1:]):
            h += x * gate
        h += self.w[2]
        np.tanh(h, out=h)
        z = self._logits(h)
        np.exp(z, out=z)
        z /= (z @ np.ones(OUT, np.float32))[:, None]
        z[np.arange(len(target)), target] -= 1
        z /= n
        d, tree = z @ self.w[3].T, []
        if words is not None:
            rows, sums, errors = [np.empty(0, np.int64)], [np.empty((0, HIDDEN), np.float32)], [np.empty(0, np.float32)]
            for at, mid, right, _, _ in decisions(words, v.lo, v.hi):
                first = np.flatnonzero(np.concatenate([[True], mid[1:] != mid[:-1]]))
                t, own = self.w[5].take(mid, 0), h if len(at) == len(h) else h.take(at, 0)
                x = np.einsum("ij,ij->i", t, own) + self.w[6].take(mid)
                error = ((0.5 + 0.5 * np.tanh(0.5 * x) - right) / n).astype(np.float32)
                t *= error[:, None]
                d[at] += t
                rows.append(mid[first])
                sums.append(np.add.reduceat(np.multiply(own, error[:, None], out=t), first, axis=0))
                errors.append(np.add.reduceat(error, first))
            rows = np.concatenate(rows)  # a decision is met on one level only
            tree = [(rows, np.concatenate(sums)), (rows, np.concatenate(errors))]
        d *= 1 - h * h
        gates = np.stack([np.einsum("ij,ij->j", d, x) for x in around])
        for x, gate in zip(around, g):
            np.multiply(d, gate, out=x)
        return [summed(sides.ravel(), np.concatenate(around)), gates, d.sum(0), h.T @ z, z.sum(0), *tree]

    def gradients(self, sides: np.ndarray, target: np.ndarray, words: np.ndarray | None = None, v: Vocabulary | None = None) -> list[np.ndarray]:
        out = []
        for w, g in zip(self.w, self.sparse_gradients(sides, target, words, v)):
            if isinstance(g, tuple):
                (rows, some), g = g, np.zeros_like(w)
                g[rows] = some
            out.append(g)
        return out


def ordered(rows: np.ndarray) -> np.ndarray:
    """The stable order of numbers from 0; of short ones by radix."""
    return np.argsort(rows.astype(np.uint16) if len(rows) and rows.max() < 1 << 16 else rows, kind="stable")


def summed(rows: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows, and the sum of ``x`` for each."""
    if not len(rows):
        return rows, x
    order = ordered(rows)
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return rows[first], np.add.reduceat(x.take(order, 0), first, axis=0)


class Adam:
    """Adam for small weights; for tables Adagrad with one sum for each row, as a minibatch meets few rows."""

    def __init__(self, net: Network):
        self.net, self.t = net, 0
        self.m, self.v = [np.zeros_like(x) for x in net.w[1:5]], [np.zeros_like(x) for x in net.w[1:5]]
        self.sums = {i: np.zeros(len(net.w[i]), np.float32) for i in TABLES if i < len(net.w)}

    def step(self, sides: np.ndarray, target: np.ndarray, words: np.ndarray, v: Vocabulary) -> None:
        self.t += 1
        rate = RATE * (1 - 0.999**self.t) ** 0.5 / (1 - 0.9**self.t)
        found = self.net.sparse_gradients(sides, target, words, v)
        for w, g, m, s in zip(self.net.w[1:5], found[1:5], self.m, self.v):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            w -= rate * m / (np.sqrt(s) + 1e-8)
        for i, sums in self.sums.items():
            rows, g = found[i]
            sums[rows] += (g * g).mean(1) if g.ndim > 1 else g * g
            scale = TABLE_RATE / (np.sqrt(sums[rows]) + 1e-8)
            self.net.w[i][rows] -= g * (scale[:, None] if g.ndim > 1 else scale)


def windows(indices: list[np.ndarray], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``classes`` (or input rows) at the places around every word, and the words' own; texts don't see each other."""
    gap = np.full(SIDE, PAD, np.int64)
    line = np.concatenate([gap, *(x for i in indices for x in (classes[i], gap))])
    inside = np.concatenate([np.zeros(SIDE, bool), *(np.repeat([True, False], [len(i), SIDE]) for i in indices)])
    at = np.flatnonzero(inside)
    return np.stack([line[at + k] for k in (*range(-SIDE, 0), *range(1, SIDE + 1))]), line[at]


def _batched(batches, vocab: Vocabulary, most: int = 65_536):
    """Ids, word indices and words beyond the vocabulary of whole texts, in lists of about ``most`` words; a longer text is one list."""
    rows, held, beyond, size = [], [], [], 0
    for b in sliced(batches):
        for i, text in enumerate(b.column(1).to_pylist()):
            w = words(text)
            rows.append(b.column(0)[i])
            held.append(np.fromiter(map(vocab.__getitem__, w), np.int64, len(w)))
            beyond.append(Counter(w[k] for k in np.flatnonzero(held[-1] >= vocab.size)))
            size += len(w)
            if size >= most:
                yield rows, held, beyond
                rows, held, beyond, size = [], [], [], 0
    if held:
        yield rows, held, beyond


def shards(n_words: int) -> int:
    """Shards of a round: 32, fewer if they had few words, and more if they had too many."""
    ceil = lambda most: -(-n_words // (ROUNDS * most))
    return max(1, min(SHARDS, ceil(SHARD_LEAST)), ceil(SHARD_MOST))


def _indices(texts, vocab: Vocabulary, most: int):
    """Word indices of whole texts, in lists of about ``most`` words."""
    held, size = [], 0
    for text in texts:
        w = words(text)
        held.append(np.fromiter(map(vocab.__getitem__, w), np.int64, len(w)))
        size += len(w)
        if size >= most:
            yield held
            held, size = [], 0
    if size:
        yield held


def _trainer(vocab, weights):
    """Rows (shard, text) in the order of the shards to the weights that each shard trained."""

    def run(batches):
        v = vocab.value
        rows = (row for b in sliced(batches) for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for shard, own in groupby(rows, key=lambda row: row[0]):
            net: Network = pickle.loads(weights.value)
            base = [x.copy() for x in net.w]
            adam, seen = Adam(net), 0
            for held in _indices((text for _, text in own), v, 16 * MINIBATCH):
                sides, _ = windows(held, v.inputs)
                flat = np.concatenate(held)
                target = v.classes[flat]
                order = np.random.default_rng(seen).permutation(len(target))
                for i in range(0, len(order), MINIBATCH):
                    some = order[i : i + MINIBATCH]
                    adam.step(sides[:, some], target[some], flat[some], v)
                seen += len(target)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([seen], pa.int64()), pa.array([pickle.dumps(changes(base, net.w))], pa.binary())], ["shard", "n", "w"])

    return run


def changes(base: list[np.ndarray], w: list[np.ndarray]) -> list:
    """What training added to the weights: of tables the rows that it met, as (rows, what was added to them)."""
    out = [new - old for old, new in zip(base, w)]
    for i in TABLES:
        if i < len(out):
            rows = np.flatnonzero(out[i].reshape(len(out[i]), -1).any(1))
            out[i] = rows.astype(np.int32), out[i][rows]
    return out


def changed(base: list[np.ndarray], found: list) -> list[np.ndarray]:
    """Weights with changes added."""
    out = []
    for x, d in zip(base, found):
        x = x.copy()
        if isinstance(d, tuple):
            x[d[0]] += d[1]
        else:
            x += d
        out.append(x.astype(np.float32))
    return out


def _mean(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
    """The mean of changes, weighted by the number of windows; a row that a shard didn't meet has no change there."""
    t = t.sort_values("shard")
    total, n = None, int(t["n"].sum())
    for w, k in zip(t["w"], t["n"]):
        k = np.float32(k / n)
        part = [(x[0], x[1] * k) if isinstance(x, tuple) else x * k for x in pickle.loads(w)]
        if total is None:
            total = part
        else:
            both = zip(total, part)
            total = [summed(*(np.concatenate(x) for x in zip(a, b))) if isinstance(a, tuple) else a + b for a, b in both]
    return pd.DataFrame({"shard": [int(key[0])], "n": [n], "w": [pickle.dumps(total)]})


def train(docs: DataFrame, vocab, n_words: int) -> Network:
    """``docs`` has id and text and ``n_words`` words; ``vocab`` is a broadcast vocabulary."""
    v, spark = vocab.value, docs.sparkSession
    net, each = Network(inputs=OUT + 1 + v.size, odds=v.odds), shards(n_words)
    keyed = docs.where("text is not null").select("text", F.xxhash64("id", "text", F.lit(23)).alias("h"))
    part = F.pmod("h", F.lit(ROUNDS * each))
    keyed = keyed.select((part % ROUNDS).alias("round"), F.expr(f"cast(pmod(h, {ROUNDS * each}) div {ROUNDS} as int)").alias("shard"), "h", "text")
    for r in range(ROUNDS):
        weights = spark.sparkContext.broadcast(pickle.dumps(net))
        mine = keyed.where(f"round = {r}").select("shard", "h", "text").repartitionById(each, "shard").sortWithinPartitions("shard", "h", "text")
        means = mine.select("shard", "text").mapInArrow(_trainer(vocab, weights), "shard long, n long, w binary")
        left = each
        while True:  # a task holds about FAN weights, whatever the number of shards
            left = max(AVERAGES, -(-left // FAN))
            means = means.groupBy(F.expr(f"shard % {left}").alias("g")).applyInPandas(_mean, "shard long, n long, w binary")
            if left == AVERAGES:
                break
        means = means.toPandas()
        weights.unpersist()
        if len(means):
            net.w = changed(net.w, pickle.loads(_mean((0,), means)["w"][0]))
        del mine, means
        release(spark)  # what all shards sent
    return net


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, log_prob, mean_log_prob): the pseudo-likelihood of every whole text."""
    spark = docs.sparkSession
    small_batches(spark)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = written(word_counts(picked), "word-counts")
    vocab = spark.sparkContext.broadcast(vocabulary(counts))
    n_words = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    weights = spark.sparkContext.broadcast(pickle.dumps(train(picked, vocab, n_words)))

    def run(batches):
        net, v = pickle.loads(weights.value), vocab.value
        done, first = 0, TaskContext.get().partitionId() << 33
        for rows, held, beyond in _batched(batches, v):
            sides, _ = windows(held, v.inputs)
            flat = np.concatenate(held)
            own = net.log_probs(sides, v.classes[flat], flat, v).astype(np.float64) + np.where(flat < v.size, 0, v.logp[flat])
            logp = np.concatenate([[0.0], np.cumsum(own)])
            n = np.array([len(x) for x in held])
            end = np.cumsum(n)
            ids = pa.array([x.as_py() for x in rows], rows[0].type)
            key = pa.array(first + done + np.arange(len(rows)))
            done += len(rows)
            lists = [pa.array([list(x) for x in beyond], pa.list_(pa.binary())), pa.array([list(x.values()) for x in beyond], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([ids, key, pa.array(n), pa.array(logp[end] - logp[end - n]), *lists], ["id", "key", "n_tokens", "part", "words", "times"])

    id_type = picked.schema["id"].dataType.simpleString()
    scored = written(picked.mapInArrow(run, f"id {id_type}, key long, n_tokens long, part double, words array<binary>, times array<long>"), "scored")
    # The exact counts of words beyond the vocabulary; decimals, so that sums don't depend on their order.
    beyond = scored.select("key", F.explode(F.arrays_zip("words", "times")).alias("x")).select("key", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    own = (F.col("times") * F.ln("n")).cast("decimal(28,12)")
    sums = beyond.join(counts, "word").groupBy("key").agg(F.sum(own).cast("double").alias("own"))
    total = F.col("part") + F.coalesce("own", F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return scored.join(sums, "key", "left").select("id", "n_tokens", total.alias("log_prob")).withColumn("mean_log_prob", mean)
