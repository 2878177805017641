"""Removal of repeated byte strings by a difference cover and bucket-wise sorting.

A byte goes if a window of ``window`` bytes that covers it also starts anywhere else,
in the same document or in another.  Matches never cross documents.

1. Cover sample.  D is a perfect difference set modulo its period v (Singer's
   construction), so two windows at any two places a and b have an offset d < v for
   which a + d and b + d are both sample positions.  The sample strings are those of
   ``window - v + 1`` bytes that start there; they lie within the windows.  They are
   sorted first, by names, bucket by bucket.  A window that recurs holds a sample string that
   recurs, so sample strings with names of their own rule out all suffixes before them.
2. Only suffixes that start within v before a recurring sample string can tie over a whole
   window.  They are sorted one bucket at a time, in ``BLOCKS`` rounds, by the name of
   their first ``window`` bytes, and each is linked to the one before it of equal name.
3. A name is a 64-bit fingerprint and decides nothing but order.  Links of suffixes that follow each
   other on a diagonal (both ends advance together) are one run, and the bytes of its two
   ends are compared: within a batch at once, between batches by a join, where a run
   carries its bytes once however many windows lie in it.
4. Where bytes differ under one name (a collision), all suffixes of that name are grouped
   by their bytes instead.  So the result is exact for every input.
5. Repeated windows of a document are merged to spans, which are cut.

Memory: a task holds one bucket of entries, or one batch of at most ``BATCH`` suffixes and
the texts they lie in, never the corpus or its suffix array.  Every batch sends a name
once: suffixes that recur within it are settled there, so the entries of a passage that a
third of all documents share are as many as there are batches.

Defined results: a null or empty text has no bytes and no spans; texts shorter than the
window never change; very long texts are treated whole, in parts of a batch; repeated rows are
documents of their own, so their strings repeat; of windows that tie none is kept; null ids
pass through; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import partitions, release, sliced, small_batches, written

WINDOW = 400
#: Suffixes of a batch and bytes of its texts, bytes hashed at once, and keys up to which their table is broadcast.
BATCH, TEXTS, SEGMENT, BROADCAST_KEYS = 2_000_000, 1 << 25, 1 << 16, 2_000_000
#: Rounds of the window names.
BLOCKS = 4
#: Bit of a place that marks an entry as settled within its batch.
SETTLED = np.uint32(1 << 31)
ENTRY = "dest int, kind int, src long, n long, payload binary"
#: Kinds of rows: documents of a batch, places that recur, entries, links between batches, names that collide.
KEYS, PLACES, ENTRIES, LINKS, COLLIDING = range(5)


@lru_cache
def difference_cover(window: int) -> tuple[int, tuple[int, ...]]:
    """(period, offsets): every residue is a difference of two offsets modulo the period.

    The powers of a root x of a cubic over GF(q) that have no x**2 part form a perfect
    difference set modulo q*q + q + 1 when the cubic is suitable; the largest prime q
    whose period is at most half the window is taken.
    """
    primes = [p for p in range(2, int(window**0.5) + 1) if all(p % d for d in range(2, p)) and p * p + p + 1 <= window // 2]
    if not primes:
        return 1, (0,)
    q = primes[-1]
    v = q * q + q + 1
    for k in range(q**3):
        a, b, c = k % q, k // q % q, k // q // q
        x, found = (1, 0, 0), []
        for i in range(v):
            if x[2] == 0:
                found.append(i)
            x = (x[2] * c % q, (x[0] + x[2] * b) % q, (x[1] + x[2] * a) % q)
        if len(found) == q + 1 and len({(i - j) % v for i in found for j in found}) == v:
            return v, tuple(found)
    raise AssertionError("no suitable cubic")


class Names:
    """Fingerprints of the strings of a length that start at given places."""

    FACTOR = 0x9E3779B97F4A7C15

    def __init__(self, length: int):
        self.length = length
        n = SEGMENT + length
        power = lambda x: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)]), dtype=np.uint64)
        self.up, self.down = power(self.FACTOR), power(pow(self.FACTOR, -1, 2**64))
        self.value = np.random.default_rng(400).integers(0, 2**64, 256, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """``starts`` rise, and every string lies within data."""
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            lo = int(starts[at])
            to = int(np.searchsorted(starts, lo + SEGMENT))
            part = data[lo : int(starts[to - 1]) + self.length]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.value[part] * self.up[: len(part)], out=sums[1:])
            s = starts[at:to] - lo
            out[at:to] = (sums[s + self.length] - sums[s]) * self.down[s]
            at = to
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
        return out


def _planes(x: np.ndarray) -> bytes:
    """Byte planes, most significant last: small numbers leave planes of zeros, which compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(data: bytes, n: int, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, n).T).view(kind).reshape(n)


class Batch:
    """Occurrences of names in some documents, as rows for the bucket sort.

    With a ``window`` the names are those of whole windows: what recurs is confirmed by
    bytes.  Without, they are of sample strings, of which only the different ones matter.
    """

    def __init__(self, buckets: int, most: int, window: int = 0, block: int = 0):
        self.buckets, self.most, self.window, self.block, self.no = buckets, most, window, block, 0
        self.clear()

    def clear(self):
        self.keys, self.names, self.doc, self.at, self.data, self.size, self.held = [], [], [], [], [], 0, 0

    def add(self, key: tuple[int, int], names: np.ndarray, starts: np.ndarray, data: np.ndarray, size: int) -> None:
        """``size``: suffixes of all rounds, so that batches are the same in each."""
        self.doc.append(np.full(len(names), len(self.keys), np.uint16))
        self.keys.append(key)
        self.names.append(names)
        self.at.append(starts.astype(np.uint32))
        self.size += size
        if self.window:
            self.data.append(data)
            self.held += len(data)

    def full(self) -> bool:
        return self.size >= self.most or self.held >= TEXTS or len(self.keys) >= 60_000

    def equal(self, doc: np.ndarray, at: np.ndarray, doc2: np.ndarray, at2: np.ndarray) -> np.ndarray:
        """Whether the windows at both places have the same bytes, compared run by run."""
        out = np.ones(len(doc), bool)
        order = np.lexsort((at, doc))
        runs = _runs(doc[order], at[order].astype(np.int64), at2[order].astype(np.int64), self.window, doc2[order])
        for lo, hi in zip(*(x.tolist() for x in runs)):
            some = order[lo:hi]
            a, b = at[some].astype(np.int64), at2[some].astype(np.int64)
            n = int(a[-1] - a[0]) + self.window
            differ = self.data[doc[some[0]]][a[0] : a[0] + n] != self.data[doc2[some[0]]][b[0] : b[0] + n]
            if differ.any():
                sums = np.concatenate([[0], np.cumsum(differ)])
                out[some] = sums[a - a[0] + self.window] == sums[a - a[0]]
        return out

    def rows(self):
        if not self.size:
            return self.clear()
        src = (TaskContext.get().partitionId() << 24) + self.no
        self.no += 1
        names, doc, at = map(np.concatenate, (self.names, self.doc, self.at))
        order = np.argsort(names, kind="stable")
        names, doc, at = names[order], doc[order], at[order]
        new = np.concatenate([[True], names[1:] != names[:-1]])[: len(names)]
        later = np.flatnonzero(~new)
        out = []
        if self.block == 0:
            out.append((src % self.buckets, KEYS, src, len(self.keys), np.array(self.keys, np.int64).T.tobytes()))
        if self.window and len(later):
            same = self.equal(doc[later], at[later], doc[later - 1], at[later - 1])
            colliding = np.unique(names[later[~same]])
            later = later[same]
            if len(colliding):
                out.append((src % self.buckets, COLLIDING, src, len(colliding), colliding.tobytes()))
        again = np.zeros(len(names), bool)
        again[later] = again[later - 1] = True
        if again.any():
            out.append((src % self.buckets, PLACES, src, int(again.sum()), doc[again].tobytes() + _planes(at[again])))
        at = np.where(again, at | SETTLED, at)[new]
        names, doc = names[new], doc[new]
        cut = np.searchsorted(names, np.array([-(-(i << 64) // self.buckets) for i in range(1, self.buckets)], np.uint64))
        for i, (lo, hi) in enumerate(zip([0, *cut.tolist()], [*cut.tolist(), len(names)])):
            if hi > lo:
                steps = np.diff(names[lo:hi], prepend=np.uint64(0))
                out.append((i, ENTRIES, src, hi - lo, _planes(steps) + doc[lo:hi].tobytes() + _planes(at[lo:hi])))
        self.clear()
        for i in range(0, len(out), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + 64]), _TYPES)], _COLS)


def _runs(doc: np.ndarray, at: np.ndarray, at2: np.ndarray, window: int, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of the runs of pairs, sorted by (doc, at), whose windows overlap on one diagonal; ``same`` must not change."""
    new = np.ones(len(doc), bool)
    if len(doc):
        step = np.diff(at)
        new[1:] = (np.diff(doc.astype(np.int64)) != 0) | (step > window) | (step != np.diff(at2))
        for x in same:
            new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return first, np.concatenate([first[1:], [len(doc)]])[: len(first)]


_COLS = ["dest", "kind", "src", "n", "payload"]
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]


def _sorted_bucket(rows: list, linked: bool) -> list:
    """Entries of one bucket to the places, or the links, of those names that recur."""
    rows.sort(key=lambda r: r[0])
    names = np.concatenate([np.cumsum(_unplanes(p[: 8 * n], n, "<u8"), dtype=np.uint64) for _, n, p in rows])
    doc = np.concatenate([np.frombuffer(p, "<u2", n, 8 * n) for _, n, p in rows])
    at = np.concatenate([_unplanes(p[10 * n :], n, "<u4") for _, n, p in rows])
    of = np.repeat(np.arange(len(rows)), [n for _, n, _ in rows])
    open_ = at < SETTLED
    at &= ~SETTLED
    order = np.argsort(names, kind="stable")
    same = names[order][1:] == names[order][:-1]
    later, before = order[1:][same], order[:-1][same]
    out = []
    if linked:
        some = open_[later] | open_[before]
        later, before = later[some], before[some]
        order = np.lexsort((at[later], doc[later], of[later]))
        later, before = later[order], before[order]
        sources = np.array([r[0] for r in rows])
        for lo, hi in _groups(of[later]):
            e, p = later[lo:hi], before[lo:hi]
            steps = np.diff(at[e].astype(np.int64), prepend=0).astype("<u4"), (at[p].astype(np.int64) - at[e]).astype("<i4")
            payload = doc[e].tobytes() + doc[p].tobytes() + b"".join(map(_planes, (*steps, sources[of[p]])))
            out.append((0, LINKS, rows[of[e[0]]][0], hi - lo, payload))
    else:
        recurs = np.zeros(len(names), bool)
        recurs[later] = recurs[before] = True
        here = np.flatnonzero(recurs & open_)
        for lo, hi in _groups(of[here]):
            some = here[lo:hi]
            out.append((0, PLACES, rows[of[some[0]]][0], hi - lo, doc[some].tobytes() + _planes(at[some])))
    return out


def _groups(keys: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal keys that follow each other."""
    if not len(keys):
        return []
    edge = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    return list(zip(edge[:-1], edge[1:]))


def _sort_buckets(linked: bool):
    def run(batches):
        held, dest = [], None

        def done():
            if held:
                out = _sorted_bucket(held, linked)
                for i in range(0, len(out), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i : i + 64]), _TYPES)], _COLS)
                held.clear()

        for b in batches:
            for d, kind, src, n, payload in zip(*(c.to_pylist() for c in b.columns)):
                if kind != ENTRIES:
                    yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((d, kind, src, n, payload), _TYPES)], _COLS)
                    continue
                if d != dest:
                    yield from done()
                    dest = d
                held.append((src, n, payload))
        yield from done()

    return run


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of half-open spans, given by rising starts, that touch or overlap."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])]


def _packed(starts: np.ndarray, ends: np.ndarray) -> list[int]:
    """Spans as numbers: start in the upper half, end in the lower."""
    return ((starts << 32) + ends).tolist()


def _union(spans) -> tuple[np.ndarray, np.ndarray]:
    both = np.sort(np.array(spans, np.int64))
    return merged(both >> 32, both & 0xFFFFFFFF)


_SOURCE = "kind int, u1 long, u2 long, spans array<long>, src long, doc int, at long, n long, pat long"
_SOURCE_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def _by_source(before: int, after: int, window: int):
    """Batch by batch its documents (kind KEYS), their spans [p - before, p + after) about places (PLACES), and its links as runs (LINKS).

    src, doc and pat of a run are those of its other end; n is its number of bytes.
    """

    def rows(kind, size, **columns):
        names = [c.split()[0] for c in _SOURCE.split(", ")]
        cols = {"kind": [kind] * size, **columns}
        return pa.RecordBatch.from_arrays([pa.array(cols[c], t) if c in cols else pa.nulls(size, t) for c, t in zip(names, _SOURCE_TYPES)], names)

    def run(batches):
        src, keys, found, links = None, None, [], []

        def done():
            if keys is None:
                return
            if window:
                n = keys.shape[1]
                yield rows(KEYS, n, u1=keys[0], u2=keys[1], src=[src] * n, doc=list(range(n)))
            if found:
                doc = np.concatenate([np.frombuffer(p, "<u2", n) for n, p in found])
                at = np.concatenate([_unplanes(p[2 * n :], n, "<u4") for n, p in found])
                order = np.lexsort((at, doc))
                doc, at = doc[order], at[order].astype(np.int64)
                which, spans = [], []
                for lo, hi in _groups(doc):
                    which.append(int(doc[lo]))
                    spans.append(_packed(*merged(np.maximum(at[lo:hi] - before, 0), at[lo:hi] + after)))
                yield rows(PLACES, len(which), u1=keys[0][which], u2=keys[1][which], spans=spans)
            if links:
                doc, doc2 = (np.concatenate([np.frombuffer(p, "<u2", n, i * n) for n, p in links]) for i in (0, 2))
                at = np.concatenate([np.cumsum(_unplanes(p[4 * n : 8 * n], n, "<u4"), dtype=np.uint32) for n, p in links]).astype(np.int64)
                at2 = at + np.concatenate([_unplanes(p[8 * n : 12 * n], n, "<i4") for n, p in links])
                src2 = np.concatenate([_unplanes(p[12 * n :], n, "<i8") for n, p in links])
                order = np.lexsort((at, doc))
                doc, doc2, at, at2, src2 = (x[order] for x in (doc, doc2, at, at2, src2))
                lo, hi = _runs(doc, at, at2, window, doc2, src2)
                some = doc[lo]
                yield rows(
                    LINKS, len(lo), u1=keys[0][some], u2=keys[1][some], src=src2[lo], doc=doc2[lo].astype(np.int32),
                    at=at[lo], n=at[hi - 1] + window - at[lo], pat=at2[lo],
                )

        for b in batches:
            for kind, s, n, payload in zip(*(b.column(c).to_pylist() for c in ("kind", "src", "n", "payload"))):
                if s != src:
                    yield from done()
                    src, keys, found, links = s, None, [], []
                if kind == KEYS:
                    keys = np.frombuffer(payload, np.int64).reshape(2, n)
                elif kind != COLLIDING:
                    (found if kind == PLACES else links).append((n, payload))
        yield from done()

    return run


def _recurring(entries: DataFrame, name: str, linked: bool = False) -> DataFrame:
    """Places, or links, of the names that recur, in rows like the entries'."""
    n = partitions(entries.sparkSession)
    sorted_ = entries.repartition(n, "dest").sortWithinPartitions("dest").mapInArrow(_sort_buckets(linked), ENTRY)
    places = written(sorted_, name)
    del sorted_
    release(entries.sparkSession)
    return places


def _sources(places: DataFrame, before: int, after: int, window: int) -> DataFrame:
    n = partitions(places.sparkSession)
    return places.repartition(n, "src").sortWithinPartitions("src", "kind").mapInArrow(_by_source(before, after, window), _SOURCE)


def _by_document(spans: DataFrame) -> DataFrame:
    return spans.groupBy("u1", "u2").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _sample_names(window: int, buckets: int, most: int):
    period, offsets = difference_cover(window)

    def run(batches):
        names, batch, base = Names(window - period + 1), Batch(buckets, most), np.array(offsets, np.int64)
        block = (np.arange(BATCH // 2 // len(base) + 1)[:, None] * period + base).ravel()
        wide = (BATCH // 2 // len(base) + 1) * period
        for b in sliced(batches):
            for u1, u2, text in zip(*(c.to_pylist() for c in b.columns)):
                data = np.frombuffer(text, np.uint8)
                if len(data) < window:
                    continue
                last = len(data) - names.length
                for lo in range(0, last + 1, wide):
                    starts = block[: np.searchsorted(block, last - lo + 1)] + lo
                    if len(starts):
                        batch.add((u1, u2), names(data, starts), starts, data, len(starts))
                    if batch.full():
                        yield from batch.rows()
        yield from batch.rows()

    return run


def _suffixes(batches, window: int):
    """(u1, u2, data, starts, names) of the suffixes that may tie, in parts."""
    names = Names(window)
    for b in sliced(batches):
        for u1, u2, text, spans in zip(*(c.to_pylist() for c in b.columns)):
            data = np.frombuffer(text, np.uint8)
            for lo, hi in zip(*(x.tolist() for x in _union(spans))):
                hi = min(hi, len(data) - window + 1)
                for at in range(lo, hi, BATCH // 2):
                    starts = np.arange(at, min(hi, at + BATCH // 2))
                    yield u1, u2, data, starts, names(data, starts)


def _window_names(window: int, buckets: int, most: int, block: int):
    def run(batches):
        batch = Batch(buckets, most, window, block)
        for u1, u2, data, starts, found in _suffixes(batches, window):
            mine = found % np.uint64(BLOCKS) == block
            batch.add((u1, u2), found[mine], starts[mine], data, len(starts))
            if batch.full():
                yield from batch.rows()
        yield from batch.rows()

    return run


def _names_of(window: int):
    """Rows (u1, u2, text, spans) to (name, u1, u2, at), one for each suffix in the spans."""

    def run(batches):
        for u1, u2, _, starts, found in _suffixes(batches, window):
            for i in range(0, len(starts), 50_000):
                n = len(starts[i : i + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(found[i : i + n].view(np.int64)), pa.array([u1] * n), pa.array([u2] * n), pa.array(starts[i : i + n])], ["name", "u1", "u2", "at"])

    return run


def _colliding(batches):
    for b in batches:
        for payload in b.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(payload, np.int64))], ["name"])


def _span(at: str, end: str):
    return F.expr(f"array(shiftleft({at}, 32) + {end})").alias("spans")


def _few(df: DataFrame) -> DataFrame:
    """For a written table: broadcast if its rows are few, else joined by shuffling."""
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS else df


def _by_bytes(some: DataFrame, names: DataFrame, window: int) -> DataFrame:
    """(u1, u2, spans) of windows that recur, exactly, among all windows with the given names."""
    places = some.select("u1", "u2", "text", "spans").mapInArrow(_names_of(window), "name long, u1 long, u2 long, at long").join(_few(names), "name")
    there = F.expr(f"substring(text, cast(at as int) + 1, {window})").alias("bytes")
    held = written(places.join(some.select("u1", "u2", "text"), ["u1", "u2"]).select("u1", "u2", "at", there), "repeats-bytes")
    again = held.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bytes")
    return held.join(again, "bytes").select("u1", "u2", _span("at", f"(at + {window})"))


def _repeated_spans(some: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """(u1, u2, spans): what recurs, each link confirmed by its bytes."""
    rows = written(_sources(found, 0, window, window), "repeats-runs")
    keys = rows.where(f"kind = {KEYS}").select("src", "doc", F.col("u1").alias("p1"), F.col("u2").alias("p2"))
    links = rows.where(f"kind = {LINKS}").select(F.monotonically_increasing_id().alias("link"), "u1", "u2", "at", "n", "src", "doc", "pat").join(keys, ["src", "doc"])
    ends = links.select("link", "n", F.explode(F.expr("array(struct(u1, u2, at), struct(p1 as u1, p2 as u2, pat as at))")).alias("x")).select("link", "n", "x.*")
    ends = written(ends, "repeats-ends")
    there = F.expr("substring(text, cast(at as int) + 1, cast(n as int))").alias("bytes")
    compared = ends.join(some.select("u1", "u2", "text"), ["u1", "u2"]).select("link", there).groupBy("link").agg(F.min("bytes").alias("a"), F.max("bytes").alias("b"))
    unequal = written(compared.where("a <> b").select("link"), "repeats-unequal")
    spans = rows.where(f"kind = {PLACES}").select("u1", "u2", "spans")
    names = found.where(f"kind = {COLLIDING}").select("payload").mapInArrow(_colliding, "name long")
    if unequal.count():
        wrong = ends.join(_few(unequal), "link").select("u1", "u2", _span("at", f"(at + n - {window} + 1)"))
        texts = some.select("u1", "u2", "text").join(_by_document(wrong), ["u1", "u2"])
        names = names.unionByName(texts.select("u1", "u2", "text", "spans").mapInArrow(_names_of(window), "name long, u1 long, u2 long, at long").select("name"))
        ends = ends.join(_few(unequal), "link", "left_anti")
    spans = spans.unionByName(ends.select("u1", "u2", _span("at", "(at + n)")))
    names = written(names.distinct(), "repeats-colliding")
    if names.count():
        spans = spans.unionByName(_by_bytes(some, names, window))
    return written(_by_document(spans), "repeats-spans")


def _cut(batches):
    for b in sliced(batches):
        starts, ends, kept = [], [], []
        for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            s, e = _union(spans) if spans else (np.empty(0, np.int64),) * 2
            e = np.minimum(e, len(text))
            edges = [0, *np.stack([s, e], 1).ravel().tolist(), len(text)]
            starts.append(s.tolist())
            ends.append(e.tolist())
            kept.append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2])))
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(starts, longs), pa.array(ends, longs), pa.array(kept, pa.binary())], ["id", "starts", "ends", "kept"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", batch: int = BATCH) -> DataFrame:
    """One row per document: id, starts and ends of the removed spans, kept (binary).

    ``batch``: suffixes of a batch, which bounds memory and changes no result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    # Two fingerprints of the row are its key: they are defined for null ids, and equal rows share it.
    keyed = docs.select(
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("u1"),
        F.xxhash64(F.col(text_col), F.col(id_col), F.lit(1)).alias("u2"),
        F.col(id_col).alias("id"),
        text.alias("text"),
    )
    buckets, period = 2 * partitions(spark), difference_cover(window)[0]
    long_ = keyed.where(F.octet_length("text") >= window)
    entries = long_.select("u1", "u2", "text").mapInArrow(_sample_names(window, buckets, batch), ENTRY)
    # Written once: off a native library Hadoop's local file system starts a process of the executor's for every file.
    near = written(_by_document(_sources(_recurring(entries, "repeats-sample"), period - 1, 1, 0)), "repeats-near")
    keys = _few(near.select("u1", "u2"))
    rest = keyed.join(keys, ["u1", "u2"], "left_anti")
    # Equal rows are one with a number of copies; all of it recurs if there are more.
    some = keyed.join(keys, ["u1", "u2"], "left_semi").groupBy("u1", "u2").agg(F.first("id").alias("id"), F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    some = written(some.join(near, ["u1", "u2"]), "repeats-text")
    found = None
    for block in range(BLOCKS):
        entries = some.select("u1", "u2", "text", "spans").mapInArrow(_window_names(window, buckets, batch, block), ENTRY)
        part = _recurring(entries, "repeats-windows", linked=True)
        found = part if found is None else found.unionByName(part)
    spans = _repeated_spans(some, found, window)
    cut = some.drop("spans").join(spans, ["u1", "u2"], "left")
    whole = F.expr("if(copies > 1, array(cast(octet_length(text) as bigint)), spans)").alias("spans")
    cut = cut.select("id", "text", whole, F.explode(F.expr("sequence(1, copies)")).alias("copy")).select("id", "text", "spans")
    id_type = keyed.schema["id"].dataType.simpleString()
    cut = cut.mapInArrow(_cut, f"id {id_type}, starts array<long>, ends array<long>, kept binary")
    none = F.array().cast("array<long>")
    rest = rest.select("id", none.alias("starts"), none.alias("ends"), F.col("text").alias("kept"))
    return rest.unionByName(cut)
