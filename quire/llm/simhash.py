"""SimHash near-duplicates: fingerprints, a binary-trie self-join and its components.

Fingerprint: ASCII letters in lower case, words between ASCII white space, shingles of
three words (or another number) with repeats (fewer words: the whole sequence), XXH64 with seed 42; a bit
is set if it is set in over half of the hashes.  A text without words, or null, has
fingerprint zero, which is linked like any other.

Join: documents of one fingerprint are one entry.  If two fingerprints differ in at
most three bits, one of their four 16-bit blocks is equal, so each fingerprint is sent
to four buckets, rotated so that the equal block is on top.  A task holds some buckets
of its partition at a time as one sorted array, which is a binary trie whose nodes are ranges.
Node pairs are traversed together: a pair's children differ by one more bit or none,
and a pair is pruned when its differing bits exceed the budget, or when both subtrees
already lie in one component.  The task returns a spanning forest of the links found,
never all pairs of a group, so its output is linear in its input.

Buckets with more entries than the mean partition are dealt to several tasks: their
entries are split into chunks and every pair of chunks is joined, which finds every
link.  Components of the forests are computed by alternating stars.

Defined results: a null id is kept with its row and never names a component unless no
other id is in it; very long texts are read whole, in parts; a bit that is set in exactly half of the hashes is 0; repeated rows are documents of their own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import partitions, sliced, small_batches, written
from quire.llm.components import connected_components

BITS, BLOCKS, SHINGLE, SEED = 64, 4, 3, 42
#: Hashes whose bits are counted at once, node pairs that are expanded at once.
HASHES, FRONTIER = 1 << 16, 1 << 16
#: A pair of nodes is compared entry by entry when it has at most so many pairs of entries.
SMALL = 16
#: Entries of buckets that a task holds at once.
HELD = 500_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size) + np.arange(len(words))
    k = min(shingle, len(words))
    starts, ends = (ends - size)[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    xx, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for i in range(0, len(starts), HASHES):
        hashes = np.array([xx(joined[a:b], SEED) for a, b in zip(starts[i : i + HASHES], ends[i : i + HASHES])], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of every whole text, as a signed bigint."""
    small_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in sliced(batches):
            fps = np.fromiter((fingerprint(t, shingle) for t in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, fp bigint")


def rotate(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    by = by.astype(np.uint64)
    return (x << by) | (x >> ((np.uint64(BITS) - by) & np.uint64(BITS - 1)))


class Forest:
    """Union-find over 0..n-1; ``root`` is flat after every call."""

    def __init__(self, n: int):
        self.root = np.arange(n, dtype=np.int64)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        r = self.root
        while True:
            x, y = r[a], r[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(r, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := r[r], r):
                r[:] = up

    def breaks(self) -> np.ndarray:
        """Running number of places where neighbours lie in different components."""
        return np.concatenate([[0], np.cumsum(self.root[1:] != self.root[:-1])])


def trie_join(group: np.ndarray, keys: np.ndarray, budget: int = 3, top: int = BITS) -> np.ndarray:
    """Roots of a spanning forest over entries of one group with at most ``budget`` differing bits.

    ``group``, ``keys``: sorted by group, then by key (uint64), without repeats.
    ``top``: the bits below it may differ within a group.
    """
    n = len(keys)
    forest = Forest(n)
    if n < 2:
        return forest.root
    ones = lambda bit: np.concatenate([[0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    lo, hi = edge[:-1], edge[1:]
    counts: dict[int, np.ndarray] = {}
    meet = []  # by level: sibling nodes, whose entries differ in this level's bit
    for bit in range(top - 1, -1, -1):
        many = hi - lo > 1
        lo, hi = lo[many], hi[many]
        if not len(lo):
            break
        p = counts[bit] = ones(bit)
        mid = hi - (p[hi] - p[lo])
        both = (mid > lo) & (mid < hi)
        meet.append((bit, lo[both], mid[both], mid[both], hi[both]))
        lo, hi = np.concatenate([lo, mid]), np.concatenate([mid, hi])

    def compare(al, ah, bl, bh):
        size = (ah - al) * (bh - bl)
        pair = np.repeat(np.arange(len(al)), size)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        wide = (bh - bl)[pair]
        a, b = al[pair] + k // wide, bl[pair] + k % wide
        near = np.bitwise_count(keys[a] ^ keys[b]) <= budget
        forest.link(a[near], b[near])

    for bit, al, ah, bl, bh in reversed(meet):  # small subtrees first: what they join need not be compared above
        stack = [(bit, al, ah, bl, bh, np.ones(len(al), np.int64))]
        while stack:
            bit, al, ah, bl, bh, wrong = stack.pop()
            if len(al) > FRONTIER:
                half = len(al) // 2
                stack += [(bit, *(x[:half] for x in (al, ah, bl, bh, wrong))), (bit, *(x[half:] for x in (al, ah, bl, bh, wrong)))]
                continue
            s, r = forest.breaks(), forest.root
            apart = (s[ah - 1] != s[al]) | (s[bh - 1] != s[bl]) | (r[al] != r[bl])
            al, ah, bl, bh, wrong = (x[apart] for x in (al, ah, bl, bh, wrong))
            small = (ah - al) * (bh - bl) <= SMALL
            compare(al[small], ah[small], bl[small], bh[small])
            al, ah, bl, bh, wrong = (x[~small] for x in (al, ah, bl, bh, wrong))
            if not len(al) or bit == 0:
                continue
            bit -= 1
            if bit not in counts:
                counts[bit] = ones(bit)
            p = counts[bit]
            am, bm = ah - (p[ah] - p[al]), bh - (p[bh] - p[bl])
            next_ = [np.concatenate(x) for x in ((al, am, al, am), (am, ah, am, ah), (bl, bm, bm, bl), (bm, bh, bh, bm), (wrong, wrong, wrong + 1, wrong + 1))]
            live = (next_[0] < next_[1]) & (next_[2] < next_[3]) & (next_[4] <= budget)
            stack.append((bit, *(x[live] for x in next_)))
    return forest.root


def _links(fp: np.ndarray, block: np.ndarray, head: np.ndarray, task: np.ndarray):
    """Spanning forests of some whole buckets, as batches of (u, v)."""
    keys = rotate(fp, block * (BITS // BLOCKS))
    order = np.lexsort((keys, task, head, block))
    fp, block, head, task, keys = fp[order], block[order], head[order], task[order], keys[order]
    new = (head[1:] != head[:-1]) | (task[1:] != task[:-1]) | (block[1:] != block[:-1])
    root = trie_join(np.concatenate([[0], np.cumsum(new)]), keys, top=BITS - BITS // BLOCKS)
    child = np.flatnonzero(root != np.arange(len(root)))
    for i in range(0, len(child), 100_000):
        some = child[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(fp[some].view(np.int64)), pa.array(fp[root[some]].view(np.int64))], ["u", "v"])


def _forests(batches):
    """Rows (fp, block, head, task) that are sorted by bucket; about ``HELD`` entries, and one bucket, are held at once."""
    held, size = [], 0
    for b in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        held.append([columns[0].view(np.uint64), *columns[1:]])
        size += b.num_rows
        if size >= HELD:
            rows = [np.concatenate(c) for c in zip(*held)]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in rows[1:]], axis=0))
            cut = int(new[-1]) + 1 if len(new) else 0  # the last bucket may go on
            if cut:
                yield from _links(*(c[:cut] for c in rows))
            held, size = [[c[cut:] for c in rows]], size - cut
    if size:
        yield from _links(*(np.concatenate(c) for c in zip(*held)))


def near_links(distinct: DataFrame) -> DataFrame:
    """Spanning forests (u, v) of all links between the fingerprints in column fp (no repeats)."""
    spark = distinct.sparkSession
    n_parts = partitions(spark)
    most = max(512, -(-distinct.count() * BLOCKS // n_parts))
    width = BITS // BLOCKS
    spread = distinct.select("fp", F.explode(F.array(*map(F.lit, range(BLOCKS)))).alias("block"))
    place = F.expr(f"cast(shiftrightunsigned(fp, {BITS - width} - block * {width}) & {2**width - 1} as int)")
    spread = spread.withColumn("head", place)
    # At most BLOCKS * n / most <= n_parts buckets are larger than ``most``: a bound on the broadcast.
    large = spread.groupBy("block", "head").count().where(F.col("count") > most)
    large = large.select("block", "head", F.ceil(F.col("count") / most).cast("int").alias("chunks"))
    dealt = spread.join(F.broadcast(large), ["block", "head"], "left").withColumn("c", F.expr("pmod(hash(fp), coalesce(chunks, 1))"))
    tasks = F.expr("""if(chunks is null, array(0),
        transform(filter(sequence(0, chunks - 1), x -> x <> c), x -> 1 + least(x, c) * chunks + greatest(x, c)))""")
    dealt = dealt.select("fp", "block", F.explode(tasks).alias("task"), "head")
    sorted_ = dealt.select("fp", "block", "head", "task").repartition(n_parts, "block", "head", "task").sortWithinPartitions("block", "head", "task")
    return sorted_.mapInArrow(_forests, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per document: id, fp and component (smallest id reachable over links of three bits or fewer)."""
    fps = written(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = written(fps.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes", fps.count())
    # A forest has fewer links than entries, of which each fingerprint has one for each block.
    roots = connected_components(near_links(nodes.select("fp")), BLOCKS * nodes.count()).withColumnRenamed("u", "fp")
    nodes = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component"))
    component = nodes.join(least, "root").select("fp", "component")
    return fps.join(component, "fp").select("id", "fp", "component")
