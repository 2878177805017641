"""Near-duplicates by the exact Jaccard similarity of five-word shingles.

A text is the set of its shingles: ASCII letters in lower case, words between ASCII white
space, ``SHINGLE`` words (fewer words: the whole sequence), XXH64.  Two texts are linked
if their sets have a similarity of ``SIMILAR`` or more; components of the links.

Candidates: the pairs that a caller has, such as those of SimHash fingerprints.  But at this
similarity two fingerprints of 64 bits differ by ten bits on average, which no scheme of
equal blocks selects.  So each set also gets ``BANDS`` keys of
``ROWS`` smallest hashes; linked sets share a key but for one pair in 2 * 10**7
((1 - 0.8**4)**32, at the very threshold).  Every pair of sets that share a key is
compared exactly, unless links already found join the two: the caller's pairs are compared
first, and buckets whose entries their links join are left out.

Scale: equal sets are one entry, and keys with the same entries are one bucket.  Large
buckets are dealt to several tasks as chunks, each pair of chunks one task, which returns
a spanning forest of the links, never all pairs.  Only the sets of entries in a bucket are
computed again and shuffled.

Defined results: null texts and texts without words are equal; very long texts are read whole; a
similarity of exactly ``SIMILAR`` links; ids are as in simhash.py.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import discard, partitions, release, sliced, small_batches, written
from quire.llm.components import connected_components

SHINGLE, SIMILAR, BANDS, ROWS = 5, 0.8, 32, 4
#: Hashes that are permuted at once, entries of a chunk at least.
HASHES, CHUNK = 4_096, 512

_RNG = np.random.default_rng(41)
_FLIP = _RNG.integers(0, 2**64, (BANDS * ROWS, 1), np.uint64)
_TIMES = _RNG.integers(0, 2**64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the different shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    k = min(SHINGLE, len(words))
    if not k:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size) + np.arange(len(words))
    starts, ends = (ends - size)[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    xx = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((xx(joined[a:b]) for a, b in zip(starts, ends)), np.uint64, len(starts)))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A signed key for each band; no key for an empty set."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for i in range(0, len(hashes), HASHES):
        np.minimum(least, ((hashes[i : i + HASHES] ^ _FLIP) * _TIMES).min(1), out=least)
    raw, width = least.tobytes(), 8 * ROWS
    keys = np.array([xxhash.xxh64_intdigest(raw[i * width : (i + 1) * width], i) for i in range(BANDS)], np.uint64)
    return keys.view(np.int64).tolist()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= SIMILAR * (len(a) + len(b) - both)


def forest(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the number of another one of its component, or its own."""
    n = np.array([len(s) for s in sets])
    root = np.arange(len(sets))
    for i in range(1, len(sets)):
        near = (np.minimum(n[:i], n[i]) >= SIMILAR * np.maximum(n[:i], n[i])).nonzero()[0]
        for j in near:
            if root[j] != root[i] and similar(sets[i], sets[j]):
                a, b = sorted((root[i], root[j]))
                root[root == b] = a
    return root


def _sketches(batches):
    for b in sliced(batches):
        nodes, keys = [], []
        for text in b.column(1).to_pylist():
            hashes = shingles(text)
            nodes.append(xxhash.xxh64_intdigest(hashes.tobytes()))
            keys.append(band_keys(hashes))
        nodes = pa.array(np.array(nodes, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([b.column(0), nodes, pa.array(keys, pa.list_(pa.int64()))], ["id", "node", "keys"])


def _sets(batches):
    for b in sliced(batches):
        sets = [shingles(t).tobytes() for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["node", "hashes"])


def _forests(batches):
    """Rows sorted by key and task to links (u, v)."""

    def linked(nodes, sets):
        root = forest(sets)
        child = np.flatnonzero(root != np.arange(len(root)))
        nodes = np.array(nodes, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(nodes[child]), pa.array(nodes[root[child]])], ["u", "v"])

    at, nodes, sets = None, [], []
    for b in batches:
        for key, task, node, raw in zip(*(b.column(c).to_pylist() for c in ("key", "task", "node", "hashes"))):
            if (key, task) != at:
                if len(nodes) > 1:
                    yield linked(nodes, sets)
                at, nodes, sets = (key, task), [], []
            nodes.append(node)
            sets.append(np.frombuffer(raw, np.uint64))
    if len(nodes) > 1:
        yield linked(nodes, sets)


def _compared(batches):
    """Pairs of sets to the links among them."""
    for b in batches:
        both = zip(*(b.column(c).to_pylist() for c in ("a", "b")))
        same = pa.array([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in both], pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("u").filter(same), b.column("v").filter(same)], ["u", "v"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pairs: DataFrame | None = None) -> DataFrame:
    """One row per document: id and component (smallest id reachable over links).

    ``pairs``: (id, other), candidates besides those of the keys; they are compared exactly, too.
    """
    spark = docs.sparkSession
    small_batches(spark)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = picked.schema["id"].dataType.simpleString()
    sketches = written(picked.mapInArrow(_sketches, f"id {id_type}, node bigint, keys array<bigint>"), "near-sketches")
    nodes = written(sketches.groupBy("node").agg(F.min("id").alias("least"), F.any_value("keys").alias("keys")), "near-nodes")
    # One text for each entry; equal rows have equal texts.
    least = nodes.select("node", F.col("least").alias("id"))

    def sets_of(asked: DataFrame, name: str) -> DataFrame:
        texts = picked.join(least.join(asked, "node", "left_semi"), "id").dropDuplicates(["node"]).select("node", "text")
        return written(texts.mapInArrow(_sets, "node bigint, hashes binary"), name)

    first = sets = joined = None
    if pairs is not None:
        at = sketches.select("id", "node").distinct()
        both = pairs.join(at, "id").select(F.col("node").alias("u"), "other").distinct()
        both = both.join(at.select(F.col("id").alias("other"), F.col("node").alias("v")), "other").where("u <> v").select("u", "v").distinct()
        pairs = written(both, "near-pairs")
        sets = sets_of(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "near-pair-sets")
        side = lambda n, c: sets.select(F.col("node").alias(n), F.col("hashes").alias(c))
        first = written(pairs.join(side("u", "a"), "u").join(side("v", "b"), "v").mapInArrow(_compared, "u bigint, v bigint"), "near-first")
        joined = connected_components(first, pairs.count()).select(F.col("u").alias("node"), "root")
        release(spark)
    # A bucket whose entries the pairs' links join already has nothing more to say.
    rooted = nodes.withColumn("root", F.col("node")) if joined is None else nodes.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    spread = rooted.select("node", "root", F.explode("keys").alias("key"))
    same = [F.count(F.lit(1)).alias("n"), F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y"), F.min("root").alias("lo"), F.max("root").alias("hi")]
    buckets = spread.groupBy("key").agg(*same).where("n > 1 and lo <> hi").groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", "n")
    buckets = written(buckets, "near-buckets")
    total = buckets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = max(CHUNK, -(-total // partitions(spark)))
    release(spark)
    members = written(spread.join(buckets, "key").select("key", "node", F.ceil(F.col("n") / most).cast("int").alias("chunks")), "near-members")
    asked = members.select("node").distinct()
    more = sets_of(asked if sets is None else asked.join(sets, "node", "left_anti"), "near-sets")
    used = [members, buckets, more] if sets is None else [members, buckets, more, sets, pairs, first]
    sets = more if sets is None else sets.unionByName(more)
    release(spark)  # the texts that were shuffled for this
    tasks = F.expr("transform(filter(sequence(0, chunks - 1), x -> x <> c or chunks = 1), x -> least(x, c) * chunks + greatest(x, c))")
    dealt = members.withColumn("c", F.pmod(F.hash("node"), F.col("chunks"))).select("key", "node", F.explode(tasks).alias("task"))
    dealt = dealt.join(sets, "node").repartition(partitions(spark), "key", "task").sortWithinPartitions("key", "task", "node")
    links = dealt.select("key", "task", "node", "hashes").mapInArrow(_forests, "u bigint, v bigint")
    if first is not None:
        links = links.unionByName(first)
        total += pairs.count()
    roots = connected_components(links, total).withColumnRenamed("u", "node")
    entries = nodes
    nodes = nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    component = nodes.join(nodes.groupBy("root").agg(F.min("least").alias("component")), "root").select("node", "component")
    found = written(sketches.select("id", "node").join(component, "node").select("id", "component"), "near-components")
    # What the caller does next, such as a shuffle of all texts, need not share the disk with the way to it.
    discard(*used, sketches, entries)
    release(spark)
    return found
