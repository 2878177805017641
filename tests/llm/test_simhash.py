import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from quire.llm import simhash
from quire.llm.components import connected_components


def slow_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps):
    """Smallest id reachable over links of three bits or fewer."""
    label = list(range(len(ids)))
    for _ in ids:
        for i in range(len(ids)):
            for j in range(len(ids)):
                if (fps[i] ^ fps[j]).bit_count() <= 3:
                    label[i] = label[j] = min(label[i], label[j])
    least = {}
    for i, d in zip(label, ids):
        if d is not None:
            least[i] = min(least.get(i, d), d)
    return [least.get(i) for i in label]


def test_fingerprints_and_components(spark, odd, odd_rows):
    got = simhash.near_duplicates(odd).collect()
    fps = [slow_fingerprint(r.text) for r in odd_rows]
    want = slow_components([r.doc_id for r in odd_rows], fps)
    key = lambda t: (t[0] is None, t)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    assert sorted(((r.id, r.fp, r.component) for r in got), key=str) == sorted(((r.doc_id, signed(f), c) for r, f, c in zip(odd_rows, fps, want)), key=str)


def test_empty(empty):
    assert simhash.near_duplicates(empty).collect() == []


def test_trie_join_finds_every_link():
    rng = random.Random(5)
    keys = set()
    for _ in range(60):
        base = rng.getrandbits(48)
        for _ in range(rng.randint(1, 9)):
            x = base
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(48)
            keys.add(x)
    keys = np.array(sorted(keys), np.uint64)
    root = simhash.trie_join(np.zeros(len(keys), int), keys, top=48)
    n = len(keys)
    label = np.arange(n)
    for _ in range(n):
        before = label.copy()
        for i in range(n):
            near = np.bitwise_count(keys ^ keys[i]) <= 3
            label[near] = label[near].min()
        if (before == label).all():
            break
    assert [(label[i] == label[j]) for i in range(n) for j in range(i)] == [(root[i] == root[j]) for i in range(n) for j in range(i)]


def test_large_buckets_are_split(spark, monkeypatch):
    """One dense group far above the mean partition: chunks are joined pair by pair."""
    rng = random.Random(9)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 3_000:
        x = base
        for b in rng.sample(range(64), rng.randint(1, 3)):
            x ^= 1 << b
        fps.add(x)
    far = [rng.getrandbits(64) for _ in range(50)]
    rows = [(x - (1 << 64) if x >> 63 else x,) for x in [*fps, *far]]
    links = simhash.near_links(spark.createDataFrame(rows, "fp long"))
    assert links.count() < 20_000
    roots = {r.u: r.root for r in connected_components(links).collect()}
    group = [x - (1 << 64) if x >> 63 else x for x in fps]
    assert {roots[min(group)] if x == min(group) and x in roots else roots.get(x, min(group)) for x in group} == {min(group)}
    assert not any((x - (1 << 64) if x >> 63 else x) in roots for x in far)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 200)] + [(300, 300), (None, 3)]
    got = {r.u: r.root for r in connected_components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 200)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_buckets_are_read_some_at_a_time(monkeypatch):
    """Links of sorted rows that come in small batches, with little held at once, join what brute force joins."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**64, 6, np.uint64)
    fps = np.unique(np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, 64, 6, np.uint64)) for _ in range(12))]))
    width = simhash.BITS // simhash.BLOCKS
    rows = []
    for block in range(simhash.BLOCKS):
        head = simhash.rotate(fps, np.full(len(fps), block * width)) >> np.uint64(simhash.BITS - width)
        rows += [(f, block, int(h), 0) for f, h in zip(fps.view(np.int64).tolist(), head)]
    rows.sort(key=lambda r: r[1:])
    monkeypatch.setattr(simhash, "HELD", 10)
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 7])], ["fp", "block", "head", "task"]) for i in range(0, len(rows), 7)]
    links = [pair for b in simhash._forests(batches) for pair in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    label = {f: i for i, f in enumerate(fps.view(np.int64).tolist())}
    want = dict(label)
    for names, pairs in ((label, links), (want, [(a, b) for a in want for b in want if bin((a ^ b) & (2**64 - 1)).count("1") <= 3])):
        for a, b in pairs:
            low, high = sorted((names[a], names[b]))
            names.update({k: low for k, v in names.items() if v == high})
    assert label == want
