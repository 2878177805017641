import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.llm import mixing


def fill(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing again and again, in plain Python."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        if not free:
            return fixed
        t = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] > most * sizes[s]]
        if not over:
            return fixed | t
        fixed |= {s: most * sizes[s] for s in over}


def test_targets_and_quotas(spark):
    rows = [(i, "w " * (1 + i % 37), f"s{i % 7}" if i % 11 else None) for i in range(900)] + [(1000, "one", "tiny"), (1001, "", "zero")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(docs, block_words=16).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    want = fill(dict(sizes))
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix_sources(docs.repartition(7), block_words=16).collect()), key=str)


def test_points_are_multiples_of_the_golden_ratio(spark):
    k = [0, 1, 2, 3, 2**24 - 1, 2**24, 2**31, 2**40 + 12345, 2**52 + 7]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in k], "id long").select(mixing.golden_point(F.col("id"))).collect()]
    assert got == [x * mixing.GOLDEN % 2**48 for x in k] and mixing.GOLDEN == round(2**48 * (5**0.5 - 1) / 2) | 1


def test_every_schedule_prefix_is_near_the_weights(spark):
    sources = spark.createDataFrame([(1, 500, 0), (2, 300, 500), (3, 200, 800)], "sid int, slots long, lo long")
    got = sorted((r.position, r.sid, r.slot_rank) for r in mixing.schedule(sources).collect())
    assert len({p for p, _, _ in got}) == 1_000
    seen = Counter()
    for i, (_, sid, rank) in enumerate(got, 1):
        assert rank == seen[sid]
        seen[sid] += 1
        assert all(abs(seen[s] - i * share) <= 4 for s, share in ((1, 0.5), (2, 0.3), (3, 0.2)))
    assert seen == {1: 500, 2: 300, 3: 200}


def test_taken_and_the_mix_against_brute_force(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(i * 7 % 41)), f"s{i % 3}" if i % 5 else None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    taken = {r.doc_id: r for r in mixing.mix_sources(docs, block_words=16).collect()}
    mix = sorted(mixing.mix_schedule(docs, block_words=16).collect(), key=lambda r: (r.position, r.place))
    words = {s: [] for s in {r[2] for r in rows}}
    for i, text, source in sorted(rows, key=lambda r: hashlib.md5(f"17/{r[0]}".encode()).hexdigest()):
        words[source] += [(i, w) for w in text.split()]
    want = {s: [words[s][k % len(words[s])] for k in range(round(next(r.target for r in taken.values() if r.source == s)))] for s in words}
    counts = Counter(i for some in want.values() for i, _ in some)
    assert {i: r.taken for i, r in taken.items()} == {r[0]: counts[r[0]] for r in rows}
    texts, got = {r[0]: r[1].split() for r in rows}, {s: [] for s in words}
    for r in mix:
        got[r.source] += [(r.doc_id, w) for w in texts[r.doc_id][r.first_word : r.first_word + r.words]]
    assert {s: Counter(x) for s, x in got.items()} == {s: Counter(x) for s, x in want.items()} and got == want


def test_odd_rows(odd, empty, odd_rows):
    got = mixing.mix_sources(odd).collect()
    assert len(got) == len(odd_rows)
    assert all(r.taken == 0 for r in got if r["size"] == 0)
    assert sum(r["size"] for r in got) == sum(len((x.text or "").encode().split()) for x in odd_rows)
    assert mixing.mix_sources(empty).collect() == []
