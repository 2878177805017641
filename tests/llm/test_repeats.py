import random
from collections import Counter

import numpy as np
import pytest

from quire.llm import repeats


def slow(texts, window):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + window] for b in data for i in range(len(b) - window + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                gone[i : i + window] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        out.append((edge[::2].tolist(), edge[1::2].tolist(), np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("window", [16, 40, 120, 400])
def test_cover_holds_every_difference(window):
    v, d = repeats.difference_cover(window)
    assert {(i - j) % v for i in d for j in d} == set(range(v)) and v <= window // 2


@pytest.mark.parametrize("window, batch", [(13, 2_000_000), (20, 300), (60, 2_000_000), (60, 500)])
def test_against_brute_force(spark, window, batch):
    rng = random.Random(window)
    base = ["".join(rng.choice("ab cé") for _ in range(300)) for _ in range(6)]
    texts = [b[i : i + rng.randint(1, 200)] + rng.choice(base)[rng.randint(0, 99) :] for b in base for i in range(0, 90, 7)]
    texts += ["ab" * 80, "x" * 50, "", None, base[0], base[0], "ab" * 10]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.id: (r.starts, r.ends, bytes(r.kept)) for r in repeats.remove_repeats(docs, window, batch=batch).collect()}
    assert [got[i] for i in range(len(texts))] == slow(texts, window)


def test_small_batches_and_join_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BROADCAST_KEYS", 0)
    rng = random.Random(1)
    base = "".join(rng.choice("abc ") for _ in range(900))
    texts = [base[i : i + 500] for i in range(0, 400, 50)] + ["".join(rng.choice("abc ") for _ in range(300)) for _ in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: (r.starts, r.ends, bytes(r.kept)) for r in repeats.remove_repeats(docs, 100).collect()}
    assert [got[i] for i in range(len(texts))] == slow(texts, 100)


def test_odd_rows(odd, empty, odd_rows):
    got = repeats.remove_repeats(odd).collect()
    want = [(r.doc_id, *x) for r, x in zip(odd_rows, slow([r.text for r in odd_rows], 400))]
    assert sorted(((r.id, r.starts, r.ends, bytes(r.kept)) for r in got), key=str) == sorted(want, key=str)
    assert repeats.remove_repeats(empty).collect() == []


def test_strings_that_collide_are_told_apart_by_their_bytes(spark, monkeypatch):
    morse = [bin(i).count("1") % 2 for i in range(128)]

    def string(swapped):
        return "".join(chr(pair[bit ^ swapped]) for pair in ((33, 36), (98, 75), (120, 92)) for bit in morse) + "e" * 16

    x, y = string(0), string(1)
    names = repeats.Names(400)
    at = np.zeros(1, np.int64)
    assert names(np.frombuffer(x.encode(), np.uint8), at) == names(np.frombuffer(y.encode(), np.uint8), at)
    texts = [x, y, "other words " * 9 + x[100:], "words of another " * 7 + y[100:], "k" * 30 + x + "a", y + "b", x[:399], None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for batch in (2_000_000, 1):  # within a batch, and between batches
        for some in (texts[:4], texts):
            rows = repeats.remove_repeats(docs.where(f"doc_id < {len(some)}"), batch=batch).collect()
            got = {r.id: (r.starts, r.ends, bytes(r.kept)) for r in rows}
            assert [got[i] for i in range(len(some))] == slow(some, 400)
    assert [r for _, r, _ in slow(texts[:4], 400)] == [[]] * 4


def test_tables_that_are_read_once_are_not_written(odd, monkeypatch):
    names = []
    monkeypatch.setattr(repeats, "written", lambda df, name, *more, write=repeats.written: names.append(name) or write(df, name, *more))
    assert repeats.remove_repeats(odd).count() == odd.count()
    assert Counter(names) == Counter(["repeats-sample", "repeats-near", "repeats-text", *["repeats-windows"] * repeats.BLOCKS, "repeats-runs", "repeats-ends", "repeats-unequal", "repeats-colliding", "repeats-spans"])
