import random

import corpus_pipeline
import pytest

from quire.llm import overlap


def slow_components(texts):
    """Smallest number reachable over pairs of five-word Jaccard 0.8 or more."""
    words = [t.lower().split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    label = list(range(len(texts)))
    for _ in texts:
        before = list(label)
        for i in range(len(texts)):
            for j in range(i):
                if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    return label


def edited(rng, words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.random()}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    rng, out = random.Random(8), []
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(60, 200))]
        out += [" ".join(base), " ".join(base).upper()] + [edited(rng, base, n) for n in (1, 1, 2, 2, 3, 3, 4, 5, 6, 9)]
    return out + ["", "one two", "One  TWO", "one two three"]


def kept(spark, texts):
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())


def test_stage_keeps_what_brute_force_jaccard_keeps(spark, texts):
    want = slow_components(texts)
    assert 20 < len(set(want)) < 100
    assert kept(spark, texts) == sorted(set(want))


def test_pairs_of_the_caller_are_compared(spark):
    docs = spark.createDataFrame([(0, "a b c d e f g h i j k"), (1, "a b c d e f g h i j k l"), (2, "a b c d x y z")], "doc_id long, text string")
    pairs = spark.createDataFrame([(1, 0), (2, 0), (2, 2), (9, 1)], "id long, other long")
    got = {r.id: r.component for r in overlap.near_duplicates(docs, pairs=pairs).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_large_buckets_are_split(spark, texts, monkeypatch):
    monkeypatch.setattr(overlap, "CHUNK", 2)
    monkeypatch.setattr(overlap, "partitions", lambda spark: 400)
    assert kept(spark, texts) == sorted(set(slow_components(texts)))


def test_what_given_pairs_join_is_not_compared_again(spark, monkeypatch):
    """The same components, from fewer buckets."""
    rows = [(i, " ".join(f"w{k}" for k in range(200)) + f" end{i}") for i in range(8)] + [(i, f"other {i} text of its own kind") for i in range(8, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = {}

    def spy(df, name, *more, write=overlap.written):
        out = write(df, name, *more)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(overlap, "written", spy)
    plain = sorted(map(tuple, overlap.near_duplicates(docs).collect()))
    assert sizes["near-buckets"] > 0
    pairs = spark.createDataFrame([(i, 0) for i in range(1, 8)], "id long, other long")
    assert sorted(map(tuple, overlap.near_duplicates(docs, pairs=pairs).collect())) == plain
    assert sizes["near-buckets"] == 0 and sizes["near-first"] == 7
