import sys
from collections import Counter, defaultdict

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from pyspark.sql import functions as F  # noqa: E402

from quire.llm import langid, mixing, packing  # noqa: E402


@pytest.fixture(scope="module")
def docs(odd):
    return odd.select(*corpus_pipeline.COLUMNS)


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "mix_sources", "best_fit_packing"]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_and_odd_tables(spark, docs, empty, odd, name):
    out = stage(name)(spark, odd, "")
    if name != "best_fit_packing":
        assert tuple(out.columns) == corpus_pipeline.COLUMNS
    assert out.count() > 0
    assert stage(name)(spark, empty, "").count() == 0


def test_language_stage_keeps_what_the_operator_accepts(spark, docs):
    """And fills in the language where it was null."""
    unnamed = docs.withColumn("lang", F.when(F.col("doc_id") % 4 == 0, None).otherwise(F.col("lang")))
    got = stage("language_id")(spark, unnamed, "").collect()
    model = langid.learn(unnamed.where(langid.held_in(unnamed.doc_id)))
    want = []
    for r in unnamed.collect():
        langs, _, rejected = langid.judge([r.text], model)
        if not rejected[0]:
            want.append((*r[:2], r.lang or langs[0], *r[3:]))
    assert Counter(map(str, map(tuple, got))) == Counter(map(str, want))
    assert all(r.lang for r in got) and any(r.doc_id and r.doc_id % 4 == 0 for r in got)


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_duplicate_stage_keeps_one_of_each_group(spark, docs, odd_rows):
    """Groups of five-word Jaccard similarity of 0.8 or more, by comparing all pairs."""
    rows = sorted((tuple(r[:5]) for r in odd_rows if r.doc_id is not None), key=lambda r: r[0])
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    got = stage("simhash_near_dedup")(spark, docs.where("doc_id is not null"), "").collect()
    assert sorted(r.doc_id for r in got) == [rows[i][0] for i in sorted(set(root))]


def test_near_duplicate_stage_shuffles_the_texts_once_and_leaves_little(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr("quire.llm.common.folder", lambda spark: f"file://{tmp_path}")
    key, was = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        out = stage("simhash_near_dedup")(spark, docs, "")
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, was)
    assert plan.count("Exchange hashpartitioning") == 2  # the texts, and the rows that stay
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert "near-components" in left and not left & {"near-sketches", "near-nodes", "near-sets", "near-pair-sets", "near-members"}
    assert out.count() > 0


def test_repeated_rows_of_the_mix_are_taken_one_by_one(spark):
    rows = [(1, "a b c d e f g", "en", "x", 13)] * 5 + [(2, "h i j", "en", "y", 5), (3, "k " * 40, "en", "z", 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = stage("mix_sources")(spark, docs, "").collect()
    numbered = corpus_pipeline._numbered(docs)
    assert sorted((r.doc_id, r.copy) for r in numbered.collect()) == [(1, i) for i in range(1, 6)] + [(2, 1), (3, 1)]
    want = [(r.doc_id, r.taken) for r in mixing.mix_sources(numbered, keep=("doc_id", "key", "copy")).collect() if r.taken]
    assert Counter((r.doc_id, len(r.text.split())) for r in got) == Counter(want)


def test_mixing_stage_takes_the_words(spark, docs):
    unique = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in stage("mix_sources")(spark, unique, "").collect()}
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(corpus_pipeline._numbered(unique), keep=("doc_id", "key", "copy")).collect()}
    assert {i: len(r.text.encode().split()) for i, r in got.items()} == {i: n for i, n in taken.items() if n}


def test_whole_run_packs_what_is_left(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    fill, ends = defaultdict(int), defaultdict(list)
    for r in rows:
        fill[r.sequence_id] += r.length
        ends[r.sequence_id].append((r.offset, r.offset + r.length))
    assert max(fill.values()) <= 2048
    for parts in ends.values():  # gapless from 0
        assert [a for a, _ in sorted(parts)] == [0, *(b for _, b in sorted(parts)[:-1])]
    lengths = np.array(sorted((r.length for r in rows), reverse=True))
    assert packing.least_bins(lengths, 2048) <= len(fill) <= len(packing.best_fit_decreasing(lengths, 2048)[2])
