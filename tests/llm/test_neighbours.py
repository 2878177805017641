import heapq
import random

import numpy as np

from pyspark.sql import functions as F
from quire.llm import neighbours


def test_visits_cells_in_order():
    rng = np.random.default_rng(1)
    a, b = rng.random(9), rng.random(7)
    got = neighbours.visited_cells(a, b, np.ones(63, int), 63)
    sums = [a[c // 7] + b[c % 7] for c in got]
    assert sorted(got.tolist()) == list(range(63)) and sums == sorted(sums)
    assert len(neighbours.visited_cells(a, b, np.ones(63, int), 10)) == 10


def test_recall_and_ranks(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3_000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = neighbours.nearest_neighbours(df, F.col("vec_id") % 100 == 0).collect()
    hits = 0
    for q in range(0, 3_000, 100):
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in mine] == list(range(1, 11))
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        assert all(s == d[v] for _, v, s in mine) and [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        d[q] = np.inf
        hits += len({v for _, v, _ in mine} & set(np.argsort(d)[:10].tolist()))
    assert hits / 300 >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (100, [0.5, 0.5]), (200, None)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id int, vec int")
    got = neighbours.nearest_neighbours(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 100), (0, 4, 3), (100, 1, 0), (100, 2, 1), (100, 3, 2), (100, 4, 3)]
    assert neighbours.nearest_neighbours(df.where("vec_id = 4"), F.lit(True)).collect() == []
    assert neighbours.nearest_neighbours(df.where("vec_id = 0"), F.lit(True)).collect() == []


def test_small_tables_return_k_or_all_candidates(spark):
    rng = np.random.default_rng(6)
    for n in (1, 2, 5, 11, 15):
        df = spark.createDataFrame([(i, rng.standard_normal(8).tolist()) for i in range(n)], "vec_id long, embedding array<double>")
        got = neighbours.nearest_neighbours(df, F.lit(True)).collect()
        assert len(got) == n * min(10, n - 1)


def test_chunks_hold_cells_and_parts_of_crowded_cells():
    entries = np.array([3, 0, 4, 25, 2, 2, 9, 10, 0])
    first, parts = neighbours.chunks_of_cells(entries, 10)
    assert first.tolist() == [0, 0, 0, 1, 4, 4, 5, 6, 6] and parts.tolist() == [1, 0, 1, 3, 1, 1, 1, 1, 0]


def test_queries_go_to_the_chunks_of_their_cells_only(spark, monkeypatch):
    """Clustered vectors with a crowded cell: few copies, and the results of brute force."""
    monkeypatch.setattr(neighbours, "CHUNK", 40)
    monkeypatch.setattr(neighbours, "BLOCK", 3)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((12, 8)) * 30
    x = np.concatenate([centres[i % 12] + rng.standard_normal(8) for i in range(600)] + [centres[0]] * 300).reshape(900, 8)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    asked = []
    monkeypatch.setattr(neighbours, "written", lambda df, name, f=neighbours.written: asked.append((name, f(df, name))) or asked[-1][1])
    got = neighbours.nearest_neighbours(df, F.col("vec_id") % 20 == 0, visit=0.1).collect()
    pairs = dict(asked)["ann-asked"]
    chunks = pairs.agg(F.max("chunk")).first()[0] + 1
    assert chunks >= 20 and pairs.count() < 45 * chunks / 2
    hits = 0
    for q in range(0, 900, 20):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in mine] == list(range(1, 11)) and all(s == d[v] for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & set(np.lexsort((np.arange(900), d))[:10].tolist()))
    assert hits / 450 >= 0.9


def test_one_id_with_two_vectors(spark):
    rows = [(0, [0.0, 1.0]), (0, [8.0, 1.0]), (1, [1.0, 1.0]), (1, [9.0, 1.5]), (2, [4.0, 1.0]), (2, [4.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest_neighbours(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, 4.0)]
