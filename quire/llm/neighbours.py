"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, and each half is quantised by its own codebook, so k + k
centroids make k * k cells.  For a query the pairs of centroids are visited in the order
of their summed squared distance, by a heap over the two sorted lists, until the cells
visited hold a share ``visit`` of all entries, and ``k`` besides the query; every entry of those cells is ranked by
its distance in double precision.  The codebooks are fitted on at most ``FIT`` vectors
(chosen by hash), everything else covers every row.

Scale: the cells, in the order of their numbers, are dealt into chunks of at most ``CHUNK``
entries, the inverted lists; a cell with more entries is dealt by hash over chunks of its
own, so that none, however crowded, is one task.  A query goes only to chunks that hold
cells which it visits, with the numbers of those.  Queries that meet in a chunk come in
blocks of ``BLOCK``, each with a copy of the chunk, so there are as many copies of an entry
as its cell is visited, divided by ``BLOCK``, and one more.  A task ranks one block against one
chunk and returns ten rows a query, which are merged.  How many cells a query visits
follows from the data: on vectors without structure it is a fixed share of all entries
(``visit``, which trades work against recall), on clustered vectors its share lies in few chunks.

Defined results: rows with a null id, and vectors that are null, of another length than
most, all zero, or that hold null or non-finite components take no part; repeated rows
count once; two vectors of one id are two candidates and two queries, whose lists are one, where each
candidate counts once with its smallest distance, and the id itself is no candidate; ties go to the
smaller id; fewer than ``k`` candidates are all returned; an empty table gives an empty
result; other columns are ignored; there are no texts.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import uniform, written

#: Vectors that the codebooks are fitted on, centroids of a half, entries of a chunk, queries of a block.
FIT, CENTROIDS, CHUNK, BLOCK = 16_384, 128, 8_192, 4_096
VISIT = 0.45


def usable(vec: Column) -> Column:
    """Whether a vector has only finite components, and one that is not zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vec, lambda x: x != 0)


def codebook(half: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """k-means centroids; the first ones are rows at even steps, empty clusters keep theirs."""
    k = min(k, len(half))
    centroids = half[np.linspace(0, len(half) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(half, centroids)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(centroids)
        np.add.at(total, near, half)
        centroids[n > 0] = total[n > 0] / n[n > 0, None]
    return chained(centroids)


def chained(centroids: np.ndarray) -> np.ndarray:
    """Each is followed by the nearest one that is left, so that near cells have near numbers."""
    order, left = [0], list(range(1, len(centroids)))
    while left:
        order.append(left.pop(int(((centroids[left] - centroids[order[-1]]) ** 2).sum(1).argmin())))
    return centroids[order]


def nearest(half: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(1) - 2 * half @ centroids.T).argmin(1)


def visited_cells(first: np.ndarray, second: np.ndarray, entries: np.ndarray, enough: float) -> np.ndarray:
    """Cells in rising order of first[i] + second[j] until they hold ``enough`` entries.

    A pair is pushed when its predecessors in both lists have been taken, so the heap
    never holds more pairs than there are centroids.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y, la, lb = first[a].tolist(), second[b].tolist(), a.tolist(), b.tolist()
    n = entries.reshape(len(la), len(lb)).tolist()
    heap, done, out, held = [(x[0] + y[0], 0, 0)], [0] * len(la), [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        out.append(la[i] * len(lb) + lb[j])
        held += n[la[i]][lb[j]]
        done[i] = j + 1
        if j + 1 < len(lb) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if i + 1 < len(la) and done[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
    return np.array(out, np.int32)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def _assigner(dim: int, books: tuple[np.ndarray, np.ndarray]):
    def run(batches):
        for b in batches:
            x = _vectors(b.column(1), dim)
            cell = nearest(x[:, : dim // 2], books[0]) * len(books[1]) + nearest(x[:, dim // 2 :], books[1])
            raw = pa.array([row.tobytes() for row in x], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cell.astype(np.int32)), raw], ["id", "cell", "vec"])

    return run


def _prober(dim: int, books: tuple[np.ndarray, np.ndarray], entries: np.ndarray, enough: float):
    def run(batches):
        for b in batches:
            cells = []
            for raw in b.column(1).to_pylist():
                q = np.frombuffer(raw, np.float64)
                d1, d2 = ((books[0] - q[: dim // 2]) ** 2).sum(1), ((books[1] - q[dim // 2 :]) ** 2).sum(1)
                cells.append(visited_cells(d1, d2, entries, enough).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cells, pa.binary())], ["qid", "vec", "cells"])

    return run


def _chunked(first: np.ndarray, parts: np.ndarray):
    """A row for each chunk that a query's cells lie in, with those cells."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                b = batch.slice(at, 64)
                row, chunk, cells = [], [], []
                for i, raw in enumerate(b.column(2).to_pylist()):
                    mine = np.sort(np.frombuffer(raw, np.int32))
                    times = parts[mine]
                    every = np.repeat(mine, times)
                    # The chunks of a cell follow each other from its first one.
                    where = np.repeat(first[mine], times) + np.arange(len(every)) - np.repeat(np.cumsum(times) - times, times)
                    order = np.argsort(where, kind="stable")
                    edge = np.flatnonzero(np.diff(where[order], prepend=-1))
                    for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(order)]):
                        row.append(i)
                        chunk.append(int(where[order[lo]]))
                        cells.append(every[order[lo:hi]])
                taken = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).take(taken), b.column(1).take(taken), pa.array(chunk, pa.int64()), pa.array(cells, pa.list_(pa.int32()))], ["qid", "vec", "chunk", "cells"])

    return run


def _ranker(k: int, n_cells: int):
    def run(key: tuple, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(queries):
            index = index.sort_values(["cell", "id"])
            cell, ids = index["cell"].to_numpy(), index["id"].to_numpy()
            x = np.frombuffer(b"".join(index["vec"]), np.float64).reshape(len(ids), -1)
            for qid, raw, cells in zip(queries["qid"], queries["vec"], queries["cells"]):
                visited = np.zeros(n_cells, bool)
                visited[np.asarray(cells)] = True
                rows = np.flatnonzero(visited[cell] & (ids != qid))
                d = np.sqrt(((x[rows] - np.frombuffer(raw, np.float64)) ** 2).sum(1))
                best = np.lexsort((ids[rows], d))
                if len(best) > 2 * k:
                    best = best[d[best] <= d[best[2 * k - 1]]]
                _, first = np.unique(ids[rows][best], return_index=True)  # an id may have several vectors
                best = best[np.sort(first)][:k]
                out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[rows][best], "score": d[best]}))
        none = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        return pd.concat(out) if out else none

    return run


def chunks_of_cells(entries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First chunk of each cell and the number of chunks it is dealt over, of at most about ``most`` entries each; none for empty cells."""
    first, parts = np.zeros(len(entries), np.int64), -(-entries // most)
    chunk, held = 0, 0
    for cell, n in enumerate(entries.tolist()):
        if held and held + n > most:
            chunk, held = chunk + 1, 0
        first[cell] = chunk
        held += n
        if parts[cell] > 1:
            chunk, held = chunk + int(parts[cell]), 0
    return first, parts


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 10, visit: float = VISIT, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found of each row for which ``is_query`` holds."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vec_col)))
    by_dim = rows.groupBy(F.size(vec_col).alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if by_dim is None:
        return empty
    dim, n = by_dim
    rows = rows.where(F.size(vec_col) == dim)
    picked = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("q"))
    fit = picked.where(uniform("id") < 0.9 * FIT / n if n > FIT else F.lit(True)).select("id", "vec").limit(FIT).toArrow().sort_by("id")
    if not fit.num_rows:
        fit = picked.select("id", "vec").limit(FIT).toArrow().sort_by("id")
    sample = _vectors(fit.column("vec").combine_chunks(), dim)
    books = (codebook(sample[:, : dim // 2], CENTROIDS), codebook(sample[:, dim // 2 :], CENTROIDS))
    n_cells = len(books[0]) * len(books[1])

    index = picked.select("id", "vec").mapInArrow(_assigner(dim, books), "id long, cell int, vec binary")
    index = written(index.dropDuplicates(["id", "vec"]), "ann-index")
    entries = np.zeros(n_cells, np.int64)  # a number for each of the k * k cells
    for cell, count in index.groupBy("cell").count().collect():
        entries[cell] = count
    queries = index.join(picked.where("q").select("id").distinct(), "id", "left_semi").select(F.col("id").alias("qid"), "vec")
    queries = queries.repartition(max(1, min(1_000, n // 10_000)), "qid")
    queries = queries.mapInArrow(_prober(dim, books, entries, max(visit * entries.sum(), k + 1)), "qid long, vec binary, cells binary")
    queries = written(queries, "ann-queries")
    # Chunks of cells: their table has a row for each of the k * k cells.
    first, parts = chunks_of_cells(entries, CHUNK)
    cells = spark.createDataFrame(pd.DataFrame({"cell": np.arange(n_cells, dtype=np.int32), "first": first, "parts": parts}))
    lists = index.join(F.broadcast(cells), "cell").withColumn("chunk", F.col("first") + F.pmod(F.xxhash64("id", "vec"), F.col("parts")))
    asked = queries.mapInArrow(_chunked(first, parts), "qid long, vec binary, chunk long, cells array<int>")
    asked = written(asked, "ann-asked")
    many = asked.groupBy("chunk").agg(F.expr(f"(count(1) + {BLOCK} - 1) div {BLOCK}").alias("blocks"))
    lists = lists.join(many, "chunk").withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    asked = asked.join(many, "chunk").withColumn("block", F.pmod(F.xxhash64("qid", "vec"), F.col("blocks")))
    found = (
        lists.select("chunk", "block", "id", "cell", "vec")
        .groupBy("chunk", "block")
        .cogroup(asked.select("chunk", "block", "qid", "vec", "cells").groupBy("chunk", "block"))
        .applyInPandas(_ranker(k, n_cells), "query_id long, vec_id long, score double")
    )
    # An id with several vectors is one candidate of one query.
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
