"""Best-fit packing of documents into fixed-length sequences, certified by lower bounds.

1. Every whole text is tokenized and ended by id 0.  Only a document longer than a
   sequence is cut, into full pieces and a rest; a full piece is a sequence.
2. The other pieces are dealt by hash into groups of bounded size.  A group is packed by
   best-fit decreasing over a table of free space (lengths are small integers).
3. Dual feasible functions give a lower bound of the group's number of bins, its
   certificate.  Where the packing meets the bound, all bins but the loosest (the rounding
   of this group) are closed; where there is a gap, loosest bins stay open until their
   free space exceeds the gap, or until they hold an eighth of a group's pieces.  Eight
   groups put the pieces of their open bins together and pack them again, until one group
   is left.
4. Every piece carries the number of bins and the bound of the group that closed its
   sequence, and ``certificate`` gives both for the whole table.

Scale: no group has more pieces than a group of the first round, because at most
``group / MERGE`` pieces of each are handed on, whatever its gap; so a task's memory is bounded
and each round handles an eighth of the pieces of the round before, at most.  Groups are
dealt by a hash that also takes the place in the written table, so that many equal rows
are no large group.  Every round is written to the scratch folder.  Pieces travel with
their rows, so there is no join.

Defined results: a null or empty text is the single id 0; a very long text is cut into full pieces
and a rest; repeated rows are documents of their own; of pieces of one length, which
sequence gets which is decided by their id, piece and checksum, null ids first; a null id
stays null; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.llm.common import sliced, small_batches, written
from quire.llm.tokens import word_tokens

#: Tokens of a sequence, groups whose open bins meet, pieces of a group.
SEQUENCE, MERGE, GROUP = 2048, 8, 8192
END = b"\x00\x00\x00\x00"


def _pieces(length: int, path: str | None):
    """Batches of (id, text) to those of (id, piece, start, length, crc); the tasks of one call share the words that a process has met."""
    call = uuid.uuid4().hex

    def run(batches):
        tokens = word_tokens(path)
        tokens.serve(call)
        for b in sliced(batches):
            row, piece, size, crc = [], [], [], []
            for i, ids in enumerate(tokens.batch(b.column(1).to_pylist())):
                ids += END
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    row.append(i)
                    piece.append(k)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            piece = np.array(piece, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece.astype(np.int32)), pa.array(piece * length), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                ["id", "piece", "start", "length", "crc"],
            )

    return run


def token_pieces(docs: DataFrame, length: int = SEQUENCE, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, crc): the pieces of every document's ids."""
    small_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(_pieces(length, path), f"id {picked.schema['id'].dataType.simpleString()}, piece int, start long, length long, crc long")


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each size (given in falling order), and each bin's free space."""
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit f is set if a bin with free space f exists
    bins, at, free = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    for i, s in enumerate(sizes.tolist()):
        fits = mask >> s
        if fits:
            f = s + (fits & -fits).bit_length() - 1
            b = by_free[f].pop()
            if not by_free[f]:
                mask ^= 1 << f
        else:
            f, b = capacity, len(free)
            free.append(capacity)
        bins[i], at[i], free[b] = b, capacity - f, f - s
        if f > s:
            by_free[f - s].append(b)
            mask |= 1 << (f - s)
    return bins, at, np.array(free, np.int64)


def least_bins(sizes: np.ndarray, capacity: int, counted: bool = False) -> int:
    """A lower bound of the number of bins by dual feasible functions, of sizes or of their counts.

    One family counts sizes over C - e as whole bins and leaves out those under e, for
    every e up to C / 2; the other rounds (k + 1) * size / C down, for k up to 30.
    """
    if not sizes.any():
        return 0
    n = sizes if counted else np.bincount(sizes, minlength=capacity + 1)
    total = np.cumsum(n * np.arange(capacity + 1))
    count = np.cumsum(n)
    half = capacity // 2
    e = np.arange(half + 1)
    whole = count[capacity] - count[capacity - e]
    large_n, large = count[capacity - e] - count[half], total[capacity - e] - total[half]
    small = total[half] - np.where(e > 0, total[np.maximum(e, 1) - 1], 0)
    found = int((whole + large_n + np.maximum(0, -(-(small - (large_n * capacity - large)) // capacity))).max())
    x = np.arange(capacity + 1)
    for k in range(1, 31):
        y = (k + 1) * x
        u = np.where(y % capacity == 0, x * k, y // capacity * capacity)  # k times the function, so that it is whole
        found = max(found, int(-(-int((n * u).sum()) // (k * capacity))))
    return max(found, int(-(-total[capacity] // capacity)))


def open_bins(bins: np.ndarray, free: np.ndarray, bound: int, capacity: int, most: int) -> np.ndarray:
    """Which bins exchange their documents with other groups: the loosest ones, with ``most`` pieces at most.

    ``bins`` has the bin of each piece.
    """
    order = np.argsort(-free, kind="stable")
    gap = len(free) - bound
    need = 1 if gap <= 0 else int(np.searchsorted(np.cumsum(free[order]), (gap + 1) * capacity)) + 1
    held = np.cumsum(np.bincount(bins, minlength=len(free))[order])
    out = np.zeros(len(free), bool)
    out[order[: min(need, int(np.searchsorted(held, most, "right")))]] = True
    return out & (free > 0)


def _packer(capacity: int, level: int, last: bool, most: int):
    def run(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["length", "id", "piece", "crc"], ascending=[False, True, True, True], na_position="first", ignore_index=True)
        sizes = t["length"].to_numpy()
        bins, at, free = best_fit_decreasing(sizes, capacity)
        bound = least_bins(sizes, capacity)
        stay = np.zeros(len(free), bool) if last else open_bins(bins, free, bound, capacity, most)
        t["sequence_id"] = (level << 58) + (int(key[0]) << 24) + bins
        t["offset"], t["group_bins"], t["group_bound"], t["open"] = at, len(free), bound, stay[bins]
        return t

    return run


def pack(pieces: DataFrame, capacity: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """Adds sequence_id, offset, group_bins and group_bound to rows with id, piece, crc and length (of 1 to ``capacity``)."""
    cols = pieces.columns
    one = F.lit(1).cast("long")
    full = pieces.where(F.col("length") >= capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id())
    full = full.select(*cols, "sequence_id", F.lit(0).cast("long").alias("offset"), one.alias("group_bins"), one.alias("group_bound"))
    rest = pieces.where(F.col("length") < capacity)
    n = rest.count()
    groups = max(1, -(-n * 8 // (group * 7))) if n > group else 1  # seven eighths on average leave room for uneven dealing
    place = F.pmod(F.monotonically_increasing_id(), F.lit(65_521))
    rest = rest.withColumn("g", F.pmod(F.xxhash64("id", "piece", "crc", "length", place), F.lit(groups)))
    done, level = [full], 0
    while True:
        last = groups == 1
        schema = StructType([*rest.schema, *StructType.fromDDL("sequence_id long, offset long, group_bins long, group_bound long, open boolean")])
        packed = written(rest.groupBy("g").applyInPandas(_packer(capacity, level, last, group // MERGE), schema), "packed")
        done.append(packed.where(~F.col("open")).select(*cols, "sequence_id", "offset", "group_bins", "group_bound"))
        if last:
            break
        groups, level = -(-groups // MERGE), level + 1
        rest = packed.where("open").withColumn("g", F.expr(f"g div {MERGE}")).select(*cols, "g")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def certificate(packed: DataFrame, capacity: int = SEQUENCE) -> tuple[int, int]:
    """Number of sequences, and the lower bound of it by the lengths of all pieces (``capacity`` counts at most come to the driver)."""
    sequences = packed.where("offset = 0").count()
    full, counts = 0, np.zeros(capacity + 1, np.int64)
    for length, n in packed.groupBy("length").count().collect():
        if length >= capacity:
            full += n
        else:
            counts[length] = n
    return sequences, full + least_bins(counts, capacity, counted=True)


def pack_documents(docs: DataFrame, capacity: int = SEQUENCE, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, crc, sequence_id, offset, group_bins, group_bound."""
    return pack(written(token_pieces(docs, capacity, path, id_col, text_col), "pieces"), capacity)
