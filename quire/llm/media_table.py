"""The media column on DataFrames: stored streams, and what is read back from them.

Defined results: a null text is an empty one, whose payload is 64 zero bytes; very long texts are
stored whole, a few documents of a batch at a time; repeated rows are stored one by one, and equal
texts give equal streams and features; null ids pass through; an empty table gives an empty result;
other columns are ignored, whatever their names.  There is nothing to tie.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import media
from quire.llm.common import small_batches

_LONGS = pa.list_(pa.int64())


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): every whole text, padded, as a transport stream.  Equal texts give equal streams."""
    small_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            for b in _slices(batch):
                texts = b.column(1).to_pylist()
                sizes = [len((t or "").encode("utf-8", "surrogatepass")) for t in texts]
                streams = [media.mux(media.padded(t)) for t in texts]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(streams, pa.binary())], ["id", "n_bytes", "media"])

    return picked.mapInArrow(run, f"id {picked.schema['id'].dataType.simpleString()}, n_bytes long, media binary")


def _slices(batch: pa.RecordBatch, rows: int = 256):
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def streams(table: DataFrame, media_col: str = "media") -> DataFrame:
    """Reads a media column back: one row per elementary stream.

    Columns: the other columns of the table, then pid, stream_type, program, units, gaps,
    duplicates, pts, offsets, random_access, payload.
    """
    small_batches(table.sparkSession)
    others = [c for c in table.columns if c != media_col]
    added = "pid int, stream_type int, program int, units int, gaps int, duplicates int, pts array<long>, offsets array<long>, random_access array<long>, payload binary"
    types = [pa.int32()] * 6 + [_LONGS] * 3 + [pa.binary()]
    names = [x.split()[0] for x in added.split(", ")]

    def run(batches):
        for batch in batches:
            for b in _slices(batch):
                rows, found = [], []
                for i, raw in enumerate(b.column(len(others)).to_pylist()):
                    for s in media.demux(raw).streams:
                        rows.append(i)
                        found.append([getattr(s, n) for n in names])
                kept = b.take(pa.array(rows, pa.int64()))
                new = [pa.array(c, t) for c, t in zip(zip(*found), types)] if found else [pa.array([], t) for t in types]
                yield pa.RecordBatch.from_arrays([*kept.columns[: len(others)], *new], [*others, *names])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema if f.name != media_col)
    return table.select(*(F.col(f"`{c}`") for c in others), F.col(media_col)).mapInArrow(run, ", ".join(x for x in (kept, added) if x))


def digests(table: DataFrame) -> DataFrame:
    """(id, n_bytes, media) rows to digests of the stored form and of the payload read back."""
    cols = [("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]

    def run(batches):
        for batch in batches:
            for b in _slices(batch):
                rows = []
                for raw in b.column(2).to_pylist():
                    m = media.demux(raw)
                    data = m.streams[0].payload if m.streams else b""
                    rows.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), len(raw), hashlib.sha256(raw).hexdigest(), media.feature(m)))
                arrays = [pa.array(c, t) for c, (_, t) in zip(zip(*rows), cols)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *arrays], ["id", "n_bytes", *(n for n, _ in cols)])

    id_type = table.schema["id"].dataType.simpleString()
    return table.select("id", "n_bytes", "media").mapInArrow(
        run, f"id {id_type}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )
