"""Binding of mentions within sentences, over one row.

The mentions of a block are an array in its row, so nearest-neighbour and containment
rules need no join and no shuffle, whatever the number of blocks.  They are read in
Arrow batches, like the mentions.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import functions as F

from quire.functions import rowwise
from quire.functions.mentions import listed, records

RELATION = "struct<type:string,source:int,target:int,confidence:double,rule:string,distance:int,sentence:int>"
_TYPES = {
    "type": pa.string(), "source": pa.int32(), "target": pa.int32(), "confidence": pa.float64(),
    "rule": pa.string(), "distance": pa.int32(), "sentence": pa.int32(),
}


@lru_cache(1)
def _binder():
    def read(texts: pa.Array, entities: pa.Array) -> pa.Array:
        return listed([rowwise.relations(t or "", e) if len(e) > 1 else [] for t, e in zip(texts.to_pylist(), records(entities))], _TYPES)

    return F.arrow_udf(read, f"array<{RELATION}>")


def bind(df, text: str = "text", entities: str = "entities"):
    """Adds ``relations``: metric values, then roles by wording, by chunk, by the only material of a sentence."""
    return df.withColumn("relations", _binder()(F.col(text), F.col(entities)))
