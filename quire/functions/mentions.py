"""Typed mentions with character spans.

``entities(text)`` is an array of structs in a fixed order: values with units, colour
coordinates, metrics by keyword, materials by pattern, layers, roles.  It is read in Arrow
batches by the functions of ``rowwise``: some fifty patterns that mostly don't occur are
ruled out there by one look at the lower-case text, where expressions of the JVM would scan
it for each; that takes a tenth of the time.
"""

from __future__ import annotations

from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import rowwise
from quire.functions import vocabulary as V

ENTITY = "struct<i:int,type:string,value:string,unit:string,value_num:double,value_pair:array<double>,start:int,end:int,normalized:string>"
_TYPES = {
    "i": pa.int32(), "type": pa.string(), "value": pa.string(), "unit": pa.string(), "value_num": pa.float64(),
    "value_pair": pa.list_(pa.float64()), "start": pa.int32(), "end": pa.int32(), "normalized": pa.string(),
}


def listed(rows: list[list[dict]], types: dict[str, pa.DataType]) -> pa.Array:
    """Lists of records to an array of lists of structs."""
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = [x for r in rows for x in r]
    columns = [pa.array([x.get(k) for x in flat], t) for k, t in types.items()]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, fields=[pa.field(*x) for x in types.items()]))


def records(lists: pa.Array) -> list[list[dict]]:
    """The other way round."""
    flat = lists.flatten()
    names = [f.name for f in flat.type]
    rows = [dict(zip(names, x)) for x in zip(*(c.to_pylist() for c in flat.flatten()))]
    ends = np.cumsum([0, *(n or 0 for n in lists.value_lengths().to_pylist())]).tolist()
    return [rows[a:b] for a, b in zip(ends[:-1], ends[1:])]


@lru_cache(1)
def _reader():
    def read(texts: pa.Array) -> pa.Array:
        rows = [rowwise.entities(t) for t in texts.to_pylist()]
        for r in rows:
            for i, e in enumerate(r):
                e["i"] = i
        return listed(rows, _TYPES)

    return F.arrow_udf(read, f"array<{ENTITY}>")


def entities(text: Column) -> Column:
    """All mentions, numbered from 0 in ``i``; none of a null text."""
    return _reader()(text)


def alias_pairs(text: Column) -> Column:
    """(alias, canonical) of names that explain one another in brackets, both directions."""
    found = []
    for p in V.ALIAS_PAIRS:
        part = lambda g, p=p: F.regexp_extract_all(text, F.lit(p), F.lit(g))
        found.append(F.arrays_zip(part(1).alias("l"), part(2).alias("r")))
    key_length = lambda x: F.length(F.regexp_replace(x, "[^A-Za-z0-9]+", ""))

    def pair(x: Column) -> Column:
        left, right = F.trim(x["l"]), F.trim(x["r"])
        short = lambda c: F.regexp_like(c, F.lit(V.ABBREVIATION))
        canonical = (
            F.when(short(left) & ~short(right), left)
            .when(short(right) & ~short(left), right)
            .when(key_length(left) <= key_length(right), left)
            .otherwise(right)
        )
        one = lambda c: F.struct(c.alias("alias"), canonical.alias("canonical"))
        return F.array(one(left), one(right))

    return F.flatten(reduce(lambda a, b: F.concat(a, b), (F.transform(f, pair) for f in found)))


def reference_numerals(text: Column) -> Column:
    """(number, label) of parts named like ``label (12)``."""
    pattern = "(?U)" + V.REFERENCE_NUMERAL
    part = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    return F.zip_with(part(2), part(1), lambda n, label: F.struct(n.alias("number"), F.lower(F.trim(label)).alias("label")))
