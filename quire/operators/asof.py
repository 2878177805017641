"""As-of matches: for each row the last row of another table that is not later."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_before(left: DataFrame, right: DataFrame, keys: list[str], on: str, values: list[str]) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` with the same keys and ``on`` not after; null if there is none.

    Both sides are put together and one window carries the values forward, so the work is
    one sort by key, without pairs.
    """
    cols = left.columns
    l = left.select(*cols, *(F.lit(None).alias(f"__{v}") for v in values), F.lit(1).alias("__side"))
    r = right.select(*keys, on, *(F.col(v).alias(f"__{v}") for v in values), F.lit(0).alias("__side"))
    both = l.unionByName(r, allowMissingColumns=True)
    so_far = Window.partitionBy(*keys).orderBy(on, "__side").rowsBetween(Window.unboundedPreceding, 0)
    row = F.when(F.col("__side") == 0, F.struct(*(F.col(f"__{v}").alias(v) for v in values)))
    found = both.withColumn("__v", F.last(row, ignorenulls=True).over(so_far)).where("__side = 1")
    return found.select(*cols, *(F.col(f"__v.{v}").alias(v) for v in values))
