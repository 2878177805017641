"""The registered queries over the driver's tables, each next to SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Tables of a folder by name: ``t.part``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str, *columns: str) -> DataFrame:
        """Columns of a table, dealt out over all cores where its files have fewer splits than there are cores.

        For queries that work long on each row; a table of many splits stays as it is.
        """
        df = getattr(self, name).select(*columns)
        cores = self.spark.sparkContext.defaultParallelism
        splits = -(-self._size(name) // (128 << 20))
        return df.repartition(cores) if splits < cores else df

    def _size(self, name: str) -> int:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return fs.getContentSummary(path).getLength()


def query(sql: str | None = None):
    """Registers a function of ``Tables`` under its name."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


from quire.plans.catalogue import graph, registry, relational, rules, search, stores, tables, text  # noqa: E402, F401
