"""Writers: structured JSON, versioned tables, search documents, failed files, Markdown picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import natural_key


def structured_json(df: DataFrame, path: str, pretty: bool = False) -> None:
    """One JSON object per line and document; ``pretty``: indented, in a folder ``doc_id=...`` for each document."""
    if not pretty:
        df.write.mode("overwrite").json(path, ignoreNullFields=False)
        return
    whole = F.to_json(F.struct(*df.columns), {"pretty": "true", "ignoreNullFields": "false"})
    df.select("doc_id", whole.alias("value")).write.mode("overwrite").partitionBy("doc_id").text(path)


class Table:
    """A table as Parquet folders by version and bucket; a version is complete before its number is written.

    Rows are dealt into ``buckets`` by a hash of the column ``by``.  A write replaces the
    buckets that it names and leaves the others where they are, so it costs what it
    touches.  A reader never sees a version that is being written, and a write never
    replaces what it reads.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, by: str | None = None, buckets: int = 16):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.by, self.n = by, buckets if by else 1

    def _state(self) -> tuple[int, dict[int, int]]:
        """The last version, and the version of each bucket that holds rows."""
        try:
            row = self.spark.read.schema("n long, buckets map<string,long>, dealt int").json(f"{self.path}/versions").orderBy(F.desc("n")).first()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            row = None
        if row and self.by:
            self.n = row[2]  # a table keeps the number of buckets that it was made with
        return (row[0], {int(b): v for b, v in (row[1] or {}).items()}) if row else (0, {})

    def version(self) -> int:
        return self._state()[0]

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.by), F.lit(self.n)).cast("int") if self.by else F.lit(0)

    def buckets_of(self, df: DataFrame) -> list[int]:
        """Buckets that rows with these values of ``by`` are in: at most as many numbers as there are buckets."""
        self._state()
        return self._buckets_of(df)

    def _buckets_of(self, df: DataFrame) -> list[int]:
        return sorted(r[0] for r in df.select(self.bucket().alias("b")).distinct().collect())

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets."""
        return self._read(self._state()[1], buckets)

    def _read(self, state: dict[int, int], buckets: list[int] | None) -> DataFrame:
        paths = [f"{self.path}/v{v}/bucket={b}" for b, v in sorted(state.items()) if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, df: DataFrame, buckets: list[int] | None = None) -> int:
        """A new version with ``df`` in place of some buckets' rows, or of all rows."""
        return self._write(*self._state(), df, buckets)

    def _write(self, n: int, state: dict[int, int], df: DataFrame, buckets: list[int] | None) -> int:
        n, path = n + 1, self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v{n + 1}")
        df.withColumn("bucket", self.bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path.toString())
        names = [f.getPath().getName() for f in path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)]
        kept = {} if buckets is None else {b: v for b, v in state.items() if b not in buckets}
        kept |= {int(x.removeprefix("bucket=")): n for x in names if x.startswith("bucket=")}
        one = self.spark.createDataFrame([(n, {str(b): v for b, v in kept.items()}, self.n)], "n long, buckets map<string,long>, dealt int").coalesce(1)
        one.write.mode("append").json(f"{self.path}/versions")
        return n

    def replace(self, new: DataFrame, touched: DataFrame) -> int:
        """Rows with the values of ``by`` in ``touched`` go, ``new`` comes; only their buckets are read and written."""
        n, state = self._state()
        buckets = self._buckets_of(touched)
        old = self._read(state, buckets)
        kept = old.join(touched.select(self.by).distinct(), self.by, "left_anti").select(*old.columns)
        return self._write(n, state, kept.unionByName(new.select(*old.columns)), buckets)

    def vacuum(self) -> list[int]:
        """Deletes folders of versions that the last one doesn't use; returns their numbers."""
        n, state = self._state()
        fs = self.spark._jvm.org.apache.hadoop.fs
        gone = []
        for v in range(1, n + 1):
            folder = fs.Path(f"{self.path}/v{v}")
            if v not in state.values() and folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True):
                gone.append(v)
        return gone


def last_by_id(df: DataFrame, key: str, order: str) -> DataFrame:
    """Search documents: the last row of each id, as a bulk index keeps it."""
    latest = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("__n", F.row_number().over(latest)).where("__n = 1").drop("__n")


def searchable_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks with text that is not blank."""
    return blocks.where(F.trim(F.coalesce("text", F.lit(""))) != "")


def main_markdown(files: DataFrame) -> DataFrame:
    """Of (doc_id, path) the Markdown file to keep: the shortest path, the first by name of equal ones."""
    order = Window.partitionBy("doc_id").orderBy(F.size(F.split("path", "/")), F.length("path"), natural_key(F.col("path")))
    return files.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def failed_files(ledger: DataFrame) -> DataFrame:
    return ledger.where("status = 'failed'").select("file").distinct().orderBy("file")
