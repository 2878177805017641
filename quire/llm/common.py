"""What the operators of this folder share: scratch tables and partition counts."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.scratch import folder

#: Words as the contracts define them: runs of anything but the six ASCII white-space bytes.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a file of a table whose size is known to be small.
FILE_ROWS = 200_000


def written(df: DataFrame, name: str, most_rows: int | None = None) -> DataFrame:
    """Writes df as Parquet into the session's scratch folder (``quire.sources.scratch``) and reads it again.

    This cuts the lineage: later stages, and retries after a lost executor, read
    the files instead of computing the plan again.  With a bound on its rows a table is
    written in as few files as it needs.
    """
    if most_rows is not None:
        df = df.coalesce(-(-max(1, most_rows) // FILE_ROWS))
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more.

    Its cleaner acts when the driver collects garbage, which may not happen for long
    while executors do the work; steps that run block by block call this in between.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Deletes the files of written tables that nothing still to be computed reads."""
    for df in tables:
        spark = df.sparkSession
        for folder_ in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder_))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of an Arrow batch between the JVM and Python.  Spark's default of 10,000 is meant for narrow rows;
#: as many texts, some of them very long, would fill memory outside the heap.
BATCH_ROWS, SPARK_DEFAULT = 512, 10_000


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches of this session, unless the session has a bound of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, str(SPARK_DEFAULT))) == SPARK_DEFAULT:
        spark.conf.set(key, str(BATCH_ROWS))


def sliced(batches, rows: int = 256):
    """Arrow batches cut to fewer rows, so that a task holds the Python texts of few documents at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text):
    """Number of words of a text column as bigint; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*columns, seed: int = 0):
    """A number from 0 to below 1 by the hash of the columns, fine enough for shares of any table."""
    return F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 11).cast("double") / F.lit(2.0**53)
