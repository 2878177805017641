"""Intermediate tables in the shared folder of the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of this machine only where that is unset and everything runs in this process."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return f"{named.rstrip('/')}/quire-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(f"file://{tempfile.mkdtemp(prefix='quire-tables-')}")
    return _own[0]


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Writes df as Parquet, with options of the writer, and reads it again, which cuts its lineage."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Deletes this application's tables, once no DataFrame that was made from them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
