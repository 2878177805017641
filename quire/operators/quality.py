"""Counts over a corpus and its tables: quality summary, health, distinct types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import smiles


def corpus_summary(documents: DataFrame) -> DataFrame:
    """Documents, blocks, entities, relations and structure candidates, at most one per entity."""
    entities = F.flatten(F.transform("blocks", lambda b: b["entities"]))
    relations = F.flatten(F.transform("blocks", lambda b: b["relations"]))
    like = F.filter(entities, lambda e: smiles(e["canonical_id"], e["value"], e["normalized"]).isNotNull())
    total = lambda c, name: F.coalesce(F.sum(F.size(c)), F.lit(0)).cast("long").alias(name)
    return documents.agg(F.count(F.lit(1)).alias("documents"), total(F.col("blocks"), "blocks"), total(entities, "entities"), total(relations, "relations"), total(like, "smiles_candidates"))


def type_lists(rows: DataFrame, doc: str, type_: str, name: str) -> DataFrame:
    """Per document the distinct types, sorted."""
    return rows.where(F.col(type_).isNotNull()).groupBy(doc).agg(F.sort_array(F.collect_set(type_)).alias(name))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows), one count per table in one plan."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def health(spark, tables: dict[str, str], keys: dict[str, list[str]]) -> DataFrame:
    """(table, exists, rows, repeated_keys) of tables by path."""
    rows = []
    for name, path in tables.items():
        try:
            df = spark.read.parquet(path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows.append((name, False, 0, 0))
            continue
        key = keys.get(name, df.columns[:1])
        n, repeated = df.groupBy(*key).count().agg(F.sum("count"), F.count_if(F.col("count") > 1)).first()
        rows.append((name, True, n or 0, repeated))
    return spark.createDataFrame(rows, "table string, exists boolean, rows long, repeated_keys long")
