"""Lookups with a cascade of key forms, and the language routing of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import vocabulary as V
from quire.functions.text import alias_key, language_code, literal_map, publication_key, world_number


def cascade(rows: DataFrame, cache: DataFrame, key: str, forms: list[tuple[Column, Column]], out: str = "value") -> DataFrame:
    """Left join with the first form of the key that the cache has; adds ``out`` (null if none).

    ``forms`` are pairs of Columns, one over ``key`` of the rows and one over the cache's
    ``key``.  Forms are one equi-join: each row and each cache entry is listed once per form.
    """
    wanted = rows.select(key).distinct()
    asked = wanted.select(F.col(key), F.posexplode(F.array(*(a for a, _ in forms))).alias("form", "k"))
    held = cache.select(F.col("value"), F.col("key").alias("__raw"), F.posexplode(F.array(*(b for _, b in forms))).alias("form", "k"))
    # Of entries whose keys have one form, the first by key counts.
    first = Window.partitionBy("form", "k").orderBy("__raw")
    held = held.where("k <> ''").withColumn("__n", F.row_number().over(first)).where("__n = 1")
    found = asked.join(held, ["form", "k"]).groupBy(key).agg(F.min_by("value", "form").alias(out))
    return rows.join(found, key, "left")


def biblio_forms(key: str) -> list[tuple[Column, Column]]:
    """As written, upper case, lower case, without separators, letters and digits only."""
    own, entry = F.col(key), F.col("key")
    return [(own, entry), (F.upper(own), entry), (F.lower(own), entry), (publication_key(own), entry), (alias_key(own), alias_key(entry))]


def biblio(rows: DataFrame, cache: DataFrame, key: str = "doc_id", out: str = "metadata") -> DataFrame:
    return cascade(rows, cache, key, biblio_forms(key), out)


def world_forms(key: str) -> list[tuple[Column, Column]]:
    own, entry = F.coalesce(world_number(F.col(key)), F.col(key)), F.col("key")
    return [(own, entry), (F.upper(own), entry), (F.lower(own), entry)]


def route_language(files: DataFrame, cache: DataFrame | None = None, allowed: list[str] | None = None, stem: str = "stem") -> DataFrame:
    """Adds lang and lang_source: the office's own metadata for WO files, else the prefix, else the first allowed.

    ``cache``: key, value (the publication language).
    """
    ok = lambda c: F.when(c.isin(*allowed), c) if allowed else c
    fallback = F.lit(allowed[0] if allowed else "en")
    prefix = ok(literal_map(V.PREFIX_LANGUAGE)[F.upper(F.regexp_extract(stem, "^([A-Za-z]{2})", 1))])
    df, official = files, F.lit(None).cast("string")
    if cache is not None:
        df = cascade(files, cache, stem, world_forms(stem), "__lang")
        official = F.when(F.upper(stem).startswith("WO"), ok(literal_map(V.LANGUAGE_PACK)[language_code(F.col("__lang"))]))
    lang = F.coalesce(official, prefix, fallback)
    source = F.when(official.isNotNull(), F.lit("wipo")).when(prefix.isNotNull(), F.lit("prefix")).otherwise(F.lit("fallback"))
    return df.select(*files.columns, lang.alias("lang"), source.alias("lang_source"))
