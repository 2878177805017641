"""The cross-document material registry and tables that are written again by key.

Tables are DataFrames; a merge returns the new state, which is written as a new version.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import alias_key, fallback_id
from quire.operators.graph import connected
from quire.sources.scratch import written

PENDING = "PENDING_MAPPING"
CANONICAL = "canonical_id string, canonical_key string, preferred_name string, first_seen_doc_id string, last_seen_doc_id string"
ALIAS = "alias_key string, alias_text string, canonical_id string, first_seen_doc_id string, last_seen_doc_id string"
USAGE = "doc_id string, canonical_id string, mention_count long, alias_keys array<string>"


def alias_texts(value: Column, normalized: Column) -> Column:
    """Trimmed non-empty names of a mention, each once, in order."""
    return F.array_distinct(F.filter(F.transform(F.array(value, normalized), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))


def mentions(entities: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Material mentions with the id they stand for.

    ``entities``: doc_id, pos (order in the document), entity_id, entity_type,
    value_text, normalized, canonical_id.  ``existing``: alias_key, canonical_id.  A
    known alias wins, the first of the mention's aliases first; else the mention's own
    id; else an id from its first name.  Adds texts, keys (aligned) and canonical_id.
    """
    df = entities.where("entity_type = 'material'").withColumn("texts", alias_texts(F.col("value_text"), F.col("normalized")))
    pairs = F.filter(F.transform("texts", lambda x: F.struct(x.alias("text"), alias_key(x).alias("key"))), lambda p: p["key"] != "")
    seed = F.coalesce(F.get("texts", F.lit(0)), F.col("entity_id"), F.lit(""))
    own = F.when(F.coalesce("canonical_id", F.lit("")).isin("", PENDING), fallback_id(seed)).otherwise(F.col("canonical_id"))
    df = df.withColumn("pairs", pairs).withColumn("canonical_id", own)
    if existing is not None:
        rows = df.select("doc_id", "pos", F.posexplode("pairs").alias("n", "p")).select("doc_id", "pos", "n", F.col("p.key").alias("alias_key"))
        known = rows.join(existing.select("alias_key", F.col("canonical_id").alias("known")).where("known <> ''"), "alias_key")
        known = known.groupBy("doc_id", "pos").agg(F.min_by("known", "n").alias("known"))
        df = df.join(known, ["doc_id", "pos"], "left").withColumn("canonical_id", F.coalesce("known", "canonical_id")).drop("known")
    return df


def canonical_rows(found: DataFrame) -> DataFrame:
    """Per (doc, id): key and the shortest name, the earliest of equal ones."""
    name = F.coalesce(F.get("texts", F.lit(0)), F.col("canonical_id"))
    first = F.min_by("name", "pos")
    df = found.withColumn("name", name).groupBy("doc_id", "canonical_id").agg(F.min_by("name", F.struct(F.length("name"), "pos")).alias("preferred_name"), first.alias("first_name"))
    key = F.when(F.col("canonical_id").startswith("mat:"), F.substring("canonical_id", 5, 1_000))
    key = F.coalesce(F.nullif(key, F.lit("")), alias_key(F.col("first_name")))
    return df.select("doc_id", "canonical_id", key.alias("canonical_key"), "preferred_name")


def alias_rows(found: DataFrame) -> DataFrame:
    """Per (doc, alias): the id of its first mention and the longest text among mentions with that id."""
    df = found.select("doc_id", "pos", "canonical_id", F.posexplode("pairs").alias("n", "p")).select("doc_id", F.struct("pos", "n").alias("at"), "canonical_id", F.col("p.key").alias("alias_key"), F.col("p.text").alias("text"))
    first = df.groupBy("doc_id", "alias_key").agg(F.min_by("canonical_id", "at").alias("canonical_id"))
    same = df.join(first, ["doc_id", "alias_key", "canonical_id"])
    text = F.min_by("text", F.struct(-F.length("text"), "at"))
    return same.groupBy("doc_id", "alias_key", "canonical_id").agg(text.alias("alias_text"))


def usage_rows(found: DataFrame) -> DataFrame:
    keys = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform("pairs", lambda p: p["key"])))))
    return found.groupBy("doc_id", "canonical_id").agg(F.count(F.lit(1)).alias("mention_count"), keys.alias("alias_keys"))


def align(entities: DataFrame, existing: DataFrame) -> DataFrame:
    """Mentions of many documents, read in the order of seq, with ids as if one followed the other.

    ``entities`` has seq (of any type with an order) besides the columns of ``mentions``.
    Where every mention has one key, the first id given to an alias holds; mentions with
    several keys hand ids on from alias to alias.  So aliases that meet in a mention, directly
    or by others, are one component, and the distinct tuples of aliases of each component, with
    their first places, are read in order; components are read side by side.
    """
    df = mentions(entities)
    keys = F.transform("pairs", lambda p: p["key"])
    tuples = df.withColumn("keys", F.array_distinct(keys)).groupBy("keys", F.col("canonical_id").alias("own")).agg(F.min(F.struct("seq", "pos")).alias("first"))
    tuples = written(tuples.select("keys", "own", F.col("first.seq").alias("seq"), F.col("first.pos").cast("long").alias("pos"), F.lit(1).alias("kind")), "alias-tuples")
    start = existing.where("canonical_id <> ''").select(F.array("alias_key").alias("keys"), F.col("canonical_id").alias("own"), F.lit(None).cast(tuples.schema["seq"].dataType).alias("seq"), F.lit(0).cast("long").alias("pos"), F.lit(0).alias("kind"))

    plain = (lambda x: x) if tuples.schema["seq"].dataType.simpleString() == "string" else int

    def fold(t: pd.DataFrame) -> pd.DataFrame:
        known: dict[str, str] = {}  # before the document that is read
        new: dict[str, str] = {}
        out, seq = [], None
        for r in t.sort_values(["kind", "seq", "pos"]).itertuples():
            if r.seq != seq:
                for k, v in new.items():
                    known.setdefault(k, v)
                new, seq = {}, r.seq
            got = next((known[k] for k in r.keys if k in known), r.own)
            for k in r.keys:
                new.setdefault(k, got)
            if r.kind:
                out.append((list(r.keys), r.own, plain(r.seq), got))
        for k, v in new.items():
            known.setdefault(k, v)
        # In later documents all aliases of a tuple are known, and what they stand for never changes.
        rows = [(keys, own, seq, got, known[keys[0]] if keys else own) for keys, own, seq, got in out]
        return pd.DataFrame(rows, columns=["keys", "own", "seq", "first", "later"])

    links = tuples.where("size(keys) > 1").select(F.col("keys")[0].alias("u"), F.explode(F.expr("slice(keys, 2, size(keys))")).alias("v"))
    roots = connected(links)
    first = F.coalesce(F.get("keys", F.lit(0)), F.concat(F.lit("own:"), "own"))  # mentions without a key concern no other
    rows = tuples.unionByName(start).withColumn("u", first).join(roots, "u", "left").withColumn("component", F.coalesce("root", "u")).drop("u", "root")
    kind = tuples.schema["seq"].dataType.simpleString()
    read = rows.groupBy("component").applyInPandas(fold, f"keys array<string>, own string, seq {kind}, first string, later string")
    read = read.select(F.col("keys").alias("__k"), F.col("own").alias("__o"), F.col("seq").alias("__s"), "first", "later")
    both = df.withColumn("__keys", F.array_distinct(keys)).join(read, [F.col("__keys") == F.col("__k"), F.col("canonical_id") == F.col("__o")])
    aligned = F.when(F.col("seq") == F.col("__s"), F.col("first")).otherwise(F.col("later"))
    return both.withColumn("canonical_id", aligned).select(*df.columns)


def merge_canonical(old: DataFrame, new: DataFrame) -> DataFrame:
    """Last document wins for key and name; the first one that showed an id is kept.  ``new`` has seq."""
    latest = new.groupBy("canonical_id").agg(
        F.max_by("canonical_key", "seq").alias("k"), F.max_by("preferred_name", "seq").alias("n"), F.min_by("doc_id", "seq").alias("f"), F.max_by("doc_id", "seq").alias("l")
    )
    return old.join(latest, "canonical_id", "full").select(
        "canonical_id", F.coalesce("k", "canonical_key").alias("canonical_key"), F.coalesce("n", "preferred_name").alias("preferred_name"),
        F.coalesce("first_seen_doc_id", "f").alias("first_seen_doc_id"), F.coalesce("l", "last_seen_doc_id").alias("last_seen_doc_id"),
    )


def merge_alias(old: DataFrame, new: DataFrame) -> DataFrame:
    """The last text, the first id: an alias never changes what it stands for."""
    latest = new.groupBy("alias_key").agg(
        F.max_by("alias_text", "seq").alias("t"), F.min_by("canonical_id", "seq").alias("c"), F.min_by("doc_id", "seq").alias("f"), F.max_by("doc_id", "seq").alias("l")
    )
    return old.join(latest, "alias_key", "full").select(
        "alias_key", F.coalesce("t", "alias_text").alias("alias_text"), F.coalesce("canonical_id", "c").alias("canonical_id"),
        F.coalesce("first_seen_doc_id", "f").alias("first_seen_doc_id"), F.coalesce("l", "last_seen_doc_id").alias("last_seen_doc_id"),
    )


def replace_by_key(old: DataFrame, new: DataFrame, keys: list[str], touched: DataFrame | None = None) -> DataFrame:
    """Rows of ``old`` whose keys are not among ``touched`` (or ``new``), and all of ``new``."""
    gone = (touched if touched is not None else new).select(*keys).distinct()
    return old.join(gone, keys, "left_anti").unionByName(new)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last row, by ``seq``, of each key; rows of ``old`` come before all of ``new``."""
    cols = old.columns
    rest = [c for c in cols if c not in keys]
    marked = old.select(*cols, F.lit(None).cast("long").alias("__s")).unionByName(new.select(*cols, F.col(seq).cast("long").alias("__s")))
    value = F.max_by(F.struct(*rest), F.struct(F.col("__s").isNotNull(), F.col("__s"))).alias("v")
    return marked.groupBy(*keys).agg(value).select(*keys, *(F.col(f"v.{c}").alias(c) for c in rest)).select(*cols)


def orphans(canonical: DataFrame, alias: DataFrame, usage: DataFrame) -> DataFrame:
    """Ids that neither an alias nor a usage names."""
    return canonical.join(alias.select("canonical_id"), "canonical_id", "left_anti").join(usage.select("canonical_id"), "canonical_id", "left_anti")


def rebuild(entities: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Registry tables from all entities, documents in the order of their ids."""
    order = entities.select("doc_id").distinct().withColumn("seq", F.col("doc_id"))
    spark = entities.sparkSession
    found = align(entities.join(order, "doc_id"), spark.createDataFrame([], ALIAS))
    with_seq = lambda df: df.join(order, "doc_id")
    canonical = merge_canonical(spark.createDataFrame([], CANONICAL), with_seq(canonical_rows(found)))
    alias = merge_alias(spark.createDataFrame([], ALIAS), with_seq(alias_rows(found)))
    return canonical, alias, usage_rows(found)


def rebuild_summary(entities: DataFrame) -> DataFrame:
    """How many documents with materials, and how many mentions, a rebuild reads."""
    return entities.where("entity_type = 'material'").agg(F.countDistinct("doc_id").alias("documents"), F.count(F.lit(1)).alias("material_entities"))


def backfill_key(df: DataFrame, key: str, doc: str, part: str) -> DataFrame:
    """Missing keys as doc::part, with ``unknown`` for a missing document."""
    made = F.concat_ws("::", F.coalesce(F.nullif(F.col(doc), F.lit("")), F.lit("unknown")), F.col(part))
    return df.withColumn(key, F.coalesce(F.nullif(F.col(key), F.lit("")), made))


def split_key(df: DataFrame, key: str, doc: str) -> DataFrame:
    """The inverse: missing documents from the key."""
    return df.withColumn(doc, F.coalesce(F.col(doc), F.nullif(F.split_part(key, F.lit("::"), F.lit(1)), F.lit(""))))


def missing_references(child: DataFrame, parent: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Rows whose reference has no target; references with a null pass."""
    condition = reduce(lambda a, b: a & b, (child[c] == parent[p] for c, p in keys.items()))
    present = reduce(lambda a, b: a & b, (child[c].isNotNull() for c in keys))
    return child.where(present).join(parent, condition, "left_anti")
