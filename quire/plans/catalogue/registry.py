"""The material registry, tables written by key, ledgers and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import ledger, lookups, registry
from quire.operators.registry import ALIAS, CANONICAL
from quire.plans.catalogue import query


def mentioned(t) -> DataFrame:
    """Parts as mentions: a brand is a document, a type an id, names alternate in spelling."""
    name = F.expr("case p_partkey % 3 when 0 then p_name when 1 then upper(p_name) else concat(p_name, '-') end")
    return t.part.select(
        F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("pos"), F.concat(F.lit("e"), "p_partkey").alias("entity_id"), F.lit("material").alias("entity_type"),
        name.alias("value_text"), F.lower("p_name").alias("normalized"), F.concat(F.lit("mat:"), "p_type").alias("canonical_id"),
    )


_M = """
with m as (select p_brand as doc_id, p_partkey as pos, case p_partkey % 3 when 0 then p_name when 1 then upper(p_name) else concat(p_name, '-') end as value_text, lower(p_name) as normalized,
           concat('mat:', p_type) as canonical_id, upper(replace(p_name, ' ', '')) as alias_key from part)
"""
_A = _M + """, a as (select doc_id, pos, 0 as n, value_text as text, canonical_id, alias_key from m union all
             select doc_id, pos, 1, normalized, canonical_id, alias_key from m where normalized <> value_text),
f as (select doc_id, alias_key, arg_min(canonical_id, pos * 2 + n) as canonical_id from a group by all),
rows as (select doc_id, alias_key, canonical_id, arg_max(text, length(text) * 1000000 - (pos * 2 + n)) as alias_text from a join f using (doc_id, alias_key, canonical_id) group by all)
"""
_SEQ = "cast(replace(doc_id, 'Brand#', '') as bigint)"


def _seq(df: DataFrame) -> DataFrame:
    return df.withColumn("seq", F.regexp_replace("doc_id", "Brand#", "").cast("long"))


@query(_M + "select doc_id, canonical_id, count(*) as mention_count, array_to_string(list_sort(list_distinct(list(alias_key))), ',') as alias_keys from m group by 1, 2")
def registry_usage(t):
    return registry.usage_rows(registry.mentions(mentioned(t))).withColumn("alias_keys", F.array_join("alias_keys", ","))


@query(_M + "select doc_id, canonical_id, substr(canonical_id, 5) as canonical_key, arg_min(value_text, length(value_text) * 1000000 + pos) as preferred_name from m group by 1, 2")
def registry_preferred_name(t):
    return registry.canonical_rows(registry.mentions(mentioned(t)))


@query(_A + "select doc_id, alias_key, canonical_id, alias_text from rows")
def registry_alias_rows(t):
    return registry.alias_rows(registry.mentions(mentioned(t)))


@query(_A + f"""select alias_key, arg_max(alias_text, {_SEQ}) as alias_text, arg_min(canonical_id, {_SEQ}) as canonical_id, arg_min(doc_id, {_SEQ}) as first_seen_doc_id,
       arg_max(doc_id, {_SEQ}) as last_seen_doc_id from rows group by alias_key""")
def registry_alias_first_writer(t):
    rows = _seq(registry.alias_rows(registry.mentions(mentioned(t))))
    return registry.merge_alias(t.spark.createDataFrame([], ALIAS), rows)


@query(_M + f""", c as (select doc_id, canonical_id, substr(canonical_id, 5) as canonical_key, arg_min(value_text, length(value_text) * 1000000 + pos) as preferred_name from m group by 1, 2)
select canonical_id, arg_max(canonical_key, {_SEQ}) as canonical_key, arg_max(preferred_name, {_SEQ}) as preferred_name, arg_min(doc_id, {_SEQ}) as first_seen_doc_id,
       arg_max(doc_id, {_SEQ}) as last_seen_doc_id from c group by canonical_id""")
def registry_canonical_merge(t):
    rows = _seq(registry.canonical_rows(registry.mentions(mentioned(t))))
    return registry.merge_canonical(t.spark.createDataFrame([], CANONICAL), rows)


@query(_M + f""", one as (select alias_key, arg_min(canonical_id, {_SEQ} * 10000000 + pos) as canonical_id, min({_SEQ}) as s0 from m group by 1),
firsts as (select m.*, {_SEQ} as s, one.canonical_id as known, s0 from m join one using (alias_key))
select doc_id, pos, case when s > s0 then known else canonical_id end as canonical_id from firsts""")
def registry_align(t):
    """Ids as if one document followed the other: a known alias gives the id, from the next document on."""
    rows = _seq(mentioned(t))
    found = registry.align(rows, t.spark.createDataFrame([], ALIAS))
    return found.select("doc_id", "pos", "canonical_id")


@query(_M + "select count(distinct doc_id) as documents, count(*) as material_entities from m")
def registry_rebuild_summary(t):
    return registry.rebuild_summary(mentioned(t))


@query("""
select o_orderkey from orders o where not exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey) and not exists (select 1 from lineitem l where l.l_partkey = o.o_orderkey)""")
def registry_orphans(t):
    ids = t.orders.select(F.col("o_orderkey").alias("canonical_id"))
    return registry.orphans(ids, t.lineitem.withColumnRenamed("l_orderkey", "canonical_id"), t.lineitem.withColumnRenamed("l_partkey", "canonical_id")).withColumnRenamed("canonical_id", "o_orderkey")


@query("select user_id, event_type, arg_max(value, event_id) as value, max(event_id) as event_id from events group by 1, 2")
def upsert_last_writer(t):
    rows = t.events.select("user_id", "event_type", "value", "event_id")
    half = rows.groupBy("user_id", "event_type").agg(F.min_by("value", "event_id").alias("value"), F.min("event_id").alias("event_id"))
    return registry.upsert(half, rows.join(half.select("event_id"), "event_id", "left_anti").select(rows.columns), ["user_id", "event_type"], "event_id")


_REPLACED = "select o_custkey, o_orderkey, 'new' as state from orders where o_orderstatus = 'F'"


@query(f"""
with n as ({_REPLACED}), merged as (select o_custkey, o_orderkey, 'old' as state from orders where o_custkey not in (select o_custkey from n) union all select * from n)
select o_custkey, state, count(*) as rows, cast(sum(o_orderkey) as bigint) as keys from merged group by 1, 2""")
def replace_details(t):
    old = t.orders.select("o_custkey", "o_orderkey", F.lit("old").alias("state"))
    new = t.orders.where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", F.lit("new").alias("state"))
    return registry.replace_by_key(old, new, ["o_custkey"]).groupBy("o_custkey", "state").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))


@query("""
with b as (select o_orderkey, case when o_orderkey % 3 = 0 then concat('k', o_orderkey) end as k, case when o_orderkey % 5 = 0 then '' else o_orderpriority end as doc from orders)
select o_orderkey, coalesce(k, concat(coalesce(nullif(doc, ''), 'unknown'), '::', o_orderkey)) as experiment_key from b""")
def experiment_key_backfill(t):
    df = t.orders.select("o_orderkey", F.expr("if(o_orderkey % 3 = 0, concat('k', o_orderkey), null)").alias("experiment_key"), F.expr("if(o_orderkey % 5 = 0, '', o_orderpriority)").alias("doc"), F.col("o_orderkey").cast("string").alias("part"))
    return registry.backfill_key(df, "experiment_key", "doc", "part").select("o_orderkey", "experiment_key")


@query("select o_orderkey, case when o_orderkey % 2 = 0 then o_orderstatus else o_orderpriority end as doc from orders")
def experiment_key_split(t):
    df = t.orders.select("o_orderkey", F.expr("if(o_orderkey % 2 = 0, o_orderstatus, null)").alias("doc"), F.concat_ws("::", "o_orderpriority", "o_orderkey").alias("k"))
    return registry.split_key(df, "k", "doc").select("o_orderkey", "doc")


@query("select l_orderkey, l_linenumber, count(*) as rows from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P') group by 1, 2")
def missing_references(t):
    found = registry.missing_references(t.lineitem, t.orders.where("o_orderstatus <> 'P'"), {"l_orderkey": "o_orderkey"})
    return found.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("rows"))


# ---- ledger ----

_LEDGER = """
with last as (select user_id, arg_max(event_type, event_id) as kind, max(event_id) as n from events group by 1),
ledger as (select concat('file', user_id) as file, case kind when 'error' then 'failed' when 'click' then 'done_without_tables' else 'done' end as status,
           case when n % 2 = 0 then 'v1' else 'v2' end as parser_version,
           case kind when 'error' then case when n % 3 = 0 then 'RuntimeError in RapidTable' else 'Traceback: out of paper' end end as error_msg from last)
"""


def _ledger(t) -> DataFrame:
    last = t.events.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("kind"), F.max("event_id").alias("n"))
    status = ledger.status(F.col("kind") != "error", F.col("kind") == "click")
    error = F.expr("if(kind = 'error', if(n % 3 = 0, 'RuntimeError in RapidTable', 'Traceback: out of paper'), null)")
    return last.select(F.concat(F.lit("file"), "user_id").alias("file"), status.alias("status"), F.expr("if(n % 2 = 0, 'v1', 'v2')").alias("parser_version"), error.alias("error_msg"))


@query(_LEDGER + "select concat('file', c_custkey) as file from customer where concat('file', c_custkey) not in (select file from ledger where status in ('done', 'done_without_tables') and parser_version = 'v2')")
def resume_pending(t):
    return ledger.pending(t.customer.select(F.concat(F.lit("file"), "c_custkey").alias("file")), _ledger(t), "v2")


@query(_LEDGER + "select file from ledger where error_msg = 'RuntimeError in RapidTable'")
def retry_failed(t):
    return ledger.retry(_ledger(t)).select("file")


@query(_LEDGER + "select status, count(*) as files from ledger group by 1")
def ledger_counts(t):
    return ledger.counts(_ledger(t))


@query(_LEDGER + """
select file, case when status = 'failed' then 'done' else status end as status, case when status = 'failed' then 'v3' else parser_version end as parser_version,
       case when status = 'failed' then repeat('x', 500) else error_msg end as error_msg from ledger""")
def ledger_mark(t):
    old = _ledger(t)
    again = old.where("status = 'failed'").select("file", F.lit("done").alias("status"), F.lit("v3").alias("parser_version"), F.repeat(F.lit("x"), F.lit(900)).alias("error_msg"))
    return ledger.mark(old, again)


# ---- lookups ----


@query("select c_custkey, case when c_custkey % 5 <> 4 then c_acctbal end as balance from customer")
def biblio_lookup_cascade(t):
    """Names asked for in several spellings find the record of the one that the cache holds."""
    cache = t.customer.select(F.col("c_name").alias("key"), F.col("c_acctbal").alias("value"))
    asked = F.expr("case c_custkey % 5 when 0 then c_name when 1 then upper(c_name) when 2 then replace(lower(c_name), '#', ' ') when 3 then replace(c_name, '#', '-/_') else concat(c_name, 'x') end")
    return lookups.biblio(t.customer.select("c_custkey", asked.alias("asked")), cache, "asked", "balance").select("c_custkey", "balance")


_STEMS = "concat(case c_custkey % 6 when 0 then 'CN' when 1 then 'jp' when 2 then 'WO2024' when 3 then 'ZZ' when 4 then 'EP' else 'DE' end, lpad(cast(c_custkey as {}), 6, '0'))"


@query("""
select c_custkey, case c_custkey % 6 when 2 then case when c_custkey % 4 = 0 then 'latin' else 'en' end when 4 then 'en' when 5 then 'latin' else 'en' end as lang,
       case c_custkey % 6 when 2 then case when c_custkey % 4 = 0 then 'wipo' else 'prefix' end when 4 then 'prefix' when 5 then 'prefix' else 'fallback' end as lang_source from customer""")
def language_routing(t):
    files = t.customer.select("c_custkey", F.expr(_STEMS.format("string")).alias("stem"))
    cache = files.where("c_custkey % 6 = 2 and c_custkey % 4 = 0").select(F.col("stem").alias("key"), F.lit(" French ").alias("value"))
    return lookups.route_language(files, cache, ["en", "latin"]).select("c_custkey", "lang", "lang_source")
