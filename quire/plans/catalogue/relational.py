"""Merging of parts, roll-ups, counts, as-of matches, windows over time, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import asof, ledger, quality
from quire.plans.catalogue import query
from quire.streaming import incremental


def chunks(t) -> DataFrame:
    """Documents as items: a source is a document, its parts are by doc_id modulo 4."""
    return t.documents.select(
        F.col("source").alias("doc_id"), (F.col("doc_id") % 4 + 1).cast("int").alias("part_no"), F.col("doc_id").alias("idx"), (F.col("doc_id") % 60).cast("int").alias("page_idx"),
        F.concat(F.lit("images/"), "doc_id").alias("img_path"), (F.col("n_chars") < 15_000).alias("ok"),
    )


_CHUNKS = """
with c as (select source as doc_id, cast(doc_id % 4 + 1 as int) as part_no, doc_id as idx, cast(doc_id % 60 as int) as page_idx, n_chars < 15000 as ok from documents),
bad as (select distinct doc_id, part_no from c where not ok), good as (select c.* from c left join bad using (doc_id, part_no) where bad.part_no is null)
"""
_MERGED = """select doc_id, part_no, cast(row_number() over (partition by doc_id order by part_no, idx) - 1 as int) as idx, cast(page_idx + (part_no - 1) * 60 as int) as page_idx,
       concat('part', lpad(cast(part_no as varchar), 3, '0'), '/images/', idx) as img_path from good"""


@query(_CHUNKS + _MERGED)
def merge_parts_offset(t):
    c = chunks(t)
    return ledger.merge_items(c, c.select("doc_id", "part_no").distinct(), partial=True)


@query(_CHUNKS + _MERGED + " where doc_id not in (select doc_id from bad)")
def merge_all_or_nothing(t):
    c = chunks(t)
    return ledger.merge_items(c, c.select("doc_id", "part_no").distinct())


@query("select conv_id as doc_id, string_agg(trim(text), chr(10) || chr(10) order by turn) as text from conversations group by 1")
def merge_texts(t):
    parts = t.conversations.select(F.col("conv_id").alias("doc_id"), F.concat(F.lit("part_"), "turn").alias("name"), "text")
    return ledger.merge_texts(parts)


@query("""
select source as doc_id, bool_or(n_chars > 15000) as table_fallback_used, cast(sum(n_chars % 3) as bigint) as warnings, array_to_string(flatten(list(case when doc_id % 2 = 0 then [concat('w', doc_id)] else [] end order by doc_id)), ',') as messages
from documents group by 1""")
def merge_warnings(t):
    parts = t.documents.select(F.col("source").alias("doc_id"), F.col("doc_id").alias("part_no"), (F.col("n_chars") > 15_000).alias("table_fallback_used"), (F.col("n_chars") % 3).alias("warnings"), F.expr("if(doc_id % 2 = 0, array(concat('w', doc_id)), null)").alias("messages"))
    return ledger.merge_warnings(parts).withColumn("messages", F.array_join("messages", ","))


@query("""
select source as doc_id, case when bool_or(n_chars > 19000) then 'failed' when bool_or(n_chars > 12000) then 'done_without_tables' else 'done' end as status, count(*) filter (n_chars > 19000) as failed_parts from documents group by 1""")
def document_status(t):
    one = ledger.status(F.col("n_chars") <= 19_000, F.col("n_chars") > 12_000)
    return ledger.document_status(t.documents.select(F.col("source").alias("doc_id"), one.alias("status")))


@query("""
with d as (select doc_id, n_chars % 200 as pages from documents)
select doc_id, cast(k + 1 as bigint) as part_no, cast(k * 60 as bigint) as first_page, cast(least(k * 60 + 60, pages) - 1 as bigint) as last_page from d, unnest(generate_series(0, greatest((pages - 1) // 60, 0))) as g(k) where true""")
def page_parts(t):
    docs = t.documents.select("doc_id", F.expr("n_chars % 200").alias("pages"))
    return ledger.page_parts(docs).select("doc_id", "part_no", "first_page", "last_page")


@query("""
with s as (select conv_id, turn, text, count(*) over (partition by conv_id) as total from conversations),
p as (select conv_id, case when turn in (0, 1, 2, total // 2, total - 1) then case when turn % 2 = 1 and conv_id % 2 = 0 then text else '  ' end end as x from s)
select conv_id as doc_id, not (coalesce(sum(length(x)), 0) > 120) and coalesce(sum(length(trim(x))), 0) = 0 as scanned from p group by 1""")
def scanned_documents(t):
    total = t.conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("total"))
    pages = t.conversations.join(total, "conv_id").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("page_idx"), F.expr("if(turn % 2 = 1 and conv_id % 2 = 0, text, '  ')").alias("text"), "total")
    return ledger.is_scanned(pages)


@query("""
select count(distinct conv_id) as documents, count(*) as blocks, cast(count(*) as bigint) as entities, cast(0 as bigint) as relations, count(*) filter (turn % 3 <> 2) as smiles_candidates from conversations""")
def corpus_summary(t):
    value = F.expr("element_at(array('CCO', 'c1ccccc1', 'x'), cast(turn % 3 as int) + 1)")
    entity = F.struct(F.lit(None).cast("string").alias("canonical_id"), value.alias("value"), F.lit(None).cast("string").alias("normalized"))
    block = F.struct(F.array(entity).alias("entities"), F.array().cast("array<string>").alias("relations"))
    return quality.corpus_summary(t.conversations.groupBy("conv_id").agg(F.collect_list(block).alias("blocks")))


@query("select user_id, array_to_string(list_sort(list_distinct(list(event_type))), ',') as event_types from events group by 1")
def distinct_types(t):
    return quality.type_lists(t.events, "user_id", "event_type", "event_types").withColumn("event_types", F.array_join("event_types", ","))


_NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query(" union all ".join(f"select '{n}' as \"table\", count(*) as rows from {n}" for n in _NAMES))
def table_counts(t):
    return quality.table_counts({n: getattr(t, n) for n in _NAMES})


@query("""
select p.event_id, max(v.event_id) as view_id from events p left join events v on v.user_id = p.user_id and v.event_type = 'view' and v.ts <= p.ts
and not exists (select 1 from events w where w.user_id = p.user_id and w.event_type = 'view' and w.ts <= p.ts and w.ts > v.ts) where p.event_type = 'purchase' group by 1""")
def nearest_preceding_metric(t):
    """Each purchase with the last view of its user: one window over both sides, no range join."""
    found = asof.last_before(t.events.where("event_type = 'purchase'"), t.events.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id")), ["user_id"], "ts", ["view_id"])
    return found.select("event_id", "view_id")


@query("""
select time_bucket(interval '1 day', ts) as window_start, event_type, count(*) as events, round(sum(value), 4) as total from events group by 1, 2""")
def tumbling_windows(t):
    df = incremental.tumbling(t.events, "1 day")
    return df.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events", F.round("total", 4).alias("total"))


@query("""
with g as (select user_id, ts, case when ts - lag(ts) over w < interval '6 hours' then 0 else 1 end as new from events window w as (partition by user_id order by ts)),
s as (select user_id, ts, sum(new) over (partition by user_id order by ts rows unbounded preceding) as n from g)
select user_id, min(ts) as session_start, max(ts) + interval '6 hours' as session_end, count(*) as events from s group by user_id, n""")
def session_windows(t):
    df = incremental.sessions(t.events, "6 hours")
    return df.select("user_id", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")), "events")


@query("""
select l_returnflag, l_linestatus, count(*) as lines, round(sum(l_quantity), 2) as quantity from lineitem group by rollup (l_returnflag, l_linestatus)""")
def rollup_totals(t):
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("""
select 'union' as op, count(*) as n from (select c_nationkey as k from customer union select s_nationkey from supplier) union all
select 'intersect', count(*) from (select c_nationkey from customer intersect select s_nationkey from supplier) union all
select 'except', count(*) from (select c_custkey from customer except select o_custkey from orders)""")
def set_operations(t):
    c, s = t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k"))
    ops = {"union": c.union(s).distinct(), "intersect": c.intersect(s), "except": t.customer.select("c_custkey").subtract(t.orders.select("o_custkey"))}
    return quality.table_counts(ops).withColumnsRenamed({"table": "op", "rows": "n"})
