"""Flattened documents, row checks, sinks, keys and health."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire import schemas
from quire.functions import text
from quire.operators import quality, search
from quire.plans import ingest
from quire.plans.catalogue import query
from quire.sources import writers


def documents(t) -> DataFrame:
    """Conversations as structured documents: a turn is a block, its role an entity, every second turn a relation."""
    entity = F.struct(
        F.concat_ws("_", F.lit("e"), "conv_id", "turn").alias("entity_id"), F.lit("material").alias("type"), F.col("role").alias("value"), F.lit(None).cast("double").alias("value_num"),
        F.lit(None).cast("string").alias("unit"), F.lit(None).cast("array<double>").alias("value_pair"), F.array(F.lit(0), F.length("role")).alias("span"), F.upper("role").alias("normalized"),
        F.concat(F.lit("mat:"), F.upper("role")).alias("canonical_id"),
    )
    relation = F.from_json(F.expr("""to_json(named_struct('relation_id', concat_ws('_', 'r', conv_id, turn), 'type', 'has_role', 'source_entity_id', concat_ws('_', 'e', conv_id, turn), 'confidence', 0.5D, 'distance', turn))"""), schemas.RELATION)
    block = F.from_json(F.expr("""to_json(named_struct('block_id', concat_ws('_', 'b', conv_id, turn), 'type', if(turn = 0, 'title', 'text'), 'text', text, 'claim_no', turn))"""), schemas.BLOCK)
    block = block.withField("entities", F.array(entity)).withField("relations", F.when(F.col("turn") % 2 == 1, F.array(relation)).otherwise(F.array().cast(f"array<{schemas.RELATION}>")))
    rows = t.conversations.groupBy(F.col("conv_id").cast("string").alias("doc_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("turn").alias("o"), block.alias("b"))), lambda a, b: (a["o"] - b["o"]).cast("int")), lambda x: x["b"]).alias("blocks"))
    meta = F.from_json(F.concat(F.lit('{"title": "T'), "doc_id", F.lit('", "publication_number": ""}')), schemas.METADATA)
    none = F.lit(None)
    return rows.select("doc_id", F.lit("f").alias("source_file"), none.cast("string").alias("abstract"), meta.alias("metadata"), "blocks", none.cast("map<string,string>").alias("reference_numerals"), F.array().cast(f"array<{schemas.EXPERIMENT}>").alias("experiments"))


@query("select cast(conv_id as varchar) as doc_id, concat('T', conv_id) as title, cast(null as varchar) as publication_number, 'null' as reference_numerals from conversations group by conv_id")
def metadata_projection(t):
    return ingest.flatten(documents(t))["document"].select("doc_id", "title", "publication_number", "reference_numerals")


@query("select cast(conv_id as varchar) as doc_id, concat_ws('_', 'b', conv_id, turn) as block_id, cast(row_number() over (partition by conv_id order by turn) - 1 as int) as pos, case when turn = 0 then 'title' else 'text' end as block_type, cast(turn as int) as claim_no from conversations")
def flatten_blocks(t):
    return ingest.flatten(documents(t))["block"].select("doc_id", "block_id", "pos", "block_type", "claim_no")


@query("select concat_ws('_', 'b', conv_id, turn) as block_id, concat_ws('_', 'e', conv_id, turn) as entity_id, role as value_text, concat('mat:', upper(role)) as canonical_id, cast(length(role) as int) as span_end from conversations")
def flatten_entities(t):
    return ingest.flatten(documents(t))["entity"].select("block_id", "entity_id", "value_text", "canonical_id", F.col("span")[1].alias("span_end"))


@query("select concat_ws('_', 'b', conv_id, turn) as block_id, concat_ws('_', 'r', conv_id, turn) as relation_id, concat_ws('_', 'e', conv_id, turn) as source_entity_id, 0.5::double as confidence, cast(turn as int) as distance from conversations where turn % 2 = 1")
def flatten_relations(t):
    return ingest.flatten(documents(t))["relation"].select("block_id", "relation_id", "source_entity_id", "confidence", "distance")


@query("""
select cast(conv_id as varchar) as doc_id, 'material' as entity_types, case when count(*) filter (turn % 2 = 1) > 0 then 'has_role' else '' end as relation_types from conversations group by conv_id""")
def search_rows(t):
    rows = ingest.search_rows(ingest.flatten(documents(t)), 8)["search_document"]
    return rows.select("doc_id", F.array_join("entity_types", ",").alias("entity_types"), F.array_join("relation_types", ",").alias("relation_types"))


@query("""
select o_orderkey, array_to_string(list_filter([case when o_totalprice <= 100000 then 'price' end, case when o_orderstatus = 'P' then 'status' end], lambda x: x is not null), ',') as failed from orders
where o_totalprice <= 100000 or o_orderstatus = 'P'""")
def valid_rows(t):
    _, bad = ingest.valid_rows(t.orders, {"price": F.col("o_totalprice") > 100_000, "status": F.col("o_orderstatus") != "P"})
    return bad.select("o_orderkey", F.array_join("failed_checks", ",").alias("failed"))


@query("select user_id, max(event_id) as event_id, arg_max(event_type, event_id) as event_type from events group by 1")
def last_by_id(t):
    return writers.last_by_id(t.events.select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("select conv_id, turn from conversations where turn % 3 <> 0 and trim(text) <> ''")
def searchable_blocks(t):
    return writers.searchable_blocks(t.conversations.withColumn("text", F.expr("if(turn % 3 = 0, '  ', text)"))).select("conv_id", "turn")




@query("select p_brand as doc_id, concat('/', min(p_partkey), '.md') as path from part group by 1")
def main_markdown(t):
    """The shortest path wins, then the smallest number in it."""
    return writers.main_markdown(t.part.select(F.col("p_brand").alias("doc_id"), F.concat(F.lit("/"), "p_partkey", F.lit(".md")).alias("path")))


@query("select distinct concat('u', user_id) as file from events where event_type = 'error'")
def failed_files(t):
    return writers.failed_files(t.events.select(F.concat(F.lit("u"), "user_id").alias("file"), F.expr("if(event_type = 'error', 'failed', 'done')").alias("status")))


@query(r"select term, count(*) as documents, cast(sum(tf) as bigint) as occurrences from (select doc_id, w as term, count(*) as tf from documents, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) as u(w) group by 1, 2) group by 1")
def inverted_index(t):
    return search.inverted_index(t.documents, "doc_id", "text").groupBy("term").agg(F.count(F.lit(1)).alias("documents"), F.sum("tf").alias("occurrences"))


@query("select event_id, event_id % 4 in (0, 1) as table_failure from events")
def error_classifier(t):
    error = F.expr("element_at(array('RuntimeError in RapidTable', 'failed: table_rec', 'table of contents', 'CUDA error'), cast(event_id % 4 as int) + 1)")
    return t.events.select("event_id", text.looks_like_table_failure(error).alias("table_failure"))


@query("""
select c_custkey, concat('WO2024', lpad(cast(c_custkey as varchar), 6, '0'), 'A1') as publication_key, concat('WO2024', lpad(cast(c_custkey as varchar), 6, '0')) as world_number,
       case c_custkey % 3 when 0 then 'en' when 1 then 'zh' else 'xx' end as language, concat('doc_wo_2024_', lpad(cast(c_custkey as varchar), 6, '0'), '_a1') as safe from customer""")
def publication_keys(t):
    number = F.concat(F.lit("2024"), F.lpad(F.col("c_custkey").cast("string"), 6, "0"))
    name = F.concat(F.lit("wo-2024/"), F.lpad(F.col("c_custkey").cast("string"), 6, "0"), F.lit("-a1"))
    language = F.expr("element_at(array('English', ' chinese', 'XX'), cast(c_custkey % 3 as int) + 1)")
    return t.customer.select("c_custkey", text.publication_key(name).alias("publication_key"), text.world_number(F.concat(F.lit("wo "), number)).alias("world_number"), text.language_code(language).alias("language"), text.safe_stem(name).alias("safe"))


@query("""select p_partkey, w as word, cast(i as int) as place from (select p_partkey, unnest(string_split(p_name, ' ')) as w, generate_subscripts(string_split(p_name, ' '), 1) as i from part)""")
def unnest_with_ordinality(t):
    return t.part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("i", "word")).select("p_partkey", "word", (F.col("i") + 1).alias("place"))


@query("""
select 'orders' as "table", true as "exists", count(*) as rows, 0::bigint as repeated_keys from orders union all
select 'lineitem', true, (select count(*) from lineitem), (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)) union all
select 'absent', false, 0, 0""")
def health(t):
    paths = {n: f"{t.folder}/{n}.parquet" for n in ("orders", "lineitem", "absent")}
    return quality.health(t.spark, paths, {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]})
