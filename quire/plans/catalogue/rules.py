"""Rules that plain prose doesn't meet: wordings of roles, refused values, pairs, tables of every form, second runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import mentions, text
from quire.operators import ledger, registry, relations, search, tables
from quire.plans import ingest, parse
from quire.plans.catalogue import query
from quire.plans.catalogue.stores import documents

_WORDINGS = """case p_partkey % 8
    when 0 then concat('The emitter is Compound ', p_partkey, '.') when 1 then concat('Compound ', p_partkey, ' in anode.')
    when 2 then concat('EQE of ', p_size, ' V at lab.') when 3 then concat('CE ', p_size, ' cd/A and EQE of ', p_size + 1, ' %.')
    when 4 then concat('Luminance ', p_size, ' cd/m2; lifetime ', p_size + 1, ' h.') when 5 then concat('CIE ', p_size, ', ', p_size + 1, ' today.')
    when 6 then concat('Compound ', p_partkey, ' host, voltage ', p_size, ' V.') else concat('Compound ', p_partkey, ', which is a host.') end"""


def wordings(t) -> DataFrame:
    df = t.spread("part", "p_partkey", "p_size").withColumn("text", F.expr(_WORDINGS))
    return relations.bind(df.withColumn("entities", mentions.entities(F.col("text"))))


_N, _S = "cast(p_partkey as varchar)", "cast(p_size as varchar)"


@query(f"""
select p_partkey, 'has_role' as type, concat('Compound ', p_partkey) as source, 'emitter' as target, 'pattern_role_material' as rule, 0.92::double as confidence, 11 as distance, 0 as sentence from part where p_partkey % 8 = 0 union all
select p_partkey, 'has_role', concat('Compound ', p_partkey), 'anode', 'pattern_material_in_layer', 0.9, cast(length(concat('Compound ', p_partkey, ' in ')) as int), 0 from part where p_partkey % 8 = 1 union all
select p_partkey, 'has_value', 'ce', {_S}, 'metric_unit_match', 0.85, 3, 0 from part where p_partkey % 8 = 3 union all
select p_partkey, 'has_value', 'eqe', cast(p_size + 1 as varchar), 'metric_unit_match', 0.85, 7, 0 from part where p_partkey % 8 = 3 union all
select p_partkey, 'has_value', 'luminance', {_S}, 'metric_unit_match', 0.85, 10, 0 from part where p_partkey % 8 = 4 union all
select p_partkey, 'has_value', 'lifetime', cast(p_size + 1 as varchar), 'metric_unit_match', 0.85, 9, 1 from part where p_partkey % 8 = 4 union all
select p_partkey, 'has_value', 'cie', concat(p_size, ',', p_size + 1), 'cie_coord_inline', 0.95, 0, 0 from part where p_partkey % 8 = 5 union all
select p_partkey, 'has_value', 'voltage', {_S}, 'metric_unit_match', 0.85, 8, 0 from part where p_partkey % 8 = 6 union all
select p_partkey, 'has_role', concat('Compound ', p_partkey), 'host', 'chunk_role_binding', 0.82, cast(length(concat('Compound ', p_partkey, ' ')) as int), 0 from part where p_partkey % 8 = 6 union all
select p_partkey, 'has_role', concat('Compound ', p_partkey), 'host', 'nearest_role', 0.7, cast(length(concat('Compound ', p_partkey, ', which is a ')) as int), 0 from part where p_partkey % 8 = 7""")
def binding_rules(t):
    """Every rule of values and roles; values of a wrong unit are bound to nothing."""
    df = text.exploded(wordings(t), F.col("relations"), "r", "p_partkey", "entities")
    value = lambda end: F.get("entities", F.col(f"r.{end}"))["value"].alias(end)
    return df.select("p_partkey", "r.type", value("source"), value("target"), "r.rule", "r.confidence", "r.distance", "r.sentence")


@query("""
select p_partkey, 'metric' as type, 'cie' as value, cast(p_size as double) as x, cast(p_size + 1 as double) as y from part where p_partkey % 8 = 5 union all
select p_partkey, 'value', concat(p_size, ',', p_size + 1), p_size, p_size + 1 from part where p_partkey % 8 = 5""")
def coordinate_mentions(t):
    df = text.exploded(wordings(t), F.filter("entities", lambda e: e["value_pair"].isNotNull()), "e", "p_partkey")
    return df.select("p_partkey", "e.type", "e.value", F.col("e.value_pair")[0].alias("x"), F.col("e.value_pair")[1].alias("y"))


@query("""
select p_partkey, 'anode' as value, 'anode' as normalized, cast(length(concat('Compound ', p_partkey, ' in ')) as int) as start from part where p_partkey % 8 = 1""")
def layer_mentions(t):
    df = text.exploded(wordings(t), F.filter("entities", lambda e: e["type"] == "device_layer"), "e", "p_partkey")
    return df.select("p_partkey", "e.value", "e.normalized", "e.start")


# ---- tables ----


def forms(t) -> DataFrame:
    """A table per part, in four forms: a role column, a material over two rows, coordinate pairs, no structure."""
    html = F.expr("""case p_partkey % 4
        when 0 then concat('<table><tr><th>Material</th><th>Host</th><th>Voltage (V)</th></tr><tr><td>Compound ', p_partkey, '</td><td>yes</td><td>', p_size, '</td></tr></table>')
        when 1 then concat('<table><tr><th>Sample</th><th>EQE (%)</th></tr><tr><td rowspan="2">Compound ', p_partkey, '</td><td>', p_size, '</td></tr><tr><td>', p_size + 1, '</td></tr></table>')
        when 2 then concat('<table><tr><th>Name</th><th>CIE</th></tr><tr><td>part-', p_partkey, '</td><td>', p_size, ', ', p_size + 1, '</td></tr></table>')
        else concat('<table><tr><td>Compound ', p_partkey, ' was used as host</td></tr></table>') end""")
    return t.part.select(F.concat(F.lit("t"), "p_partkey").alias("table_id"), html.alias("html"))


_ID = "concat('t', p_partkey) as table_id"


@query(f"""
select {_ID}, 'row_has_metric' as type, 'table_row_key_binding' as rule, 2 as distance, concat('t', p_partkey, '_row002') as sentence_id from part where p_partkey % 4 = 0 union all
select {_ID}, 'has_value', 'table_col_binding', 0, concat('t', p_partkey, '_row002') from part where p_partkey % 4 = 0 union all
select {_ID}, 'has_role', 'table_role_column', 1, concat('t', p_partkey, '_row002') from part where p_partkey % 4 = 0 union all
select {_ID}, unnest(['row_has_metric', 'row_has_metric']), 'table_row_key_binding', 1, concat('t', p_partkey, '_row00', unnest([2, 3])) from part where p_partkey % 4 = 1 union all
select {_ID}, unnest(['has_value', 'has_value']), 'table_col_binding', 0, concat('t', p_partkey, '_row00', unnest([2, 3])) from part where p_partkey % 4 = 1 union all
select {_ID}, unnest(['row_has_metric', 'has_value']), unnest(['table_row_key_binding', 'table_col_binding']), unnest([1, 0]), concat('t', p_partkey, '_row002') from part where p_partkey % 4 = 2 union all
select {_ID}, 'has_role', 'pattern_material_as_role', cast(length(concat('Compound ', p_partkey, ' was used as ')) as int), concat('t', p_partkey, '_row001_s000') from part where p_partkey % 4 = 3""")
def table_forms(t):
    return tables.table_relations(forms(t)).select("table_id", "type", "rule", "distance", "sentence_id")


@query(f"""
select {_ID}, concat('mat:COMPOUND', p_partkey) as canonical_id, cast(null as double) as x, cast(null as double) as y from part where p_partkey % 4 <> 2 union all
select {_ID}, concat('mat:PART', p_partkey), null, null from part where p_partkey % 4 = 2 union all
select {_ID}, null, cast(p_size as double), cast(p_size + 1 as double) from part where p_partkey % 4 = 2""")
def table_materials_and_pairs(t):
    """Materials of row names, promoted where the cell has no mention, and pairs of a coordinate column."""
    e = tables.table_entities(forms(t)).where("type = 'material' or value_pair is not null")
    return e.select("table_id", "canonical_id", F.col("value_pair")[0].alias("x"), F.col("value_pair")[1].alias("y")).distinct()


@query("""
select p_brand as table_id, unnest([0, 1, 2]) as col, unnest(['Material', 'Measured EQE (%)', 'Measured CE (cd/A)']) as header, unnest(['row_key', 'metric', 'metric']) as kind, 2 as header_rows from part group by 1""")
def table_header_levels(t):
    head = "<table><tr><th rowspan=\"2\">Material</th><th colspan=\"2\">Measured</th></tr><tr><th>EQE (%)</th><th>CE (cd/A)</th></tr>"
    rows = F.array_join(F.collect_list(F.expr("concat('<tr><td>Compound ', p_partkey, '</td><td>', p_size, '</td><td>', p_size, '</td></tr>')")), "")
    html = t.part.groupBy(F.col("p_brand").alias("table_id")).agg(F.concat(F.lit(head), rows, F.lit("</table>")).alias("html"))
    return tables.column_kinds(html).select("table_id", "col", "header", "kind", "header_rows")


# ---- search, registry, experiments, rows ----

_QUERY = "the of that"


def _blocks(t) -> DataFrame:
    docs = t.spread("documents", "doc_id", "text", "source")
    return docs.join(t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id").select(F.col("doc_id").alias("block_id"), F.col("source").alias("doc_id"), "text", F.expr(f"if(doc_id % 50 = 7, '{_QUERY}', 'text')").alias("block_type"), "embedding")


def _dimension() -> int:
    return 64


@query(f"""
with b as (select d.doc_id as block_id, d.text, case when d.doc_id % 50 = 7 then '{_QUERY}' else 'text' end as block_type, e.embedding::double[] as embedding from documents d join embeddings e on e.vec_id = d.doc_id where d.source = 'src0'),
t as (select block_id as k, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') as t from b), n as (select count(*) as n, avg(len(t)) as mean from t),
h as (select k, len(t) as length, term, len(list_filter(t, lambda x: x = term)) as tf from t, unnest(['the', 'of', 'that']) as q(term) where list_contains(t, term)),
f as (select term, count(*) as df from h group by 1),
w as (select k, 0.5 * sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))) as score from h join f using (term), n group by 1 union all select block_id, 0.25 from b where block_type = '{_QUERY}'),
words as (select k, sum(score) as score from w group by 1 order by 2 desc, 1 limit 10),
near as (select block_id as k, list_cosine_similarity(embedding, {search.hash_vector(_QUERY, _dimension())}::double[]) as score from b order by 2 desc, 1 limit 10),
a as (select k, coalesce((score - min(score) over ()) / nullif(max(score) over () - min(score) over (), 0), 1.0) as x from words),
v as (select k, coalesce((score - min(score) over ()) / nullif(max(score) over () - min(score) over (), 0), 1.0) as y from near)
select coalesce(a.k, v.k) as block_id, round((coalesce(x, 0) * 0.5 + coalesce(y, 0) * 0.5) / 1.0, 6) as score from a full join v on a.k = v.k order by (coalesce(x, 0) * 0.5 + coalesce(y, 0) * 0.5) desc, 1 limit 10""")
def block_search(t):
    """Blocks of one document by words, block type and vector."""
    found = search.search_blocks(_blocks(t), _QUERY, doc_id="src0", dim=_dimension())
    return found.select("block_id", F.round("score", 6).alias("score"))


_ALIAS = "upper(regexp_replace(p_name, '[^A-Za-z0-9]+', '', 'g'))"


@query(f"""
with known as (select {_ALIAS} as alias_key, min(concat('mat:KNOWN', p_size % 7)) as id from part where p_partkey % 3 = 0 group by 1)
select p_partkey, coalesce(id, concat('mat:RAW', upper(substr(sha1(lower(trim(p_name))), 1, 12)))) as canonical_id from part left join known on alias_key = {_ALIAS}""")
def known_aliases(t):
    """Mentions whose names an alias table knows take its ids."""
    e = t.part.select(
        F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("pos"), F.col("p_partkey").cast("string").alias("entity_id"), F.lit("material").alias("entity_type"),
        F.col("p_name").alias("value_text"), F.lower("p_name").alias("normalized"), F.lit(None).cast("string").alias("canonical_id"),
    )
    known = t.part.where("p_partkey % 3 = 0").groupBy(text.alias_key(F.col("p_name")).alias("alias_key")).agg(F.min(F.expr("concat('mat:KNOWN', p_size % 7)")).alias("canonical_id"))
    return registry.mentions(e, known).select(F.col("entity_id").cast("long").alias("p_partkey"), "canonical_id")


@query("""
select cast(l_orderkey as varchar) as doc_id, concat('example_', l_returnflag) as example_id, string_agg(concat('m', l_partkey), ',' order by l_linenumber, l_partkey) as materials,
       coalesce(string_agg(concat('r', l_partkey), ',' order by l_linenumber, l_partkey) filter (l_partkey % 2 = 0), '') as performance,
       coalesce(string_agg(concat('r', l_partkey), ',' order by l_linenumber, l_partkey) filter (l_partkey % 2 = 1), '') as roles from lineitem group by 1, 2""")
def experiment_rollup(t):
    """Lines as blocks of examples: materials and relations of each, in order."""
    entity = F.expr("array(named_struct('type', 'material', 'entity_id', concat('m', l_partkey)))").alias("entities")
    relation = F.expr("array(named_struct('type', if(l_partkey % 2 = 0, 'has_value', 'has_role'), 'relation_id', concat('r', l_partkey)))").alias("relations")
    block = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("doc_id"), F.concat(F.lit("example_"), "l_returnflag").alias("example_id"), F.struct("l_linenumber", "l_partkey").alias("paragraph_index"),
        F.concat(F.lit("b"), "l_partkey").alias("block_id"), entity, relation,
    )
    listed = lambda c, name: F.array_join(c, ",").alias(name)
    return parse.experiments(block).select("doc_id", "example_id", listed("materials_used", "materials"), listed("performance_relations", "performance"), listed("role_relations", "roles"))


@query("""
select cast(conv_id as varchar) as doc_id, 'molecule' as table_name, concat_ws('_', 'e', conv_id, turn) as row_key, 'structure cannot be read' as failed_checks from conversations where turn % 3 = 1""")
def rejected_rows(t):
    """Molecules whose structure cannot be read don't stop the rows beside them."""
    docs = documents(t)
    value = lambda b: F.element_at(F.array(F.lit("CCO"), F.lit("C1CO"), F.lit("c1ccccc1")), (b["claim_no"] % 3).cast("int") + 1)
    changed = F.transform("blocks", lambda b: b.withField("entities", F.transform(b["entities"], lambda e: e.withField("canonical_id", F.lit(None).cast("string")).withField("value", value(b)).withField("normalized", F.lit(None).cast("string")))))
    _, bad = ingest.checked(ingest.flatten(docs.withColumn("blocks", changed)))
    return bad.select("doc_id", "table_name", "row_key", F.array_join("failed_checks", ",").alias("failed_checks"))


# ---- runs ----

_RUNS = """
with f as (select c_custkey as n, concat('f', c_custkey) as file, c_custkey % 4 <> 1 and c_custkey % 4 <> 2 as ok, case c_custkey % 4 when 1 then 'RuntimeError in RapidTable' when 2 then 'out of paper' end as error_msg from customer)
"""


def _run(t):
    def run(files: DataFrame, with_tables: bool) -> DataFrame:
        kind = F.expr("cast(substring(file, 2) as bigint) % 4")
        n = F.expr("cast(substring(file, 2) as bigint)")
        if with_tables:
            error = F.when(kind == 1, F.lit("RuntimeError in RapidTable")).when(kind == 2, F.lit("out of paper"))
        else:
            error = F.when(n % 3 == 0, F.lit("failed again"))
        log = F.when(error.isNotNull(), F.concat(F.lit("log of "), "file", F.lit("" if with_tables else " again")))
        return files.select("file", error.isNull().alias("ok"), error.alias("error_msg"), log.alias("error_log"), F.lit(None).cast("int").alias("timeout_sec"))

    files = t.customer.select(F.concat(F.lit("f"), "c_custkey").alias("file"))
    return ledger.run_with_fallback(files, run)


@query(_RUNS + """
select file, case when n % 4 = 1 then n % 3 <> 0 else ok end as ok, case when n % 4 = 1 then case when n % 3 = 0 then 'failed again' end else error_msg end as error_msg,
       case when n % 4 = 1 then case when n % 3 = 0 then concat('log of ', file, ' again') end when n % 4 = 2 then concat('log of ', file) end as error_log,
       n % 4 = 1 as table_fallback_used, n % 4 = 2 as table_fallback_skipped, case when n % 4 = 1 then concat('log of ', file) end as initial_error_log,
       case when n % 4 = 2 or (n % 4 = 1 and n % 3 = 0) then 'failed' when n % 4 = 1 then 'done_without_tables' else 'done' end as status from f""")
def second_runs(t):
    """Files whose error looks like one of table recognition run once more, without tables."""
    return _run(t).drop("timeout_sec")


_PARTS = """
with p as (select source as doc_id, doc_id as part_no, concat('part', doc_id) as part, n_chars <= 12000 as ok, case when n_chars > 12000 then 'too long' end as error_msg, doc_id % 5 = 0 as used, doc_id % 7 = 0 and n_chars > 12000 as skipped,
    case when n_chars > 12000 then concat('log', doc_id) end as error_log from documents),
a as (select doc_id, count(*) filter (not ok) as failed_parts, arg_min(concat('part ', part, ' failed: ', error_msg), part_no) filter (not ok) as first_error, bool_or(used) as table_fallback_used, count(*) filter (skipped) as table_fallback_skipped_parts,
    coalesce(string_agg(error_log, ',' order by part_no), '') as logs, max(part_no) % 2 = 0 as markdown from p group by 1)
"""


@query(_PARTS + """
select doc_id, failed_parts, table_fallback_used, table_fallback_skipped_parts, logs, failed_parts = 0 and markdown as ok,
       case when failed_parts > 0 then first_error when not markdown then 'merge lacks markdown' end as error_msg,
       case when failed_parts > 0 or not markdown then 'failed' when table_fallback_used then 'done_without_tables' else 'done' end as status from a""")
def document_results(t):
    """Parts of a document, with their logs and second runs, and what could not be merged."""
    none = F.lit(None).cast("string")
    parts = t.documents.select(
        F.col("source").alias("doc_id"), F.col("doc_id").alias("part_no"), F.concat(F.lit("part"), "doc_id").alias("part"), (F.col("n_chars") <= 12_000).alias("ok"), F.expr("if(n_chars > 12000, 'too long', null)").alias("error_msg"),
        F.expr("if(n_chars > 12000, concat('log', doc_id), null)").alias("error_log"), none.alias("initial_error_log"), F.lit(None).cast("int").alias("timeout_sec"),
        (F.col("doc_id") % 5 == 0).alias("table_fallback_used"), F.expr("doc_id % 7 = 0 and n_chars > 12000").alias("table_fallback_skipped"),
    )
    merged = t.documents.groupBy(F.col("source").alias("doc_id")).agg((F.max("doc_id") % 2 == 0).alias("markdown"), F.lit(True).alias("items"), F.lit(True).alias("pages"))
    found = ledger.document_results(parts, merged)
    return found.select("doc_id", "failed_parts", "table_fallback_used", "table_fallback_skipped_parts", F.array_join(F.transform("part_error_logs", lambda x: x["log"]), ",").alias("logs"), "ok", "error_msg", "status")


_PAGES = """
with p as (select conv_id // 4 as doc_id, conv_id % 4 + 1 as part_no, turn as pos, turn as page_idx, not (conv_id % 11 = 3 and turn = 1) as ok from conversations),
h as (select doc_id, part_no, bool_and(ok) and (doc_id * 4 + part_no - 1) % 13 <> 5 as good, case when part_no % 2 = 0 then concat('b', doc_id * 4 + part_no - 1) end as backend, concat('v', doc_id * 4 + part_no - 1) as version from p group by 1, 2)
"""


@query(_PAGES + """
select p.doc_id, cast(row_number() over (partition by p.doc_id order by p.part_no, pos) - 1 as int) as pos, cast(page_idx + (p.part_no - 1) * 60 as bigint) as page_idx, coalesce(x.backend, '') as backend, x.version
from p join h using (doc_id, part_no) join (select doc_id, arg_min(backend, part_no) as backend, arg_min(version, part_no) as version from h where good group by 1) x using (doc_id) where good""")
def merge_pages(t):
    """Pages of parts; the first backend and version that a good part names."""
    c = t.conversations.select(F.expr("conv_id div 4").alias("doc_id"), (F.col("conv_id") % 4 + 1).alias("part_no"), F.col("turn").alias("pos"), F.col("turn").alias("page_idx"), F.expr("not (conv_id % 11 = 3 and turn = 1)").alias("ok"), "conv_id")
    heads = c.select("doc_id", "part_no", (F.col("conv_id") % 13 != 5).alias("there"), F.expr("if(part_no % 2 = 0, concat('b', conv_id), null)").alias("backend"), F.concat(F.lit("v"), "conv_id").alias("version")).distinct()
    pages, named = ledger.merge_pages(c.drop("conv_id"), heads, partial=True)
    return pages.join(named, "doc_id").select("doc_id", "pos", F.col("page_idx").cast("long").alias("page_idx"), F.coalesce("backend", F.lit("")).alias("backend"), "version")


@query("""
with l as (select user_id, arg_max(event_type, event_id) as kind, max(ts) as ts from events group by 1)
select concat('file', user_id) as file, strftime(ts, '%Y-%m-%d %H:%M:%S') as time, case kind when 'error' then 'failed' else 'done' end as status, case kind when 'error' then repeat('x', 500) end as error_msg from l""")
def ledger_times(t):
    """A mark notes the time, here that of a user's last event."""
    last = t.events.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("kind"), F.max("ts").alias("ts"))
    results = last.select(F.concat(F.lit("file"), "user_id").alias("file"), ledger.status(F.col("kind") != "error", F.lit(False)).alias("status"), F.expr("if(kind = 'error', repeat('x', 700), null)").alias("error_msg"), "ts")
    empty = t.spark.createDataFrame([], "file string, time string, status string, error_msg string")
    return ledger.mark(empty, results, now=F.col("ts"))


@query("""
select event_id, left(repeat(event_type, 90), 2097152) as kept, right(repeat(event_type, 90), 500) as tail from events""")
def failure_logs(t):
    kept, tail = ledger.failure_log(F.repeat("event_type", 90))
    return t.events.select("event_id", kept.alias("kept"), tail.alias("tail"))
