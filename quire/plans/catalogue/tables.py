"""HTML tables and whole documents, made from parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import tables
from quire.plans import parse
from quire.plans.catalogue import query


def html(t) -> DataFrame:
    """A table per brand: a row per part with its compound, size in % and price as cd/A."""
    row = F.expr("concat('<tr><td>Compound ', p_partkey, '</td><td>', p_size, '</td><td colspan=\"2\">', cast(p_retailprice as int), '</td></tr>')")
    head = "<table><tr><th>Material</th><th>EQE (%)</th><th colspan=\"2\">CE (cd/A)</th></tr>"
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("r")))), lambda x: x["r"]), "")
    return t.part.groupBy(F.col("p_brand").alias("table_id")).agg(F.concat(F.lit(head), rows, F.lit("</table>")).alias("html"))


_P = "with p as (select p_brand as table_id, p_partkey, p_size, cast(trunc(p_retailprice) as int) as price, row_number() over (partition by p_brand order by p_partkey) as r from part)"


@query(_P + """
select table_id, cast(r as int) as row, 0 as col, concat('Compound ', p_partkey) as text, 1 as rowspan, 1 as colspan, false as is_header from p union all
select table_id, cast(r as int), 1, cast(p_size as varchar), 1, 1, false from p union all select table_id, cast(r as int), 2, cast(price as varchar), 1, 2, false from p union all
select distinct table_id, 0, 0, 'Material', 1, 1, true from p union all select distinct table_id, 0, 1, 'EQE (%)', 1, 1, true from p union all select distinct table_id, 0, 2, 'CE (cd/A)', 1, 2, true from p""")
def html_table_cells(t):
    return tables.cells(html(t))


@query("""
select p_brand as table_id, unnest([0, 1, 2, 3]) as col, unnest(['row_key', 'metric', 'metric', 'metric']) as kind, unnest([null, 'eqe', 'ce', 'ce']) as name, unnest([null, '%', 'cd/A', 'cd/A']) as unit, 1 as header_rows from part group by 1""")
def table_columns(t):
    return tables.column_kinds(html(t)).drop("header")


@query(_P + """
select table_id, type, rule, sum(n)::bigint as relations from (select table_id, unnest(['row_has_metric', 'has_value']) as type, unnest(['table_row_key_binding', 'table_col_binding']) as rule, 3 as n from p) group by 1, 2, 3""")
def table_relations(t):
    return tables.table_relations(html(t)).groupBy("table_id", "type", "rule").agg(F.count(F.lit(1)).alias("relations"))


@query(_P + """
select table_id, type, value, unit, canonical_id, count(*) as n from (
  select table_id, 'material' as type, concat('Compound ', p_partkey) as value, null as unit, concat('mat:COMPOUND', p_partkey) as canonical_id from p union all
  select table_id, 'value', cast(p_size as varchar), '%', null from p union all select table_id, 'value', cast(price as varchar), 'cd/A', null from p union all select table_id, 'value', cast(price as varchar), 'cd/A', null from p union all
  select table_id, unnest(['metric', 'metric', 'metric']), unnest(['eqe', 'ce', 'ce']), null, null from p union all
  select distinct table_id, unnest(['metric', 'metric']), unnest(['eqe', 'ce']), null, null from p) group by all""")
def table_entities(t):
    return tables.table_entities(html(t)).groupBy("table_id", "type", "value", "unit", "canonical_id").agg(F.count(F.lit(1)).alias("n"))


def items(t) -> DataFrame:
    """A document per brand: abstract, claims, examples with their parts, and the brand's table."""
    fixed = lambda doc: [(0, "Abstract"), (1, "A few words."), (2, "Claims"), (3, "1. A device."), (4, "2. The device of claim 1."), (5, "具体实施方式"), (6, "Example 1")]
    docs = html(t).select(F.col("table_id").alias("doc_id"), "html")
    head = docs.select("doc_id", F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("idx"), F.lit(x).alias("text")) for i, x in fixed(0)))).alias("x")).select("doc_id", "x.idx", F.lit("text").alias("type"), "x.text")
    body = t.part.select(F.col("p_brand").alias("doc_id"), (F.col("p_partkey") + 100).alias("idx"), F.lit("text").alias("type"), F.expr("concat('Compound ', p_partkey, ' was used as host, EQE of ', p_size, ' %.')").alias("text"))
    table = docs.select("doc_id", F.lit(50).cast("long").alias("idx"), F.lit("table").alias("type"), F.col("html").alias("table_body"), F.array(F.lit("Table 1 results")).alias("table_caption"))
    all_ = head.unionByName(body).unionByName(table, allowMissingColumns=True)
    rest = {"page_idx": "int", "bbox": "array<int>", "html": "string", "image_caption": "array<string>", "img_path": "string", "source_file": "string"}
    return all_.withColumns({c: F.lit(None).cast(k) for c, k in rest.items()})


@query("""
select p_brand as doc_id, 'A few words.' as abstract, cast(count(*) + 9 as int) as blocks, cast(2 * count(*) + 6 * count(*) as int) as relations, 1 as experiments, cast(2 * count(*) + count(*) as int) as materials_used from part group by 1""")
def parse_documents(t):
    """Layout items to documents, end to end."""
    # Blocks and experiments are named once, so that they are counted where they are put together: a row of a long document takes several times its size to write.
    none = F.struct(F.lit(0).alias("blocks"), F.lit(0).alias("relations"))
    count = F.aggregate("blocks", none, lambda a, b: F.struct((a["blocks"] + 1).alias("blocks"), (a["relations"] + F.size(b["relations"])).alias("relations")))
    used = F.transform("experiments", lambda e: F.size(e["materials_used"]))
    d = parse.parse(items(t)).select("doc_id", "abstract", count.alias("n"), used.alias("used"))
    return d.select("doc_id", "abstract", "n.blocks", "n.relations", F.size("used").alias("experiments"), F.get("used", F.lit(0)).alias("materials_used"))
