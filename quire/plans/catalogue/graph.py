"""The property graph and claim trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import claims, graph
from quire.plans.catalogue import query


def parts(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Regions as documents, nations as blocks, customers as entities."""
    doc = t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("doc_id"), "r_name")
    block = t.nation.select(F.concat(F.lit("r"), "n_regionkey").alias("doc_id"), F.concat(F.lit("n"), "n_nationkey").alias("block_id"))
    entity = t.customer.select(F.concat(F.lit("n"), "c_nationkey").alias("block_id"), F.concat(F.lit("c"), "c_custkey").alias("entity_id"))
    return doc, block, entity


def network(t) -> tuple[DataFrame, DataFrame]:
    """Entities of successive customers are related; every tenth relation lacks its target."""
    doc, block, entity = parts(t)
    rel = t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("source_entity_id"), F.expr("if(c_custkey % 10 = 9, null, concat('c', c_custkey + 1))").alias("target_entity_id"))
    return graph.vertices(doc, block, entity), graph.edges(block, entity, rel)


_E = """
with e as (select concat('r', n_regionkey) as src, concat('n', n_nationkey) as dst, 'HAS_BLOCK' as type from nation union all
           select concat('n', c_nationkey), concat('c', c_custkey), 'HAS_ENTITY' from customer where c_nationkey in (select n_nationkey from nation) or true union all
           select concat('c', c_custkey), concat('c', c_custkey + 1), 'REL' from customer where c_custkey % 10 <> 9 and c_custkey + 1 in (select c_custkey from customer)),
v as (select concat('r', r_regionkey) as id, 'Document' as label from region union all select concat('n', n_nationkey), 'Block' from nation union all select concat('c', c_custkey), 'Entity' from customer)
"""


@query(_E + "select label as kind, count(*) as n from v group by 1 union all select type, count(*) from e group by 1")
def graph_build(t):
    vertex, edge = network(t)
    return vertex.groupBy(F.col("label").alias("kind")).agg(F.count(F.lit(1)).alias("n")).unionByName(edge.groupBy(F.col("type").alias("kind")).agg(F.count(F.lit(1)).alias("n")))


@query(_E + "select a.src as doc_id, b.dst as entity_id from e a join e b on a.dst = b.src where a.type = 'HAS_BLOCK' and b.type = 'HAS_ENTITY' and a.src = 'r1'")
def graph_pattern(t):
    found = graph.pattern(network(t)[1], ["HAS_BLOCK", "HAS_ENTITY"], F.col("v0") == "r1")
    return found.select(F.col("v0").alias("doc_id"), F.col("v2").alias("entity_id"))


@query(_E + """, h0 as (select 'r1' as id), h1 as (select distinct dst as id from e join h0 on src = id), h2 as (select distinct dst as id from e join h1 on src = id), h3 as (select distinct dst as id from e join h2 on src = id)
select id, cast(min(h) as int) as hops from (select id, 0 as h from h0 union all select id, 1 from h1 union all select id, 2 from h2 union all select id, 3 from h3) group by 1""")
def graph_khop(t):
    start = t.region.where("r_regionkey = 1").select(F.concat(F.lit("r"), "r_regionkey").alias("id"))
    return graph.reachable(network(t)[1], start, 3).select("id", "hops")


@query(_E + """, h1 as (select distinct dst as id from e where src = 'r1'), h2 as (select distinct dst as id from e join h1 on src = id), h3 as (select distinct dst as id from e join h2 on src = id),
gone as (select 'r1' as id union select id from h1 union select id from h2 union select id from h3)
select 'vertex' as kind, count(*) as n from v where id not in (select id from gone) union all
select 'edge', count(*) from e where src not in (select id from gone) and dst not in (select id from gone)""")
def graph_delete_document(t):
    vertex, edge = network(t)
    vertex, edge = graph.delete_document(vertex, edge, t.region.where("r_regionkey = 1").select(F.lit("r1").alias("doc_id")))
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("kind"), "n")
    return count(vertex, "vertex").unionByName(count(edge, "edge"))


@query("""
select concat('n', n_nationkey) as id from nation where n_regionkey = 1 union all
select concat('c', c_custkey) from customer where c_nationkey in (select n_nationkey from nation where n_regionkey = 1) or c_nationkey not in (select n_nationkey from nation)""")
def graph_orphans(t):
    vertex, edge = network(t)
    return graph.orphans(vertex.where("id <> 'r1'"), edge).select("id")


def tree(t) -> DataFrame:
    """Documents as claims, numbered from 1: claim n depends on claim n div 3, and every seventh on a missing one as well."""
    n = t.documents.select((F.col("doc_id") + 1).alias("n"), "text")
    depends = F.expr("if(n % 7 = 0, array(n div 3, -1), array(n div 3))")
    return n.select(F.lit("d").alias("doc_id"), F.col("n").cast("int").alias("claim_no"), F.col("n").alias("idx"), "text", F.transform(depends, lambda x: x.cast("int")).alias("depends_on"))


@query("select cast(doc_id + 1 as int) as claim_no from documents where (doc_id + 1) // 3 = 0")
def claim_roots(t):
    return claims.roots(claims.nodes(tree(t))).select("claim_no")


@query("""
with recursive e as (select cast((doc_id + 1) // 3 as int) as parent, cast(doc_id + 1 as int) as child from documents where doc_id >= 2),
r(ancestor, descendant, depth) as (select parent, child, 1 from e union all select r.ancestor, e.child, r.depth + 1 from r join e on e.parent = r.descendant)
select ancestor, descendant, depth from r""")
def claim_tree_closure(t):
    return claims.closure(claims.edges(claims.nodes(tree(t)))).select("ancestor", "descendant", "depth")


@query("select cast((doc_id + 1) // 3 as int) as parent, count(*) as children from documents where doc_id >= 2 group by 1")
def claim_children(t):
    return claims.edges(claims.nodes(tree(t))).groupBy("parent").agg(F.count(F.lit(1)).alias("children"))


@query()
def claim_tree_nested(t):
    """Nested JSON of small trees, one for each conversation; tests compare it with hand-made trees."""
    node = t.conversations.select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("claim_no"), F.col("turn").alias("idx"), F.lit("claim").alias("text"), F.expr("if(turn = 0, array(), array(cast((turn + 1) div 2 as int)))").alias("depends_on"))
    return claims.nested(claims.nodes(node))
