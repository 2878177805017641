"""Keyword, vector and hybrid search, embedding texts, set similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import chemistry, search
from quire.plans.catalogue import query

WORDS = "the of that"


def bm25_sql(name: str, table: str, key: str, text: str) -> str:
    return f"""
{name}_t as (select {key} as k, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+') as t from {table}),
{name}_n as (select count(*) as n, avg(len(t)) as mean from {name}_t),
{name}_h as (select k, len(t) as length, term, len(list_filter(t, lambda x: x = term)) as tf from {name}_t, unnest(['the', 'of', 'that']) as q(term) where list_contains(t, term)),
{name}_d as (select term, count(*) as df from {name}_h group by 1),
{name} as (select k, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))) as score from {name}_h join {name}_d using (term), {name}_n group by 1)"""


@query("with " + bm25_sql("s", "documents", "doc_id", "text") + " select k as doc_id, round(score, 6) as score from s order by score desc, k limit 20")
def bm25_search(t):
    found = search.top(search.bm25(t.spread("documents", "doc_id", "text"), WORDS, "doc_id", "text"), 20, "doc_id")
    return found.select("doc_id", F.round("score", 6).alias("score"))


def fields(t) -> DataFrame:
    return t.documents.select("doc_id", F.substring_index("text", "\n", 1).alias("title"), F.substring_index("text", "\n", -1).alias("abstract"), F.col("text").alias("full_text"))


_FIELDS = "with d as (select doc_id, split_part(text, chr(10), 1) as title, list_extract(string_split(text, chr(10)), -1) as abstract, text as full_text from documents)"


@query(_FIELDS + "," + ",".join(bm25_sql(f"s{i}", "d", "doc_id", c) for i, c in enumerate(("title", "abstract", "full_text"))) + """
select k as doc_id, round(sum(score), 6) as score from (select k, score from s0 union all select k, score * 0.5 from s1 union all select k, score * 0.5 from s2) group by 1 order by sum(score) desc, k limit 20""")
def field_boost_search(t):
    found = search.field_search(fields(t), WORDS, "doc_id", {"title": 1.0, "abstract": 0.5, "full_text": 0.5})
    return search.top(found, 20, "doc_id").select("doc_id", F.round("score", 6).alias("score"))


def _vector(t) -> list[float]:
    return [float(x) for x in t.embeddings.where("vec_id = 0").first()["embedding"]]


_KNN = """v as (select vec_id as k, list_cosine_similarity(embedding::double[], (select embedding::double[] from embeddings where vec_id = 0)) as score from embeddings)"""


@query(f"with {_KNN} select k as vec_id, round(score, 6) as score from v order by score desc, k limit 10")
def knn_topk(t):
    return search.nearest(t.embeddings, _vector(t), "vec_id", "embedding", 10).select("vec_id", F.round("score", 6).alias("score"))


_HYBRID = """
a as (select k, score from {s} order by score desc, k limit 10), b as (select k, score from {v} order by score desc, k limit 10),
an as (select k, coalesce((score - min(score) over ()) / nullif(max(score) over () - min(score) over (), 0), 1.0) as x from a),
bn as (select k, coalesce((score - min(score) over ()) / nullif(max(score) over () - min(score) over (), 0), 1.0) as y from b)
select coalesce(an.k, bn.k) as doc_id, round((coalesce(x, 0) + coalesce(y, 0)) / 2, 6) as score, round(coalesce(x, 0), 6) as keyword_score, round(coalesce(y, 0), 6) as vector_score
from an full join bn on an.k = bn.k order by (coalesce(x, 0) + coalesce(y, 0)) / 2 desc, 1 limit 10"""


def _hybrid(docs: DataFrame, vectors: DataFrame, vector: list[float]) -> DataFrame:
    near = search.nearest(vectors.withColumnRenamed("vec_id", "doc_id"), vector, "doc_id", "embedding", 10)
    found = search.hybrid(search.bm25(docs, WORDS, "doc_id", "text"), near, "doc_id", 10)
    return found.select("doc_id", *(F.round(c, 6).alias(c) for c in ("score", "keyword_score", "vector_score")))


@query("with " + bm25_sql("s", "documents", "doc_id", "text") + f", {_KNN}, " + _HYBRID.format(s="s", v="v"))
def hybrid_search(t):
    return _hybrid(t.spread("documents", "doc_id", "text"), t.embeddings, _vector(t))


@query("with d as (select * from documents where source in ('src0', 'src1')), " + bm25_sql("s", "d", "doc_id", "text") + f", {_KNN}, w as (select v.* from v join d on d.doc_id = v.k), " + _HYBRID.format(s="s", v="w"))
def hybrid_search_filtered(t):
    docs = t.documents.where("source in ('src0', 'src1')")
    near = t.embeddings.join(docs.select(F.col("doc_id").alias("vec_id")), "vec_id", "left_semi")
    return _hybrid(docs, near, _vector(t))


@query()
def hash_embedding(t):
    """Vectors of whole texts by BLAKE2b, which SQL lacks; tests compare them with a plain loop."""
    df = search.embed(t.documents.select("doc_id", "text"), "text", 64)
    return df.select("doc_id", F.transform("embedding", lambda x: F.round(x, 9)).alias("embedding"))


_BUDGET = """
with b as (select conv_id as doc_id, turn as pos, trim(text) as text, case role when 'system' then 3 when 'user' then 4 else 6 end as rank from conversations),
b2 as (select doc_id, pos, text, case when rank = 3 and pos % 2 = 0 then 2 else rank end as rank from b),
p as (select * from b2 where text <> '' union all select conv_id, 0, concat('Title ', conv_id), 0 from conversations group by conv_id),
once as (select doc_id, text, min(rank * 1000000 + pos) as place from p group by 1, 2),
n as (select *, row_number() over (partition by doc_id, place < 1000000 order by place) as n from once)
select doc_id, string_agg(text, chr(10) order by place) as text from n where place < 1000000 or n <= 3 group by 1
"""


@query(_BUDGET)
def embedding_text_budget(t):
    c = t.conversations
    docs = c.select(F.col("conv_id").alias("doc_id")).distinct().select("doc_id", F.concat(F.lit("Title "), "doc_id").alias("title"), F.lit(None).cast("string").alias("abstract"))
    blocks = c.select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("pos"), "text", F.expr("if(role = 'system', 'claim', 'text')").alias("block_type"), F.lit(None).cast("string").alias("section"),
        F.expr("if(role = 'user', 'summary', null)").alias("subsection"), F.lit(None).cast("string").alias("example_id"), F.expr("if(turn % 2 = 0, 1, 2)").alias("claim_no"),
    )
    return search.embedding_text(docs, blocks, 3)


def _bits(t) -> DataFrame:
    positive = F.filter(F.transform("embedding", lambda x, i: F.when(x > 0, i)), lambda x: x.isNotNull())
    return t.embeddings.select("vec_id", positive.alias("fp"))


_SETS = "with b as (select vec_id, list_filter(list_transform(embedding, lambda x, i: case when x > 0 then i - 1 end), lambda x: x is not null) as fp from embeddings), q as (select fp as qfp from b where vec_id = 0)"


@query(_SETS + " select vec_id, round(len(list_intersect(fp, qfp)) / len(list_distinct(list_concat(fp, qfp)))::double, 6) as score from b, q order by len(list_intersect(fp, qfp)) / len(list_distinct(list_concat(fp, qfp)))::double desc, vec_id limit 10")
def tanimoto_topk(t):
    bits = _bits(t)
    wanted = F.array(*map(F.lit, bits.where("vec_id = 0").first()["fp"]))
    found = bits.select("vec_id", chemistry.tanimoto(F.col("fp"), wanted).alias("score"))
    return search.top(found, 10, "vec_id").select("vec_id", F.round("score", 6).alias("score"))


@query(_SETS + " select vec_id from b, q where list_has_all(fp, qfp[1:4])")
def subset_containment(t):
    bits = _bits(t)
    wanted = F.array(*map(F.lit, bits.where("vec_id = 0").first()["fp"][:4]))
    return bits.where(F.size(F.array_except(wanted, F.col("fp"))) == 0).select("vec_id")


@query()
def molecule_similarity(t):
    """Circular fingerprints of structure strings on parts; tests hold them against hand-worked cases."""
    names = ["CCO", "CCN", "c1ccccc1", "c1ccccc1O", "CC(=O)O", "CCCCCC"]
    smiles = F.element_at(F.array(*map(F.lit, names)), (F.col("p_partkey") % len(names)).cast("int") + 1)
    molecules = chemistry.with_fingerprint(t.part.select(F.col("p_partkey").alias("id"), smiles.alias("smiles")))
    return chemistry.similar(molecules, "c1ccccc1O", 20, 0.1)


@query("select p_partkey as id, (['CCO', 'CCN', 'c1ccccc1', 'c1ccccc1O', 'CC(=O)O', 'CCCCCC'])[p_partkey % 6 + 1] as smiles from part where p_partkey % 6 in (2, 3) order by 1 limit 25")
def substructure_search(t):
    names = ["CCO", "CCN", "c1ccccc1", "c1ccccc1O", "CC(=O)O", "CCCCCC"]
    smiles = F.element_at(F.array(*map(F.lit, names)), (F.col("p_partkey") % len(names)).cast("int") + 1)
    return chemistry.with_substructure(t.part.select(F.col("p_partkey").alias("id"), smiles.alias("smiles")), "cc", 25)
