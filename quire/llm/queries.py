"""The registered queries of this folder: thin digests of its operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import langid, lines, media_table, mixing, neighbours, packing, pseudo_likelihood, repeats, simhash, toxicity
from quire.llm.common import table


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select(
        F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset", "group_bins", "group_bound"
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("ends", "starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        F.col("id").alias("doc_id"),
        (F.octet_length("kept") + removed).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media_table.store(table(spark, sf_dir, "documents"))
    return media_table.digests(stored).withColumnRenamed("id", "doc_id")


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    inside = langid.held_in(F.col("doc_id"))
    found = langid.predict(docs, langid.learn(docs.where(inside)))
    return found.select(
        F.col("id").alias("doc_id"), (~langid.held_in(F.col("id"))).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "source", "lines_dropped", "text")


def op2_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.score_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"),
        toxicity.held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        *toxicity.FEATURES,
    )


QUERIES = {
    "op6_toxicity": op6_toxicity,
    "op2_pseudo_likelihood": op2_pseudo_likelihood,
    "op8_line_dedup": op8_line_dedup,
    "op1_language_id": op1_language_id,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op7_media_columns": op7_media_columns,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op10_mix_sources": op10_mix_sources,
}

#: The schedule takes all blocks of a source in turn, so what it takes of a document follows from the document's
#: place in the stream of its source: whole passes, and the part of it that lies in the first ``rest`` words.
OP10 = r"""
with docs as (
    select doc_id, source, md5(concat_ws('/', '17', coalesce(cast(doc_id as varchar), ''))) as h,
        cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size
    from documents
), sources as (
    select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as sid from docs group by source
), weighed as (
    select *, case (sid - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w, source_size * 3 as cap from sources
), filled as (
    select *, sum(source_size) over () as whole,
        sum(source_size) over () - coalesce(sum(cap) over (order by cap / w, sid rows between unbounded preceding and 1 preceding), 0) as remaining,
        sum(w) over () - coalesce(sum(w) over (order by cap / w, sid rows between unbounded preceding and 1 preceding), 0) as w_left
    from weighed
), capped as (
    select *, cap * w_left < remaining * w as capped from filled
), shares as (
    select *, coalesce(sum(cap) filter (where capped) over (), 0) as taken_by_caps, sum(w) filter (where not capped) over () as free_w from capped
), targets as (
    select source, source_size, cap,
        case when capped then cast(cap as double) else cast(whole - taken_by_caps as double) * cast(w as double) / cast(free_w as double) end as target
    from shares
), quotas as (
    select *, least(cast(floor(target + 0.5) as bigint), cap) as quota from targets
), placed as (
    select d.doc_id, d.source, d.size, q.source_size, q.target, q.quota,
        coalesce(sum(d.size) over (partition by d.source order by d.h, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0) as place
    from docs d join quotas q on d.source is not distinct from q.source
)
select doc_id, source, size, source_size, target,
    cast(case when size = 0 then 0
        else quota // source_size * size + greatest(least(place + size, quota % source_size) - place, 0) end as bigint) as taken
from placed
"""

ORACLE: dict[str, str] = {"op10_mix_sources": OP10}
