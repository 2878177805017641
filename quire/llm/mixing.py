"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame operations only).

1. Every document gets a size; sizes are summed by source.
2. Targets: the sources share all sizes by weight; a target stops at ``max_repeat``
   times its source's size and the excess is shared again.  This is water filling:
   sorted by (cap / weight), the capped sources form a prefix, found by running sums.
3. Schedule: slot k stands at the golden-ratio point frac(k * phi).  Mapped through
   the cumulative quotas it names a source; slots are ranked within their source.
   A source's quota is met to the word: surplus slots (a few, by the discrepancy of
   the points) are left out and missing ones are appended at the end.
4. The documents of a source, shuffled by the MD5 of their keys, form one stream which is cut into
   blocks of equal token counts.  The r-th slot of a source takes block r modulo its
   number of blocks, so a document is taken ``max_repeat`` times at most.
5. ``mix_schedule`` returns the mix itself: slots in their order, each with the documents
   of its block and their ranges of words.  ``mix_sources`` sums it up by document.

Scale: no window or join key holds a source as a whole.  Running sums within a source
go by hash buckets (documents) and chunks of slots, whose totals are summed first.
The table of sources is broadcast only after its rows have been counted.

Defined results: a null text has size 0; the null source is a source of its own and
sorts last; documents of size 0 are taken 0 times; a very long text is cut at the ends of
blocks only; of documents with equal hashes the order is by key, then size; repeated rows are documents of
their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import word_count, written

#: frac(phi) * 2**48, odd: multiples of it modulo 2**48 are the golden-ratio points.
GOLDEN = 173961102589771
#: Up to this number of sources their table is broadcast.
BROADCAST_SOURCES = 50_000
DOCS_PER_BUCKET, MOST_BUCKETS, SLOTS_PER_CHUNK = 256, 65_536, 4_096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeat: int = 3) -> DataFrame:
    """(source, size) rows to one row per source with its target.

    Columns: sid (rank by code point, null last), source, source_size, docs, target,
    quota (the target in whole words).
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    big = "decimal(38,0)"
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    per = (
        per.withColumn("sid", F.row_number().over(by_name))
        .withColumn("w", w.cast(big))
        .withColumn("cap", (F.col("source_size") * max_repeat).cast(big))
    )
    every = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast(big)
    per = (
        per.withColumn("left", F.sum("source_size").over(whole).cast(big) - F.coalesce(F.sum("cap").over(before), zero))
        .withColumn("w_left", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), zero))
        .withColumn("capped", F.col("cap") * F.col("w_left") < F.col("left") * F.col("w"))
    )
    free = F.sum("source_size").over(whole) - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(whole), zero)
    free_w = F.sum(F.when(~F.col("capped"), F.col("w"))).over(whole)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        free.cast("double") * F.col("w").cast("double") / free_w.cast("double")
    )
    return per.withColumn("target", target).select(
        "sid",
        "source",
        "source_size",
        "docs",
        "target",
        F.least(F.floor(F.col("target") + 0.5), F.col("cap").cast("long")).cast("long").alias("quota"),
    )


def golden_point(k):
    """k * GOLDEN modulo 2**48 of a bigint column, in halves of 24 bits that don't overflow."""
    half = (1 << 24) - 1
    high, low = F.shiftright(k, 24).bitwiseAND(half), k.bitwiseAND(half)
    upper = (high * F.lit(GOLDEN & half) + low * F.lit(GOLDEN >> 24)).bitwiseAND(half)
    return (F.shiftleft(upper, 24) + low * F.lit(GOLDEN & half)).bitwiseAND((1 << 48) - 1)


def schedule(sources: DataFrame) -> DataFrame:
    """Slots of the mix: (sid, slot_rank, position), one row per slot; positions are an order of low discrepancy.

    ``sources`` has sid, slots (the number each is to get), lo (slots of those before it).
    """
    spark = sources.sparkSession
    n, n_sources = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count(F.lit(1))).first()
    cells = max(1_024, 4 * n_sources)
    width = max(1, -(-n // cells))
    held = sources.where("slots > 0").select(
        "sid",
        "lo",
        (F.col("lo") + F.col("slots")).alias("hi"),
        F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(lo + slots - 1) div {width}"))).alias("cell"),
    )
    point = (golden_point(F.col("id")) / F.lit(2.0**48) * F.lit(float(n))).cast("long")
    slots = (
        spark.range(0, n, 1, max(1, min(10_000, n // 200_000)))
        .withColumn("x", F.least(point, F.lit(max(0, n - 1))))
        .withColumn("cell", F.expr(f"x div {width}"))
        .join(held, "cell")
        .where("x >= lo and x < hi")
        .select("sid", "id", F.expr(f"id div {SLOTS_PER_CHUNK}").alias("chunk"))
    )
    counts = slots.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("sid", "chunk", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("start"))
    ranked = (
        slots.withColumn("r", F.row_number().over(Window.partitionBy("chunk", "sid").orderBy("id")) - 1)
        .join(starts, ["chunk", "sid"])
        .select("sid", (F.col("r") + F.col("start")).alias("slot_rank"), F.col("id").alias("position"))
    )
    had = counts.groupBy("sid").agg(F.sum("n").alias("had"))
    quota = sources.select("sid", "slots", "lo").join(had, "sid", "left").fillna(0, ["had"])
    missing = quota.where("had < slots").select("sid", "lo", F.explode(F.expr("sequence(had, slots - 1)")).alias("slot_rank"))
    missing = missing.select("sid", "slot_rank", (F.lit(n) + F.col("lo") + F.col("slot_rank")).alias("position"))
    slots_of = sources.select("sid", "slots")
    if n_sources <= BROADCAST_SOURCES:
        slots_of = F.broadcast(slots_of)
    kept = ranked.join(slots_of, "sid").where("slot_rank < slots").select("sid", "slot_rank", "position")
    return kept.unionByName(missing)


def _plan(docs: DataFrame, weights: tuple[int, ...], max_repeat: int, block_words: int, keep: tuple[str, ...], seed: int) -> tuple[DataFrame, DataFrame]:
    """The documents (keep, source, size, source_size, target, sid, at), and the rows of the mix: (position, sid, block, at, from, to)."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keep]
    key = F.md5(F.concat_ws("/", F.lit(str(seed)), *names))
    base = written(docs.select(*keep, "source", word_count(F.col("text")).alias("size"), key.alias("h")), "mix-sizes")
    B = block_words
    sources = (
        source_targets(base, weights, max_repeat)
        .withColumn("blocks", F.expr(f"(source_size + {B - 1}) div {B}"))
        .withColumn("passes", F.expr("if(source_size > 0, quota div greatest(source_size, 1), 0)"))
        .withColumn("rest", F.expr("quota - passes * source_size"))
        .withColumn("slots", F.expr(f"passes * blocks + (rest + {B - 1}) div {B}"))
        .withColumn("last_words", F.expr(f"if(rest > 0, rest - (rest - 1) div {B} * {B}, {B})"))
        .withColumn("lo", F.coalesce(F.sum("slots").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )
    sources = written(sources, "mix-sources")
    n_sources, n_docs = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("docs"), F.lit(0))).first()
    few = F.broadcast if n_sources <= BROADCAST_SOURCES else (lambda df: df)

    # Place of each document in its source's shuffled stream: running sums by buckets of the hash's range.
    buckets = min(MOST_BUCKETS, max(1, -(-n_docs // DOCS_PER_BUCKET)))
    bucket = F.expr(f"(cast(conv(substring(h, 1, 8), 16, 10) as bigint) * {buckets}) div {1 << 32}")
    there = base.join(few(sources.select("sid", "source", "source_size", "target")), base.source.eqNullSafe(sources.source)).select(
        *keep, base.source, "size", "h", "sid", "source_size", "target", bucket.alias("bucket")
    )
    order = Window.partitionBy("sid", "bucket").orderBy("h", *keep, "size").rowsBetween(Window.unboundedPreceding, -1)
    totals = there.groupBy("sid", "bucket").agg(F.sum("size").alias("total"))
    run = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("sid", "bucket", F.coalesce(F.sum("total").over(run), F.lit(0)).alias("start"))
    placed = (
        there.withColumn("within", F.coalesce(F.sum("size").over(order), F.lit(0)))
        .join(starts, ["sid", "bucket"])
        .withColumn("at", F.col("start") + F.col("within"))
        .select(*keep, "source", "size", "source_size", "target", "sid", "at")
    )

    # Every slot takes its block whole, but for the last of a source.
    slots = schedule(sources).join(few(sources.select("sid", "slots", "blocks", "last_words")), "sid")
    slots = slots.select("position", "sid", F.expr("slot_rank % blocks").alias("block"), F.expr(f"if(slot_rank = slots - 1, last_words, {B})").alias("words"))
    pieces = placed.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(at div {B}, (at + size - 1) div {B})")))
    return placed, pieces.join(slots, ["sid", "block"], "left").withColumns(
        {"from": F.expr(f"greatest(at - block * {B}, 0)"), "to": F.expr(f"least(at + size - block * {B}, {B}, words)")}
    )


def mix_schedule(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    max_repeat: int = 3,
    block_words: int = 256,
    keep: tuple[str, ...] = ("doc_id",),
    seed: int = 17,
) -> DataFrame:
    """The mix in its order: position, place (of the document within the slot), source, block, the ``keep`` columns, first_word and words.

    A slot has a row for each document that its block holds, which gives ``words`` words
    from ``first_word`` (counted from 0) on; sorted by position and place the rows are the mix.
    """
    _, rows = _plan(docs, weights, max_repeat, block_words, keep, seed)
    rows = rows.where("position is not null and `to` > `from`")
    first = F.expr(f"block * {block_words} + `from` - at").alias("first_word")
    return rows.select("position", F.col("from").alias("place"), "source", "block", *keep, first, F.expr("`to` - `from`").alias("words"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    max_repeat: int = 3,
    block_words: int = 256,
    keep: tuple[str, ...] = ("doc_id",),
    seed: int = 17,
) -> DataFrame:
    """Mixes ``docs`` (text, source and the columns in ``keep``) to the target weights.

    Returns per document: the ``keep`` columns, source, size, source_size, target and
    taken (words of it that the mix takes, repeats counted).
    """
    placed, rows = _plan(docs, weights, max_repeat, block_words, keep, seed)
    out = [*keep, "source", "size", "source_size", "target"]
    words = F.greatest(F.coalesce(F.expr("`to` - `from`"), F.lit(0)), F.lit(0))
    some = rows.groupBy("sid", "at", *out).agg(F.sum(F.when(F.col("position").isNotNull(), words).otherwise(0)).cast("long").alias("taken")).select(*out, "taken")
    none = placed.where("size = 0").select(*out, F.lit(0).cast("long").alias("taken"))
    return some.unionByName(none)
