"""The ledger of processed files: what is pending, what a run's results are, retries, merged parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import vocabulary as V
from quire.functions.text import looks_like_table_failure, natural_key
from quire.sources.scratch import written


def pending(files: DataFrame, ledger: DataFrame, version: str | None = None, key: str = "file") -> DataFrame:
    """Files that are not done, or (with ``version``) not done by this version."""
    done = ledger.where(F.col("status").isin(*V.DONE_STATES))
    if version:
        done = done.where(F.col("parser_version") == version)
    return files.join(done.select(key).distinct(), key, "left_anti")


def mark(ledger: DataFrame, results: DataFrame, key: str = "file", now: Column | None = None) -> DataFrame:
    """The ledger with the results of a run; errors are cut to 500 characters.

    A ledger with a column ``time`` gets the time of the mark, as text, where results have none.
    """
    new = results.withColumn("error_msg", F.substring("error_msg", 1, 500))
    if "time" in ledger.columns and "time" not in results.columns:
        new = new.withColumn("time", F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd HH:mm:ss"))
    new = new.select(*ledger.columns)
    return ledger.join(new.select(key), key, "left_anti").unionByName(new)


def status(ok: Column, without_tables: Column) -> Column:
    return F.when(~ok, F.lit("failed")).when(without_tables, F.lit("done_without_tables")).otherwise(F.lit("done"))


def counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def retry(results: DataFrame) -> DataFrame:
    """Failed files whose error looks like one of table recognition."""
    return results.where((F.col("status") == "failed") & looks_like_table_failure(F.col("error_msg")))


#: Bytes of a failure's log that are kept, and of its end that are reported.
LOG_BYTES, TAIL_BYTES = 2 << 20, 500


def failure_log(log: Column) -> tuple[Column, Column]:
    """What is kept of a failure's output, and its end, both by bytes; letters that are cut apart go."""
    data = F.coalesce(log, F.lit("")).cast("binary")
    tail = F.substring(data, F.greatest(F.octet_length(data) - TAIL_BYTES, F.lit(0)) + 1, F.lit(TAIL_BYTES))
    as_text = lambda b: F.replace(F.make_valid_utf8(b.cast("string")), F.lit("\ufffd"), F.lit(""))
    return as_text(F.substring(data, F.lit(1), F.lit(LOG_BYTES))), as_text(tail)


def with_fallback(first: DataFrame, second: DataFrame, key: str = "file") -> DataFrame:
    """Results of a run and of the second run, without tables, of those that ``retry`` picked, as one.

    Both have key, ok, error_msg, error_log, timeout_sec.  A second result counts in place of the
    first, whose log stays as initial_error_log.  table_fallback_used and
    table_fallback_skipped tell which way a file went; status is the ledger's.
    """
    table = looks_like_table_failure(F.col("error_msg"))
    marked = first.withColumns({"failed": ~F.coalesce("ok", F.lit(False))}).withColumn("again", F.col("failed") & F.coalesce(table, F.lit(False)))
    later = second.select(F.col(key).alias("__key"), *(F.col(c).alias(f"second_{c}") for c in ("ok", "error_msg", "error_log", "timeout_sec")))
    both = marked.join(later, marked["again"] & (marked[key] == F.col("__key")), "left")
    used = F.col("__key").isNotNull()
    ok = F.when(used, F.coalesce("second_ok", F.lit(False))).otherwise(~F.col("failed"))
    pick = lambda c: F.when(used, F.col(f"second_{c}")).otherwise(F.col(c)).alias(c)
    return both.select(
        key, ok.alias("ok"), pick("error_msg"), F.when(used & ok, F.lit(None)).otherwise(F.when(used, F.col("second_error_log")).otherwise(F.col("error_log"))).alias("error_log"),
        pick("timeout_sec"), used.alias("table_fallback_used"), (F.col("failed") & ~F.col("again")).alias("table_fallback_skipped"),
        F.when(used, F.col("error_log")).alias("initial_error_log"), status(ok, used).alias("status"),
    )


def run_with_fallback(files: DataFrame, run, key: str = "file") -> DataFrame:
    """Runs files with tables and, where an error looks like one of table recognition, once more without.

    ``run(files, tables)`` returns results as ``with_fallback`` takes them.
    """
    first = written(run(files, True), "run-first")
    failed = first.where(~F.coalesce("ok", F.lit(False)) & looks_like_table_failure(F.col("error_msg"))).select(key)
    return with_fallback(first, written(run(files.join(failed, key, "left_semi"), False), "run-second"), key)


def document_results(parts: DataFrame, merged: DataFrame) -> DataFrame:
    """Per document what its parts came to.

    ``parts``: doc_id, part_no, part, and the columns of ``with_fallback``; ``merged``: doc_id and
    whether the Markdown, the items and the pages could be merged (markdown, items, pages).
    A document is ok if all of its parts are and all three could; its error is that of the first failed part,
    else what is missing; logs go by part.
    """
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("part_no", F.struct("part", F.col(c).alias("log")).alias("x"))))), lambda y: y["x"])
    bad = ~F.coalesce("ok", F.lit(False))
    per = parts.groupBy("doc_id").agg(
        F.count_if(bad).alias("failed_parts"), F.min_by(F.when(bad, F.concat(F.lit("part "), "part", F.lit(" failed: "), F.coalesce("error_msg", F.lit("")))), F.when(bad, F.col("part_no"))).alias("first_error"),
        F.bool_or("table_fallback_used").alias("table_fallback_used"), F.count_if("table_fallback_skipped").alias("table_fallback_skipped_parts"),
        ordered("error_log").alias("part_error_logs"), ordered("initial_error_log").alias("initial_error_logs"), F.max_by("timeout_sec", F.when(F.col("timeout_sec").isNotNull(), F.col("part_no"))).alias("timeout_sec"),
    )
    there = merged.select("doc_id", F.filter(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(c)) for c in ("markdown", "items", "pages"))), lambda x: x.isNotNull()).alias("merge_missing"))
    per = per.join(there, "doc_id", "left").withColumn("merge_missing", F.coalesce("merge_missing", F.array(*map(F.lit, ("markdown", "items", "pages")))))
    ok = (F.col("failed_parts") == 0) & (F.size("merge_missing") == 0)
    error = F.when(F.col("failed_parts") > 0, F.col("first_error")).when(F.size("merge_missing") > 0, F.concat(F.lit("merge lacks "), F.array_join("merge_missing", ", ")))
    missing = F.when(F.col("failed_parts") == 0, F.col("merge_missing")).otherwise(F.array().cast("array<string>"))
    return per.withColumns({"ok": ok, "error_msg": error, "merge_missing": missing, "status": status(ok, F.col("table_fallback_used"))}).drop("first_error")


def page_parts(docs: DataFrame, pages: str = "pages", size: int = V.PAGES_PER_PART) -> DataFrame:
    """(…, part_no, first_page, last_page): parts of at most ``size`` pages, from page 0."""
    last = F.expr(f"greatest(({pages} - 1) div {size}, 0)")
    df = docs.withColumn("part_no", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return df.withColumn("first_page", F.col("part_no") * size).withColumn("last_page", F.least(F.col("first_page") + size, F.col(pages)) - 1).withColumn("part_no", F.col("part_no") + 1)


def merge_items(items: DataFrame, parts: DataFrame, partial: bool = False, size: int = V.PAGES_PER_PART) -> DataFrame:
    """Items of parts as items of documents: pages shifted, image paths under the part's folder.

    ``items``: doc_id, part_no, idx, page_idx, img_path, ok.  ``parts``: doc_id, part_no of
    all parts.  A part with an item that is not ok counts as missing.  A document with a
    missing part has no items unless ``partial``.
    """
    bad = items.where(~F.coalesce("ok", F.lit(False))).select("doc_id", "part_no").distinct()
    good = items.join(bad, ["doc_id", "part_no"], "left_anti")
    if not partial:
        there = good.select("doc_id", "part_no").distinct()
        lacking = parts.join(there, ["doc_id", "part_no"], "left_anti").select("doc_id").distinct()
        good = good.join(lacking, "doc_id", "left_anti")
    order = Window.partitionBy("doc_id").orderBy("part_no", "idx")
    moved = good.withColumn("page_idx", F.col("page_idx") + (F.col("part_no") - 1) * size)
    moved = moved.withColumn("img_path", F.when(F.col("img_path") != "", F.concat(F.format_string("part%03d/", F.col("part_no")), F.col("img_path"))))
    return moved.withColumn("idx", F.row_number().over(order) - 1).drop("ok")


def merge_pages(pages: DataFrame, heads: DataFrame, partial: bool = False, size: int = V.PAGES_PER_PART) -> tuple[DataFrame, DataFrame]:
    """Pages of parts as pages of documents, and (doc_id, backend, version): the first that a good part names.

    ``pages``: doc_id, part_no, pos (place in the part), page_idx, ok, and whatever a page holds;
    ``heads``: doc_id, part_no of all parts, there (whether the part has pages at all), backend, version.
    A part that isn't there, or has a page that is not ok, is bad.  A document with a bad part has nothing unless ``partial``.
    """
    broken = pages.where(~F.coalesce("ok", F.lit(False))).select("doc_id", "part_no").distinct()
    good = heads.where("there").join(broken, ["doc_id", "part_no"], "left_anti")
    if not partial:
        lacking = heads.join(good.select("doc_id", "part_no"), ["doc_id", "part_no"], "left_anti").select("doc_id").distinct()
        good = good.join(lacking, "doc_id", "left_anti")
    moved = pages.join(good.select("doc_id", "part_no"), ["doc_id", "part_no"], "left_semi").withColumn("page_idx", F.col("page_idx") + (F.col("part_no") - 1) * size)
    order = Window.partitionBy("doc_id").orderBy("part_no", "pos")
    named = lambda c: F.min_by(c, F.when(F.nullif(c, F.lit("")).isNotNull(), F.col("part_no"))).alias(c)
    return moved.withColumn("pos", F.row_number().over(order) - 1).drop("ok"), good.groupBy("doc_id").agg(named("backend"), named("version"))


def merge_texts(parts: DataFrame, name: str = "name", text: str = "text") -> DataFrame:
    """(doc_id, text): texts of parts, in the natural order of their names, joined by blank lines."""
    entry = F.struct(natural_key(F.col(name)).alias("k"), F.trim(text).alias("t"))
    return parts.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["t"]), "\n\n").alias("text"))


def merge_warnings(parts: DataFrame) -> DataFrame:
    """Flags, counts and lists of parts put together: any, sum, in the order of parts."""
    lists = F.transform(F.array_sort(F.collect_list(F.struct("part_no", F.coalesce("messages", F.array()).alias("m")))), lambda x: x["m"])
    return parts.groupBy("doc_id").agg(
        F.bool_or("table_fallback_used").alias("table_fallback_used"), F.sum("warnings").alias("warnings"), F.flatten(lists).alias("messages")
    )


def document_status(parts: DataFrame) -> DataFrame:
    """A document failed if any part failed; without tables if any part lacks them."""
    failed = F.bool_or(F.col("status") == "failed")
    return parts.groupBy("doc_id").agg(status(~failed, F.bool_or(F.col("status") == "done_without_tables")).alias("status"), F.count_if(F.col("status") == "failed").alias("failed_parts"))


def is_scanned(pages: DataFrame) -> DataFrame:
    """(doc_id, scanned): of (doc_id, page_idx, text, total) whether sampled pages hold no text.

    Pages 0, 1, 2, the middle and the last are sampled; more than 120 characters in them
    mean text; a document without pages counts as scanned.
    """
    sampled = F.col("page_idx").isin(0, 1, 2) | (F.col("page_idx") == F.expr("total div 2")) | (F.col("page_idx") == F.col("total") - 1)
    text = F.when(sampled, F.coalesce("text", F.lit("")))
    size, kept = F.coalesce(F.sum(F.length(text)), F.lit(0)), F.coalesce(F.sum(F.length(F.trim(text))), F.lit(0))
    return pages.groupBy("doc_id").agg((~(size > 120) & (kept == 0)).alias("scanned"))
