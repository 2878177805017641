"""Sections, example context, offsets and ordinals of a document's items, as windows.

Only some items change the running state.  Each change is a column that is null where
nothing changes and "" where a field is cleared; ``last_value`` without nulls carries it.
A document's items are one window partition, which is bounded by the document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import vocabulary as V
from quire.functions.text import IU, U, claim_depends, claim_no, claim_text, example_id, in_order, is_example_heading


def _any(text: Column, patterns: list[str]) -> Column:
    return text.rlike(U + IU + "|".join(f"(?:{p})" for p in patterns))


def heading(text: Column) -> Column:
    """The first section, then the first kind of example, whose words occur in a text; null if none does."""
    t = F.trim(text)
    return in_order(*((_any(t, p), k) for k, p in (V.SECTIONS | V.EXAMPLES).items()))


def carry(value: Column, doc: str, order: list[str]) -> Column:
    """The last value that is not null so far; "" stands for none."""
    so_far = Window.partitionBy(doc).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.nullif(F.last(value, ignorenulls=True).over(so_far), F.lit(""))


def classify(items: DataFrame, doc: str = "doc_id", order: str = "idx", text: str = "text", is_text: str = "is_text") -> DataFrame:
    """Adds section, subsection, block_type, example_id, claim_no and depends_on."""
    t = F.when(F.col(is_text), F.trim(F.coalesce(F.col(text), F.lit(""))))
    event = F.when(t != "", heading(t))
    parts, examples = list(V.SUBSECTIONS), list(V.EXAMPLES)
    section = F.when(event.isin(*parts), F.lit("description")).otherwise(event)
    subsection = F.when(event.isin(*parts), event).when(event.isNotNull() & ~event.isin(*examples), F.lit(""))
    df = items.withColumn("__t", t).withColumn("__event", event)
    df = df.withColumn("section", carry(section, doc, [order])).withColumn("subsection", carry(subsection, doc, [order]))
    t, event, now = F.col("__t"), F.col("__event"), F.col("section")
    depends = F.regexp_like(F.coalesce(claim_text(t), F.lit("")), F.lit(IU + V.CLAIM_DEPENDS))
    in_claims = F.when(claim_text(t).isNull(), F.lit("claim")).when(depends, F.lit("claim_dependent")).otherwise(F.lit("claim_independent"))
    kind = (
        F.when(t.isNull() | (t == ""), F.lit("text"))
        .when(event == "claims", F.lit("claims_title"))
        .when(event.isin(*examples), event)
        .when(event.isNotNull(), F.lit("title"))
        .when(now == "claims", in_claims)
        .when(now.isin("abstract", "description", *examples), now)
        .otherwise(F.lit("text"))
    )
    df = df.withColumn("block_type", F.when(F.col(is_text), kind))
    kind = F.col("block_type")
    starts = kind.isin(*examples) & is_example_heading(t)
    number = F.when(starts, example_id(t))
    leaves = now.isin("claims", "abstract") | kind.isin("claims_title", "claim") | ((kind == "title") & F.col("subsection").isin(*parts))
    example = F.when(number.isNotNull(), F.concat(kind, F.lit("_"), number)).when(
        F.coalesce(starts, F.lit(False)) | event.isNotNull() | F.coalesce(F.col(is_text) & leaves, F.lit(False)), F.lit("")
    )
    df = df.withColumn("example_id", carry(example, doc, [order]))
    claim = F.col(is_text) & kind.startswith("claim")
    own = F.when(claim, claim_no(t))
    depends_on = F.when(claim, claim_depends(t, own))
    return (
        df.withColumn("claim_no", own)
        .withColumn("depends_on", F.when(F.size(depends_on) > 0, depends_on))
        .drop("__t", "__event")
    )


def char_offsets(items: DataFrame, doc: str = "doc_id", order: str = "idx", text: str = "text", is_text: str = "is_text") -> DataFrame:
    """Adds char_start and char_end: texts follow one another with one character between them."""
    size = F.when(F.col(is_text), F.length(F.coalesce(F.col(text), F.lit(""))))
    so_far = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(size + 1).over(so_far) - 1
    return items.withColumn("char_end", F.when(F.col(is_text), end)).withColumn("char_start", F.col("char_end") - size)


def inid_fields(lines: DataFrame, doc: str = "doc_id", order: str = "line_no", line: str = "line") -> DataFrame:
    """Front-page fields by their two-digit codes: (doc, code, value); lines without a code continue the last one.

    A later line with the same code replaces the field.
    """
    t = F.trim(line)
    code = F.when(t.rlike(V.INID_LINE), F.regexp_extract(t, V.INID_LINE, 1))
    so_far = Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    df = lines.where(t != "").withColumn("code", F.last(code, ignorenulls=True).over(so_far))
    df = df.withColumn("run", F.count(code).over(so_far)).where("code is not null")
    content = F.trim(F.when(code.isNotNull(), F.regexp_extract(t, V.INID_LINE, 2)).otherwise(t))
    by_run = df.groupBy(doc, "code", "run").agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), content.alias("v")))).alias("parts")
    )
    value = F.array_join(F.filter(F.transform("parts", lambda p: p["v"]), lambda v: v != ""), " ")
    latest = by_run.groupBy(doc, "code").agg(F.max_by(value, "run").alias("value"))
    return latest.select(doc, "code", F.nullif(F.trim("value"), F.lit("")).alias("value"))


def inid_metadata(lines: DataFrame, doc: str = "doc_id", order: str = "line_no", line: str = "line") -> DataFrame:
    """One row per document with front-page lines: numbers, date, title and lists of names."""
    codes = ["10", "11", "21", "22", "30", "54", "71", "72", "73"]
    wide = inid_fields(lines, doc, order, line).groupBy(doc).agg(*(F.max(F.when(F.col("code") == c, F.col("value"))).alias(f"c{c}") for c in codes))
    names = lambda c: F.filter(F.transform(F.split(f"c{c}", "[;/,]"), lambda x: F.trim(x)), lambda x: x != "")
    listed = lambda c: F.when(F.size(names(c)) > 0, names(c))
    return wide.select(
        doc, F.coalesce("c10", "c11").alias("publication_number"), F.col("c21").alias("application_number"), F.col("c22").alias("application_date"),
        listed("30").alias("priority"), F.col("c54").alias("title"), F.coalesce(listed("71"), listed("73")).alias("applicants"), listed("72").alias("inventors"),
    )


def numeral_labels(rows: DataFrame, doc: str = "doc_id", order: tuple[str, ...] = ("idx", "pos")) -> DataFrame:
    """(doc, number, label) rows to one map per document: the first label of a number counts."""
    first = rows.groupBy(doc, "number").agg(F.min_by("label", F.struct(*order)).alias("label"))
    entries = first.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("number", "label"))).alias("e"))
    return entries.select(doc, F.map_from_entries("e").alias("reference_numerals"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
