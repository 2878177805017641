"""Text functions as Column expressions: everything runs in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import vocabulary as V

IU, U = "(?iu)", "(?U)"


def literal_map(pairs: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))


def in_order(*cases: tuple[Column, object], otherwise=None) -> Column:
    out = F.lit(otherwise) if not isinstance(otherwise, Column) else otherwise
    for condition, value in reversed(cases):
        out = F.when(condition, value).otherwise(out)
    return out


def matched(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null if there is none."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def spans(text: Column, pattern: str) -> Column:
    """All matches as an array of (start, end, value), counted in characters from 0.

    The pieces between matches, from ``split``, give the places that
    ``regexp_extract_all`` doesn't return.  Matches must not be empty.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("value"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        one = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    some = F.aggregate(pairs, zero, add, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), some).otherwise(zero["out"])


def sentences(text: Column) -> Column:
    """Sentences as an array of (start, end); a decimal point ends one, too."""
    cuts = F.transform(spans(text, V.SENTENCE_END), lambda s: s["end"])
    starts, ends = F.concat(F.array(F.lit(0)), cuts), F.concat(cuts, F.array(F.length(text)))
    return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), e.alias("end")))


def exploded(df, items: Column, name: str, *keep: str):
    """A row per element, null elements left out.

    The outer form is used on purpose: the plain one lets the optimizer add a filter on
    the array, and so evaluate whatever computes it several times over.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())


# ---- keys ----


def alias_key(text: Column) -> Column:
    """Upper-case letters and digits (ASCII) of a name."""
    return F.upper(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z0-9]+", ""))


def fallback_id(text: Column) -> Column:
    """An id for a name without a key: from the SHA-1 of its trimmed lower-case text."""
    raw = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    digest = F.when(raw == "", F.lit("0" * 12)).otherwise(F.upper(F.substring(F.sha1(raw), 1, 12)))
    return F.concat(F.lit("mat:RAW"), digest)


def publication_key(text: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(text)), r"[\s\-_/]", "")


def world_number(text: Column) -> Column:
    """WO and the digits of a publication number of the world office; null if none is found."""
    pattern = r"(?i)(WO\s*[-/]?\s*)?(\d{4})(\d{4,7})"
    return F.when(text.rlike(pattern), F.concat(F.lit("WO"), F.regexp_extract(text, pattern, 2), F.regexp_extract(text, pattern, 3)))


def language_code(name: Column) -> Column:
    v = F.lower(F.trim(name))
    return F.when(v != "", F.coalesce(literal_map(V.LANGUAGE_NAMES)[v], v))


def safe_stem(stem: Column) -> Column:
    return F.concat(F.lit("doc_"), F.regexp_replace(stem, "[^a-zA-Z0-9]", "_"))


# ---- numbers and units ----


def parse_number(raw: Column) -> Column:
    """A double from plain, exponent or ``a x 10^n`` notation, with superscripts; null if it is none."""
    s = F.translate(F.replace(raw, F.lit(" "), F.lit("")), *V.SUPERSCRIPTS)
    s = F.translate(s, "×−", "x-")
    power = r"^([+-]?\d+(?:\.\d+)?)[xX]10\^?([+-]?\d+)$"
    plain = s.try_cast("double")
    scaled = F.regexp_extract(s, power, 1).try_cast("double") * F.pow(F.lit(10.0), F.regexp_extract(s, power, 2).try_cast("int"))
    return F.when(s.rlike(power), scaled).otherwise(plain)


def normal_unit(unit: Column) -> Column:
    s = F.replace(F.lower(F.trim(unit)), F.lit(" "), F.lit(""))
    s = F.translate(s, "·−⁻²", "*--2")
    return F.coalesce(literal_map(V.UNIT_FORMS)[s], F.trim(unit))


# ---- claims, examples, captions ----


def claim_no(text: Column) -> Column:
    t = F.trim(text)
    return F.coalesce(matched(t, IU + V.CLAIM_LINE), matched(t, IU + V.CLAIM_LABEL)).try_cast("int")


def claim_text(text: Column) -> Column:
    t = F.trim(text)
    return F.trim(F.coalesce(matched(t, IU + V.CLAIM_LINE, 2), matched(t, IU + V.CLAIM_LABEL, 2)))


def claim_depends(text: Column, own: Column) -> Column:
    """Numbers in the first reference to claims, ranges of up to 50 included, without the claim's own."""
    raw = F.regexp_extract(text, IU + V.CLAIM_DEPENDS, 1)
    range_ = r"(?iu)(\d+)\s*(?:to|至|-)\s*(\d+)"
    lows = F.transform(F.regexp_extract_all(raw, F.lit(range_), F.lit(1)), lambda x: x.try_cast("int"))
    highs = F.transform(F.regexp_extract_all(raw, F.lit(range_), F.lit(2)), lambda x: x.try_cast("int"))
    ranges = F.zip_with(
        lows, highs, lambda a, b: F.when((a <= b) & (b - a < 50), F.sequence(a, F.greatest(a, b))).otherwise(F.array().cast("array<int>"))
    )
    single = F.transform(F.regexp_extract_all(raw, F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("int"))
    numbers = F.array_sort(F.array_distinct(F.concat(F.flatten(ranges), single)))
    return F.filter(numbers, lambda n: n.isNotNull() & ~n.eqNullSafe(own))


def example_id(text: Column) -> Column:
    token = matched(F.trim(text), rf"(?U)(?iu)^\s*(?:{V.EXAMPLE_WORDS})\s*([0-9A-Za-z\-]+)\b")
    return F.when(token.rlike(r"\d|^[A-Za-z]$"), token)


def is_example_heading(text: Column) -> Column:
    return F.trim(text).rlike(rf"(?U)(?iu)^\s*(?:{V.EXAMPLE_WORDS})\b")


def figure_no(caption: Column) -> Column:
    return matched(caption, U + IU + V.FIGURE_NO)


def table_no(caption: Column) -> Column:
    return matched(caption, U + IU + V.TABLE_NO)


def absolute_box(box: Column, width: Column, height: Column) -> Column:
    """A box on a 0..1000 grid in units of the page, cut to integers."""
    sizes = (width, height, width, height)
    scaled = F.array(*((box[i] * sizes[i] / 1000).cast("int") for i in range(4)))
    return F.when((F.size(box) == 4) & width.isNotNull(), scaled)


def looks_like_table_failure(error: Column) -> Column:
    s = F.lower(F.coalesce(error, F.lit("")))
    any_of = lambda words: s.rlike("|".join(words))
    return any_of(V.TABLE_WORDS) & any_of(V.ERROR_WORDS)


def rewrite_links(text: Column, prefix: str) -> Column:
    """Puts ``prefix`` before local targets of Markdown links and of src and href attributes."""
    local = r"(?!(?:[A-Za-z][A-Za-z0-9+.\-]*:|/|#))"
    text = F.regexp_replace(text, rf"(\]\()\s*{local}([^)\s]+)", F.lit(f"$1{prefix}$2"))
    return F.regexp_replace(text, rf"(?i)\b((?:src|href)\s*=\s*[\"']){local}([^\"']+)", F.lit(f"$1{prefix}$2"))


def natural_key(name: Column) -> Column:
    """Sorts digit runs as numbers: runs padded to 20 digits, other runs in lower case."""
    runs = F.regexp_extract_all(F.lower(name), F.lit(r"\d+|\D+"), F.lit(0))
    return F.transform(runs, lambda r: F.when(r.rlike(r"^\d"), F.lpad(r, 20, "0")).otherwise(r))


def smiles(canonical_id: Column, value: Column, normalized: Column) -> Column:
    """The structure string of a mention: one marked ``SMILES:``, else the first that looks like one."""
    given = F.filter(F.transform(F.array(canonical_id, value, normalized), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    marked = F.filter(F.transform(given, lambda x: F.when(x.startswith("SMILES:"), F.trim(F.substring(x, 8, 1_000_000)))), lambda x: x.isNotNull() & (x != ""))
    carbons = lambda x: F.length(x) - F.length(F.translate(x, "Cc", ""))
    like = F.filter(
        given,
        lambda x: ~x.isin("PENDING_MAPPING", "UNKNOWN", "N/A", "NA")
        & F.length(x).between(3, 512)
        & x.rlike(r"^[A-Za-z0-9@+\-\[\]=#$()\\/%.]+$")
        & (carbons(x) >= 2)
        & (x.rlike(r"[\[\]=#@()/\\]") | x.rlike(r"[bcnops]|[0-9].*[A-Za-z]|[A-Za-z].*[0-9]") | x.rlike(r"^(?:Br|Cl|[BCNOPSFIbcnops]){2,}$")),
    )
    return F.coalesce(F.try_element_at(marked, F.lit(1)), F.try_element_at(like, F.lit(1)))
