"""Mentions and bindings once more, as Column expressions: what the Arrow functions are held against."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import vocabulary as V
from quire.functions.mentions import ENTITY
from quire.functions.text import literal_map, normal_unit, parse_number, sentences, spans
from quire.operators.relations import RELATION

_EMPTY = f"array<{ENTITY}>"
_NO_RELATION = f"array<{RELATION}>"


def entity(span: Column, type_: str, value=None, unit=None, num=None, pair=None, normalized=None) -> Column:
    null = F.lit(None)
    return F.struct(
        F.lit(0).alias("i"), F.lit(type_).alias("type"), (span["value"] if value is None else value).alias("value"),
        (null if unit is None else unit).cast("string").alias("unit"), (null if num is None else num).cast("double").alias("value_num"),
        (null if pair is None else pair).cast("array<double>").alias("value_pair"), span["start"].alias("start"), span["end"].alias("end"),
        (null if normalized is None else normalized).cast("string").alias("normalized"),
    )


def keyword_pattern(word: str) -> str:
    escaped = "".join(c if c.isalnum() else r"\s+" if c == " " else "\\" + c for c in word)
    return rf"(?U)(?iu)\b{escaped}\b"


def values(text: Column) -> Column:
    pattern = rf"(?iu)({V.VALUE})\s*({V.UNIT})"
    units = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    numbers = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    found = F.arrays_zip(spans(text, pattern).alias("s"), numbers.alias("n"), units.alias("u"))
    return F.transform(found, lambda x: entity(x["s"], "value", x["n"], normal_unit(x["u"]), parse_number(x["n"])))


def colour_coordinates(text: Column) -> Column:
    """A metric and a value for each pair; a pair that is no number has a null pair."""
    pattern = "(?iu)" + V.CIE
    part = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    either = lambda a, b: F.when(F.coalesce(a, F.lit("")) != "", a).otherwise(b)
    found = F.arrays_zip(spans(text, pattern).alias("s"), part(1).alias("a"), part(2).alias("b"), part(3).alias("c"), part(4).alias("d"))

    def both(x: Column) -> Column:
        a, b = either(x["a"], x["c"]), either(x["b"], x["d"])
        pair = F.array(a.try_cast("double"), b.try_cast("double"))
        return F.array(entity(x["s"], "metric", F.lit("cie"), pair=pair), entity(x["s"], "value", F.concat_ws(",", a, b), pair=pair))

    return F.flatten(F.transform(found, both))


def keywords(text: Column, words: list[str], type_: str, normalized: dict | None = None) -> Column:

    def one(word: str) -> Column:
        form = F.lit(normalized[word]) if normalized else None
        return F.transform(spans(text, keyword_pattern(word)), lambda s: entity(s, type_, F.lit(word), normalized=form))

    parts = [one(w) for w in words]
    union = "(?U)(?iu)" + "|".join(keyword_pattern(w).removeprefix("(?U)(?iu)") for w in words)
    # One test for all words first: most texts have none of them.
    return F.when(text.rlike(union), F.concat(*parts)).otherwise(F.array().cast(_EMPTY))


def materials(text: Column) -> Column:
    """Names that hold a digit, or that stand near a word about materials; each span and name once."""
    hint = "(?U)(?iu)" + V.MATERIAL_HINT

    def keep(s: Column) -> Column:
        low = F.greatest(s["start"] - V.MATERIAL_WINDOW, F.lit(0))
        window = F.substring(text, low + 1, s["end"] + V.MATERIAL_WINDOW - low)
        named = F.regexp_like(s["value"], F.lit(r"\d")) | F.regexp_like(window, F.lit(hint))
        return ~F.upper(s["value"]).isin(*V.NO_MATERIALS) & ~F.regexp_like(s["value"], F.lit(V.PUBLICATION_NUMBER)) & named

    found = F.array_distinct(F.concat(*(F.filter(spans(text, p), keep) for p in V.MATERIALS)))
    return F.transform(found, lambda s: entity(s, "material", normalized=F.lower(s["value"])))


def entities(text: Column) -> Column:
    """All mentions, numbered from 0 in ``i``."""
    t = F.coalesce(text, F.lit(""))
    metrics = [w for w in V.METRICS]
    parts = [
        values(t), colour_coordinates(t), keywords(t, metrics, "metric"), materials(t),
        keywords(t, list(V.LAYERS), "device_layer", V.LAYERS), keywords(t, V.ROLES, "role"),
    ]
    all_ = F.concat(*(p.cast(_EMPTY) for p in parts))
    return F.transform(all_, lambda e, i: e.withField("i", i))


def _of_type(entities: Column, *types: str) -> Column:
    return F.filter(entities, lambda e: e["type"].isin(*types))


def _within(items: Column, s: Column) -> Column:
    return F.filter(items, lambda e: (e["start"] >= s["start"]) & (e["end"] <= s["end"]))


def _relation(type_: str, source: Column, target: Column, rule: Column, distance: Column, sentence: Column) -> Column:
    return F.struct(
        F.lit(type_).alias("type"), source.alias("source"), target.alias("target"), literal_map(V.CONFIDENCE)[rule].alias("confidence"),
        rule.alias("rule"), distance.alias("distance"), sentence.alias("sentence"),
    )


def _nearest(candidates: Column) -> Column:
    """The struct with the smallest leading fields; null of an empty array."""
    return F.array_min(candidates)


def metric_values(entities: Column, bounds: Column) -> Column:
    """``has_value``: each value with the nearest metric of its sentence that starts before it, else the nearest.

    Refused if another metric starts between them, or if the metric has units and the
    value another one.
    """
    metrics, values = _of_type(entities, "metric"), _of_type(entities, "value")
    units = F.create_map(*(x for m, us in V.METRIC_UNITS.items() for x in (F.lit(m), F.array(*map(F.lit, us)))))

    def in_sentence(s: Column, sid: Column) -> Column:
        own = _within(metrics, s)

        def bind(v: Column) -> Column:
            before = F.filter(own, lambda m: m["start"] <= v["start"])
            pool = F.when(F.size(before) > 0, before).otherwise(own)
            best = _nearest(F.transform(pool, lambda m: F.struct(F.abs(v["start"] - m["start"]).alias("d"), m["i"].alias("i"), m["start"].alias("start"), m["value"].alias("value"))))
            low, high = F.least(best["start"], v["start"]), F.greatest(best["start"], v["start"])
            crossed = F.exists(own, lambda m: (m["start"] > low) & (m["start"] < high))
            allowed = units[best["value"]]
            unit = F.replace(F.lower(v["unit"]), F.lit(" "), F.lit(""))
            gated = (F.coalesce(v["unit"], F.lit("")) != "") & allowed.isNotNull()
            fits = ~gated | F.array_contains(allowed, unit)
            rule = (
                F.when(gated, F.lit("metric_unit_match"))
                .when((best["value"] == "cie") & v["value_pair"].isNotNull(), F.lit("cie_coord_inline"))
                .otherwise(F.lit("nearest_metric"))
            )
            made = _relation("has_value", best["i"], v["i"], rule, best["d"], sid)
            return F.when(best.isNotNull() & ~crossed & F.coalesce(fits, F.lit(False)), made)

        return F.filter(F.transform(_within(values, s), bind), lambda r: r.isNotNull())

    return F.flatten(F.transform(bounds, in_sentence)).cast(_NO_RELATION)


def pattern_roles(text: Column, entities: Column, bounds: Column) -> Column:
    """``has_role`` by wording: material "as" role, role material, material "in" layer; the nearest material."""
    materials, roles, layers = _of_type(entities, "material"), _of_type(entities, "role"), _of_type(entities, "device_layer")
    gap = lambda a, b: F.substring(text, a + 1, F.greatest(b - a, F.lit(0)))

    def in_sentence(s: Column, sid: Column) -> Column:
        own = _within(materials, s)

        def bind(r: Column, layer: bool) -> Column:
            def candidate(m: Column) -> Column:
                ahead, behind = gap(m["end"], r["start"]), gap(r["end"], m["start"])
                first, second = m["end"] <= r["start"], r["end"] <= m["start"]
                if layer:
                    rule = F.when(first & (F.length(ahead) <= V.LAYER_GAP) & F.regexp_like(ahead, F.lit("(?U)(?iu)" + V.IN_LAYER)), F.lit("pattern_material_in_layer"))
                else:
                    as_ = first & (F.length(ahead) <= V.AS_GAP) & F.regexp_like(ahead, F.lit("(?U)(?iu)" + V.ROLE_AS))
                    filler = ~first & second & (F.length(behind) <= V.FILLER_GAP) & F.regexp_like(behind, F.lit("(?U)(?iu)" + V.ROLE_FILLER))
                    rule = F.when(as_, F.lit("pattern_material_as_role")).when(filler, F.lit("pattern_role_material"))
                found = F.struct(F.abs(r["start"] - m["start"]).alias("d"), m["i"].alias("i"), rule.alias("rule"))
                return F.when(rule.isNotNull(), found)

            best = _nearest(F.filter(F.transform(own, candidate), lambda c: c.isNotNull()))
            return F.when(best.isNotNull(), _relation("has_role", best["i"], r["i"], best["rule"], best["d"], sid))

        all_ = F.concat(F.transform(_within(roles, s), lambda r: bind(r, False)), F.transform(_within(layers, s), lambda r: bind(r, True)))
        return F.filter(all_, lambda r: r.isNotNull())

    return F.flatten(F.transform(bounds, in_sentence)).cast(_NO_RELATION)


def chunks(text: Column, bounds: Column) -> Column:
    """Parts of sentences between commas, colons and connecting words: (start, end, sentence)."""
    pattern = "(?U)(?iu)" + V.CHUNK_SPLIT

    def cut(s: Column, sid: Column) -> Column:
        own = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        cuts = spans(own, pattern)
        starts = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda c: c["end"]))
        ends = F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.length(own)))
        parts = F.zip_with(starts, ends, lambda a, b: F.struct((s["start"] + a).alias("start"), (s["start"] + b).alias("end"), sid.alias("sentence")))
        return F.filter(parts, lambda p: p["end"] > p["start"])

    return F.flatten(F.transform(bounds, cut))


def single_material_roles(entities: Column, scopes: Column, bound: Column, rule: str) -> Column:
    """``has_role`` in scopes (start, end, sentence) with exactly one material, for roles not bound yet, up to a distance."""
    materials, roles = _of_type(entities, "material"), _of_type(entities, "role")

    def in_scope(c: Column) -> Column:
        own = _within(materials, c)
        m = F.get(own, F.lit(0))
        free = F.filter(
            _within(roles, c),
            lambda r: (F.size(own) == 1) & ~F.array_contains(bound, r["i"]) & (F.abs(r["start"] - m["start"]) <= V.ROLE_DISTANCE),
        )
        return F.transform(free, lambda r: _relation("has_role", m["i"], r["i"], F.lit(rule), F.abs(r["start"] - m["start"]), c["sentence"]))

    return F.flatten(F.transform(scopes, in_scope)).cast(_NO_RELATION)


def bind(df, text: str = "text", entities: str = "entities"):
    """Adds ``relations``: metric values, then roles by wording, by chunk, by the only material of a sentence."""
    keep = df.columns
    t, e = F.coalesce(F.col(text), F.lit("")), F.col(entities)
    df = df.withColumn("__s", sentences(t))
    numbered = F.transform(F.col("__s"), lambda s, i: F.struct(s["start"].alias("start"), s["end"].alias("end"), i.alias("sentence")))
    # Most blocks hold mentions of one type only; they skip all of the array work.
    has = lambda *types: F.exists(e, lambda x: x["type"].isin(*types))
    none = F.array().cast(_NO_RELATION)
    df = df.withColumn("__v", F.when(has("metric") & has("value"), metric_values(e, F.col("__s"))).otherwise(none))
    df = df.withColumn("__1", F.when(has("material") & has("role", "device_layer"), pattern_roles(t, e, F.col("__s"))).otherwise(none))
    df = df.withColumn("__bound", F.transform("__1", lambda r: r["target"]))
    two = single_material_roles(e, chunks(t, F.col("__s")), F.col("__bound"), "chunk_role_binding")
    df = df.withColumn("__2", F.when(has("material") & has("role"), two).otherwise(none))
    df = df.withColumn("__bound", F.concat("__bound", F.transform("__2", lambda r: r["target"])))
    three = single_material_roles(e, numbered, F.col("__bound"), "nearest_role")
    df = df.withColumn("__3", F.when(has("material") & has("role"), three).otherwise(none))
    return df.select(*keep, F.concat("__v", "__1", "__2", "__3").alias("relations"))
