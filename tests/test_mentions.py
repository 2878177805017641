"""The Arrow functions against Column expressions of the same rules, and hand-worked cases."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import mentions, rowwise, text
from quire.operators import relations
from tests import expressions

TEXTS = [
    "TCTA served as host, while BPhen acts as acceptor in EML.", "mCBP was used as guest material in EML.", "Pt(acac)2 functioned as emitter in EML.",
    "Compound 12 is used as host material.", "TCTA host, BPhen dopant.", "TCTA " + "y" * 130 + " donor.", "Compound 7 " + "y" * 46 + " dopant.",
    "EQE of 18% at 4 V", "EQE of 18.6% at 4.5 V", "CIE 0.28, 0.55.", "CIE (0.28, 0.55) luminance 1.5×10^3 cd/m2; 2 x 10⁻³ mA / cm²",
    "US20190012345A1 teaches a host, FIG 4", "emitter: Cmpd. B; the donor is TCTA", "功率效率 PE 45 lm/W，客体材料 mCP（掺杂）。", "", None,
    "turn-on voltage 2 V and voltage 6 V, current  efficiency 14 cd / A", "HIL/TCTA, HBL with BPhen in anode and host 9 hours 4 compounds",
    "ACCEPTOR Kelvin emİtter hoſt", "guest materials, hole transporting host-material; exciton  blocking",
]


def native(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("entities", mentions.entities(F.col("text")))
    return {r.i: r for r in relations.bind(df).collect()}


def same(row, t):
    want = rowwise.entities(t)
    keys = ("type", "value", "start", "end", "unit", "value_num", "value_pair", "normalized")
    norm = lambda v: pytest.approx(v) if isinstance(v, float) else v
    assert [tuple(e[k] for k in keys) for e in row.entities] == [tuple(norm(e.get(k)) for k in keys) for e in want]
    keys = ("type", "source", "target", "confidence", "rule", "distance", "sentence")
    assert [tuple(r[k] for k in keys) for r in row.relations] == [tuple(r[k] for k in keys) for r in rowwise.relations(t or "", want)]


def by_expressions(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("entities", expressions.entities(F.col("text")))
    return {r.i: r for r in expressions.bind(df).collect()}


def test_fixed_texts(spark):
    got, want = native(spark, TEXTS), by_expressions(spark, TEXTS)
    for i, t in enumerate(TEXTS):
        same(got[i], t)
        if "İ" not in (t or ""):  # a letter that the two engines fold differently
            assert got[i] == want[i]


PIECES = ["CBP", "host", " as ", "in EML", "EQE", "21 %", "3.5 V", ". ", ", ", "Compound 2", "dopant", "CIE 0.3, 0.4", "CE 3 cd/A", " and ", "is", "voltage", "mCP", "材料", "; ", "is used as"]


def test_mixed_texts(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14))) for _ in range(300)]
    got, want = native(spark, texts), by_expressions(spark, texts)
    for i, t in enumerate(texts):
        same(got[i], t)
        assert got[i] == want[i]


def test_bindings_by_hand(spark):
    got = native(spark, TEXTS)
    pairs = lambda i: [(got[i].entities[r.source].value, got[i].entities[r.target].value, r.rule, r.distance) for r in got[i].relations]
    assert pairs(0) == [("TCTA", "host", "pattern_material_as_role", 15), ("BPhen", "acceptor", "pattern_material_as_role", 14), ("BPhen", "eml", "pattern_material_in_layer", 26)]
    assert pairs(1) == [("mCBP", "guest", "pattern_material_as_role", 17), ("mCBP", "guest material", "pattern_material_as_role", 17)]
    assert pairs(4) == [("TCTA", "host", "chunk_role_binding", 5), ("BPhen", "dopant", "chunk_role_binding", 6)]
    assert pairs(5) == pairs(6) == []  # no material near a hint; a role too far away
    assert pairs(7) == [("eqe", "18", "metric_unit_match", 7)]
    assert pairs(8) == []  # a decimal point ends a sentence
    assert got[9].entities[0].value_pair == [0.28, None]  # a number with a dot at its end is none


def test_spans_count_characters(spark):
    df = spark.createDataFrame([("aé12日本345",), ("",), ("99",)], "t string")
    got = [[tuple(s) for s in r[0]] for r in df.select(text.spans(F.col("t"), r"\d+")).collect()]
    assert got == [[(2, 4, "12"), (6, 9, "345")], [], [(0, 2, "99")]]


def test_numbers_and_units(spark):
    cases = {"1.5": 1.5, "2 x 10^3": 2000.0, "7×10²": 700.0, "3 x 10⁻²": 0.03, "1e-3": 0.001, "0.62.": None, "−5": -5.0, "x": None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.n for r in df.select("t", text.parse_number(F.col("t")).alias("n")).collect()}
    for k, v in cases.items():
        assert got[k] == (pytest.approx(v) if v is not None else None) and rowwise.parse_number(k) == (pytest.approx(v) if v is not None else None)
    units = {"cd / m²": "cd/m2", "cd·m-2": "cd/m2", "MA/CM2": "mA/cm2", "hours": "hours", " V ": "V", "Hr": "hr"}
    df = spark.createDataFrame([(k,) for k in units], "t string")
    assert {r.t: r.u for r in df.select("t", text.normal_unit(F.col("t")).alias("u")).collect()} == units
    assert {k: rowwise.normal_unit(k) for k in units} == units


def test_claims_and_examples(spark):
    cases = [
        ("1. An OLED device comprising", 1, "An OLED device comprising", []), ("Claim 1: The device of claim 1 ...", 1, "The device of claim 1 ...", []),
        ("Claim 1 The device", 1, "The device", []), ("权利要求1 一种有机电致发光器件", 1, "一种有机电致发光器件", []), ("Claim 3: The device of claim 1", 3, "The device of claim 1", []),
        ("3. The device of claims 1 to 2", 3, "The device of claims 1 to 2", [1, 2]), ("9. As in claim 2 and 4 to 6 or 9", 9, "As in claim 2 and 4 to 6 or 9", [2, 4, 5, 6]),
        ("5. claims 1 to 99", 5, "claims 1 to 99", [1, 99]), ("no number", None, None, []),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    no = text.claim_no(F.col("t"))
    got = df.select("i", no.alias("n"), text.claim_text(F.col("t")).alias("x"), text.claim_depends(F.col("t"), no).alias("d")).orderBy("i").collect()
    assert [(r.n, r.x, r.d) for r in got] == [c[1:] for c in cases]
    cases = {"实施例 1 制备方法": "1", "Comparative Example A": "A", "example without number": None, "在实施例1中，器件性能提升": None, "Device Example B-2 x": "B-2"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.e for r in df.select("t", text.example_id(F.col("t")).alias("e")).collect()} == cases


def test_keys(spark):
    cases = {"Ir(ppy)3": "IRPPY3", " 4,4'-Bis ": "44BIS", "材料": "", None: ""}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.k for r in df.select("t", text.alias_key(F.col("t")).alias("k")).collect()} == cases
    got = {r.t: r.k for r in df.select("t", text.fallback_id(F.col("t")).alias("k")).collect()}
    assert got[None] == "mat:RAW" + "0" * 12 and all(rowwise.fallback_id(t) == k for t, k in got.items())
    df = spark.createDataFrame([("WO2023123456A1",), ("wo - 2023123456",), ("WO2023/123456",), ("US1",)], "t string")
    assert [r[0] for r in df.select(text.world_number(F.col("t"))).collect()] == ["WO2023123456", "WO2023123456", None, None]


def test_smiles(spark):
    cases = [("SMILES: CCO ", "x", None, "CCO"), ("mat:CBP", "c1ccccc1", None, "c1ccccc1"), ("mat:CBP", "CBP", "cbp", None), (None, "C C=O", None, None), (None, "N/A", "CC(=O)O", "CC(=O)O"), (None, "CCBr", None, "CCBr"), (None, "CO", None, None)]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, a string, b string, c string")
    got = df.select("i", text.smiles(F.col("a"), F.col("b"), F.col("c")).alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [c[3] for c in cases]


def test_links_and_natural_order(spark):
    df = spark.createDataFrame([('![a](img/x.png) [b](https://h/p) [c](#s) [d](/abs) <img src="i.png"> <a href=\'http://x\'>',)], "t string")
    got = df.select(text.rewrite_links(F.col("t"), "p/")).first()[0]
    assert got == '![a](p/img/x.png) [b](https://h/p) [c](#s) [d](/abs) <img src="p/i.png"> <a href=\'http://x\'>'
    df = spark.createDataFrame([("part10",), ("part2",), ("Part1",), ("a",)], "t string")
    assert [r.t for r in df.orderBy(text.natural_key(F.col("t"))).collect()] == ["a", "Part1", "part2", "part10"]


def test_table_failures(spark):
    df = spark.createDataFrame([("RuntimeError in RapidTable",), ("table of contents",), ("CUDA error",), (None,)], "t string")
    assert [r[0] for r in df.select(text.looks_like_table_failure(F.col("t"))).collect()] == [True, False, False, False]


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(PIECES), max_size=12))
def test_relations_name_mentions_of_the_right_type(parts):
    t = " ".join(parts)
    found = rowwise.entities(t)
    for r in rowwise.relations(t, found):
        ends = found[r["source"]]["type"], found[r["target"]]["type"]
        assert ends in ({("metric", "value")} if r["type"] == "has_value" else {("material", "role"), ("material", "device_layer")})
