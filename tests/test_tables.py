from collections import Counter

from quire.functions import rowwise
from quire.operators import tables

LEVELS = (
    '<table><tr><th colspan="2">Measured data</th><th rowspan="2">Compound</th><th rowspan="2">Emitter</th></tr><tr><th>PE (lm/W)</th><th>Luminance (cd/m2)</th></tr>'
    "<tr><td>42.5</td><td>1500</td><td>BPhen</td><td>no</td></tr><tr><td>37.1</td><td>900</td><td>TCTA</td><td>yes</td></tr></table>"
)


def cell(text, header=False, rowspan=1, colspan=1):
    return {"text": text, "is_header": header, "rowspan": rowspan, "colspan": colspan}


def test_simple_grid():
    rows = [[cell("Donor", True), cell("Sample", True), cell("Voltage (V)", True)], [cell("weak"), cell("TPBi"), cell("4.8")]]
    t = tables.Table(rows, "T", rowwise.Aliases())
    assert [(r["type"], r["distance"]) for r in t.relations] == [("row_has_metric", 1), ("has_value", 0), ("has_role", 1)]
    assert next(e for e in t.entities if e["type"] == "material")["canonical_id"] == "mat:TPBI"
    assert next(e for e in t.entities if e["type"] == "value")["unit"] == "V"


def test_two_header_levels():
    rows = tables.parse_rows(LEVELS)
    kinds = tables.columns(tables.grid(rows))
    assert [k["header"] for k in kinds] == ["Measured data PE (lm/W)", "Measured data Luminance (cd/m2)", "Compound", "Emitter"]
    assert [k["kind"] for k in kinds] == ["metric", "metric", "row_key", "role"]
    t = tables.Table(rows, "T", rowwise.Aliases())
    assert Counter(r["type"] for r in t.relations) == {"row_has_metric": 4, "has_value": 4, "has_role": 2}
    assert {r["rule"] for r in t.relations} == {"table_row_key_binding", "table_col_binding", "table_role_column"}
    assert [e["canonical_id"] for e in t.entities if e["type"] == "material"] == ["mat:BPHEN", "mat:TCTA"]
    assert tables.units(rows) == ["cd/m2", "lm/W"]


def test_odd_html():
    assert tables.parse_rows(None) == tables.parse_rows("no table") == []
    nested = "<table><tr><td>a<table><tr><td>b</td></tr></table></td></tr></table><table><tr><td>c</td></tr></table>"
    assert [[c["text"] for c in r] for r in tables.parse_rows(nested)] == [["a"], ["c"]]
    assert tables.parse_rows('<table><tr><td rowspan="x" colspan="0">a</td><td>b</tr></table>') == [[cell("a")]]
    assert [[c and c["text"] for c in r] for r in tables.grid([[cell("a", rowspan=3), cell("b")], [cell("c", colspan=2)], []])] == [["a", "b", None], ["a", "c", "c"], ["a", None, None]]
    assert tables.grid([]) == tables.grid([[]]) == []
    deep = "<table><tr><td>a<table><tr><td>b<table><tr><td>c</td></tr></table>d</td></tr></table>e</td><td>f</td></tr></table>"
    assert [[c["text"] for c in r] for r in tables.parse_rows(deep)] == [["ae", "f"]]
    twice = "<table><tr><td>a</td><td>b<td>c</td><tr><th>d</th></tr>" + "<p>x</p><table><tr><td>y</td></tr></table></table><tr><td>z"
    assert [[c["text"] for c in r] for r in tables.parse_rows(twice)] == [["d"]]


def test_columns_without_a_metric_are_metrics():
    rows = [[cell("Sample", True), cell("", True), cell("Yield", True)], [cell("A1"), cell("5"), cell("x")]]
    t = tables.Table(rows, "T", rowwise.Aliases())
    assert {e["value"] for e in t.entities if e["type"] == "metric"} == {"col_2", "Yield"}


def test_rows_are_read_when_there_is_no_structure():
    t = tables.Table(tables.parse_rows("<table><tr><td>CBP was used as host</td></tr></table>"), "T", rowwise.Aliases())
    assert [(r["type"], r["rule"], r["sentence_id"]) for r in t.relations] == [("has_role", "pattern_material_as_role", "T_row001_s000")]


def test_coordinate_pairs_and_bare_numbers():
    got = tables.cell_values("cie", "0.31, 0.62", None)
    assert [v["value_pair"] for v in got] == [[0.31, 0.62]]
    assert [(v["value"], v.get("unit")) for v in tables.cell_values("luminance", "1200 / 3e3", "cd/m2")] == [("1200", "cd/m2"), ("3e3", "cd/m2")]


def test_aliases_follow_one_another():
    names = rowwise.Aliases()
    names.read("Bis carbazol biphenyl (BCB)")
    assert names.id_of("BCB") == names.id_of("bis carbazol biphenyl") == "mat:BCB"
    assert names.promote("Bis carbazol biphenyl") == "mat:BISCARBAZOLBIPHENYL" == names.id_of("BCB")
    assert names.id_of("材料").startswith("mat:RAW")
    assert names.id_of("fac-Ir(ppy)3") == "mat:IRPPY3"


def test_on_a_column(spark):
    df = spark.createDataFrame([("a", LEVELS), ("b", None), ("c", "x")], "table_id string, html string")
    assert tables.cells(df).count() == 13
    assert tables.table_relations(df).count() == 10
    assert tables.column_kinds(df).where("kind = 'metric'").count() == 2


def test_a_long_table_comes_in_parts_that_make_the_whole(monkeypatch):
    """No part holds many records, and the unit of a column reaches the mentions of cells, which come last."""
    monkeypatch.setattr(tables, "PART", 20)
    html = "<table><tr><th>Material</th><th>EQE (%)</th><th>CIE</th></tr>" + "".join(f"<tr><td>Compound {i}</td><td>{i}</td><td>CIE (0.1, 0.{i})</td></tr>" for i in range(1, 100)) + "</table>"
    whole = tables.Table(tables.parse_rows(html), "T", rowwise.Aliases())
    parts = list(tables.Reader(tables.parse_rows(html), "T", rowwise.Aliases()).parts())
    assert len(parts) > 10 and max(len(e) + len(r) for _, e, r in parts) < 40
    parts.sort(key=lambda x: x[0])
    assert [e for _, x, _ in parts for e in x] == whole.entities and [r for _, _, x in parts for r in x] == whole.relations
    assert len({e["entity_id"] for e in whole.entities}) == len(whole.entities)
