"""Sections, claims, whole documents, sources and sinks."""

import json
import re

import pytest
from pyspark.sql import functions as F

from quire import schemas
from quire.operators import claims, sections
from quire.plans import parse
from quire.sources import readers, writers
from tests.test_tables import LEVELS

ITEMS = [
    {"type": "text", "page_idx": 0, "text": "(10) WO 2026/1\n(54) Device title\nmore title\n(71) A Corp; B Inc", "bbox": [0, 0, 500, 999]},
    {"type": "text", "page_idx": 0, "text": "Abstract"}, {"type": "text", "page_idx": 0, "text": "An OLED using CBP host (12)."},
    {"type": "text", "page_idx": 1, "text": "Claims"}, {"type": "text", "page_idx": 1, "text": "1. A device comprising an anode."}, {"type": "text", "page_idx": 1, "text": "2. The device, wherein HTL is thick; EQE of 21%."},
    {"type": "text", "page_idx": 2, "text": "具体实施方式"}, {"type": "text", "page_idx": 2, "text": "a substrate (10) and an anode layer (20), a base (10)"},
    {"type": "text", "page_idx": 2, "text": "实施例 1 制备方法"}, {"type": "text", "page_idx": 2, "text": "Bis carbazol biphenyl (BCB) was used as host, EQE of 20%."},
    {"type": "table", "page_idx": 3, "table_body": LEVELS, "table_caption": ["Table 1 OLED device performance"]},
    {"type": "image", "page_idx": 3, "image_caption": ["Fig. 2a stack", "figure 3"], "img_path": "images/a.jpg"}, {"type": "equation", "page_idx": None, "text": "x"},
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("layout")
    for stem in ("WO2026000001A1", "文献 b"):
        (d / stem / "auto").mkdir(parents=True)
        (d / stem / "auto" / f"{stem}_content_list.json").write_text(json.dumps(ITEMS, ensure_ascii=False))
        (d / stem / "auto" / f"{stem}_middle.json").write_text(json.dumps({"pdf_info": [{"page_idx": 0, "page_size": [600.9, 800]}, {"page_idx": 1, "page_size": [1]}], "_backend": "p"}))
    (d / "bad").mkdir()
    (d / "bad" / "bad_content_list.json").write_text("{not json")
    return str(d)


@pytest.fixture(scope="module")
def document(spark, folder):
    items = readers.layout_items(spark, [folder])
    return {r.doc_id: r for r in parse.parse(items, readers.page_sizes(spark, [folder])).collect()}


def test_documents_from_files(document):
    assert set(document) == {"WO2026000001A1", "文献 b"}
    d = document["WO2026000001A1"]
    assert d.metadata.publication_number == "WO 2026/1" and d.metadata.title == "Device title more title" and d.metadata.applicants == ["A Corp", "B Inc"] and d.metadata.source == "inid"
    assert d.abstract == "An OLED using CBP host (12)."
    assert d.reference_numerals == {"10": "a substrate", "20": "and an anode layer"}
    b = {x.block_id.removeprefix("doc_WO2026000001A1_"): x for x in d.blocks}
    assert list(b) == ["p1_b0", "p1_b1", "p1_b2", "p2_b3", "p2_b4", "p2_b5", "p3_b6", "p3_b7", "p3_b8", "p3_b9", "p4_b10", "p4_b10_table_cap01", "p4_b11", "p4_b11_fig_cap01", "p4_b11_fig_cap02", "pNone_b12"]
    assert [x.type for x in d.blocks][:10] == ["text", "title", "abstract", "claims_title", "claim_independent", "claim_independent", "title", "description", "example", "example"]
    assert b["p1_b1"].char_offset == [63, 71] and b["p3_b9"].example_id == "example_1" and b["p2_b5"].claim_no == 2
    assert b["p4_b10_table_cap01"].table_no == "1" and b["p4_b11"].figure_no == "2a" and b["p4_b11_fig_cap02"].figure_no == "3"
    assert len(b["p4_b10"].entities) == 15 and len(b["p4_b10"].relations) == 10
    assert b["p4_b10"].relations[0].relation_id == "doc_WO2026000001A1_p4_b10_table_r001"
    assert b["p3_b9"].entities[0].entity_id == "doc_WO2026000001A1_p3_b9_e001" and b["p3_b9"].relations[0].sentence_id.endswith("_s000")
    (e,) = d.experiments
    assert e.example_id == "example_1" and len(e.materials_used) == 4 and len(e.performance) == 5 and len(e.role_relations) == 3
    assert e.source_block_ids[0].endswith("p3_b8") and len(e.source_block_ids) == 8


def test_aliases_are_followed(document):
    found = [e for b in document["文献 b"].blocks for e in b.entities if e.type == "material" and e.value == "BCB"]
    assert {e.canonical_id for e in found} == {"mat:BCB"}


def test_boxes_follow_the_page(spark, folder):
    b = parse.blocks(readers.layout_items(spark, [folder]), readers.page_sizes(spark, [folder])).where("doc_id = 'WO2026000001A1' and idx = 0").first()
    assert b.bbox_abs == [0, 0, 300, 799]


def test_cached_metadata_wins(spark, folder):
    cached = spark.createDataFrame([("文献 b",)], "doc_id string").withColumn("metadata", F.from_json(F.lit('{"title": "Cached", "source": "cache"}'), schemas.METADATA))
    got = {r.doc_id: r.metadata for r in parse.parse(readers.layout_items(spark, [folder]), None, cached).collect()}
    assert got["文献 b"].title == "Cached" and got["WO2026000001A1"].source == "inid"


def test_state_rules(spark):
    lines = ["intro", "Example 7 first", "text a", "Description of it", "text b", "Device Example without", "text c", "Example 2", "", "Background", "text d"]
    df = spark.createDataFrame([("d", i, t, True) for i, t in enumerate(lines)], "doc_id string, idx int, text string, is_text boolean")
    got = sections.classify(df).orderBy("idx").collect()
    assert [r.block_type for r in got] == ["text", "example", "example", "title", "description", "device_example", "device_example", "example", "text", "title", "description"]
    assert [r.section for r in got] == [None, "example", "example", "description", "description", "device_example", "device_example", "example", "example", "description", "description"]
    assert [r.subsection for r in got] == [None] * 9 + ["background"] * 2
    assert [r.example_id for r in got] == [None, "example_7", "example_7", None, None, None, None, "example_2", "example_2", None, None]


def test_claim_trees(spark):
    rows = [(1, []), (2, [1]), (3, [1, 2]), (4, [9]), (5, [6]), (6, [5]), (2, [1])]
    node = claims.nodes(spark.createDataFrame([("d", i, n, f"t{n}", d) for i, (n, d) in enumerate(rows)], "doc_id string, idx int, claim_no int, text string, depends_on array<int>"))
    assert sorted(r.claim_no for r in claims.roots(node).collect()) == [1, 4]
    pairs = {(r.ancestor, r.descendant, r.depth) for r in claims.closure(claims.edges(node)).collect()}
    assert pairs == {(1, 2, 1), (1, 3, 1), (2, 3, 1), (5, 6, 1), (6, 5, 1), (5, 5, 2), (6, 6, 2)}
    (tree,) = [json.loads(r.tree) for r in claims.nested(node).collect()]
    assert [t["claim_no"] for t in tree] == [1, 4] and [c["claim_no"] for c in tree[0]["children"]] == [2, 3] and tree[0]["children"][0]["children"][0]["claim_no"] == 3


def test_deep_claims(spark):
    """A chain beyond a hundred levels, and a cycle beside it."""
    edge = spark.createDataFrame([("d", i, i + 1) for i in range(1, 130)] + [("e", 1, 2), ("e", 2, 3), ("e", 3, 1)], "doc_id string, parent int, child int")
    got = {(r.doc_id, r.ancestor, r.descendant): r.depth for r in claims.closure(edge).collect()}
    want = {("d", i, j): j - i for i in range(1, 131) for j in range(i + 1, 131)}
    want |= {("e", i, j): (j - i - 1) % 3 + 1 for i in range(1, 4) for j in range(1, 4)}
    assert got == want


def test_folder_of_the_parse_method_comes_first(spark, tmp_path):
    for folder, text in (("x/doc 1/auto", "by auto"), ("x/doc 1/ocr", "by ocr"), ("x/doc 2", "at the root")):
        (tmp_path / folder).mkdir(parents=True)
        stem = folder.split("/")[1]
        (tmp_path / folder / f"{stem}_content_list.json").write_text(json.dumps([{"type": "text", "page_idx": 0, "text": text}]))
        (tmp_path / folder / f"{stem}_middle.json").write_text(json.dumps({"pdf_info": [{"page_idx": 0, "page_size": [len(text), 1]}]}))
    read = lambda method: {r.doc_id: r.text for r in readers.layout_items(spark, [str(tmp_path)], method).collect()}
    assert read("ocr") == {"doc 1": "by ocr", "doc 2": "at the root"}
    assert read("auto") == read(None) == read("absent") == {"doc 1": "by auto", "doc 2": "at the root"}
    assert {r.doc_id: r.width for r in readers.page_sizes(spark, [str(tmp_path)], "ocr").collect()} == {"doc 1": 6, "doc 2": 11}


def test_raw_items_are_kept_on_demand(spark, folder, tmp_path):
    items = readers.layout_items(spark, [folder]).where("doc_id = 'WO2026000001A1' and idx < 3")
    (kept,) = parse.parse(items, keep_raw=True).collect()
    assert [json.loads(b.raw)["text"] for b in kept.blocks] == [i["text"] for i in ITEMS[:3]]
    (plain,) = parse.parse(items).collect()
    assert "raw" not in plain.blocks[0].asDict()
    writers.structured_json(parse.parse(items), f"{tmp_path}/pretty", pretty=True)
    (file,) = (tmp_path / "pretty" / "doc_id=WO2026000001A1").glob("*.txt")
    text = file.read_text()
    assert json.loads(text)["abstract"] == "An OLED using CBP host (12)." and text.count("\n") > 20


def test_parts_of_a_table_carry_no_layout(spark, folder):
    """A long table comes in hundreds of parts: none has a copy of its markup."""
    items = readers.layout_items(spark, [folder]).where("doc_id = 'WO2026000001A1'")
    rows = parse.named_blocks(parse.blocks(items)).where("block_type = 'table' or part is not null").collect()
    whole, parts = [r for r in rows if r.part is None], [r for r in rows if r.part is not None]
    assert whole[0].table_body == LEVELS and sum(len(r.relations) for r in parts) == 10
    assert {k for r in parts for k, v in r.asDict().items() if v is not None} == {"doc_id", "block_id", "paragraph_index", "example_id", "part", "entities", "relations"}


def test_blocks_are_dealt_out_by_what_they_hold(spark, folder, document, monkeypatch):
    """A task puts together a bounded number of records, and the documents are the same."""
    monkeypatch.setattr(parse, "TOGETHER", 20)
    df = parse.parse(readers.layout_items(spark, [folder]), readers.page_sizes(spark, [folder]))
    dealt = [int(n) for n in re.findall(r"RepartitionByExpression \[[^\]]*\], (\d+)", df._jdf.queryExecution().optimizedPlan().toString())]
    held = sum(1 + len(b.entities) + len(b.relations) for d in document.values() for b in d.blocks)
    assert dealt and held / 20 <= dealt[0] <= held / 20 + 3
    assert {r.doc_id: r for r in df.collect()} == document


def test_blocks_that_are_counted_make_no_row_of_the_document(spark, folder):
    """The count is a result of the aggregate that collects the blocks; no step hands on the whole list."""
    df = parse.parse(readers.layout_items(spark, [folder])).select("doc_id", "abstract", F.size("blocks").alias("n"))
    assert df._jdf.queryExecution().optimizedPlan().nodeName() == "Aggregate"
    assert {r.n for r in df.collect()} == {16}


def test_no_items_make_no_documents(spark, folder):
    schema = readers.layout_items(spark, [folder]).schema
    assert parse.parse(spark.createDataFrame([], schema)).collect() == []


def test_structured_files(spark, tmp_path, document):
    good = {"doc_id": "", "metadata": {"title": "T"}, "blocks": [{"block_id": "b", "entities": [{"value": "v"}, None], "relations": None}, None], "experiments": [{"example_id": "e", "performance": ["x"]}]}
    (tmp_path / "one two_structured.json").write_text(json.dumps(good))
    (tmp_path / "bad_structured.json").write_text("{oops")
    (tmp_path / "list_structured.json").write_text("[1]")
    (got,) = readers.structured_documents(spark, [str(tmp_path)]).collect()
    assert got.doc_id == "one two" and len(got.blocks) == 1 and got.blocks[0].type == "unknown" and got.blocks[0].relations == []
    assert [(e.entity_id, e.type, e.value) for e in got.blocks[0].entities] == [("", "unknown", "v")]
    assert got.experiments[0].performance_relations == ["x"]
    assert {r.path.rsplit("/")[-1]: r.reason for r in readers.quarantine(spark, [str(tmp_path)]).collect()} == {"bad_structured.json": "no JSON", "list_structured.json": "no object"}
    with pytest.raises(Exception):
        readers.structured_documents(spark, [str(tmp_path)], strict=True).collect()


def test_structured_round_trip(spark, folder, tmp_path, document):
    items = readers.layout_items(spark, [folder])
    df = parse.parse(items)
    for r in df.select("doc_id", F.to_json(F.struct(*df.columns)).alias("j")).collect():
        (tmp_path / f"{r.doc_id}_structured.json").write_text(r.j)
    again = {r.doc_id: r for r in readers.structured_documents(spark, [str(tmp_path)]).collect()}
    assert {k: len(v.blocks) for k, v in again.items()} == {k: len(v.blocks) for k, v in document.items()}
    writers.structured_json(df, f"{tmp_path}/out")
    assert spark.read.schema(schemas.DOCUMENT).json(f"{tmp_path}/out").count() == 2


def test_lookup_and_file_list(spark, tmp_path):
    (tmp_path / "cache.json").write_text('{"a": {"title": "x"}, "b": null}')
    (tmp_path / "broken.json").write_text("{")
    read = lambda n: [(r.key, r.value.title) for r in readers.lookup_cache(spark, f"{tmp_path}/{n}", "struct<title:string>").collect()]
    assert read("cache.json") == [("a", "x")] and read("broken.json") == [] and read("absent.json") == []
    for p in ("in/B.PDF", "in/a.pdf", "in/output/c.pdf", "in/x.txt", "in/sub/d.pdf"):
        f = tmp_path / p
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("x")
    assert [r.file for r in readers.source_files(spark, f"{tmp_path}/in").collect()] == ["a.pdf", "B.PDF", "d.pdf"]


def test_versioned_table(spark, tmp_path):
    t = writers.Table(spark, str(tmp_path / "t"), "k int, v string")
    assert t.read().count() == 0
    t.write(spark.createDataFrame([(1, "a")], "k int, v string"))
    t.write(t.read().union(spark.createDataFrame([(2, "b")], "k int, v string")))
    assert t.version() == 2 and t.read().count() == 2


def test_buckets_that_are_not_touched_stay(spark, tmp_path):
    t = writers.Table(spark, str(tmp_path / "t"), "k string, v int", "k", 5)
    rows = lambda pairs: spark.createDataFrame(pairs, "k string, v int")
    t.write(rows([(f"k{i}", i) for i in range(40)]))
    before = t._state()[1]
    t.replace(rows([("k3", 300), ("k3", 301), ("new", 7)]), rows([("k3", 0), ("k4", 0), ("new", 0)]))
    touched = t.buckets_of(rows([("k3", 0), ("k4", 0), ("new", 0)]))
    assert {b: v for b, v in t._state()[1].items() if b not in touched} == {b: v for b, v in before.items() if b not in touched}
    want = sorted([(f"k{i}", i) for i in range(40) if i not in (3, 4)] + [("k3", 300), ("k3", 301), ("new", 7)])
    assert sorted(map(tuple, t.read().collect())) == want
    again = writers.Table(spark, str(tmp_path / "t"), "k string, v int", "k", 99)  # the number it was made with holds
    again.replace(rows([]), rows([(f"k{i}", 0) for i in range(40)]))
    assert sorted(map(tuple, again.read().collect())) == [("new", 7)]
    assert again.vacuum() and sorted(map(tuple, again.read().collect())) == [("new", 7)]


def test_small_sinks(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, " ")], "id int, seq int, text string")
    assert sorted((r.id, r.text) for r in writers.last_by_id(df, "id", "seq").collect()) == [(1, "b"), (2, " ")]
    assert writers.searchable_blocks(df).count() == 2
    md = spark.createDataFrame([("d", "/x/sub/a.md"), ("d", "/x/b10.md"), ("d", "/x/b2.md")], "doc_id string, path string")
    assert writers.main_markdown(md).first().path == "/x/b2.md"
    led = spark.createDataFrame([("b", "failed"), ("a", "failed"), ("b", "failed"), ("c", "done")], "file string, status string")
    assert [r.file for r in writers.failed_files(led).collect()] == ["a", "b"]
