import json

import pytest
from pyspark.sql import functions as F

from quire import cli
from quire.plans import ingest, parse
from quire.sources import readers
from tests.test_documents import ITEMS


@pytest.fixture(scope="module")
def layout(tmp_path_factory):
    d = tmp_path_factory.mktemp("in")
    for stem in ("docA", "docB"):
        (d / f"{stem}_content_list.json").write_text(json.dumps(ITEMS, ensure_ascii=False))
    (d / "biblio.json").write_text(json.dumps({"DOC-a": {"metadata": {"title": "From the cache", "source": "cache"}}, "other": {"title": "x"}}))
    return d


@pytest.fixture(scope="module")
def store(spark, layout, tmp_path_factory):
    s = ingest.Store(spark, str(tmp_path_factory.mktemp("store")), buckets=3)
    s.ingest(parse.parse(readers.layout_items(spark, [str(layout)])), 16)
    return s


def test_tables_are_filled_and_keys_are_unique(store):
    got = {r.table: (r.version, r.rows, r.repeated_keys) for r in store.health().collect()}
    assert all(x[0] == 1 and x[2] == 0 for x in got.values())
    assert got["document"][1] == 2 and got["block"][1] == 32 and got["entity"][1] > 40 and got["experiment"][1] == 2
    assert got["vertex"][1] == got["document"][1] + got["block"][1] + got["entity"][1]
    assert got["search_document"][1] == 2
    assert store.read("material_doc_usage").where("canonical_id = 'mat:CBP'").count() == 2


def test_second_ingest_changes_nothing_but_versions(spark, store, layout):
    before = {n: store.read(n).count() for n in ingest.TABLES}
    first = store.read("material_canonical").select("canonical_id", "first_seen_doc_id").collect()
    store.ingest(parse.parse(readers.layout_items(spark, [f"{layout}/docB_content_list.json"])), 16)
    assert {n: store.read(n).count() for n in ingest.TABLES} == before
    assert sorted(map(tuple, first)) == sorted(map(tuple, store.read("material_canonical").select("canonical_id", "first_seen_doc_id").collect()))
    assert store.tables["block"].version() == 2


def test_maintenance(spark, store):
    assert tuple(store.rebuild_registry().first())[0] == 2
    assert store.drop_orphans().count() == 0
    store.delete(spark.createDataFrame([("docB",)], "doc_id string"))
    assert store.read("document").count() == 1 and store.read("edge").where("doc_id = 'docB'").count() == 0


def test_rows_that_are_no_good_are_noted(spark, tmp_path, layout):
    docs = parse.parse(readers.layout_items(spark, [f"{layout}/docA_content_list.json"]))
    broken = F.transform("blocks", lambda b: b.withField("block_id", F.when(b["type"] == "abstract", F.lit(" ")).otherwise(b["block_id"])))
    store = ingest.Store(spark, str(tmp_path / "s"), buckets=2)
    store.ingest(docs.withColumn("blocks", broken), 8)
    assert [(r.doc_id, r.table_name, r.failed_checks) for r in store.read("rejected_row").collect()] == [("docA", "block", ["block_id is blank"])]
    assert store.read("block").count() == 15 and store.read("document").count() == 1


def test_valid_rows(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "k int, v string")
    good, bad = ingest.valid_rows(df, {"key": F.col("k").isNotNull(), "value": F.col("v") != ""})
    assert [r.k for r in good.collect()] == [1]
    assert sorted((r.v or "", r.failed_checks) for r in bad.collect()) == [("", ["value"]), ("b", ["key"])]


def test_command_line(spark, layout, tmp_path, capsys):
    def call(*argv):
        cli.main(list(map(str, argv)))
        return [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]

    call("parse", layout, "--out", tmp_path / "json", "--biblio", layout / "biblio.json")
    docs = spark.read.json(f"{tmp_path}/json")
    assert {r.doc_id: r.metadata.title for r in docs.collect()} == {"docA": "From the cache", "docB": "Device title more title"}
    for i, r in enumerate(docs.toJSON().collect()):
        (tmp_path / f"x{i}_structured.json").write_text(r)
    cli.main(["check-data", str(tmp_path), "--print-doc-limit", "1"])
    assert [x for x in capsys.readouterr().out.splitlines() if x.startswith("[")] == ["[1] doc_id=docA title=From the cache blocks=16"]
    (summary,) = call("check-data", tmp_path)
    assert summary["documents"] == 2 and summary["blocks"] == 32
    call("ingest", tmp_path, "--store", tmp_path / "store", "--dimension", 16)
    assert call("search-documents", "oled host", "--store", tmp_path / "store", "--top-k", 1, "--dimension", 16)[0]["doc_id"] in ("docA", "docB")
    assert all(r["block_id"].startswith("doc_docB") for r in call("search-blocks", "anode", "--store", tmp_path / "store", "--doc-id", "docB", "--dimension", 16))
    assert len(call("health", "--store", tmp_path / "store")) == len(ingest.TABLES)
    with pytest.raises(SystemExit):
        call("similar", "CCO", "--store", "x", "--threshold", "2")
