"""Registry, graph, search, chemistry, ledger, lookups, quality, as-of, streams."""

import datetime
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions import rowwise
from quire.operators import asof, chemistry, graph, ledger, lookups, quality, registry, search
from quire.streaming import incremental

ENTITY = "doc_id string, seq long, pos long, entity_id string, entity_type string, value_text string, normalized string, canonical_id string"


def entities(spark, rows):
    return spark.createDataFrame([(d, s, p, f"e{p}", k, v, n, c) for d, s, p, k, v, n, c in rows], ENTITY)


def test_known_aliases_win(spark):
    df = entities(spark, [("d", 1, 1, "material", "CBP", "cbp", "mat:LOCAL_CBP"), ("d", 1, 2, "material", "NPB", "npb", "mat:NPB"), ("d", 1, 3, "role", "host", None, None), ("d", 1, 4, "material", "Unknown-Mat", None, None), ("d", 1, 5, "material", None, None, "PENDING_MAPPING")])
    found = registry.mentions(df, spark.createDataFrame([("CBP", "mat:GLOBAL_CBP")], "alias_key string, canonical_id string"))
    assert {r.pos: r.canonical_id for r in found.collect()} == {1: "mat:GLOBAL_CBP", 2: "mat:NPB", 4: rowwise.fallback_id("Unknown-Mat"), 5: rowwise.fallback_id("e5")}
    assert {r.canonical_id: r.mention_count for r in registry.usage_rows(found).collect()}["mat:GLOBAL_CBP"] == 1
    assert {r.alias_key: r.canonical_id for r in registry.alias_rows(found).collect()}["CBP"] == "mat:GLOBAL_CBP"
    names = {r.canonical_id: (r.canonical_key, r.preferred_name) for r in registry.canonical_rows(found).collect()}
    assert names["mat:NPB"] == ("NPB", "NPB")


def follow(rows, existing):
    """Document after document in plain Python."""
    known, out, seq, new = dict(existing), {}, None, {}
    for d, s, p, _, v, n, c in sorted(rows, key=lambda r: (r[1], r[2])):
        if s != seq:
            for k, x in new.items():
                known.setdefault(k, x)
            new, seq = {}, s
        texts = list(dict.fromkeys(t.strip() for t in (v, n) if t and t.strip()))
        keys = [k for t in texts if (k := rowwise.alias_key(t))]
        got = next((known[k] for k in keys if k in known), c)
        for k in keys:
            new.setdefault(k, got)
        out[d, p] = got
    return out


def test_align_follows_documents_in_order(spark):
    rng = random.Random(3)
    names = ["a b", "A-B", "c", "C d", "cd", "e"]
    rows = [(f"d{s}", s, p, "material", rng.choice(names), rng.choice(names), f"mat:{rng.randint(1, 5)}") for s in range(1, 9) for p in range(6)]
    existing = {"E": "mat:OLD"}
    got = registry.align(entities(spark, rows), spark.createDataFrame(list(existing.items()), "alias_key string, canonical_id string"))
    assert {(r.doc_id, r.pos): r.canonical_id for r in got.collect()} == follow(rows, existing)


def test_merges_keep_first_and_last(spark):
    old = spark.createDataFrame([("A", "a", "mat:1", "d0", "d0"), ("Z", "z", "mat:9", "d0", "d0")], registry.ALIAS)
    new = spark.createDataFrame([("A", "aa", "mat:2", "d1", 1), ("A", "aaa", "mat:3", "d2", 2), ("B", "b", "mat:4", "d1", 1), ("B", "b", "mat:5", "d2", 2)], "alias_key string, alias_text string, canonical_id string, doc_id string, seq int")
    got = {r.alias_key: tuple(r)[1:] for r in registry.merge_alias(old, new).collect()}
    assert got == {"A": ("aaa", "mat:1", "d0", "d2"), "B": ("b", "mat:4", "d1", "d2"), "Z": ("z", "mat:9", "d0", "d0")}
    old = spark.createDataFrame([("m", "K", "old", "d0", "d0")], registry.CANONICAL)
    new = spark.createDataFrame([("m", "K2", "new", "d1", 1)], "canonical_id string, canonical_key string, preferred_name string, doc_id string, seq int")
    assert tuple(registry.merge_canonical(old, new).first()) == ("m", "K2", "new", "d0", "d1")


def test_rebuild_upsert_and_references(spark):
    df = entities(spark, [("d2", 0, 1, "material", "X1", "x1", "mat:B"), ("d1", 0, 1, "material", "X1", None, "mat:A"), ("d1", 0, 2, "role", "r", None, None)]).drop("seq")
    canonical, alias, usage = registry.rebuild(df)
    assert [r.canonical_id for r in alias.collect()] == ["mat:A"] and usage.count() == 2 and canonical.count() == 1
    assert tuple(registry.rebuild_summary(df).first()) == (2, 2)
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, None, 1)], "k int, v string, s int")
    assert sorted(map(tuple, registry.upsert(old, new, ["k"], "s").collect())) == [(1, "a"), (2, "d"), (3, None)]
    assert sorted(map(tuple, registry.replace_by_key(old, old.where("k = 2").withColumn("v", F.lit("n")), ["k"]).collect())) == [(1, "a"), (2, "n")]
    child = spark.createDataFrame([(1,), (9,), (None,)], "k int")
    assert [r.k for r in registry.missing_references(child, old, {"k": "k"}).collect()] == [9]
    assert registry.orphans(canonical, alias, usage).count() == 0


def test_graph(spark):
    doc = spark.createDataFrame([("d1",), ("d2",)], "doc_id string")
    block = spark.createDataFrame([("d1", "b1"), ("d2", "b2"), ("gone", "b3")], "doc_id string, block_id string")
    ent = spark.createDataFrame([("b1", "e1"), ("b1", "e2"), ("b2", "e3"), ("b3", "e4")], "block_id string, entity_id string")
    rel = spark.createDataFrame([("e1", "e2"), ("e2", "e3"), ("e1", None), ("e1", "nowhere"), ("", "e1")], "source_entity_id string, target_entity_id string")
    v, e = graph.vertices(doc, block, ent), graph.edges(block, ent, rel)
    assert e.where("type = 'REL'").count() == 2 and v.count() == 9
    assert {(r.v0, r.v2) for r in graph.pattern(e, ["HAS_BLOCK", "HAS_ENTITY"], F.col("v0") == "d1").collect()} == {("d1", "e1"), ("d1", "e2")}
    assert {(r.id, r.hops) for r in graph.reachable(e, doc.where("doc_id = 'd1'"), 3, "doc_id").collect()} == {("d1", 0), ("b1", 1), ("e1", 2), ("e2", 2), ("e3", 3)}
    assert {r.id for r in graph.orphans(v, e).collect()} == {"b3", "e4"}
    v2, e2 = graph.delete_document(v, e, doc.where("doc_id = 'd1'"))
    assert {r.id for r in v2.collect()} == {"d2", "b2", "b3", "e4"} and e2.count() == 3


def test_search(spark):
    docs = spark.createDataFrame([(1, "Red fox", "a fox runs", "the red fox runs far"), (2, "Blue", "whale", "whale swims"), (3, "狐狸", "赤い", "ｆｏｘ 狐")], "doc_id int, title string, abstract string, full_text string")
    assert [r.t for r in docs.select(search.tokens(F.col("full_text")).alias("t")).collect()][2] == ["fox", "狐"]
    got = {r.doc_id: r.score for r in search.field_search(docs, "fox", "doc_id", {"title": 1.0, "abstract": 0.5, "full_text": 0.5}).collect()}
    assert set(got) == {1, 3} and got[1] > got[3]
    docs = search.embed(docs, "full_text", 32)
    found = search.search_documents(docs, "red fox", k=2, dim=32).collect()
    assert found[0].doc_id == 1 and found[0].score == pytest.approx(1.0) and len(found) == 2
    blocks = docs.select("doc_id", F.concat(F.lit("b"), "doc_id").alias("block_id"), F.col("full_text").alias("text"), F.lit("claim").alias("block_type"), "embedding")
    assert [r.block_id for r in search.search_blocks(blocks, "whale", doc_id=2, dim=32).collect()] == ["b2"]
    assert search.search_blocks(blocks, "claim", dim=32).where("keyword_score > 0").count() == 3
    index = search.inverted_index(docs, "doc_id", "full_text")
    assert index.where("term = 'fox'").count() == 2


def test_hash_vectors():
    import hashlib

    v = np.zeros(16)
    for w in "a b a":
        if w != " ":
            h = hashlib.blake2b(w.encode(), digest_size=8).digest()
            v[int.from_bytes(h[:4], "little") % 16] += 1 if h[4] % 2 == 0 else -1
    n = np.linalg.norm(v)
    assert search.hash_vector("a b a", 16) == pytest.approx((v / n if n else v).tolist())
    assert search.hash_vector("", 4) == search.hash_vector(None, 4) == [0.0] * 4


def test_embedding_text(spark):
    docs = spark.createDataFrame([("d", "Title", "Abstract text")], "doc_id string, title string, abstract string")
    rows = [("rest", "text", None, None, None, None), ("ex", "example", "example", None, "example_1", None), ("sum", "text", "description", "summary", None, None), ("claim two", "claim", "claims", None, None, 2), ("claim one", "claim", "claims", None, None, 1), ("Title", "text", None, None, None, None), (" ", "text", None, None, None, None)]
    blocks = spark.createDataFrame([("d", i, *r) for i, r in enumerate(rows)], "doc_id string, pos int, text string, block_type string, section string, subsection string, example_id string, claim_no int")
    assert search.embedding_text(docs, blocks).first().text == "Title\nAbstract text\nclaim one\nclaim two\nsum\nex\nrest"
    assert search.embedding_text(docs, blocks, 2).first().text == "Title\nAbstract text\nclaim one\nclaim two"


def test_chemistry(spark):
    assert chemistry.parse("C1CC1")[1].keys() == {(0, 1), (1, 0), (1, 2), (2, 1), (0, 2), (2, 0)}
    assert chemistry.parse("C(") is None and chemistry.parse("C1C") is None and chemistry.fingerprint("X!") is None and chemistry.fingerprint(None) is None
    assert chemistry.fingerprint("CCO") == chemistry.fingerprint("OCC") and chemistry.fingerprint("c1ccccc1O") == chemistry.fingerprint("Oc1ccccc1")
    assert chemistry.contains("CC(=O)Oc1ccccc1", "C=O") and not chemistry.contains("CCO", "C=O") and chemistry.contains("CCO", "C~*") and not chemistry.contains("CCC", "C1CC1")
    df = chemistry.with_fingerprint(spark.createDataFrame([(1, "CCO"), (2, "CCN"), (3, "c1ccccc1"), (4, "bad!"), (5, None)], "id int, smiles string"))
    got = [(r.id, round(r.score, 3)) for r in chemistry.similar(df, "CCO", 5, 0.1).collect()]
    assert got[0] == (1, 1.0) and [i for i, _ in got][:2] == [1, 2]
    assert [r.id for r in chemistry.with_substructure(df, "CN").collect()] == [2]


def test_ledger(spark):
    led = spark.createDataFrame([("a", "done", "v1", None), ("b", "failed", "v1", "Table error"), ("c", "done_without_tables", "v0", None)], "file string, status string, parser_version string, error_msg string")
    files = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "file string")
    left = lambda v: sorted(r.file for r in ledger.pending(files, led, v).collect())
    assert left(None) == ["b", "d"] and left("v1") == ["b", "c", "d"]
    assert [r.file for r in ledger.retry(led).collect()] == ["b"]
    new = spark.createDataFrame([("b", "done", "v2", "e" * 600)], led.schema)
    assert {r.file: (r.status, len(r.error_msg or "")) for r in ledger.mark(led, new).collect()}["b"] == ("done", 500)
    parts = ledger.page_parts(spark.createDataFrame([("x", 0), ("y", 60), ("z", 121)], "doc_id string, pages int"))
    assert sorted((r.doc_id, r.part_no, r.first_page, r.last_page) for r in parts.collect()) == [("x", 1, 0, -1), ("y", 1, 0, 59), ("z", 1, 0, 59), ("z", 2, 60, 119), ("z", 3, 120, 120)]


def test_merging_parts(spark):
    items = spark.createDataFrame([("d", 1, 0, 5, "a.png", True), ("d", 2, 0, 1, None, True), ("d", 2, 1, 2, "", False), ("e", 1, 0, 0, "b", True)], "doc_id string, part_no int, idx int, page_idx int, img_path string, ok boolean")
    parts = items.select("doc_id", "part_no").distinct()
    assert [tuple(r) for r in ledger.merge_items(items, parts).select("doc_id", "idx").collect()] == [("e", 0)]
    got = ledger.merge_items(items, parts, partial=True).orderBy("doc_id", "idx").collect()
    assert [(r.doc_id, r.idx, r.page_idx, r.img_path) for r in got] == [("d", 0, 5, "part001/a.png"), ("e", 0, 0, "part001/b")]
    texts = spark.createDataFrame([("d", "part10", "c "), ("d", "part2", "b"), ("d", "part1", "a")], "doc_id string, name string, text string")
    assert ledger.merge_texts(texts).first().text == "a\n\nb\n\nc"


def test_lookups(spark):
    cache = spark.createDataFrame([("WO2025123456A1", "t1"), ("wo-2025/123456-a1x", "t2"), ("low", "t3")], "key string, value string")
    rows = spark.createDataFrame([("wo-2025/123456-a1",), ("LOW",), ("none",), ("WO 2025 123456 A1 X",)], "doc_id string")
    assert {r.doc_id: r.metadata for r in lookups.biblio(rows, cache).collect()} == {"wo-2025/123456-a1": "t1", "LOW": "t3", "none": None, "WO 2025 123456 A1 X": "t2"}
    files = spark.createDataFrame([("WO2024000001A1",), ("WO2024000002A1",), ("CH1",), ("cn5",), ("QQ",), ("JP1",)], "stem string")
    cached = spark.createDataFrame([("WO2024000001", "French")], "key string, value string")
    got = {r.stem: (r.lang, r.lang_source) for r in lookups.route_language(files, cached, ["en", "latin", "ch"]).collect()}
    assert got == {"WO2024000001A1": ("latin", "wipo"), "WO2024000002A1": ("en", "prefix"), "CH1": ("ch", "prefix"), "cn5": ("ch", "prefix"), "QQ": ("en", "fallback"), "JP1": ("en", "fallback")}


def test_quality(spark, tmp_path):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    df.write.parquet(f"{tmp_path}/t")
    got = {r.table: tuple(r)[1:] for r in quality.health(spark, {"t": f"{tmp_path}/t", "u": f"{tmp_path}/u"}, {}).collect()}
    assert got == {"t": (True, 3, 1), "u": (False, 0, 0)}


def test_last_before(spark):
    left = spark.createDataFrame([("a", 5, "x"), ("a", 1, "y"), ("b", 9, "z")], "k string, t int, n string")
    right = spark.createDataFrame([("a", 2, 20), ("a", 5, 50), ("b", 10, 99), ("a", 4, None)], "k string, t int, v int")
    assert {r.n: r.v for r in asof.last_before(left, right, ["k"], "t", ["v"]).collect()} == {"x": 50, "y": None, "z": None}


def test_files_are_read_once(spark, tmp_path):
    src, out = tmp_path / "in", []
    src.mkdir()
    handle = lambda df, _: out.append(sorted((r.doc_id, r.idx) for r in df.collect()))
    write = lambda n: (src / f"{n}_content_list.json").write_text(json.dumps([{"type": "text", "text": n}]))
    for new in (["a", "b"], [], ["c"]):
        for n in new:
            write(n)
        incremental.run_once(incremental.new_items(spark, str(src)), f"{tmp_path}/cp", handle)
    assert sum(out, []) == [("a", 0), ("b", 0), ("c", 0)]


def test_stream_windows_drop_late_events(spark, tmp_path):
    t = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    rows = [(t(1), 1, "view", 1.0), (t(2), 1, "view", 2.0), (t(30), 1, "view", 4.0)]
    spark.createDataFrame(rows, "ts timestamp, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/e")
    stream = spark.readStream.schema("ts timestamp, user_id long, event_type string, value double").parquet(f"{tmp_path}/e")
    q = incremental.sessions(stream, "5 minutes", "1 minute").writeStream.format("memory").queryName("s").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination()
    assert [(r.events,) for r in spark.table("s").collect()] == [(2,)]
    assert incremental.tumbling(spark.read.parquet(f"{tmp_path}/e"), "10 minutes").orderBy("window_start").first().total == 3.0


def test_components_of_aliases(spark):
    links = [("b", "a"), ("c", "b"), ("d", "c"), ("x", "y"), ("y", "z"), ("z", "x"), ("q", "q"), ("n", "m")]
    got = dict(map(tuple, graph.connected(spark.createDataFrame(links, "u string, v string")).collect()))
    assert got == {**dict.fromkeys("abcd", "a"), **dict.fromkeys("xyz", "x"), "n": "m", "m": "m"}
    assert graph.connected(spark.createDataFrame([], "u string, v string")).collect() == []


class Constant(search.Embedder):
    def __init__(self, dimension):
        self.dimension = dimension

    def embed(self, texts):
        return [[float(len(t or ""))] * self.dimension for t in texts]


def test_embedders(spark, monkeypatch):
    monkeypatch.setattr(search, "EMBEDDERS", dict(search.EMBEDDERS))
    assert search.embedder("auto", 8).embed(["a b", None]) == [search.hash_vector("a b", 8), [0.0] * 8]
    assert isinstance(search.embedder(" Local "), search.HashEmbedder)
    with pytest.raises(RuntimeError):
        search.embedder("openai")
    with pytest.raises(ValueError):
        search.embedder("other")
    with pytest.raises(ValueError):
        search.HashEmbedder(0)
    search.register_embedder("openai", Constant)
    assert search.embedder("auto", 2).embed(["abc"]) == [[3.0, 3.0]]
    df = spark.createDataFrame([("abc",), (None,)], "t string")
    assert [r.embedding for r in search.embed(df, "t", search.HashEmbedder(4)).collect()] == [search.hash_vector("abc", 4), [0.0] * 4]


def test_logs_are_cut_by_bytes(spark):
    df = spark.createDataFrame([(1, "é" * 400), (2, None), (3, "x" * 499)], "i int, log string")
    kept, tail = ledger.failure_log(F.col("log"))
    got = {r.i: (r.kept, r.tail) for r in df.select("i", kept.alias("kept"), tail.alias("tail")).collect()}
    assert got == {1: ("é" * 400, "é" * 250), 2: ("", ""), 3: ("x" * 499, "x" * 499)}
    big = df.limit(1).select(F.repeat(F.lit("aé"), 1 << 20).alias("log"))
    kept, _ = ledger.failure_log(F.col("log"))
    (r,) = big.select(F.octet_length(kept).alias("n"), F.right(kept, F.lit(2)).alias("end")).collect()
    assert (2 << 20) - 2 <= r.n <= 2 << 20 and r.end in ("aé", "éa")


def test_terms_are_counted_once(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, None), (4, "d")], "k int, t string")
    got = {r.k: r.score for r in search.bm25(docs, "a c a", "k", "t").collect()}
    n, mean = 4, (3 + 2 + 0 + 1) / 4
    idf = np.log(1 + (n - 1 + 0.5) / 1.5)
    want = {k: idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean)) for k, tf, size in ((1, 2, 3), (2, 1, 2))}
    assert got == pytest.approx(want)
    assert search.bm25(docs, "  ", "k", "t").collect() == []


def test_scratch_folder_must_be_shared_off_local_mode(spark):
    from types import SimpleNamespace

    from quire.sources import scratch

    def session(master, named):
        conf = SimpleNamespace(get=lambda key: named)
        return SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, master=master, applicationId="app"))

    assert scratch.folder(session("local-cluster[2,1,512]", "s3://x/tmp/")) == "s3://x/tmp/quire-app"
    assert scratch.folder(session("local[4]", None)).startswith("file:")
    for master in ("yarn", "local-cluster[2,1,512]", "spark://h:7077"):
        with pytest.raises(RuntimeError):
            scratch.folder(session(master, None))
