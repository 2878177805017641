"""Command line: parse layout files, ingest documents, search, maintain.

    python -m quire.cli parse LAYOUT... --out DIR [--biblio FILE]
    python -m quire.cli ingest DOCUMENTS... --store DIR
    python -m quire.cli search-documents QUERY --store DIR [--top-k N]
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.operators import chemistry, lookups, quality, search
from quire.plans import ingest, parse
from quire.sources import readers, scratch, writers


def positive(text: str) -> int:
    n = int(text)
    if n <= 0:
        raise argparse.ArgumentTypeError(f"{text} is not positive")
    return n


def share(text: str) -> float:
    x = float(text)
    if not 0 <= x <= 1:
        raise argparse.ArgumentTypeError(f"{text} is not from 0 to 1")
    return x


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quire")
    sub = p.add_subparsers(dest="action", required=True)
    add = lambda name, *paths: [c := sub.add_parser(name), [c.add_argument(x, **k) for x, k in paths]][0]
    many, store = {"nargs": "+"}, {"required": True}
    c = add("parse", ("paths", many), ("--out", store), ("--biblio", {}), ("--method", {}), ("--keep-raw", {"action": "store_true"}), ("--pretty", {"action": "store_true"}))
    shown = ("--print-doc-limit", {"type": int, "default": 5})
    c = add("check-data", ("paths", many), ("--strict", {"action": "store_true"}), shown)
    c = add("ingest", ("paths", many), ("--store", store), ("--strict", {"action": "store_true"}), ("--dimension", {"type": positive, "default": 384}), ("--embedder", {"default": "auto"}), shown)
    for name in ("search-documents", "search-blocks"):
        c = add(name, ("query", {}), ("--store", store), ("--top-k", {"type": positive, "default": 10}), ("--keyword-boost", {"type": float, "default": 0.5}), ("--vector-boost", {"type": float, "default": 0.5}), ("--dimension", {"type": positive, "default": 384}))
    c.add_argument("--doc-id")
    c = add("similar", ("smiles", {}), ("--store", store), ("--top-k", {"type": positive, "default": 10}), ("--threshold", {"type": share, "default": 0.0}))
    c = add("substructure", ("pattern", {}), ("--store", store), ("--top-k", {"type": positive, "default": 10}))
    for name in ("health", "rebuild-registry", "drop-orphans", "vacuum"):
        add(name, ("--store", store))
    return p


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    if args.action == "parse":
        items = readers.layout_items(spark, args.paths, args.method)
        biblio = None
        if args.biblio:
            record = readers.lookup_cache(spark, args.biblio, f"struct<metadata:{schemas.METADATA},{schemas.METADATA[7:-1]}>")
            flat = F.coalesce("value.metadata", F.struct(*(F.col(f"value.{f.split(':')[0]}") for f in _fields(schemas.METADATA))).cast(schemas.METADATA))
            biblio = lookups.biblio(items.select("doc_id").distinct(), record.select("key", flat.alias("value"))).where("metadata is not null")
        found = parse.parse(items, readers.page_sizes(spark, args.paths, args.method), biblio, args.keep_raw)
        writers.structured_json(found, args.out, args.pretty)
        return None
    if args.action in ("check-data", "ingest"):
        documents = readers.structured_documents(spark, args.paths, args.strict)
        first = documents.select("doc_id", "metadata.title", F.size("blocks").alias("blocks")).orderBy("doc_id").limit(max(0, args.print_doc_limit))
        for n, row in enumerate(first.collect(), 1):
            print(f"[{n}] doc_id={row.doc_id} title={row.title} blocks={row.blocks}")
        if args.action == "check-data":
            return quality.corpus_summary(documents)
        ingest.Store(spark, args.store).ingest(documents, search.embedder(args.embedder, args.dimension))
        return None
    store = ingest.Store(spark, args.store)
    if args.action == "search-documents":
        return search.search_documents(store.read("search_document"), args.query, "doc_id", args.top_k, args.keyword_boost, args.vector_boost, args.dimension)
    if args.action == "search-blocks":
        return search.search_blocks(store.read("search_block"), args.query, args.doc_id, "block_id", args.top_k, args.keyword_boost, args.vector_boost, args.dimension)
    if args.action == "similar":
        found = chemistry.with_fingerprint(store.read("molecule"))
        return chemistry.similar(found, args.smiles, args.top_k, args.threshold, "entity_id")
    if args.action == "substructure":
        return chemistry.with_substructure(store.read("molecule"), args.pattern, args.top_k, "entity_id")
    if args.action == "vacuum":
        return spark.createDataFrame(list(store.vacuum().items()), "table string, versions array<int>")
    return {"health": store.health, "rebuild-registry": store.rebuild_registry, "drop-orphans": store.drop_orphans}[args.action]()


def _fields(struct: str) -> list[str]:
    return [f for f in struct.removeprefix("struct<").removesuffix(">").split(",") if ":" in f]


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName("quire").getOrCreate()
    found = run(spark, args)
    for row in found.toLocalIterator() if found is not None else ():
        print(json.dumps(row.asDict(recursive=True), ensure_ascii=False, default=str))
    scratch.clear(spark)


if __name__ == "__main__":
    main()
