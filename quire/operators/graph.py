"""A property graph of documents, blocks and mentions: vertices, edges, patterns, walks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.sources.scratch import written


def connected(links: DataFrame) -> DataFrame:
    """(u, root) of (u, v) links: the smallest vertex that each vertex reaches; vertices without a link are left out.

    Every vertex takes the smallest root among its neighbours, and then its root's root,
    until nothing changes; each round is a written table.
    """
    both = links.where("u <> v").select("u", "v")
    both = written(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    labels = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("root")), "roots")
    while not labels.isEmpty():
        near = both.join(labels.withColumnsRenamed({"u": "v", "root": "m"}), "v").groupBy("u").agg(F.min("m").alias("m"))
        step = labels.join(near, "u").select("u", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        above = labels.select(F.col("u").alias("root"), F.col("root").alias("top"))
        step = written(step.join(above, "root", "left").select("u", "old", F.least("root", F.coalesce("top", "root")).alias("root")), "roots")
        labels = step.select("u", "root")
        if step.where("old <> root").isEmpty():
            break
    return labels


def vertices(documents: DataFrame, blocks: DataFrame, entities: DataFrame) -> DataFrame:
    """(id, label, props)"""
    def of(df: DataFrame, id_: str, label: str) -> DataFrame:
        return df.select(F.col(id_).alias("id"), F.lit(label).alias("label"), F.to_json(F.struct(*df.columns)).alias("props"))

    return of(documents, "doc_id", "Document").unionByName(of(blocks, "block_id", "Block")).unionByName(of(entities, "entity_id", "Entity"))


def edges(blocks: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(src, dst, type, props); relations need both ends, and both must be entities."""
    def of(df: DataFrame, src: str, dst: str, type_: str) -> DataFrame:
        return df.select(F.col(src).alias("src"), F.col(dst).alias("dst"), F.lit(type_).alias("type"), F.to_json(F.struct(*df.columns)).alias("props"))

    both = relations.where("coalesce(source_entity_id, '') <> '' and coalesce(target_entity_id, '') <> ''")
    ids = entities.select("entity_id").distinct()
    for end in ("source_entity_id", "target_entity_id"):
        both = both.join(ids.withColumnRenamed("entity_id", end), end, "left_semi")
    return of(blocks, "doc_id", "block_id", "HAS_BLOCK").unionByName(of(entities, "block_id", "entity_id", "HAS_ENTITY")).unionByName(of(both, "source_entity_id", "target_entity_id", "REL"))


def pattern(edge: DataFrame, types: list[str], where: Column | None = None) -> DataFrame:
    """Paths along edges of the given types: columns v0, v1, ..."""
    steps = [edge.where(F.col("type") == t).select(F.col("src").alias(f"v{i}"), F.col("dst").alias(f"v{i + 1}")) for i, t in enumerate(types)]
    out = reduce(lambda a, b: a.join(b, [c for c in a.columns if c in b.columns]), steps)
    return out.where(where) if where is not None else out


def reachable(edge: DataFrame, start: DataFrame, hops: int = 3, start_col: str = "id") -> DataFrame:
    """(start, id, hops): vertices within a number of hops, each with its least number."""
    links = edge.select("src", "dst").distinct()
    found = step = start.select(F.col(start_col).alias("start"), F.col(start_col).alias("id")).distinct()
    found = found.withColumn("hops", F.lit(0))
    for k in range(1, hops + 1):
        step = step.join(links, step["id"] == links["src"]).select("start", F.col("dst").alias("id")).distinct()
        found = found.unionByName(step.withColumn("hops", F.lit(k)))
    return found.groupBy("start", "id").agg(F.min("hops").alias("hops"))


def delete_document(vertex: DataFrame, edge: DataFrame, documents: DataFrame, hops: int = 3) -> tuple[DataFrame, DataFrame]:
    """The graph without some documents and all that is within a number of hops of them."""
    gone = reachable(edge, documents, hops, documents.columns[0]).select("id").distinct()
    kept = edge.join(gone.withColumnRenamed("id", "src"), "src", "left_anti").join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti")
    return vertex.join(gone, "id", "left_anti"), kept.select(*edge.columns)


def orphans(vertex: DataFrame, edge: DataFrame) -> DataFrame:
    """Blocks without a document, and entities without a block that stays."""
    incoming = lambda type_, sources: edge.where(F.col("type") == type_).join(sources.select(F.col("id").alias("src")), "src", "left_semi").select(F.col("dst").alias("id"))
    of = lambda label: vertex.where(F.col("label") == label)
    held = incoming("HAS_BLOCK", of("Document"))
    blocks = of("Block").join(held, "id", "left_anti")
    entities = of("Entity").join(incoming("HAS_ENTITY", of("Block").join(held, "id", "left_semi")), "id", "left_anti")
    return blocks.unionByName(entities)
