"""From structured documents to tables: relational, graph, search, registry.

One job for all documents.  A table is a versioned, bucketed Parquet folder (``writers.Table``);
rows of the documents that are read replace their old rows, and only the buckets of those
documents are written again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import smiles
from quire.operators import chemistry, graph, registry, search
from quire.sources.scratch import written
from quire.sources.writers import Table

#: Tables with their columns, and the columns whose values make a row unique.
TABLES = {
    "document": ("doc_id string, source_file string, title string, publication_number string, abstract string, metadata string, reference_numerals string", ["doc_id"]),
    "block": (
        "doc_id string, block_id string, pos int, block_type string, text string, section string, subsection string, example_id string, claim_no int, depends_on string, "
        "table_id string, figure_id string, char_offset array<int>",
        ["block_id"],
    ),
    "entity": (
        "doc_id string, block_id string, pos long, entity_id string, entity_type string, value_text string, value_num double, unit string, value_pair array<double>, "
        "span array<int>, normalized string, canonical_id string",
        ["entity_id"],
    ),
    "relation": (
        "doc_id string, block_id string, relation_id string, relation_type string, source_entity_id string, target_entity_id string, confidence double, rule string, "
        "distance int, sentence_id string",
        ["relation_id"],
    ),
    "experiment": ("experiment_key string, doc_id string, example_id string, materials_used array<string>, performance array<string>, role_relations array<string>, source_block_ids array<string>", ["experiment_key"]),
    "molecule": ("doc_id string, entity_id string, smiles string", ["entity_id"]),
    "material_canonical": (registry.CANONICAL, ["canonical_id"]),
    "material_alias": (registry.ALIAS, ["alias_key"]),
    "material_doc_usage": (registry.USAGE, ["doc_id", "canonical_id"]),
    "vertex": ("id string, label string, props string, doc_id string", ["id"]),
    "edge": ("src string, dst string, type string, props string, doc_id string", ["src", "dst", "type"]),
    "search_document": ("doc_id string, title string, abstract string, full_text string, entity_types array<string>, relation_types array<string>, embedding array<double>", ["doc_id"]),
    "search_block": ("doc_id string, block_id string, block_type string, text string, embedding array<double>", ["block_id"]),
    "rejected_row": ("doc_id string, table_name string, row_key string, failed_checks array<string>", ["doc_id", "table_name", "row_key"]),
}


def flatten(documents: DataFrame) -> dict[str, DataFrame]:
    """Documents to document, block, entity, relation, experiment and molecule rows."""
    doc = documents.select(
        "doc_id", "source_file", F.nullif("metadata.title", F.lit("")).alias("title"), F.nullif("metadata.publication_number", F.lit("")).alias("publication_number"), "abstract",
        F.to_json("metadata").alias("metadata"), F.coalesce(F.to_json("reference_numerals"), F.lit("null")).alias("reference_numerals"),
    )
    b = documents.select("doc_id", F.posexplode("blocks").alias("pos", "b"))
    block = b.select(
        "doc_id", "b.block_id", "pos", F.col("b.type").alias("block_type"), "b.text", "b.section", "b.subsection", "b.example_id", "b.claim_no",
        F.coalesce(F.to_json("b.depends_on"), F.lit("null")).alias("depends_on"), "b.table_id", "b.figure_id", "b.char_offset",
    )
    e = b.select("doc_id", "b.block_id", F.col("pos").alias("block_pos"), F.posexplode("b.entities").alias("i", "e"))
    entity = e.select(
        "doc_id", "block_id", (F.shiftleft(F.col("block_pos").cast("long"), 32) + F.col("i")).alias("pos"), "e.entity_id", F.col("e.type").alias("entity_type"), F.col("e.value").alias("value_text"), "e.value_num",
        "e.unit", "e.value_pair", "e.span", "e.normalized", "e.canonical_id",
    )
    r = b.select("doc_id", "b.block_id", F.explode("b.relations").alias("r"))
    relation = r.select("doc_id", "block_id", "r.relation_id", F.col("r.type").alias("relation_type"), "r.source_entity_id", "r.target_entity_id", "r.confidence", "r.rule", "r.distance", "r.sentence_id")
    x = documents.select("doc_id", F.explode("experiments").alias("x"))
    experiment = x.select(F.concat_ws("::", F.coalesce("doc_id", F.lit("unknown")), "x.example_id").alias("experiment_key"), "doc_id", "x.example_id", "x.materials_used", F.col("x.performance_relations").alias("performance"), "x.role_relations", "x.source_block_ids")
    molecule = entity.select("doc_id", "entity_id", smiles(F.col("canonical_id"), F.col("value_text"), F.col("normalized")).alias("smiles")).where("smiles is not null")
    return {"document": doc, "block": block, "entity": entity, "relation": relation, "experiment": experiment, "molecule": molecule}


def valid_rows(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all checks, and the others with the names of the checks they fail.

    A bad row never stops the rows beside it.
    """
    failed = F.filter(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items())), lambda x: x.isNotNull())
    marked = df.withColumn("failed_checks", failed)
    return marked.where(F.size("failed_checks") == 0).drop("failed_checks"), marked.where(F.size("failed_checks") > 0)


def checked(flat: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The rows that can be written, and (doc_id, table, key, failed_checks) of the others.

    Ids must not be blank, and a structure must be readable.
    """
    out, bad = {}, []
    for name, df in flat.items():
        keys = TABLES[name][1]
        checks = {f"{k} is blank": F.trim(F.coalesce(F.col(k), F.lit(""))) != "" for k in keys}
        if name == "molecule":
            df = chemistry.with_fingerprint(df)
            checks["structure cannot be read"] = F.col("fp").isNotNull()
        good, failed = valid_rows(df, checks)
        out[name] = good.drop("fp") if name == "molecule" else good
        bad.append(failed.select("doc_id", F.lit(name).alias("table_name"), F.concat_ws("|", *keys).alias("row_key"), "failed_checks"))
    return out, reduce(lambda a, b: a.unionByName(b), bad)


def search_rows(flat: dict[str, DataFrame], embedder: search.Embedder | int = 384) -> dict[str, DataFrame]:
    types = lambda df, c, n: df.groupBy("doc_id").agg(F.sort_array(F.collect_set(c)).alias(n))
    text = search.embedding_text(flat["document"].select("doc_id", "title", "abstract"), flat["block"]).withColumnRenamed("text", "full_text")
    docs = flat["document"].select("doc_id", "title", "abstract").join(text, "doc_id", "left")
    docs = docs.join(types(flat["entity"], "entity_type", "entity_types"), "doc_id", "left").join(types(flat["relation"], "relation_type", "relation_types"), "doc_id", "left")
    none = F.array().cast("array<string>")
    docs = docs.withColumns({c: F.coalesce(c, none) for c in ("entity_types", "relation_types")})
    blocks = flat["block"].where(F.trim(F.coalesce("text", F.lit(""))) != "").select("doc_id", "block_id", "block_type", "text")
    return {"search_document": search.embed(docs, "full_text", embedder), "search_block": search.embed(blocks, "text", embedder)}


def graph_rows(flat: dict[str, DataFrame]) -> dict[str, DataFrame]:
    block = flat["block"].select("doc_id", "block_id", "block_type", "section")
    entity = flat["entity"].select("block_id", "entity_id", "entity_type", "value_text")
    relation = flat["relation"].select("source_entity_id", "target_entity_id", "relation_type", "confidence")
    owner = reduce(lambda a, b: a.unionByName(b), (
        flat["document"].select(F.col("doc_id").alias("id"), "doc_id"), flat["block"].select(F.col("block_id").alias("id"), "doc_id"), flat["entity"].select(F.col("entity_id").alias("id"), "doc_id"),
    )).dropDuplicates(["id"])
    v = graph.vertices(flat["document"].select("doc_id", "title"), block, entity).join(owner, "id")
    e = graph.edges(block.select("doc_id", "block_id"), entity.select("block_id", "entity_id"), relation).join(owner.withColumnRenamed("id", "src"), "src")
    return {"vertex": v.select("id", "label", "props", "doc_id"), "edge": e.select("src", "dst", "type", "props", "doc_id")}


class Store:
    """The tables under one folder, each dealt into buckets by the document, or by the key of the registry."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark = spark
        by = {n: "doc_id" if "doc_id" in [c.split()[0] for c in s.split(", ")] else keys[0] for n, (s, keys) in TABLES.items()}
        self.tables = {n: Table(spark, f"{path.rstrip('/')}/{n}", s, by[n], buckets) for n, (s, _) in TABLES.items()}

    def read(self, name: str) -> DataFrame:
        return self.tables[name].read()

    def _replace(self, name: str, new: DataFrame, touched: DataFrame) -> None:
        cols = [c.split()[0] for c in TABLES[name][0].split(", ")]
        self.tables[name].replace(new.select(*cols), touched)

    def _merge(self, name: str, new: DataFrame, merge) -> None:
        """The registry's rows of the keys in ``new``, merged; other buckets stay."""
        table = self.tables[name]
        buckets = table.buckets_of(new)
        old = table.read(buckets)
        table.write(merge(old, new).select(*old.columns), buckets)

    def ingest(self, documents: DataFrame, embedder: search.Embedder | int = 384) -> None:
        """Writes documents; of several with one id the last by source file counts.  A row that is no good is left out and noted."""
        latest = Window.partitionBy("doc_id").orderBy(F.desc("source_file"))
        documents = written(documents.withColumn("__n", F.row_number().over(latest)).where("__n = 1").drop("__n"), "ingest-documents")
        flat, rejected = checked(flatten(documents))
        touched = written(flat["document"].select("doc_id"), "ingest-touched")
        order = touched.withColumn("seq", F.col("doc_id"))  # documents follow one another in the order of their ids
        keys = registry.mentions(flat["entity"]).select(F.explode("pairs.key").alias("alias_key")).distinct()
        known = self.tables["material_alias"]
        found = registry.align(flat["entity"].join(order, "doc_id"), known.read(known.buckets_of(keys)).select("alias_key", "canonical_id"))
        found = written(found, "ingest-mentions")
        with_seq = lambda df: df.join(order, "doc_id")
        canonical = written(with_seq(registry.canonical_rows(found)), "ingest-canonical")
        alias = written(with_seq(registry.alias_rows(found)), "ingest-alias")
        usage = registry.usage_rows(found)
        aligned = flat["entity"].join(found.select("entity_id", F.col("canonical_id").alias("__c")), "entity_id", "left")
        flat["entity"] = written(aligned.withColumn("canonical_id", F.coalesce("__c", "canonical_id")).drop("__c"), "ingest-entities")
        rows = flat | graph_rows(flat) | search_rows(flat, embedder)
        for name, df in rows.items():
            self._replace(name, df, touched)
        self._replace("material_doc_usage", usage, touched)
        self._replace("rejected_row", rejected, touched)
        self._merge("material_canonical", canonical, registry.merge_canonical)
        self._merge("material_alias", alias, registry.merge_alias)

    def delete(self, documents: DataFrame) -> None:
        """Takes documents out of every table that has their rows."""
        for table in self.tables.values():
            if table.by == "doc_id":
                table.replace(table.read([]), documents.select("doc_id"))

    def vacuum(self) -> dict[str, list[int]]:
        """Deletes what no current version of a table uses."""
        return {name: table.vacuum() for name, table in self.tables.items()}

    def rebuild_registry(self) -> DataFrame:
        """Registry tables again from all entities, in the order of document ids."""
        entity = self.read("entity")
        canonical, alias, usage = registry.rebuild(entity)
        for name, df in (("material_canonical", canonical), ("material_alias", alias), ("material_doc_usage", usage)):
            self.tables[name].write(df.select(*self.read(name).columns))
        return registry.rebuild_summary(entity)

    def drop_orphans(self) -> DataFrame:
        """Ids that nothing names go; returns them."""
        canonical = self.read("material_canonical")
        gone = registry.orphans(canonical, self.read("material_alias"), self.read("material_doc_usage"))
        self.tables["material_canonical"].write(canonical.join(gone.select("canonical_id"), "canonical_id", "left_anti").select(*canonical.columns))
        return gone

    def health(self) -> DataFrame:
        """(table, version, rows, repeated_keys)"""
        rows = []
        for name, (_, keys) in TABLES.items():
            n, repeated = self.read(name).groupBy(*keys).count().agg(F.coalesce(F.sum("count"), F.lit(0)), F.count_if(F.col("count") > 1)).first()
            rows.append((name, self.tables[name].version(), n, repeated))
        return self.spark.createDataFrame(rows, "table string, version int, rows long, repeated_keys long")
