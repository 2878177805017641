"""From layout items to structured documents.

Items are typed, located and read for mentions with Column expressions and windows by
document.  One grouped Python step per document follows the order-dependent aliases of
materials and reads its tables.  Everything is parallel by document.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from quire import schemas
from quire.functions import mentions, rowwise
from quire.functions import vocabulary as V
from quire.functions.text import absolute_box, figure_no, safe_stem, table_no
from quire.operators import relations, sections, tables
from quire.sources.scratch import written


def blocks(items: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """One row per block, captions included, in the order of ``paragraph_index``.

    ``items``: doc_id, source_file, idx and the fields of a layout item.  ``pages``:
    doc_id, page_idx, width, height, each page once.
    """
    raw = F.to_json(F.struct(*(c for c in items.columns if c not in ("doc_id", "source_file", "idx"))))
    df = items.withColumn("raw", raw).withColumn("is_text", F.col("type") == "text").withColumn("text", F.trim(F.coalesce("text", F.lit(""))))
    df = sections.char_offsets(sections.classify(df))
    page = F.coalesce((F.col("page_idx") + 1).cast("string"), F.lit("None"))
    df = df.withColumn("block_id", F.concat(safe_stem(F.col("doc_id")), F.lit("_p"), page, F.lit("_b"), F.col("idx")))
    if pages is not None:
        df = df.join(pages, ["doc_id", "page_idx"], "left")
    else:
        df = df.withColumns({"width": F.lit(None).cast("int"), "height": F.lit(None).cast("int")})
    df = df.withColumn("bbox_abs", absolute_box(F.col("bbox"), F.col("width"), F.col("height")))
    table, image = F.col("type") == "table", F.col("type") == "image"
    df = df.withColumn("table_id", F.when(table, F.concat("block_id", F.lit("_table")))).withColumn("figure_id", F.when(image, F.concat("block_id", F.lit("_fig"))))
    df = df.withColumn("html", F.when(table, F.coalesce(F.nullif("table_body", F.lit("")), F.nullif("html", F.lit("")))))
    captions = F.coalesce(F.when(table, F.col("table_caption")).when(image, F.col("image_caption")), F.array().cast("array<string>"))
    df = df.withColumn("caption", captions)
    kind = F.when(F.col("is_text"), F.col("block_type")).when(image, F.lit("figure")).otherwise(F.coalesce("type", F.lit("unknown")))
    main = df.withColumn("block_type", kind).withColumn("cap", F.lit(0)).withColumn("text", F.when(F.col("is_text"), F.col("text")))
    main = main.withColumn("table_no", F.lit(None).cast("string"))
    first_no = F.try_element_at(F.filter(F.transform("caption", figure_no), lambda x: x.isNotNull()), F.lit(1))
    main = main.withColumn("figure_no", F.when(image, first_no))
    below = df.select("*", F.posexplode("caption").alias("__p", "__c")).withColumn("cap", F.col("__p") + 1).withColumn("text", F.col("__c"))
    below = below.withColumn("block_type", F.when(table, F.lit("table_caption")).otherwise(F.lit("figure_caption")))
    below = below.withColumn("block_id", F.concat(F.coalesce("table_id", "figure_id"), F.lit("_cap"), F.lpad(F.col("cap").cast("string"), 2, "0")))
    below = below.withColumn("table_no", F.when(table, table_no(F.col("text")))).withColumn("figure_no", F.when(image, figure_no(F.col("text"))))
    empty = {"raw": "string", "table_id": "string", "figure_id": "string", "html": "string", "char_start": "long", "char_end": "long"}
    below = below.drop("__p", "__c").withColumns({c: F.lit(None).cast(t) for c, t in empty.items()})
    out = main.unionByName(below)
    order = Window.partitionBy("doc_id").orderBy("idx", "cap")
    out = out.withColumn("paragraph_index", F.row_number().over(order) - 1)
    read = F.col("text").isNotNull()
    out = out.withColumn("mentions", mentions.entities(F.when(read, F.col("text"))))
    return relations.bind(out, "text", "mentions").withColumnRenamed("relations", "bindings")


#: What reading adds to a block; a part of a table is a row of its own.
_ADDED = {"part": pa.int32(), "ids": pa.list_(pa.string()), "table_entities": pa.string(), "table_relations": pa.string(), "structure": pa.string(), "units": pa.list_(pa.string())}
#: What a part of a table shares with its table; its other columns are null, as a table may be long and have many parts.
_SHARED = ("doc_id", "block_id", "paragraph_index", "example_id")
_DDL = {"part": "int", "ids": "array<string>", "table_entities": "string", "table_relations": "string", "structure": "string", "units": "array<string>"}


def _follow_names(structure: bool):
    """Rows sorted by document and ``paragraph_index`` with the ids of each block's materials, and after a table its mentions and relations in parts.

    A task holds the names of a document and one of its tables.
    """

    def extended(b: pa.RecordBatch, **added) -> pa.RecordBatch:
        more = [pa.array(added[c], t) if c in added else pa.nulls(b.num_rows, t) for c, t in _ADDED.items()]
        kept = [i for i, c in enumerate(b.schema.names) if c not in ("html", "materials")]
        return pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), *more], [*(b.schema.names[i] for i in kept), *_ADDED])

    def run(batches):
        doc, names = None, rowwise.Aliases()
        for b in batches:
            ids, structures, units = [], [None] * b.num_rows, [None] * b.num_rows
            for i, (doc_id, kind, table_id, html, text, materials) in enumerate(zip(*(b.column(c).to_pylist() for c in ("doc_id", "block_type", "table_id", "html", "text", "materials")))):
                if doc_id != doc:
                    doc, names = doc_id, rowwise.Aliases()
                ids.append([])
                if html is not None or kind == "table":
                    rows = tables.parse_rows(html or "")
                    own = pa.RecordBatch.from_arrays([b.column(k).slice(i, 1) if f.name in _SHARED else pa.nulls(1, f.type) for k, f in enumerate(b.schema)], schema=b.schema)
                    for n, entities, relations in tables.Reader(rows, table_id, names).parts():
                        yield extended(own, part=[n], table_entities=[json.dumps(entities)], table_relations=[json.dumps(relations)])
                    if structure:
                        structures[i], units[i] = json.dumps(rows, ensure_ascii=False), tables.units(rows)
                elif text is not None:
                    names.read(text)
                    ids[-1] = [names.id_of(v) for v in materials]
            yield extended(b, ids=ids, structure=structures, units=units)

    return run


_CELL_ENTITY = (
    "array<struct<entity_id:string,type:string,value:string,value_num:double,unit:string,value_pair:array<double>,"
    "start:int,end:int,normalized:string,canonical_id:string>>"
)


def named_blocks(block: DataFrame, structure: bool = True) -> DataFrame:
    """Adds entities (with ids, spans and canonical ids), relations and, for tables and if asked for, structure and units.

    Besides its own row, whose ``part`` is null, a table has rows with a number in ``part``, whose entities and relations in the order of the numbers are the table's.
    """
    of_materials = F.transform(F.filter("mentions", lambda e: e["type"] == "material"), lambda e: e["value"])
    picked = block.withColumn("materials", of_materials)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in block.schema if f.name != "html")
    added = ", ".join(f"{c} {t}" for c, t in _DDL.items())
    df = picked.repartition("doc_id").sortWithinPartitions("doc_id", "paragraph_index").mapInArrow(_follow_names(structure), f"{kept}, {added}")
    entity_id = lambda i: F.concat(F.col("block_id"), F.lit("_e"), F.lpad((i + 1).cast("string"), 3, "0"))
    # The k-th material of a block has the k-th id.
    nth = lambda e: F.size(F.filter(F.col("mentions"), lambda x: (x["type"] == "material") & (x["i"] < e["i"])))
    in_table = F.transform(
        F.from_json("table_entities", _CELL_ENTITY),
        lambda e: F.struct(
            e["entity_id"].alias("entity_id"), e["type"].alias("type"), e["value"].alias("value"), e["value_num"].alias("value_num"), e["unit"].alias("unit"),
            e["value_pair"].alias("value_pair"), F.array(e["start"], e["end"]).alias("span"), e["normalized"].alias("normalized"), e["canonical_id"].alias("canonical_id"),
        ),
    )
    own = F.transform(
        "mentions",
        lambda e: F.struct(
            entity_id(e["i"]).alias("entity_id"), e["type"].alias("type"), e["value"].alias("value"), e["value_num"].alias("value_num"), e["unit"].alias("unit"),
            e["value_pair"].alias("value_pair"), F.array(e["start"], e["end"]).alias("span"), e["normalized"].alias("normalized"),
            F.when(e["type"] == "material", F.get(F.col("ids"), nth(e))).alias("canonical_id"),
        ),
    )
    bound = F.transform(
        "bindings",
        lambda r, i: F.struct(
            F.concat("block_id", F.lit("_r"), F.lpad((i + 1).cast("string"), 3, "0")).alias("relation_id"), r["type"].alias("type"),
            entity_id(r["source"]).alias("source_entity_id"), entity_id(r["target"]).alias("target_entity_id"), r["confidence"].alias("confidence"),
            r["rule"].alias("rule"), r["distance"].alias("distance"),
            F.concat("block_id", F.lit("_s"), F.lpad(r["sentence"].cast("string"), 3, "0")).alias("sentence_id"),
        ),
    )
    from_table = F.from_json("table_relations", f"array<{schemas.RELATION}>")
    whole = F.col("part").isNull()
    df = df.withColumn("entities", F.when(whole, own.cast(f"array<{schemas.ENTITY}>")).otherwise(in_table.cast(f"array<{schemas.ENTITY}>")))
    df = df.withColumn("relations", F.when(whole, bound.cast(f"array<{schemas.RELATION}>")).otherwise(from_table))
    return df.drop("mentions", "bindings", "ids", "table_entities", "table_relations", *([] if structure else ["structure", "units"]))


def experiments(block: DataFrame) -> DataFrame:
    """Per (doc, example): materials and blocks in order, relations by type; blocks without a column ``part`` are whole."""
    df = block if "part" in block.columns else block.withColumn("part", F.lit(None).cast("int"))
    df = df.where("example_id is not null")
    order = F.struct("paragraph_index", "part")
    ids = lambda items, keep, name: F.transform(F.filter(items, keep), lambda x: x[name])
    ordered = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), c.alias("v")))), lambda x: x["v"]))
    found = df.groupBy("doc_id", "example_id").agg(
        ordered(ids("entities", lambda e: e["type"] == "material", "entity_id")).alias("materials_used"),
        ordered(ids("relations", lambda r: r["type"] == "has_value", "relation_id")).alias("performance_relations"),
        ordered(ids("relations", lambda r: r["type"] == "has_role", "relation_id")).alias("role_relations"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("part").isNull(), F.struct(order.alias("o"), F.col("block_id").alias("v"))))), lambda x: x["v"]).alias("source_block_ids"),
        F.min("paragraph_index").alias("first"),
    )
    return found.withColumn("performance", F.col("performance_relations"))


def documents(block: DataFrame, biblio: DataFrame | None = None, keep_raw: bool = False, tasks: int | None = None) -> DataFrame:
    """Structured documents from named blocks; ``biblio`` is (doc_id, metadata) of cached records, which win.

    With ``keep_raw`` a block also has the layout item that it was made from, as JSON.  With ``tasks`` the
    blocks are dealt out over so many tasks before a document's are put together, since a task
    collects all that it reads and a few files may hold many long documents.
    """
    whole = block.where("part is null")
    described = (F.col("block_type") == "description") | F.col("subsection").isin(*V.SUBSECTIONS)
    numerals = whole.where(F.col("is_text") & described).select("doc_id", "idx", F.posexplode(mentions.reference_numerals(F.col("text"))).alias("pos", "n"))
    numerals = sections.numeral_labels(numerals.select("doc_id", "idx", "pos", "n.number", "n.label"))
    front = whole.where((F.col("block_type") == "text") & (F.col("page_idx") == 0)).select("doc_id", "idx", F.posexplode(F.split("text", r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85  ]")).alias("pos", "line"))
    front = front.select("doc_id", F.struct("idx", "pos").alias("line_no"), "line")
    inid = sections.inid_metadata(front)
    null = lambda t: F.lit(None).cast(t)
    inid = inid.select("doc_id", F.struct(
        "publication_number", null("string").alias("publication_date"), "application_number", "application_date", "priority", "title", "applicants",
        "inventors", null("array<string>").alias("ipc"), null("array<string>").alias("cpc"), F.lit("inid").alias("source"),
    ).alias("__inid"))
    as_struct = F.struct(
        "block_id", F.col("block_type").alias("type"), "text", F.when(F.col("char_start").isNotNull(), F.array(F.col("char_start").cast("int"), F.col("char_end").cast("int"))).alias("char_offset"),
        "section", "subsection", "example_id", "depends_on", "claim_no", "table_id", "table_no", "figure_id", "figure_no", *(["raw"] if keep_raw else []),
    )
    run = experiments(block)
    run = run.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("first", F.struct("example_id", "materials_used", "performance", "performance_relations", "role_relations", "source_block_ids").alias("e")))).alias("r"))
    run = run.select("doc_id", F.transform("r", lambda x: x["e"]).alias("experiments"))
    # What there is besides the blocks comes to a document's row in the same step: a join would sort and move the whole documents.
    of_block = F.struct(F.col("paragraph_index").alias("o"), as_struct.alias("b"), "entities", "relations")
    of_table = F.struct(F.col("paragraph_index").alias("o"), "part", "entities", "relations")
    dealt = block.repartition(tasks, "doc_id", "paragraph_index", "part") if tasks else block
    parts = dealt.select("doc_id", "source_file", F.when(F.col("part").isNull(), of_block).alias("x"), F.when(F.col("part").isNotNull(), of_table).alias("t"))
    for side in (numerals, inid, run):
        parts = parts.unionByName(side, allowMissingColumns=True)
    # Sorted for each table anew: an array has no name to be shared by within an aggregate, and a document has few tables.
    of_tables = F.array_sort(F.collect_list("t"), lambda a, b: a["part"] - b["part"])
    read = lambda x, c: F.when(x["b"]["type"] == "table", F.flatten(F.transform(F.filter(of_tables, lambda t: t["o"] == x["o"]), lambda t: t[c]))).otherwise(x[c])
    names = [f.name for f in block.select(as_struct.alias("b")).schema["b"].dataType]
    order = [n for n in names if n != "raw"] + ["entities", "relations"] + ["raw"] * keep_raw
    listed = F.transform(
        F.array_sort(F.collect_list("x"), lambda a, b: a["o"] - b["o"]),
        lambda x: F.struct(*((read(x, n) if n in ("entities", "relations") else x["b"][n]).alias(n) for n in order)),
    )
    # From rows of its own and without nullif: then whoever names the blocks once, to count or to cut them, does so in this step, without a row of the whole document.
    abstract = F.array_sort(F.collect_list(F.when((F.col("x.b.type") == "abstract") & (F.col("x.b.text") != ""), F.struct("x.o", "x.b.text"))))
    doc = parts.groupBy("doc_id").agg(
        F.first("source_file", ignorenulls=True).alias("source_file"), listed.alias("blocks"),
        F.when(F.size(abstract) > 0, F.array_join(F.transform(abstract, lambda b: b["text"]), "\n")).alias("abstract"),
        *(F.first(c, ignorenulls=True).alias(c) for c in ("reference_numerals", "__inid", "experiments")),
    )
    cached = null(schemas.METADATA)
    if biblio is not None:
        doc, cached = doc.join(biblio.withColumnRenamed("metadata", "__biblio"), "doc_id", "left"), F.col("__biblio")
    return doc.withColumn("metadata", F.coalesce(cached, F.col("__inid").cast(schemas.METADATA))).select(
        "doc_id", "source_file", "abstract", "metadata", "blocks", "reference_numerals", F.coalesce("experiments", F.array().cast(f"array<{schemas.EXPERIMENT}>")).alias("experiments")
    )


#: Pages are closed by their size after every row, as a row may hold a part of a table, and are compressed on the heap.
_SMALL_PAGES = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 100, "compression": "zstd"}


#: Blocks, mentions and relations that a task puts together at most, some 300 bytes each; a block or a part of a table is not divided.
TOGETHER = 200_000

#: What the blocks of a document don't have: fields of their layout items.
_LAYOUT = ("type", "bbox", "bbox_abs", "width", "height", "table_body", "table_caption", "image_caption", "caption", "img_path")


def parse(items: DataFrame, pages: DataFrame | None = None, biblio: DataFrame | None = None, keep_raw: bool = False) -> DataFrame:
    # Batches of whole blocks fill memory outside the heap; a session's own bound is kept.
    key, spark = "spark.sql.execution.arrow.maxRecordsPerBatch", items.sparkSession
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, "512")
    # Written once, because a document's row is made from four readings of its blocks.
    named = named_blocks(blocks(items, pages).drop(*_LAYOUT, *([] if keep_raw else ["raw"])), structure=False)
    seen = Observation()
    named = named.observe(seen, F.sum(1 + F.coalesce(F.size("entities"), F.lit(0)) + F.coalesce(F.size("relations"), F.lit(0))).alias("records"))
    named = written(named, "named-blocks", **_SMALL_PAGES)
    return documents(named, biblio, keep_raw, -(-(seen.get["records"] or 0) // TOGETHER) or 1)
