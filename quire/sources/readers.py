"""Readers: layout items, page sizes, structured documents, lookup caches, file lists.

All go through Spark's readers, so paths may be in any store that Spark knows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas


def _files(spark: SparkSession, paths: list[str], pattern: str) -> DataFrame:
    """(path, text) of whole files; a file that several paths reach counts once."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(paths, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).dropDuplicates(["path"])


def stem(path: Column, suffix: str) -> Column:
    """File name without its folder and suffix, URL escapes resolved."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(F.regexp_extract(path, "([^/]+)$", 1), r"\+", "%2B")), suffix.replace(".", r"\.") + "$", "")


def _preferred(method: str | None) -> Column:
    """Order of files of one stem: those under the folder of the stem and the parse method first, then by path."""
    if not method:
        return F.struct(F.lit(False).alias("other"), F.col("path"))
    inside = F.contains(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), F.concat(F.lit("/"), "doc_id", F.lit(f"/{method}/")))
    return F.struct((~F.coalesce(inside, F.lit(False))).alias("other"), F.col("path"))


def layout_items(spark: SparkSession, paths: list[str], method: str | None = None) -> DataFrame:
    """(doc_id, source_file, idx, item fields); a file that is no array of objects has no items.

    Of several files with one stem, the first by path counts; with a parse ``method`` one in
    the folder of that name below the document's, if there is any.
    """
    df = _files(spark, paths, "*_content_list.json").withColumn("doc_id", stem(F.col("path"), "_content_list.json"))
    first = _preferred(method)
    df = df.groupBy("doc_id").agg(F.min_by("text", first).alias("text"), F.min_by("path", first).alias("source_file"))
    items = F.from_json("text", f"array<{schemas.ITEM}>", {"mode": "PERMISSIVE"})
    return df.select("doc_id", "source_file", F.posexplode(items).alias("idx", "item")).where("item is not null").select("doc_id", "source_file", "idx", "item.*")


def page_sizes(spark: SparkSession, paths: list[str], method: str | None = None) -> DataFrame:
    """(doc_id, page_idx, width, height); pages without two sizes are left out, the last of equal ones counts."""
    df = _files(spark, paths, "*_middle.json").withColumn("doc_id", stem(F.col("path"), "_middle.json"))
    df = df.groupBy("doc_id").agg(F.min_by("text", _preferred(method)).alias("text"))
    pages = df.select("doc_id", F.posexplode(F.from_json("text", schemas.PAGES)["pdf_info"]).alias("n", "p"))
    pages = pages.select("doc_id", "n", F.coalesce("p.page_idx", F.lit(0)).alias("page_idx"), F.col("p.page_size").alias("s")).where("size(s) = 2")
    size = F.struct(F.col("s")[0].cast("int").alias("width"), F.col("s")[1].cast("int").alias("height"))
    return pages.groupBy("doc_id", "page_idx").agg(F.max_by(size, "n").alias("s")).select("doc_id", "page_idx", "s.width", "s.height")


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def coerce(df: DataFrame) -> DataFrame:
    """Documents with defaults for what is missing: ids "", types ``unknown``, null members dropped."""
    some = lambda arr, f: F.transform(F.filter(F.coalesce(arr, F.array()), lambda x: x.isNotNull()), f)
    entity = lambda e: e.withField("entity_id", _text(e["entity_id"])).withField("type", F.coalesce(F.nullif(e["type"], F.lit("")), F.lit("unknown")))
    relation = lambda r: r.withField("relation_id", _text(r["relation_id"])).withField("type", F.coalesce(F.nullif(r["type"], F.lit("")), F.lit("unknown")))

    def block(b: Column) -> Column:
        return (
            b.withField("block_id", _text(b["block_id"])).withField("type", F.coalesce(F.nullif(b["type"], F.lit("")), F.lit("unknown")))
            .withField("entities", some(b["entities"], entity)).withField("relations", some(b["relations"], relation))
        )

    run = lambda e: e.withField("example_id", _text(e["example_id"])).withField("performance_relations", F.coalesce(e["performance_relations"], e["performance"]))
    return df.withColumn("blocks", some(F.col("blocks"), block)).withColumn("experiments", some(F.col("experiments"), run))


def structured_documents(spark: SparkSession, paths: list[str], strict: bool = False) -> DataFrame:
    """Documents from ``*_structured.json`` files.

    A file that is no JSON object is left out, or fails the read when ``strict``.  A
    missing doc_id is the file's stem.
    """
    df = _files(spark, paths, "*_structured.json")
    parsed = F.from_json("text", schemas.DOCUMENT, {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    is_object = F.col("text").rlike(r"(?s)^\s*\{.*\}\s*$") & (F.get_json_object("text", "$").isNotNull())
    if strict:
        is_object = F.coalesce(is_object, F.lit(False)) | F.raise_error(F.concat(F.lit("no JSON object: "), F.col("path"))).cast("boolean")
    df = df.where(is_object).select("path", parsed.alias("d")).select("path", "d.*")
    return coerce(df.withColumn("doc_id", F.coalesce(F.nullif("doc_id", F.lit("")), stem(F.col("path"), "_structured.json"))))


def quarantine(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, reason) of files that ``structured_documents`` leaves out."""
    df = _files(spark, paths, "*_structured.json")
    bad = F.get_json_object("text", "$").isNull()
    return df.select("path", F.when(bad, F.lit("no JSON")).when(~F.col("text").rlike(r"(?s)^\s*\{"), F.lit("no object")).alias("reason")).where("reason is not null")


def lookup_cache(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(key, value) of a JSON object file; a missing or broken file is an empty cache."""
    empty = spark.createDataFrame([], f"key string, value {value}")
    try:
        df = spark.read.text(path, wholetext=True)
    except Exception as e:  # Spark's error class for a path that does not exist
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return empty
    return df.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("key", "value")).where("value is not null")


def source_files(spark: SparkSession, path: str, suffix: str = ".pdf", skip: tuple[str, ...] = ("output", "md")) -> DataFrame:
    """(dir, file, length) of files by suffix, any case, sorted by folder and lower-case name; some folders are skipped."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    df = df.where(F.lower("path").endswith(suffix))
    parts = F.split("path", "/")
    df = df.withColumn("dir", F.regexp_extract("path", "^(.*)/[^/]+$", 1)).withColumn("file", F.element_at(parts, -1))
    inside = F.filter(F.slice(parts, 1, F.size(parts) - 1), lambda p: p.isin(*skip))
    return df.where(F.size(inside) == 0).select("dir", "file", "length").orderBy("dir", F.lower("file"))
