"""The corpus pipeline: five stages over the table ``documents``, each one of the operators.

language ID, line dedup, near-dedup, source mixing, best-fit packing.  A stage
takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's ``docs``.  All but the last return the columns of documents.

What each decides: documents whose language is rejected go, and a null lang becomes the predicted one; lines of recurring templates
go, and documents that held nothing else; of each near-duplicate component (Jaccard
similarity of five-word shingles 0.8 or more) the document with the smallest id stays (of equal ids the first by fingerprint of the row); the mix
repeats or cuts texts to the words it takes; packing returns one row per piece.

Nulls: a null text has no letter and is rejected by the first stage; a null id is kept
as long as its row is; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import langid, lines, mixing, overlap, packing, simhash
from quire.llm.common import WORD, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _row_key():
    return F.xxhash64("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is recognised; lang becomes the predicted one where it was null."""
    docs = docs.select(*COLUMNS)
    model = langid.learn(docs.where(langid.held_in(F.col("doc_id"))))
    return langid.accepted(docs, model, lang_col="lang").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops recurring lines, and documents of which nothing is left."""
    cleaned = lines.drop_recurring_lines(docs.select(*COLUMNS))
    changed = F.col("lines_dropped") > 0
    emptied = changed & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.where(~emptied).withColumn("n_chars", n_chars).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of texts that share 0.8 or more of their five-word shingles."""
    # The type that a written table gives the row: by another one the last join and the last grouping would each shuffle all texts.
    kind = f"struct<missing:boolean,doc_id:{docs.schema['doc_id'].dataType.simpleString()},key:bigint>"
    keyed = docs.select(*COLUMNS).withColumn("row", F.struct(F.col("doc_id").isNull(), F.col("doc_id"), _row_key()).cast(kind))
    # Fingerprints of five-word shingles link what differs by few bits; what they can't see at this similarity is found
    # by the shingles themselves, and every link is checked by the exact similarity.
    linked = simhash.near_duplicates(keyed, id_col="row", shingle=overlap.SHINGLE)
    pairs = linked.where("id <> component").select("id", F.col("component").alias("other"))
    found = overlap.near_duplicates(keyed, id_col="row", pairs=pairs)
    # The component is named by the smallest row of it; equal rows are the same to this rule.
    kept = found.where("id = component").select(F.col("id").alias("row"))
    return keyed.join(kept, "row", "left_semi").dropDuplicates(["row"]).select(*COLUMNS)


def _numbered(docs: DataFrame) -> DataFrame:
    """Adds key, and copy: the number of a row among equal ones."""
    keyed = docs.select(*COLUMNS).withColumn("key", _row_key())
    again = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "pipeline-repeated")
    if not again.count():
        return keyed.withColumn("copy", F.lit(1).cast("long"))
    once = keyed.join(again, "key", "left_anti").withColumn("copy", F.lit(1).cast("long"))
    often = keyed.join(again, "key").groupBy("key", *COLUMNS).agg(F.count(F.lit(1)).alias("copies"))
    return once.select(*COLUMNS, "key", "copy").unionByName(often.select(*COLUMNS, "key", F.explode(F.expr("sequence(1L, copies)")).alias("copy")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts or repeats texts to the words that the mix takes of them; documents it takes nothing of go."""
    keyed = _numbered(docs)
    mixed = mixing.mix_sources(keyed, keep=("doc_id", "key", "copy")).select("doc_id", "key", "copy", "taken", "size")
    same = keyed.key.eqNullSafe(mixed.key) & keyed.doc_id.eqNullSafe(mixed.doc_id) & keyed.copy.eqNullSafe(mixed.copy)
    joined = keyed.join(mixed, same).select(*(keyed[c] for c in COLUMNS), "taken", "size")
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    whole, rest = F.expr("cast(taken div size as int)"), F.expr("cast(taken % size as int)")
    part = F.array_join(F.slice(words, 1, rest), " ")
    times = F.array_repeat(F.col("text"), whole)
    text = F.when(rest == 0, F.array_join(times, "\n")).otherwise(F.array_join(F.concat(times, F.array(part)), "\n"))
    taken = joined.where("size > 0 and taken > 0")
    changed = F.col("taken") != F.col("size")
    return taken.withColumn("text", F.when(changed, text).otherwise(F.col("text"))).withColumn(
        "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of every document's token ids."""
    packed = packing.pack_documents(docs)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mix_sources", mix),
    ("best_fit_packing", pack),
]

#: Hashes, trained classifiers and token ids are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
