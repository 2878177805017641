"""Line deduplication by a log-template tree.

Lines are parsed by a tree of fixed depth: first by their number of tokens, then by
their leading tokens, where a token with a digit counts as a variable.  In a leaf, lines
are grouped to templates: a line joins the template with the most equal tokens (at least
``SIMILAR`` of all), and where it differs the template becomes variable, which then equals
nothing, so that templates don't drift.  A template that occurs in ``MIN_DOCS`` documents or more recurs; its lines are
dropped from all documents but the first (the smallest id), so that what is repeated
stays in the corpus once, and a document that was copied is not lost.

Scale: a recurring template lies within one leaf, so only leaves met in ``MIN_DOCS``
documents or more are parsed.  Equal masked lines are one entry with a count before any
leaf is brought together, so a line that a third of all documents hold is one entry.
Leaves with more than ``LEAF`` different lines are parsed in parts, with the result of the
whole: lines that may be ``SIMILAR`` differ in few places, so if the places are cut into
one block more, one block is equal.  Lines that share no block, directly or by others,
never meet in a template, and each component of lines that do is a part.  So ``LEAF`` deals
out work and decides nothing.  Leaves, lines and tokens are compared as they are written, never
by hashes alone.  Texts are read twice and never shuffled while what documents lose is
small enough to be broadcast (otherwise they are joined).

Defined results: a null text stays null, empty lines and lines under ``MIN_TOKENS``
tokens always stay; very long lines and texts are parsed whole; a line that is equally similar to
several templates joins the one that was met first, and lines are met in the order of
their number, then by their bytes; repeated rows are documents of their own, but one and the same to
the rule which keeps the first; among null ids the order is by fingerprint; an empty
table gives an empty result; all other columns pass through.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import partitions, small_batches, written
from quire.llm.components import connected_components

MIN_TOKENS, MIN_DOCS, SIMILAR, LEAF = 3, 5, 0.8, 4_096
#: Leading tokens of the tree's leaves.
DEPTH = 3
#: Bytes of a table that is broadcast.
BROADCAST_BYTES = 16 << 20

_DIGIT = re.compile(rb"\d")
_FIELDS = ["u1", "u2", "line", "leaf", "masked", "id"]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]


def parse(line: bytes) -> tuple[bytes, bytes] | None:
    """Leaf and masked line: tokens with a digit are variable."""
    tokens = line.split()
    if len(tokens) < MIN_TOKENS:
        return None
    if _DIGIT.search(line):
        tokens = [b"<*>" if _DIGIT.search(t) else t for t in tokens]
    return b"%d " % len(tokens) + b" ".join(tokens[:DEPTH]), b" ".join(tokens)


def _lines(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            b = batch.slice(at, 512)
            rows, of = [], []
            for k, (u1, u2, text) in enumerate(zip(*(b.column(c).to_pylist() for c in range(3)))):
                for i, line in enumerate(text.encode("utf-8", "surrogatepass").split(b"\n")):
                    if found := parse(line):
                        rows.append((u1, u2, i, *found))
                        of.append(k)
            if rows:
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)]
                yield pa.RecordBatch.from_arrays([*arrays, b.column(3).take(pa.array(of))], _FIELDS)


class Leaf:
    """Templates of one leaf; lines come in a fixed order."""

    def __init__(self, width: int):
        self.tokens = np.empty((16, width), np.int32)
        self.wild = np.zeros((16, width), bool)
        self.number: dict[bytes, int] = {}  # of each different token
        self.n = 0

    def add(self, tokens: list[bytes]) -> int:
        """The number of the template that the line joins or begins."""
        line = np.array([self.number.setdefault(t, len(self.number)) for t in tokens], np.int32)
        if self.n:
            equal = ((self.tokens[: self.n] == line) & ~self.wild[: self.n]).sum(1)
            best = int(equal.argmax())
            if equal[best] >= SIMILAR * len(line):
                self.wild[best] |= self.tokens[best] != line
                return best
        if self.n == len(self.tokens):
            self.tokens = np.concatenate([self.tokens, np.empty_like(self.tokens)])
            self.wild = np.concatenate([self.wild, np.zeros_like(self.wild)])
        self.tokens[self.n], self.wild[self.n] = line, False
        self.n += 1
        return self.n - 1


def _templates(batches):
    """Rows sorted by leaf and part to (leaf, part, masked, template)."""
    key, leaf = None, None
    for b in batches:
        out = []
        for k, part, masked in zip(*(b.column(c).to_pylist() for c in ("leaf", "part", "masked"))):
            tokens = masked.split(b" ")
            if (k, part) != key:
                key, leaf = (k, part), Leaf(len(tokens))
            out.append(leaf.add(tokens))
        yield pa.RecordBatch.from_arrays([b.column("leaf"), b.column("part"), b.column("masked"), pa.array(out, pa.int32())], ["leaf", "part", "masked", "template"])


def blocks(tokens: list[bytes]) -> list[bytes]:
    """Parts of the tokens after the leaf's, one of which is equal in any two lines that may be similar."""
    n = len(tokens)
    cut = np.linspace(DEPTH, n, n - math.ceil(SIMILAR * n) + 2).astype(int).tolist()
    return [b" ".join(tokens[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def _blocks(batches):
    for b in batches:
        nodes, keys = [], []
        for leaf, node, masked in zip(*(b.column(c).to_pylist() for c in ("leaf", "node", "masked"))):
            for i, block in enumerate(blocks(masked.split(b" "))):
                nodes.append(node)
                keys.append(xxhash.xxh64_intdigest(b"%d %b %b" % (i, leaf, block)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(np.array(keys, np.uint64).view(np.int64))], ["node", "key"])


def parts(entries: DataFrame) -> DataFrame:
    """Adds to entries (leaf, masked, n) their part: entries that may be similar have the same.

    Nodes and blocks are named by hashes; should two be named alike, their parts are one.
    """
    entries = written(entries.withColumn("node", F.xxhash64("leaf", "masked")), "line-crowded")
    keyed = written(entries.select("leaf", "node", "masked").mapInArrow(_blocks, "node long, key long"), "line-blocks")
    least = keyed.groupBy("key").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    roots = connected_components(keyed.join(least, "key").select(F.col("node").alias("u"), "v"))
    return entries.join(roots.withColumnRenamed("u", "node"), "node", "left").select("leaf", "masked", "n", F.coalesce("root", "node").alias("part"))


def _few(df: DataFrame, *sizes) -> DataFrame:
    """For a written table: broadcast if it is small, by the sizes of its columns of any length, else joined by shuffling."""
    width = sum(sizes, F.lit(32)).cast("long")
    return F.broadcast(df) if (df.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES else df


def recurring_lines(keyed: DataFrame) -> DataFrame:
    """(u1, u2, line): lines to drop, of (u1, u2, id, text) rows."""
    spark = keyed.sparkSession
    small_batches(spark)
    schema = f"u1 long, u2 long, line int, leaf binary, masked binary, id {keyed.schema['id'].dataType.simpleString()}"
    lines = written(keyed.where(F.col("text").isNotNull()).select("u1", "u2", "text", "id").mapInArrow(_lines, schema), "lines")
    # The number of a leaf's lines bounds the number of its documents; few leaves are met so often.
    met = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("met")).where(F.col("met") >= MIN_DOCS).select("leaf")
    lines = written(lines.join(_few(written(met, "line-leaves"), F.octet_length("leaf")), "leaf"), "line-candidates")
    # Entries: equal masked lines, with the number of their occurrences.
    entries = written(lines.groupBy("leaf", "masked").agg(F.count(F.lit(1)).alias("n")), "line-entries")
    large = written(entries.groupBy("leaf").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > LEAF).select("leaf"), "line-large")
    whole = entries
    if large.count():
        large = _few(large, F.octet_length("leaf"))
        whole = entries.join(large, "leaf", "left_anti")
    whole = whole.withColumn("part", F.lit(0).cast("long"))
    if whole.count() < entries.count():
        whole = whole.unionByName(parts(entries.join(large, "leaf")))
    parsed = whole.repartition(partitions(spark), "leaf", "part").sortWithinPartitions("leaf", "part", F.desc("n"), "masked")
    templates = written(parsed.select("leaf", "part", "masked").mapInArrow(_templates, "leaf binary, part long, masked binary, template int"), "line-templates")
    held = lines.join(_few(templates, F.octet_length("leaf"), F.octet_length("masked")), ["leaf", "masked"])
    held = written(held.select("u1", "u2", "id", "line", "leaf", "part", "template"), "line-held")
    # Exact numbers of documents, which count once for a template, and the first of them.
    template = ["leaf", "part", "template"]
    docs = held.select(*template, "u1", "u2", "id").distinct()
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("u1"), F.col("u2"))
    recurs = docs.groupBy(*template).agg(F.count(F.lit(1)).alias("docs"), F.min(order).alias("first")).where(F.col("docs") >= MIN_DOCS)
    recurs = written(recurs.select(*template, F.col("first.u1").alias("f1"), F.col("first.u2").alias("f2")), "line-recurs")
    return held.join(_few(recurs, F.octet_length("leaf")), template).where("u1 <> f1 or u2 <> f2").select("u1", "u2", "line")


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the lines of recurring templates; adds lines_dropped (in place of a column of that name)."""
    cols = [c for c in docs.columns if c != "lines_dropped"]
    free = "_"  # a beginning of names that no column has
    while any(c.startswith(free) for c in cols):
        free += "_"
    u1, u2, gone = f"{free}u1", f"{free}u2", f"{free}drop"
    keyed = docs.select(
        *(F.col(f"`{c}`") for c in cols),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias(u1),
        F.xxhash64(F.col(text_col), F.col(id_col), F.lit(1)).alias(u2),
    )
    plain = keyed.select(F.col(u1).alias("u1"), F.col(u2).alias("u2"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    drop = recurring_lines(plain).groupBy(F.col("u1").alias(u1), F.col("u2").alias(u2)).agg(F.sort_array(F.collect_set("line")).alias(gone))
    drop = _few(written(drop, "line-drops"), F.size(gone) * 4)
    # The lines between those that go, slice by slice.
    between = F.expr(f"""transform(array(split(`{text_col}`, '\\n', -1)), l -> array_join(flatten(transform(sequence(0, size(`{gone}`)), j ->
        slice(l, if(j = 0, 1, `{gone}`[j - 1] + 2), if(j = size(`{gone}`), size(l), `{gone}`[j]) - if(j = 0, 0, `{gone}`[j - 1] + 1)))), '\n'))""")
    kept = F.element_at(between, 1)
    text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(kept)
    out = keyed.join(drop, [u1, u2], "left")
    dropped = F.coalesce(F.size(gone), F.lit(0)).cast("long")
    return out.select(*(text.alias(c) if c == text_col else F.col(f"`{c}`") for c in cols), dropped.alias("lines_dropped"))
