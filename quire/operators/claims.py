"""Claims and what they depend on: nodes, children, roots, closure and nested form."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.sources.scratch import written


def nodes(claims: DataFrame, doc: str = "doc_id", order: str = "idx") -> DataFrame:
    """One row per claim number: the last block that has it; depends_on is never null."""
    last = Window.partitionBy(doc, "claim_no").orderBy(F.desc(order))
    picked = claims.where("claim_no > 0").withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")
    return picked.withColumn("depends_on", F.coalesce("depends_on", F.array().cast("array<int>")))


def edges(node: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, parent, child) of parents that exist."""
    child = node.select(doc, F.col("claim_no").alias("child"), F.explode("depends_on").alias("parent"))
    return child.join(node.select(doc, F.col("claim_no").alias("parent")), [doc, "parent"])


def roots(node: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Claims that depend on no claim that exists."""
    return node.join(edges(node, doc).select(doc, F.col("child").alias("claim_no")).distinct(), [doc, "claim_no"], "left_anti")


def closure(edge: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, ancestor, descendant, depth): the shortest way down, however deep.

    Ways are put together two by two until no pair is new and none gets shorter, which takes
    a number of rounds logarithmic in the depth; cycles end, as a pair keeps its shortest way.
    """
    found = edge.select(doc, F.col("parent").alias("ancestor"), F.col("child").alias("descendant"), F.lit(1).alias("depth")).distinct()
    found, before = written(found, "closure"), None
    while before != (now := found.agg(F.count(F.lit(1)), F.sum("depth")).first()):
        before = now
        below = found.select(doc, F.col("ancestor").alias("descendant"), F.col("descendant").alias("below"), F.col("depth").alias("more"))
        ways = found.join(below, [doc, "descendant"]).select(doc, "ancestor", F.col("below").alias("descendant"), (F.col("depth") + F.col("more")).alias("depth"))
        found = written(found.unionByName(ways).groupBy(doc, "ancestor", "descendant").agg(F.min("depth").alias("depth")), "closure")
    return found


def nested(node: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, tree): the claims of a document as nested JSON; a claim inside itself is left out."""

    def build(t: pd.DataFrame) -> pd.DataFrame:
        by_no = {int(r.claim_no): r for r in t.itertuples()}
        children: dict[int, list[int]] = {n: [] for n in by_no}
        for n, r in by_no.items():
            for p in r.depends_on:
                if p in by_no:
                    children[p].append(n)

        def tree(n: int, above: tuple[int, ...]) -> dict:
            below = [tree(c, (*above, n)) for c in sorted(children[n]) if c not in above and c != n]
            return {"claim_no": n, "text": by_no[n].text, "depends_on": [int(d) for d in by_no[n].depends_on], "children": below}

        top = sorted(n for n, r in by_no.items() if not any(d in by_no for d in r.depends_on))
        return pd.DataFrame({doc: [t[doc].iloc[0]], "tree": [json.dumps([tree(n, ()) for n in top], ensure_ascii=False)]})

    kind = node.schema[doc].dataType.simpleString()
    return node.select(doc, "claim_no", "text", "depends_on").groupBy(doc).applyInPandas(build, f"{doc} {kind}, tree string")
