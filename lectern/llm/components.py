"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import discard, observed


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges (a long, b long) but the smallest of each component, which is its label.

    Each step is a grouped minimum and a join, so a hub costs no task more than its share of rows; every step
    is written to the shared folder. Loops count as no edge. No edges give no rows.

    The steps end when every node has one edge and none leads to a node that has an edge itself. The first is counted
    while edges are written, only then the second is looked up: a step that changes nothing would cost several times that.
    """
    e, seen = _counted(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"), F.lit(1).alias("more")).filter("u <> v"))
    while seen["n"] and (seen["more"] or not _inner(e).isEmpty()):
        both = e.select("u", "v").union(e.select("v", "u")).toDF("x", "y")
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.filter("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"), F.lit(1).alias("more"))
        before = e
        e, seen = _counted(small.union(least.select("u", "m", F.lit(0))))
        discard(before)
    return e.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _counted(e: DataFrame) -> tuple[DataFrame, dict]:
    """The stored distinct edges, their number n, and how many (more) a node may have beside its least."""
    return observed(e.groupBy("u", "v").agg(F.max("more").alias("more")), "edges", n=F.count("*"), more=F.sum("more"))


def _inner(e: DataFrame) -> DataFrame:
    """Edges that lead to a node that has one itself."""
    return e.select("v").join(e.select(F.col("u").alias("v")), "v", "left_semi")
