"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollforge.plans.storage import materialize


def star_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long) that is not the
    smallest of its component; label is the smallest.

    A round hangs the larger neighbours of every node, then the others, on its
    smallest neighbour; rounds end when nothing moves, after about log(n) of
    them. Each round is a written table, and only minima are aggregated, so a
    node with many edges is not gathered anywhere.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = materialize(now.distinct(), "edges")

    def state(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    after = state(now)
    while True:
        before = after
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hung = hung.unionByName(least.select("a", F.col("m").alias("b")))
        now = materialize(hung.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        after = state(now)
        if after == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
