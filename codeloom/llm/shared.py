"""Tables between the jobs of an operator, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.session import write_and_read

#: Rounds double the distance that labels travel, so this is never reached by fewer than 2^60 vertices.
MOST_ROUNDS = 60


def saved(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: an executor's loss then costs no more than the tasks it ran."""
    return write_and_read(df, label)


def components(edges: DataFrame) -> DataFrame:
    """`id` and `component_id`, the smallest id reachable, for the ends of edges (a, b) of two longs.

    Large-star and small-star rounds: every vertex hands its larger neighbours to its smallest one, then its smaller
    ones. Edges are made distinct in every round, so a group of n members ends as n - 1 edges to its smallest.
    """
    now = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    for _ in range(MOST_ROUNDS):
        # Large star: the larger neighbours of v hang on the smallest of v and its neighbours.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written, so that the join shuffles both sides anew and Spark can split a vertex with many neighbours.
        least = saved(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: the smaller neighbours of v, and v, hang on the smallest of them.
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        after = saved(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        # Done when every vertex has one edge, and no end of an edge is the start of another.
        counts = after.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("a").alias("starts")).first()
        chained = after.join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1).count()
        now = after
        if counts["n"] == counts["starts"] and not chained:
            break
    else:
        raise RuntimeError(f"the components are not settled after {MOST_ROUNDS} rounds")
    tops = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionByName(tops)
