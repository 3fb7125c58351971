"""Connected components of an edge table, by alternating star contractions, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import forget, save


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest one."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    out = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of these. edges: b < a."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hand = edges.join(least, "a")
    out = hand.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def connected_components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """edges (a, b), longs. Gives (node, root) for every node with an edge; root is the smallest node it reaches.

    Hubs are no danger: minima are partial aggregates, and Spark splits a hot side of the joins. No edge and no
    label is collected; a count and a checksum tell when nothing changes any more.
    """
    now = save(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    sign = None
    for _ in range(most_rounds):
        new = save(_small_star(_large_star(now)), "edges")
        forget(now)
        now = new
        got = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(got) == sign:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        sign = tuple(got)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
