"""Votes, precedence between sources, and comparisons of sets and shapes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_in_group(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """One row of each group, the first in a total order."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter("_r = 1").drop("_r")


def vote(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The commonest value of each group, ties by value: by, value, n. Counts are partial aggregates."""
    return first_in_group(df.groupBy(*by, value).agg(F.count("*").alias("n")), by, [F.desc("n"), F.asc(value)])


def ranked_union(sources: list[DataFrame], by: list[str], order: list) -> DataFrame:
    """Of several sources of the same columns, each key's row from the best (the earliest in the list): adds source_rank."""
    parts = [s.withColumn("source_rank", F.lit(k + 1).cast("bigint")) for k, s in enumerate(sources)]
    return first_in_group(reduce(DataFrame.unionByName, parts), by, ["source_rank", *order])


def override(base: DataFrame, above: DataFrame, key: str, value: str) -> DataFrame:
    """Keys of both; the value is that of `above` where it has one. Tells from where: key, value, origin."""
    a, b = above.select(F.col(key), F.col(value).alias("_a")), base.select(F.col(key), F.col(value).alias("_b"))
    origin = F.when(F.col("_a").isNull(), "base").when(F.col("_b").isNull(), "added").otherwise("overridden")
    return b.join(a, key, "full_outer").select(key, F.coalesce("_a", "_b").alias(value), origin.alias("origin"))


def shape_diff(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys of two years and what became of each: added, dropped, differs or same."""
    o, n = old.select(*keys, F.col(value).alias("old"), F.lit(1).alias("_o")), new.select(*keys, F.col(value).alias("new"), F.lit(1).alias("_n"))
    both = o.join(n, keys, "full_outer")
    kind = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "dropped").when(F.col("old").eqNullSafe(F.col("new")), "same").otherwise("differs")
    return both.select(*keys, "old", "new", kind.alias("change"))


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that one side has: key, side."""
    x, y = a.select(key).distinct().withColumn("_a", F.lit(1)), b.select(key).distinct().withColumn("_b", F.lit(1))
    out = x.join(y, key, "full_outer").filter("_a IS NULL OR _b IS NULL")
    return out.select(key, F.when(F.col("_a").isNull(), "right").otherwise("left").alias("side"))


def constant_slots(df: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """Which of two numbers never varies in a group of two rows or more: by, n, slot ('a', 'b' or null), total."""
    g = df.groupBy(*by).agg(F.count("*").alias("n"), F.countDistinct(a).alias("_da"), F.countDistinct(b).alias("_db"), F.min(a).alias("_a"), F.min(b).alias("_b"))
    slot = F.when((F.col("n") >= 2) & (F.col("_da") == 1) & (F.col("_db") > 1), "a").when((F.col("n") >= 2) & (F.col("_db") == 1) & (F.col("_da") > 1), "b")
    return g.select(*by, "n", slot.alias("slot"), F.when(slot == "a", F.col("_a")).when(slot == "b", F.col("_b")).alias("total"))


def duplicates(df: DataFrame, content: Column, key: str) -> DataFrame:
    """Contents that several rows have: hash, n, first key, last key."""
    return df.groupBy(content.alias("content")).agg(F.count("*").alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key")).filter("n > 1")
