"""Matching names, codes and ordered lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def compact(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def begins(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs (a, b) where b's name is a beginning of a's, or equal to it: an equality join on the whole shorter name.

    A name is cut only at lengths that occur on the other side, of which there are few; no two long names with the same
    opening meet unless one is the other's beginning.
    """
    lengths = [r["n"] for r in b.select(F.length("b").alias("n")).distinct().collect() if r["n"]]  # no more than the longest name has letters
    occur = F.array(*map(F.lit, sorted(lengths))) if lengths else F.array().cast("array<int>")
    cut = a.select("a", F.explode(F.filter(occur, lambda n: n <= F.length("a"))).alias("_n"))
    return cut.select("a", F.expr("left(a, _n)").alias("b")).join(b, "b").select("a", "b")


def match_names(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """Three levels: the exact name; a unique prefix either way, among names that no exact match took; a unique equal
    name without blanks and signs, among all. Gives name, match (null if none) and level.
    """
    a, b = left.select(F.col(name).alias("a")).distinct(), right.select(F.col(name).alias("b")).distinct()
    exact = a.join(b, F.col("a") == F.col("b")).select("a", "b", F.lit("exact").alias("level"))
    rest, free = a.join(exact.select("a"), "a", "left_anti"), b.join(exact.select("b"), "b", "left_anti")
    other = begins(free.withColumnRenamed("b", "a"), rest.withColumnRenamed("a", "b")).select(F.col("b").alias("a"), F.col("a").alias("b"))
    pairs = begins(rest, free).union(other).distinct()
    begun = pairs.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b")).filter("n = 1").select("a", "b", F.lit("prefix").alias("level"))
    rest = rest.join(begun.select("a"), "a", "left_anti")
    keyed = b.withColumn("k", compact(F.col("b"))).groupBy("k").agg(F.count("*").alias("n"), F.min("b").alias("b")).filter("n = 1")
    close = rest.withColumn("k", compact(F.col("a"))).join(keyed, "k").select("a", "b", F.lit("compact").alias("level"))
    none = rest.join(close.select("a"), "a", "left_anti").select("a", F.lit(None).cast("string").alias("b"), F.lit("none").alias("level"))
    return exact.union(begun).union(close).union(none).select(F.col("a").alias("name"), F.col("b").alias("match"), "level")


def near_codes(codes: DataFrame, code: str) -> DataFrame:
    """Pairs of codes that are one table: the longer is the shorter and one capital more, with two letters at least.

    The longer code without its last letter equals the shorter, so the pairs come from an equality join.
    """
    c = codes.select(F.col(code).alias("short")).distinct()
    longer = c.select(F.col("short").alias("long")).filter(F.col("long").rlike("[A-Z]$") & (F.regexp_count("long", F.lit("[A-Za-z]")) >= 2))
    return c.join(longer, F.col("short") == F.expr("left(long, length(long) - 1)")).select("short", "long")


def kth_with_kth(a: DataFrame, b: DataFrame, by: list[str], order_a: list, order_b: list) -> DataFrame:
    """The k-th row of a with the k-th of b in each group, where both have as many: by, k, a's and b's columns."""
    count = lambda d, n: d.groupBy(*by).agg(F.count("*").alias(n))
    equal = count(a, "_n").join(count(b, "_m"), by).filter("_n = _m").select(by)
    nth = lambda d, o: d.withColumn("k", F.row_number().over(W.partitionBy(*by).orderBy(*o)).cast("bigint"))
    return nth(a, order_a).join(nth(b, order_b), [*by, "k"]).join(equal, by, "left_semi")
