"""Claims on pages: ranges to pages, what nobody claims, and the verdict that each page is claimed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.operators.ordered import runs


def claims(ranges: DataFrame, first: Column, last: Column, page: str) -> DataFrame:
    """One row for every page of every range; an equi-join on the page then replaces a range join."""
    return ranges.withColumn(page, F.explode(F.when(first <= last, F.sequence(first.cast("bigint"), last.cast("bigint"))).otherwise(F.array().cast("array<bigint>"))))


def unclaimed(pages: DataFrame, claimed: DataFrame, by: list[str], page: str) -> DataFrame:
    """Pages without a claim, as maximal ranges."""
    return runs(pages.join(claimed.select(*by, page).distinct(), [*by, page], "left_anti"), by, page)


def exactly_once(pages: DataFrame, claimed: DataFrame, page: str) -> DataFrame:
    """page, n_claims, verdict: ok, lost (none) or double."""
    n = claimed.groupBy(page).agg(F.count("*").alias("n_claims"))
    out = pages.select(page).distinct().join(n, page, "left").withColumn("n_claims", F.coalesce("n_claims", F.lit(0)).cast("bigint"))
    return out.withColumn("verdict", F.when(F.col("n_claims") == 1, "ok").when(F.col("n_claims") == 0, "lost").otherwise("double"))
