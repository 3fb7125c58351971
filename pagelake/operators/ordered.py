"""Operators over rows in order: carry, runs, ends, gaps, clusters, as-of, running sums.

Every operator takes partition columns `by` and a total order; with `by` chosen well, no task sees more than one
group. Nothing relies on the order in which rows come.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.sources.tables import spread


def upto(by: list[str], order: list) -> "W":
    return W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)


def before(by: list[str], order: list) -> "W":
    return W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)


def after(by: list[str], order: list) -> "W":
    return W.partitionBy(*by).orderBy(*order).rowsBetween(1, W.unboundedFollowing)


def carry(value: Column, by: list[str], order: list) -> Column:
    """A value printed once, on all rows below it until the next."""
    return F.last(value, True).over(upto(by, order))


def segment(ends: Column, by: list[str], order: list) -> Column:
    """Number of the stretch of rows that a row with `ends` closes (that row included)."""
    return F.coalesce(F.sum(F.when(ends, 1).otherwise(0)).over(before(by, order)), F.lit(0)).cast("bigint")


def carry_until(df: DataFrame, value: Column, ends: Column, by: list[str], order: list, name: str) -> DataFrame:
    """Carry that starts afresh after every closing row."""
    out = df.withColumn("_seg", segment(ends, by, order))
    return out.withColumn(name, F.last(value, True).over(upto([*by, "_seg"], order))).withColumnRenamed("_seg", "segment")


def running_unit(opens: Column, by: list[str], order: list) -> Column:
    """Number of the unit that a row belongs to, counted up by the rows that open one."""
    return F.count(F.when(opens, 1)).over(upto(by, order))


#: Whole numbers in a block of rows that one task counts.
BLOCK = 1 << 16


def unit_in_blocks(df: DataFrame, opens: Column, by: list[str], order: str, name: str) -> DataFrame:
    """df with the number of each row's unit, as `running_unit` gives it, where a group may be a whole table.

    Rows are counted in blocks of their whole number `order`, side by side; only the blocks' sums, one row a block, are
    counted up in one place.
    """
    d = df.withColumns({"_block": F.floor(F.col(order) / BLOCK), "_opens": F.coalesce(opens, F.lit(False))})
    sums = d.groupBy(*by, "_block").agg(F.count_if("_opens").alias("_n"))
    sums = sums.select(*by, "_block", F.coalesce(F.sum("_n").over(before(by, ["_block"])), F.lit(0)).alias("_before"))
    own = spread(d, *by, "_block").withColumn("_own", F.count_if("_opens").over(upto([*by, "_block"], [order])))
    null_safe = reduce(lambda p, q: p & q, [F.col(f"o.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*by, "_block"]])
    return own.alias("o").join(sums.alias("s"), null_safe).select(*[F.col(f"o.{c}") for c in df.columns], (F.col("_before") + F.col("_own")).alias(name))


def runs(df: DataFrame, by: list[str], number: str) -> DataFrame:
    """Consecutive whole numbers as ranges: by, first, last, n. Repeated numbers count once; groups are dealt to tasks once."""
    d = spread(df.select(*by, F.col(number).cast("bigint").alias("_n")), *by)
    island = F.col("_n") - F.dense_rank().over(W.partitionBy(*by).orderBy("_n"))
    r = d.withColumn("_i", island).groupBy(*by, "_i").agg(F.min("_n").alias("first"), F.max("_n").alias("last"))
    return r.select(*by, "first", "last", F.coalesce(F.col("last") - F.col("first") + 1, F.lit(1)).alias("n"))


def end_before_next(start: Column, by: list[str], order: list, last: Column) -> Column:
    """A range ends before the next starts, the last one at `last`; never before its own start."""
    return F.greatest(start, F.coalesce(F.lead(start).over(W.partitionBy(*by).orderBy(*order)) - 1, last))


def fill_where_agreed(value: Column, by: list[str], order: list) -> Column:
    """A missing value takes its neighbours' if they agree or one side has none."""
    p, n = F.last(value, True).over(before(by, order)), F.first(value, True).over(after(by, order))
    return F.coalesce(value, F.when(p.isNull() | n.isNull() | (p == n), F.coalesce(p, n)))


def split_at_gaps(df: DataFrame, by: list[str], first: str, last: str, gap: int) -> DataFrame:
    """Ranges in clusters, cut where over `gap` numbers lie between: by, cluster, first, last, covered, rank.

    Whole clusters are kept, with every range in them; rank 1 covers most, then starts first.
    """
    w = W.partitionBy(*by).orderBy(F.col(first), F.col(last))
    cut = F.when(F.col(first) - F.lag(last).over(w) > gap, 1).otherwise(0)
    c = df.withColumn("_cut", cut).withColumn("cluster", F.sum("_cut").over(w.rowsBetween(W.unboundedPreceding, 0)))
    c = c.groupBy(*by, "cluster").agg(F.min(first).alias("first"), F.max(last).alias("last"), F.sum(F.col(last) - F.col(first) + 1).alias("covered"))
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("covered"), "first"))
    return c.withColumn("rank", rank.cast("bigint"))


def as_of(left: DataFrame, right: DataFrame, by: list[str], at: str, since: str, value: str) -> DataFrame:
    """Each left row with the value of the last right row at or before it. One sort, no range join."""
    r = right.select(*by, F.col(since).alias("_at"), F.lit(0).alias("_side"), F.struct(F.col(value).alias("v")).alias("_v"))
    cols = [c for c in left.columns if c not in by]
    rows = left.select(*by, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.struct(*cols).alias("_row"))
    both = r.withColumn("_row", F.lit(None).cast(rows.schema["_row"].dataType)).unionByName(rows.withColumn("_v", F.lit(None).cast(r.schema["_v"].dataType)))
    w = W.partitionBy(*by).orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, 0)
    out = both.withColumn("_found", F.last("_v", True).over(w)).filter("_side = 1")
    return out.select(*by, "_row.*", F.col("_found.v").alias(value))


def cluster_near(df: DataFrame, by: list[str], position: str, tolerance: float) -> DataFrame:
    """Positions in single-linkage clusters: a new one where the gap is over the tolerance; adds cluster."""
    w = W.partitionBy(*by).orderBy(position)
    new = F.when(F.col(position) - F.lag(position).over(w) > tolerance, 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("cluster", F.sum("_new").over(w.rangeBetween(W.unboundedPreceding, 0)).cast("bigint")).drop("_new")


def band_heads(values: Column, tolerance: float) -> Column:
    """A sorted array cut into bands: a value more than the tolerance above its band's first value opens another.

    Each band's head depends on the one before, so this is a fold over the (page-sized) array.
    """
    start = F.array().cast("array<struct<head:double,n:bigint>>")

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        opens = last.isNull() | (x - last["head"] > tolerance)
        one = lambda h, n: F.array(F.struct(h.cast("double").alias("head"), n.cast("bigint").alias("n")))
        return F.when(opens, F.concat(acc, one(x, F.lit(1)))).otherwise(F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), one(last["head"], last["n"] + 1)))

    return F.aggregate(F.array_sort(values), start, step)


def changed(value: Column, by: list[str], order: list) -> Column:
    """Whether a value differs from the row before; the first row of a group counts as changed."""
    w = W.partitionBy(*by).orderBy(*order)
    return ~F.lag(value).over(w).eqNullSafe(value) | (F.row_number().over(w) == 1)
