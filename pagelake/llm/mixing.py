"""Mixing sources to target weights by nested hash thresholds, with DataFrame functions only.

Every row has a fixed 60-bit hash. Tokens are summed by source and hash bucket; in each source the bucket where
the running sum crosses the budget is refined, alone, by the next bits of the hash, until one hash is left. Rows
under that threshold get one copy more. Nothing is sorted, and a larger budget keeps all rows of a smaller one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.llm.common import column, forget, save, small

#: Weights of sources in order, repeating; share of all tokens to take; most copies of a source.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Bits of the hash, and bits that one round of refining resolves.
BITS, STEP = 60, 12
WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds `target` to one row per source (source, source_size): weighted shares, capped, the excess dealt again.

    Dealing again until none is above its cap ends at one level by which all weights are multiplied. With
    sources in the order of cap by weight, those capped come first, so running sums give the level. The windows
    run over one row per source, not over documents.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    s = sources.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    order = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    s = s.withColumn("level", left / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
    s = s.withColumn("level", F.max("level").over(everything))  # it rises while sources are capped, then falls
    return s.withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))).select("source", "source_size", "target")


def row_hash(doc_id: Column) -> Column:
    """60 bits of MD5, the same in every engine; rows that repeat a doc_id share theirs."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, BITS // 4), 16, 10).cast("bigint")


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """budgets: source, rest. Gives source, threshold: rows of smaller hash hold nearest to `rest` tokens.

    The running sum of a source goes over 4,096 buckets at most, whatever its rows.
    """
    state = budgets.filter("rest > 0").select("source", "rest", F.lit(0).cast("bigint").alias("prefix"), F.lit(0).cast("bigint").alias("below"))
    last = None
    for shift in range(BITS - STEP, -1, -STEP):
        s = small(state.withColumnRenamed("source", "s"))
        inside = sized.join(s, F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", shift + STEP) == F.col("prefix")))
        buckets = inside.groupBy("source", "rest", "below", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("tokens"), F.min("h").alias("h0"), F.max("h").alias("h1"))
        upto = F.col("below") + F.sum("tokens").over(W.partitionBy("source").orderBy("bucket"))
        crossing = buckets.withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("tokens")).filter((F.col("from") < F.col("rest")) & (F.col("upto") >= F.col("rest")))
        found = save(crossing.select("source", "rest", F.col("bucket").alias("prefix"), F.col("from").alias("below"), "upto", "h0", "h1"), "mix-level")
        if last is not None:
            forget(last)
        last = found
        state = found.select("source", "rest", "prefix", "below")
        if found.filter("h0 < h1").isEmpty():
            break
    nearer = F.col("upto") - F.col("rest") <= F.col("rest") - F.col("below")
    return last.select("source", F.when(nearer, F.col("h1") + 1).otherwise(F.col("h0")).alias("threshold"))


def sizes(docs: DataFrame) -> DataFrame:
    text = column(docs, "text", "string")
    return docs.select(column(docs, "doc_id", "bigint"), column(docs, "source", "string"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"), row_hash(column(docs, "doc_id", "bigint")).alias("h"))


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per source of sized (source, size, h): source_size, target, whole copies and the hash threshold for one more."""
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = save(targets(per_source, weights, share, most), "mix-targets")
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    goal = goal.withColumn("copies", copies).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    found = thresholds(sized, goal.select("source", "rest")).withColumnRenamed("source", "s")
    return goal.join(small(found), F.col("source").eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", "copies", F.coalesce("threshold", F.lit(0)).alias("threshold"))


def taken(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Adds source_size, target and `repeats` (how often the mix has the row) to rows with source and h."""
    p = small(planned.withColumnRenamed("source", "s"))
    repeats = F.col("copies") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0)
    return rows.join(p, F.col("source").eqNullSafe(F.col("s"))).withColumn("repeats", repeats.cast("bigint")).drop("s", "copies", "threshold")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per row of docs: doc_id, source, size (words), source_size, target (the source's), taken (words, with repeats).

    Null text has size 0; a null source is a source of its own, last in order; rows that repeat a doc_id (or have
    none) share a hash and are taken together; an empty table gives an empty result. Reruns agree.
    """
    sized = save(sizes(docs), "mix-sizes")
    out = taken(sized, plan(sized, weights, share, most))
    return out.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """docs, columns as they are, whatever they are called, with every row as often as the mix takes it (possibly never).

    Null texts have size 0 and are taken like others under the threshold; a null source is a source of its own; rows that
    repeat a doc_id (or have none) are taken together; an empty table stays empty.
    """
    sized = sizes(docs)
    planned = plan(save(sized.select("source", "size", "h"), "mix-sizes"), weights, share, most)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), column(docs, "source", "string"), row_hash(column(docs, "doc_id", "bigint")).alias("h"))
    often = taken(rows, planned).filter("repeats > 0")
    return often.select("doc", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))).select("doc.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap FROM s0),
s2 AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_level FROM s1),
s3 AS (SELECT *, max(at_level) OVER () AS level FROM s2),
s4 AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), level * weight) AS target FROM s3),
s5 AS (SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS copies FROM s4),
s6 AS (SELECT *, target - copies * source_size AS rest FROM s5),
r AS (SELECT d.*, source_size, target, copies, rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto,
         sum(size) OVER (PARTITION BY d.source, h) AS here
      FROM d JOIN s6 ON d.source IS NOT DISTINCT FROM s6.source)
SELECT doc_id, source, size, source_size, target,
       CAST(size * (copies + CASE WHEN upto - here < rest AND (upto <= rest OR upto - rest <= rest - (upto - here)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""
