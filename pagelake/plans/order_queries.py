"""Queries of operators over rows in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.numbers import money
from pagelake.operators import detect, geometry
from pagelake.operators import ordered as o
from pagelake.sources.tables import spread, table

BY, ORDER = ["user_id"], ["ts", "event_id"]
OVER = "(PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _events(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", "ts", *cols)


def group_carry(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, "event_type", "value")
    heading = F.when(F.col("event_type") == "signup", F.col("value"))
    return e.select("event_id", "user_id", o.carry(heading, BY, ORDER).alias("heading"))


def carry_until_reset(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, "event_type", "value")
    out = o.carry_until(e, F.when(F.col("event_type") == "view", F.col("value")), F.col("event_type") == "purchase", BY, ORDER, "carried")
    return out.select("event_id", "user_id", "segment", "carried")


def running_count_unit(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, "event_type", "value")
    e = e.withColumn("unit", o.running_unit(F.col("event_type") == "signup", BY, ORDER))
    return e.groupBy("user_id", "unit").agg(F.count("*").alias("n"), F.max(F.when(F.col("event_type") == "signup", F.col("value"))).alias("opened_with"))


def id_runs(spark: SparkSession, d: str) -> DataFrame:
    return o.runs(table(spark, d, "lineitem"), ["l_suppkey"], "l_partkey")


def ends_from_next_start(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    return e.select("user_id", F.col("event_id").alias("start"), o.end_before_next(F.col("event_id"), BY, ["event_id"], F.lit(1_000_000).cast("bigint")).alias("end"))


def gap_fill_agree(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, "event_type")
    known = F.when(F.col("event_type").isin("click", "view"), F.col("event_type"))
    return e.select("event_id", "user_id", o.fill_where_agreed(known, BY, ORDER).alias("filled"))


def wide_gap_clusters(spark: SparkSession, d: str) -> DataFrame:
    r = o.runs(table(spark, d, "lineitem"), ["l_suppkey"], "l_partkey")
    return o.split_at_gaps(r, ["l_suppkey"], "first", "last", 40)


def two_page_runs(spark: SparkSession, d: str) -> DataFrame:
    return o.runs(table(spark, d, "lineitem"), ["l_suppkey"], "l_partkey").filter("n >= 2")


def block_owner_asof(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", (F.col("o_custkey") % 5).alias("zone"))
    blocks = table(spark, d, "nation").select((F.col("n_nationkey") % 5).cast("bigint").alias("zone"), (F.col("n_nationkey") * 60).cast("bigint").alias("since"), F.col("n_name").alias("owner"))
    return o.as_of(orders, blocks, ["zone"], "o_custkey", "since", "owner").select("o_orderkey", "o_custkey", "owner")


def last_amount_above(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, "event_type", "value")
    e = e.withColumn("unit", o.running_unit(F.col("event_type") == "signup", BY, ORDER))
    amount = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    e = e.withColumn("amount_row", F.last(amount, True).over(o.upto(["user_id", "unit"], ORDER)))
    return e.filter("event_type = 'click'").select("event_id", "user_id", "unit", "amount_row")


def unit_branches(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, "event_type")
    e = e.withColumn("unit", o.running_unit(F.col("event_type") == "signup", BY, ORDER))
    n = e.groupBy("user_id", "unit").agg(F.count_if(F.col("event_type") == "purchase").alias("amounts"), F.count_if(F.col("event_type") == "click").alias("items"))
    branch = F.when((F.col("amounts") == 0) & (F.col("items") == 0), "empty").when(F.col("amounts") == 0, "implied").when(F.col("amounts") > F.col("items"), "copied").when(F.col("amounts") == F.col("items"), "paired").otherwise("last_above")
    return n.withColumn("branch", branch)


def subtotal_scope_sums(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, "event_type", "value").withColumn("segment", o.segment(F.col("event_type") == "purchase", BY, ORDER))
    facts = F.when(F.col("event_type") != "purchase", money(F.col("value")))
    g = e.groupBy("user_id", "segment").agg(F.coalesce(F.sum(facts), F.lit(0)).cast("double").alias("scope_sum"), F.max(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("printed"))
    return g


def running_total_check(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, "event_type", "value")
    facts = F.when(F.col("event_type") != "error", money(F.col("value")))
    e = e.withColumn("so_far", F.coalesce(F.sum(facts).over(o.upto(BY, ORDER)), F.lit(0)).cast("double"))
    return e.filter("event_type = 'error'").select("event_id", "user_id", F.col("value").alias("printed"), "so_far")


def group_heading_emission(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d, "event_type")
    e = e.withColumn("new_heading", o.changed(F.col("event_type"), BY, ORDER))
    return e.select("event_id", "user_id", F.when(F.col("new_heading"), F.col("event_type")).alias("heading"))


def repeated_key_ratio(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    w = W.partitionBy("o_custkey").orderBy("o_orderkey")
    x = x.withColumn("was", F.lag("o_orderpriority").over(w))
    return x.filter("was IS NOT NULL").groupBy("o_custkey").agg(F.count("*").alias("n"), F.avg(F.when(F.col("was") != F.col("o_orderpriority"), 1.0).otherwise(0.0)).alias("change_ratio"))


def cluster_positions(spark: SparkSession, d: str) -> DataFrame:
    x = spread(table(spark, d, "lineitem").select("l_suppkey", "l_extendedprice"), "l_suppkey").distinct()
    c = o.cluster_near(x, ["l_suppkey"], "l_extendedprice", 50.0)
    return c.groupBy("l_suppkey", "cluster").agg(F.count("*").alias("n"), F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi"))


def band_fold(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice")
    g = x.groupBy("l_orderkey").agg(F.collect_list("l_extendedprice").alias("v"))  # the lines of one order: page-sized
    return g.select("l_orderkey", F.explode(o.band_heads(F.col("v"), 5000.0)).alias("b")).select("l_orderkey", "b.head", "b.n")


def cumulative_share(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", money(F.col("s_acctbal")).alias("v"))
    w = W.partitionBy("s_nationkey")
    run = F.sum("v").over(w.orderBy(F.desc("v"), "s_suppkey").rowsBetween(W.unboundedPreceding, 0))
    rank = F.row_number().over(w.orderBy(F.desc("v"), "s_suppkey")).cast("bigint")
    return s.select("s_suppkey", "s_nationkey", rank.alias("place"), run.cast("double").alias("running"), F.sum("v").over(w).cast("double").alias("total"))


def span_pipeline(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("volume"), F.concat("l_returnflag", "l_linestatus").alias("code"), F.col("l_partkey").alias("page"), F.when(F.col("l_linenumber") == 1, "title").when(F.col("l_linenumber") <= 3, "header").otherwise("inline").alias("evidence"))
    held = detect.drop_weak(x, ["volume"])
    seen = held.groupBy("volume", "code").agg(F.max("page").alias("last_seen"))
    first = detect.starts(held, ["volume"]).join(seen.withColumn("last_seen", F.least("last_seen", F.lit(100).cast("bigint"))), ["volume", "code"])
    pages = x.groupBy("volume").agg(F.max("page").alias("last_page"))
    walls = table(spark, d, "supplier").select(F.col("s_suppkey").alias("volume"), (F.col("s_nationkey") * 40).cast("bigint").alias("page"))
    return detect.spans(first, pages, ["volume"], walls).select("volume", "code", "start", "evidence", "end0", "end1", "end2")


def _printed_words(spark: SparkSession, d: str) -> DataFrame:
    """Texts of benchmark items set as pages: six words a line, lines twelve points apart, slightly uneven."""
    b = table(spark, d, "benchmark").select("item_id", F.posexplode(F.split("text", " ")).alias("word_id", "text")).filter("text <> ''")
    k = F.col("word_id")
    x0, y0 = (k % 6) * 80.0, F.floor(k / 6) * 12.0 + (k % 3) * 0.5
    return b.select("item_id", k.cast("bigint").alias("word_id"), "text", x0.alias("u0"), (x0 + 40.0).alias("u1"), y0.alias("v0"), (y0 + 9.0).alias("v1"), F.lit(9.0).alias("size"))


def page_cells(spark: SparkSession, d: str) -> DataFrame:
    w = geometry.column_starts(geometry.row_bands(_printed_words(spark, d), ["item_id"]), ["item_id"])
    return geometry.cells(w, ["item_id"])


U = "u AS (SELECT *, count(CASE WHEN event_type = 'signup' THEN 1 END) OVER " + OVER + " AS unit FROM events)"
RUNS = """d AS (SELECT DISTINCT l_suppkey, l_partkey AS n FROM lineitem),
i AS (SELECT *, n - row_number() OVER (PARTITION BY l_suppkey ORDER BY n) AS g FROM d),
r AS (SELECT l_suppkey, min(n) AS first, max(n) AS last, count(*) AS n FROM i GROUP BY l_suppkey, g)"""
SEG = "s AS (SELECT *, CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS segment FROM events)"

QUERIES = {
    "group_carry": (group_carry, f"SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER {OVER} AS heading FROM events"),
    "carry_until_reset": (carry_until_reset, f"WITH {SEG} SELECT event_id, user_id, segment, last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id, segment ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM s"),
    "running_count_unit": (running_count_unit, f"WITH {U} SELECT user_id, unit, count(*) AS n, max(CASE WHEN event_type = 'signup' THEN value END) AS opened_with FROM u GROUP BY user_id, unit"),
    "id_runs": (id_runs, f"WITH {RUNS} SELECT l_suppkey, first, last, n FROM r"),
    "ends_from_next_start": (ends_from_next_start, "SELECT user_id, event_id AS start, greatest(event_id, coalesce(lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) - 1, 1000000)) AS \"end\" FROM events"),
    "gap_fill_agree": (gap_fill_agree, """WITH k AS (SELECT event_id, user_id, ts, CASE WHEN event_type IN ('click', 'view') THEN event_type END AS v FROM events),
n AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p,
  first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS f FROM k)
SELECT event_id, user_id, coalesce(v, CASE WHEN p IS NULL OR f IS NULL OR p = f THEN coalesce(p, f) END) AS filled FROM n"""),
    "wide_gap_clusters": (wide_gap_clusters, f"""WITH {RUNS},
c AS (SELECT *, CASE WHEN first - lag(last) OVER (PARTITION BY l_suppkey ORDER BY first, last) > 40 THEN 1 ELSE 0 END AS cut FROM r),
k AS (SELECT *, CAST(sum(cut) OVER (PARTITION BY l_suppkey ORDER BY first, last ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cluster FROM c),
g AS (SELECT l_suppkey, cluster, min(first) AS first, max(last) AS last, CAST(sum(last - first + 1) AS BIGINT) AS covered FROM k GROUP BY l_suppkey, cluster)
SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY covered DESC, first) AS rank FROM g"""),
    "two_page_runs": (two_page_runs, f"WITH {RUNS} SELECT l_suppkey, first, last, n FROM r WHERE n >= 2"),
    "block_owner_asof": (block_owner_asof, """WITH b AS (SELECT CAST(n_nationkey % 5 AS BIGINT) AS zone, CAST(n_nationkey AS BIGINT) * 60 AS since, n_name FROM nation)
SELECT o_orderkey, o_custkey, (SELECT max_by(n_name, since) FROM b WHERE b.zone = o_custkey % 5 AND b.since <= o_custkey) AS owner FROM orders"""),
    "last_amount_above": (last_amount_above, f"""WITH {U}, a AS (SELECT *, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id, unit ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS amount_row FROM u)
SELECT event_id, user_id, unit, amount_row FROM a WHERE event_type = 'click'"""),
    "unit_branches": (unit_branches, f"""WITH {U}, n AS (SELECT user_id, unit, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS amounts, count(CASE WHEN event_type = 'click' THEN 1 END) AS items FROM u GROUP BY user_id, unit)
SELECT *, CASE WHEN amounts = 0 AND items = 0 THEN 'empty' WHEN amounts = 0 THEN 'implied' WHEN amounts > items THEN 'copied' WHEN amounts = items THEN 'paired' ELSE 'last_above' END AS branch FROM n"""),
    "subtotal_scope_sums": (subtotal_scope_sums, f"WITH {SEG} SELECT user_id, segment, CAST(coalesce(sum(CASE WHEN event_type <> 'purchase' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS scope_sum, max(CASE WHEN event_type = 'purchase' THEN value END) AS printed FROM s GROUP BY user_id, segment"),
    "running_total_check": (running_total_check, f"WITH r AS (SELECT *, CAST(coalesce(sum(CASE WHEN event_type <> 'error' THEN CAST(value AS DECIMAL(18,2)) END) OVER {OVER}, 0) AS DOUBLE) AS so_far FROM events) SELECT event_id, user_id, value AS printed, so_far FROM r WHERE event_type = 'error'"),
    "group_heading_emission": (group_heading_emission, "WITH l AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM events) SELECT event_id, user_id, CASE WHEN was IS DISTINCT FROM event_type THEN event_type END AS heading FROM l"),
    "repeated_key_ratio": (repeated_key_ratio, "WITH l AS (SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS was FROM orders) SELECT o_custkey, count(*) AS n, avg(CASE WHEN was <> o_orderpriority THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS change_ratio FROM l WHERE was IS NOT NULL GROUP BY o_custkey"),
    "cluster_positions": (cluster_positions, """WITH d AS (SELECT DISTINCT l_suppkey, l_extendedprice AS p FROM lineitem),
c AS (SELECT *, CASE WHEN p - lag(p) OVER (PARTITION BY l_suppkey ORDER BY p) > 50.0 THEN 1 ELSE 0 END AS cut FROM d),
k AS (SELECT *, CAST(sum(cut) OVER (PARTITION BY l_suppkey ORDER BY p) AS BIGINT) AS cluster FROM c)
SELECT l_suppkey, cluster, count(*) AS n, min(p) AS lo, max(p) AS hi FROM k GROUP BY l_suppkey, cluster"""),
    "band_fold": (band_fold, """WITH RECURSIVE x AS (SELECT l_orderkey AS k, l_extendedprice AS v FROM lineitem), b(k, head) AS (SELECT k, min(v) FROM x GROUP BY k UNION ALL SELECT x.k, min(x.v) FROM b JOIN x ON x.k = b.k AND x.v - b.head > 5000.0 GROUP BY x.k, b.head),
n AS (SELECT k, head, lead(head) OVER (PARTITION BY k ORDER BY head) AS nxt FROM b)
SELECT n.k AS l_orderkey, head, count(*) AS n FROM n JOIN x ON x.k = n.k AND v >= head AND (nxt IS NULL OR v < nxt) GROUP BY 1, 2"""),
    "span_pipeline": (span_pipeline, """WITH x AS (SELECT l_suppkey AS volume, l_returnflag || l_linestatus AS code, l_partkey AS page, CASE WHEN l_linenumber = 1 THEN 1 WHEN l_linenumber <= 3 THEN 2 ELSE 3 END AS r FROM lineitem),
i AS (SELECT *, page - dense_rank() OVER (PARTITION BY volume, code ORDER BY page) AS g FROM x WHERE r = 3),
k AS (SELECT volume, code, page, r FROM (SELECT *, max(page) OVER w - min(page) OVER w + 1 AS n FROM i WINDOW w AS (PARTITION BY volume, code, g)) WHERE n >= 2),
h AS (SELECT volume, code, page, r FROM x WHERE r < 3 UNION ALL SELECT * FROM k),
f AS (SELECT volume, code, page AS start, CASE r WHEN 1 THEN 'title' WHEN 2 THEN 'header' ELSE 'inline' END AS evidence FROM h QUALIFY row_number() OVER (PARTITION BY volume, code ORDER BY r, page) = 1),
s AS (SELECT volume, code, least(max(page), 100) AS last_seen FROM h GROUP BY volume, code), p AS (SELECT volume, max(page) AS last_page FROM x GROUP BY volume),
e AS (SELECT f.*, last_seen, greatest(start, coalesce(lead(start) OVER (PARTITION BY f.volume ORDER BY start, f.code) - 1, last_page)) AS end0, CASE WHEN s_nationkey * 40 > start THEN CAST(s_nationkey * 40 AS BIGINT) END AS wall
  FROM f JOIN s ON f.volume = s.volume AND f.code = s.code JOIN p ON f.volume = p.volume LEFT JOIN supplier ON s_suppkey = f.volume),
e1 AS (SELECT *, CASE WHEN wall <= end0 THEN wall - 1 ELSE end0 END AS end1 FROM e)
SELECT volume, code, start, evidence, end0, end1, greatest(end1, coalesce(last_seen, start)) AS end2 FROM e1"""),
    "page_cells": (page_cells, """WITH w AS (SELECT item_id, unnest(string_split(text, ' ')) AS t, unnest(range(0, len(string_split(text, ' ')))) AS k FROM benchmark)
SELECT item_id, CAST(dense_rank() OVER (PARTITION BY item_id ORDER BY k // 6) - 1 AS BIGINT) AS band, row_number() OVER (PARTITION BY item_id, k // 6 ORDER BY k) - 1 AS "column", t AS cell FROM w WHERE t <> ''"""),
    "cumulative_share": (cumulative_share, """WITH s AS (SELECT s_suppkey, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)) AS v FROM supplier)
SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY v DESC, s_suppkey) AS place,
  CAST(sum(v) OVER (PARTITION BY s_nationkey ORDER BY v DESC, s_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running,
  CAST(sum(v) OVER (PARTITION BY s_nationkey) AS DOUBLE) AS total FROM s"""),
}
