"""Queries of votes, precedence, joins, accounts and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.numbers import money, status
from pagelake.operators import account, checks, match, ordered, sets
from pagelake.operators.query import source_link
from pagelake.sources.sinks import provenance
from pagelake.sources.tables import table


def reconcile_orders(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: every order's printed total against the sum of its lines."""
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(money(F.col("l_extendedprice"))).alias("computed"))
    orders = table(spark, d, "orders").select("o_orderkey", money(F.col("o_totalprice")).alias("printed"))
    out = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    return out.select("o_orderkey", F.col("printed").cast("double").alias("printed"), F.col("computed").cast("double").alias("computed"), status(F.col("printed"), F.col("computed")).alias("status"))


def rule_sum_by_flag(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").select("l_returnflag", money(F.col("l_extendedprice")).alias("v"), F.expr("CASE WHEN l_discount > 0.05 THEN l_discount END").alias("own"), F.expr("CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END").alias("euro"), "l_linenumber")
    rule = checks.rule_sum("euro", unless="own", when="l_linenumber = 1", instead="v")
    return x.groupBy("l_returnflag").agg(F.sum(F.expr(rule)).cast("double").alias("amount"), F.count("*").alias("n"))


def majority_vote(spark: SparkSession, d: str) -> DataFrame:
    return sets.vote(table(spark, d, "customer"), ["c_nationkey"], "c_mktsegment")


def mode_offset(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "orders").select("o_orderpriority", (F.col("o_custkey") % 37 - F.col("o_orderkey") % 5).cast("bigint").alias("off"))
    n = x.groupBy("o_orderpriority", "off").agg(F.count("*").alias("n"))
    top = sets.first_in_group(n, ["o_orderpriority"], [F.desc("n"), "off"])
    total = n.groupBy("o_orderpriority").agg(F.sum("n").alias("rows_all"))
    return top.join(total, "o_orderpriority").select("o_orderpriority", "off", "n", (F.col("n") / F.col("rows_all")).alias("coverage"))


def constant_slot(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity").cast("bigint") % 3).alias("q"))
    return sets.constant_slots(x.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("a"), F.col("q").alias("b")), ["l_orderkey"], "a", "b")


def modal_signature(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_brand", F.concat_ws("/", F.length("p_name"), "p_type").alias("signature"), "p_partkey")
    n = p.groupBy("p_brand", "signature").agg(F.count("*").alias("n"), F.min("p_partkey").alias("first_part"))
    out = sets.first_in_group(n, ["p_brand"], [F.desc("n"), "first_part"])
    return out.join(n.groupBy("p_brand").agg(F.count("*").alias("kinds")), "p_brand").select("p_brand", "signature", "n", "first_part", "kinds")


def ranked_union(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    a, b, e = c.filter("c_acctbal > 5000"), c.filter("c_mktsegment = 'BUILDING'"), c.filter("c_custkey % 3 = 0")
    return sets.ranked_union([a, b, e], ["c_custkey"], ["c_mktsegment"]).select("c_custkey", "c_mktsegment", "source_rank")


def override_union(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("bigint").alias("page"))
    s = table(spark, d, "supplier").select((F.col("s_suppkey") * 20).alias("k"), F.col("s_nationkey").cast("bigint").alias("page"))
    return sets.override(c, s, "k", "page")


def best_copy(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("content"), "source")
    rank = F.row_number().over(W.partitionBy("content").orderBy(F.col("source").asc_nulls_last(), "doc_id"))
    return x.withColumn("kept", rank == 1).select("doc_id", "content", "kept")


def duplicate_content(spark: SparkSession, d: str) -> DataFrame:
    return sets.duplicates(table(spark, d, "documents"), F.md5(F.coalesce("text", F.lit(""))), "doc_id")


def page_claims(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = account.claims(o, F.col("o_custkey"), F.col("o_custkey") + F.col("o_orderkey") % 4, "page")
    return c.groupBy("page").agg(F.count("*").alias("n_claims"), F.min("o_orderkey").alias("first_order"))


def unclaimed_runs(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "lineitem").select("l_linenumber", F.col("l_orderkey").alias("page")).distinct()
    claimed = table(spark, d, "orders").filter("o_orderkey % 3 = 0").select(F.explode(F.array(*[F.lit(k) for k in range(1, 8)])).alias("l_linenumber"), F.col("o_orderkey").alias("page"))
    return account.unclaimed(pages, claimed, ["l_linenumber"], "page")


def exactly_once_verdict(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = account.claims(o, F.col("o_custkey"), F.col("o_custkey") + F.col("o_orderkey") % 3 - 1, "page")
    pages = table(spark, d, "customer").select(F.col("c_custkey").alias("page"))
    return account.exactly_once(pages, c, "page")


def kth_with_kth(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type", F.to_date("ts").alias("day"))
    a = e.filter("event_type = 'purchase'").select("user_id", "day", F.col("event_id").alias("amount_row"))
    b = e.filter("event_type = 'click'").select("user_id", "day", F.col("event_id").alias("item_row"))
    out = match.kth_with_kth(a, b, ["user_id", "day"], ["amount_row"], ["item_row"])
    return out.select("user_id", F.col("day").cast("string").alias("day"), "k", "amount_row", "item_row")


def summary_vs_detail(spark: SparkSession, d: str) -> DataFrame:
    detail = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum(money(F.col("o_totalprice"))).alias("computed"))
    summary = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), money(F.col("c_acctbal")).alias("printed"))
    out = checks.summary_against_detail(summary, detail, "o_custkey", "printed", "computed")
    return out.select("o_custkey", F.col("printed").cast("double").alias("printed"), F.col("computed").cast("double").alias("computed"), "status")


def prefix_or_compact_match(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.concat(F.lit("Firm "), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.col("c_custkey"), F.lit("."))).when(F.col("c_custkey") % 3 == 1, F.concat(F.col("c_custkey"), F.lit(" S.p.A."))).otherwise(F.col("c_custkey").cast("string"))).alias("name"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("Firm "), F.col("s_suppkey") * 2, F.when(F.col("s_suppkey") % 5 == 0, " S.p.A. Roma").otherwise("")).alias("name"))
    return match.match_names(c, s, "name")


def near_code_join(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.concat(F.upper(F.substring("p_type", 1, 1)), F.col("p_size"), F.when(F.col("p_partkey") % 2 == 0, F.upper(F.substring("p_name", 1, 1))).otherwise("")).alias("code"))
    return match.near_codes(p, "code")


def unpivot_measures(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("balance"), F.col("s_nationkey").cast("double").alias("nation"))
    return s.unpivot("s_suppkey", ["balance", "nation"], "measure", "value")


def pivot_flags(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").withColumn("year", F.year("l_shipdate").cast("bigint"))
    p = x.groupBy("year").pivot("l_returnflag", ["A", "N", "R"]).agg(F.count(F.lit(1)))
    return p.select("year", *[F.coalesce(F.col(c), F.lit(0)).alias(f"n_{c.lower()}") for c in ("A", "N", "R")])


def top_customers(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum(money(F.col("o_totalprice"))).alias("v"), F.count("*").alias("n"))
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    top = o.orderBy(F.desc("v"), "o_custkey").limit(15)  # before the join, so that only 15 rows are joined
    return top.join(c, top.o_custkey == c.c_custkey).select("c_custkey", "c_name", F.col("v").cast("double").alias("total"), "n")


def left_join_pair(spark: SparkSession, d: str) -> DataFrame:
    n = lambda c: F.upper(F.trim(F.regexp_replace(c, "^[A-Za-z]+#", "")))
    c = table(spark, d, "customer").select("c_custkey", n(F.col("c_name")).alias("k"), "c_acctbal")
    s = table(spark, d, "supplier").filter("s_acctbal > 0").select("s_suppkey", n(F.col("s_name")).alias("k2"), "s_acctbal")
    return c.join(s, F.col("k") == F.col("k2"), "left").select("c_custkey", "s_suppkey", (F.col("c_acctbal") > F.col("s_acctbal")).alias("more"))


def status_matrix(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.groupBy("o_orderpriority").agg(*[F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s.lower()}") for s in "FOP"], F.count("*").alias("n"))


def full_outer_shape_diff(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.year("o_orderdate").alias("y"), "o_custkey", "o_orderpriority")
    year = lambda y: o.filter(F.col("y") == y).groupBy("o_custkey").agg(F.max("o_orderpriority").alias("shape"))
    return sets.shape_diff(year(1996), year(1997), ["o_custkey"], "shape").select("o_custkey", "old", "new", "change")


def set_difference_codes(spark: SparkSession, d: str) -> DataFrame:
    c, o = table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return c.join(o, "c_custkey", "left_anti")


def set_symmetric_codes(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderstatus")
    return sets.symmetric_difference(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'P'"), "o_custkey")


def verdict_fold(spark: SparkSession, d: str) -> DataFrame:
    v = F.when(F.col("o_orderkey") % 97 == 0, "FAIL").when(F.col("o_orderkey") % 11 == 0, "WARN").when(F.col("o_orderkey") % 2 == 0, "SKIP").otherwise("PASS")
    o = table(spark, d, "orders").select("o_custkey", v.alias("verdict"))
    return o.groupBy("o_custkey").agg(checks.fold(F.col("verdict")).alias("verdict"), F.count("*").alias("n"))


def mutation_detect(spark: SparkSession, d: str) -> DataFrame:
    """Every mutation of the lines must flip the check of the orders it touches."""
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", money(F.col("l_extendedprice")).alias("v"))
    true = x.groupBy("l_orderkey").agg(F.sum("v").alias("printed"))
    hit = (F.col("l_orderkey") % 50 == 0) & (F.col("l_linenumber") == 1)
    broken = {"drop_row": checks.drop_row(x, hit), "wrong_value": checks.wrong_value(x, hit, "v", F.lit(1).cast("decimal(18,2)")), "twice": checks.twice(x, hit)}
    parts = []
    for name, b in broken.items():
        s = b.groupBy("l_orderkey").agg(F.sum("v").alias("computed"))
        state = true.join(s, "l_orderkey", "left").select(F.lit(name).alias("mutation"), status(F.col("printed"), F.col("computed")).alias("status"))
        parts.append(state.groupBy("mutation", "status").agg(F.count("*").alias("n")))
    return checks.verdicts(parts)


def json_provenance(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "event_type", F.from_json("props", "k INT").alias("p"))
    record = provenance(F.col("event_type").alias("kind"), F.col("p.k").alias("page"))
    return e.select("event_id", F.get_json_object(record, "$.page").cast("bigint").alias("page"), F.get_json_object(record, "$.kind").alias("kind"))


def provenance_lookup(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("https://example.org/"), F.regexp_replace("c_name", "#", "-"), F.lit(".pdf")).alias("url"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", source_link(F.col("url"), F.col("o_orderkey") % 500).alias("link"))


def null_safe_lookup(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("article"))
    names = o.groupBy("article").agg(F.count("*").alias("n"))
    return o.alias("o").join(names.alias("k"), F.col("o.article").eqNullSafe(F.col("k.article"))).select("o_orderkey", F.col("o.article").alias("article"), "n")


def row_reference_join(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "event_type", "value", "user_id")
    items = e.filter("event_type = 'click'").withColumn("ref", F.col("event_id") - F.col("event_id") % 7)
    amounts = e.select(F.col("event_id").alias("ref"), F.col("value").alias("amount"), F.col("user_id").alias("opener"))
    users = e.groupBy("user_id").agg(F.min("event_id").alias("first_row")).withColumnRenamed("user_id", "opener")
    return items.join(amounts, "ref", "left").join(users, "opener", "left").select("event_id", "ref", "amount", "first_row")


def year_list(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").cast("string").alias("y"))
    return o.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_set("y")), ",").alias("years"))


def first_row_of_group(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order"), F.min_by("o_orderpriority", "o_orderkey").alias("priority"), F.min_by("o_totalprice", "o_orderkey").alias("price"))


def rebuild_cells(spark: SparkSession, d: str) -> DataFrame:
    """Printed figures, one row a cell, and back to rows of cells."""
    x = table(spark, d, "supplier").select("s_suppkey", F.array("s_name", F.col("s_nationkey").cast("string"), F.when(F.col("s_acctbal") > 0, "+").otherwise("")).alias("cells"))
    figures = x.select("s_suppkey", F.posexplode("cells").alias("ordinal", "text")).filter("text <> ''")
    return figures.groupBy("s_suppkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "text"))), lambda c: c["text"]), "|").alias("printed"), F.count("*").alias("n_cells"))


def continuation_merge(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    e = e.withColumn("record", ordered.running_unit(F.col("event_type") != "error", ["user_id"], ["ts", "event_id"]))
    return e.groupBy("user_id", "record").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))), lambda c: c["event_type"]), " ").alias("text"))


STATUS = "CASE WHEN computed IS NULL OR printed IS NULL THEN 'UNCHECKED' WHEN abs(printed - computed) = 0 THEN 'PASS' WHEN abs(printed - computed) <= 0.02 THEN 'ROUNDING' ELSE 'FAIL' END"

QUERIES = {
    "reconcile_orders": (reconcile_orders, f"""WITH l AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS computed FROM lineitem GROUP BY l_orderkey),
j AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS printed, computed FROM orders LEFT JOIN l ON o_orderkey = l_orderkey)
SELECT o_orderkey, CAST(printed AS DOUBLE) AS printed, CAST(computed AS DOUBLE) AS computed, {STATUS} AS status FROM j"""),
    "rule_sum_by_flag": (rule_sum_by_flag, """SELECT l_returnflag, CAST(sum(CASE WHEN l_discount > 0.05 THEN 0 WHEN l_linestatus = 'F' OR l_linenumber = 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS amount, count(*) AS n FROM lineitem GROUP BY l_returnflag"""),
    "majority_vote": (majority_vote, "WITH n AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL) SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) = 1"),
    "mode_offset": (mode_offset, """WITH n AS (SELECT o_orderpriority, o_custkey % 37 - o_orderkey % 5 AS off, count(*) AS n FROM orders GROUP BY ALL), t AS (SELECT *, sum(n) OVER (PARTITION BY o_orderpriority) AS a, row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, off) AS r FROM n)
SELECT o_orderpriority, off, n, n / CAST(a AS DOUBLE) AS coverage FROM t WHERE r = 1"""),
    "constant_slot": (constant_slot, """WITH x AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS a, CAST(l_quantity AS BIGINT) % 3 AS b FROM lineitem),
g AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT a) AS da, count(DISTINCT b) AS db, min(a) AS ma, min(b) AS mb FROM x GROUP BY l_orderkey)
SELECT l_orderkey, n, CASE WHEN n >= 2 AND da = 1 AND db > 1 THEN 'a' WHEN n >= 2 AND db = 1 AND da > 1 THEN 'b' END AS slot, CASE WHEN n >= 2 AND da = 1 AND db > 1 THEN ma WHEN n >= 2 AND db = 1 AND da > 1 THEN mb END AS total FROM g"""),
    "modal_signature": (modal_signature, """WITH n AS (SELECT p_brand, length(p_name) || '/' || p_type AS signature, count(*) AS n, min(p_partkey) AS first_part FROM part GROUP BY ALL)
SELECT p_brand, signature, n, first_part, kinds FROM (SELECT *, count(*) OVER (PARTITION BY p_brand) AS kinds, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, first_part) AS r FROM n) WHERE r = 1"""),
    "ranked_union": (ranked_union, """WITH u AS (SELECT c_custkey, c_mktsegment, 1::BIGINT AS source_rank FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT c_custkey, c_mktsegment, 2 FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT c_custkey, c_mktsegment, 3 FROM customer WHERE c_custkey % 3 = 0)
SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY source_rank, c_mktsegment) = 1"""),
    "override_union": (override_union, """WITH b AS (SELECT c_custkey AS k, CAST(c_nationkey AS BIGINT) AS page FROM customer), a AS (SELECT s_suppkey * 20 AS k, CAST(s_nationkey AS BIGINT) AS page FROM supplier)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.page, b.page) AS page, CASE WHEN a.k IS NULL THEN 'base' WHEN b.k IS NULL THEN 'added' ELSE 'overridden' END AS origin FROM b FULL JOIN a ON a.k = b.k"""),
    "best_copy": (best_copy, "SELECT doc_id, md5(coalesce(text, '')) AS content, row_number() OVER (PARTITION BY md5(coalesce(text, '')) ORDER BY source ASC NULLS LAST, doc_id) = 1 AS kept FROM documents"),
    "duplicate_content": (duplicate_content, "SELECT md5(coalesce(text, '')) AS content, count(*) AS n, min(doc_id) AS first_key, max(doc_id) AS last_key FROM documents GROUP BY 1 HAVING count(*) > 1"),
    "page_claims": (page_claims, "WITH c AS (SELECT o_orderkey, unnest(range(o_custkey, o_custkey + o_orderkey % 4 + 1)) AS page FROM orders) SELECT page, count(*) AS n_claims, min(o_orderkey) AS first_order FROM c GROUP BY page"),
    "unclaimed_runs": (unclaimed_runs, """WITH d AS (SELECT DISTINCT l_linenumber, l_orderkey AS p FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0)),
i AS (SELECT *, p - row_number() OVER (PARTITION BY l_linenumber ORDER BY p) AS g FROM d)
SELECT l_linenumber, min(p) AS first, max(p) AS last, count(*) AS n FROM i GROUP BY l_linenumber, g"""),
    "exactly_once_verdict": (exactly_once_verdict, """WITH c AS (SELECT unnest(range(o_custkey, o_custkey + o_orderkey % 3)) AS page FROM orders), n AS (SELECT page, count(*) AS n FROM c GROUP BY page)
SELECT c_custkey AS page, coalesce(n, 0) AS n_claims, CASE WHEN n = 1 THEN 'ok' WHEN n IS NULL THEN 'lost' ELSE 'double' END AS verdict FROM customer LEFT JOIN n ON page = c_custkey"""),
    "kth_with_kth": (kth_with_kth, """WITH e AS (SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type FROM events),
a AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY event_id) AS k, count(*) OVER (PARTITION BY user_id, day) AS n FROM e WHERE event_type = 'purchase'),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY event_id) AS k, count(*) OVER (PARTITION BY user_id, day) AS n FROM e WHERE event_type = 'click')
SELECT a.user_id, a.day, a.k, a.event_id AS amount_row, b.event_id AS item_row FROM a JOIN b ON a.user_id = b.user_id AND a.day = b.day AND a.k = b.k AND a.n = b.n"""),
    "summary_vs_detail": (summary_vs_detail, f"""WITH d AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS computed FROM orders GROUP BY o_custkey),
j AS (SELECT coalesce(c_custkey, o_custkey) AS o_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS printed, computed FROM customer FULL JOIN d ON c_custkey = o_custkey)
SELECT o_custkey, CAST(printed AS DOUBLE) AS printed, CAST(computed AS DOUBLE) AS computed, CASE WHEN printed IS NULL OR computed IS NULL THEN 'FAIL' ELSE {STATUS} END AS status FROM j"""),
    "prefix_or_compact_match": (prefix_or_compact_match, """WITH a AS (SELECT DISTINCT 'Firm ' || CASE c_custkey % 3 WHEN 0 THEN c_custkey || '.' WHEN 1 THEN c_custkey || ' S.p.A.' ELSE c_custkey || '' END AS a FROM customer),
b AS (SELECT DISTINCT 'Firm ' || s_suppkey * 2 || CASE WHEN s_suppkey % 5 = 0 THEN ' S.p.A. Roma' ELSE '' END AS b FROM supplier),
x AS (SELECT a, b, 'exact' AS level FROM a JOIN b ON a = b),
ra AS (SELECT a FROM a WHERE a NOT IN (SELECT a FROM x)), rb AS (SELECT b FROM b WHERE b NOT IN (SELECT b FROM x)),
ca AS (SELECT a, unnest(list_transform(range(1, length(a) + 1), lambda n: substr(a, 1, n))) AS k FROM ra), cb AS (SELECT b, unnest(list_transform(range(1, length(b) + 1), lambda n: substr(b, 1, n))) AS k FROM rb),
p AS (SELECT a, b FROM ca JOIN rb ON k = b UNION SELECT a, b FROM cb JOIN ra ON k = a),
p1 AS (SELECT a, min(b) AS b, 'prefix' AS level FROM p GROUP BY a HAVING count(*) = 1),
k AS (SELECT regexp_replace(lower(b), '[^a-z0-9]', '', 'g') AS k, min(b) AS b FROM b GROUP BY 1 HAVING count(*) = 1),
c AS (SELECT a.a, k.b, 'compact' AS level FROM a JOIN k ON regexp_replace(lower(a.a), '[^a-z0-9]', '', 'g') = k.k WHERE a.a NOT IN (SELECT a FROM x) AND a.a NOT IN (SELECT a FROM p1)),
f AS (SELECT * FROM x UNION ALL SELECT * FROM p1 UNION ALL SELECT * FROM c)
SELECT a AS name, b AS match, level FROM f UNION ALL SELECT a, NULL, 'none' FROM a WHERE a NOT IN (SELECT a FROM f)"""),
    "near_code_join": (near_code_join, """WITH c AS (SELECT DISTINCT upper(substr(p_type, 1, 1)) || p_size || CASE WHEN p_partkey % 2 = 0 THEN upper(substr(p_name, 1, 1)) ELSE '' END AS code FROM part)
SELECT s.code AS short, l.code AS long FROM c s JOIN c l ON length(l.code) = length(s.code) + 1 AND starts_with(l.code, s.code) AND regexp_matches(l.code, '[A-Z]$') AND length(regexp_replace(l.code, '[^A-Za-z]', '', 'g')) >= 2"""),
    "unpivot_measures": (unpivot_measures, "SELECT s_suppkey, 'balance' AS measure, s_acctbal AS value FROM supplier UNION ALL SELECT s_suppkey, 'nation', CAST(s_nationkey AS DOUBLE) FROM supplier"),
    "pivot_flags": (pivot_flags, "SELECT year(l_shipdate) AS year, count(*) FILTER (l_returnflag = 'A') AS n_a, count(*) FILTER (l_returnflag = 'N') AS n_n, count(*) FILTER (l_returnflag = 'R') AS n_r FROM lineitem GROUP BY 1"),
    "top_customers": (top_customers, "SELECT c_custkey, c_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_name ORDER BY sum(CAST(o_totalprice AS DECIMAL(18,2))) DESC, c_custkey LIMIT 15"),
    "left_join_pair": (left_join_pair, "SELECT c_custkey, s_suppkey, c_acctbal > s_acctbal AS more FROM customer LEFT JOIN supplier ON upper(trim(regexp_replace(c_name, '^[A-Za-z]+#', ''))) = upper(trim(regexp_replace(s_name, '^[A-Za-z]+#', ''))) AND s_acctbal > 0"),
    "status_matrix": (status_matrix, "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'P') AS n_p, count(*) AS n FROM orders GROUP BY 1"),
    "full_outer_shape_diff": (full_outer_shape_diff, """WITH o AS (SELECT o_custkey, max(o_orderpriority) AS s FROM orders WHERE year(o_orderdate) = 1996 GROUP BY 1), n AS (SELECT o_custkey, max(o_orderpriority) AS s FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1)
SELECT coalesce(o.o_custkey, n.o_custkey) AS o_custkey, o.s AS old, n.s AS new, CASE WHEN o.o_custkey IS NULL THEN 'added' WHEN n.o_custkey IS NULL THEN 'dropped' WHEN o.s IS NOT DISTINCT FROM n.s THEN 'same' ELSE 'differs' END AS change FROM o FULL JOIN n ON o.o_custkey = n.o_custkey"""),
    "set_difference_codes": (set_difference_codes, "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')"),
    "set_symmetric_codes": (set_symmetric_codes, """WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P')
SELECT o_custkey, 'left' AS side FROM a WHERE o_custkey NOT IN (FROM b) UNION ALL SELECT o_custkey, 'right' FROM b WHERE o_custkey NOT IN (FROM a)"""),
    "verdict_fold": (verdict_fold, """WITH v AS (SELECT o_custkey, CASE WHEN o_orderkey % 97 = 0 THEN 3 WHEN o_orderkey % 11 = 0 THEN 2 WHEN o_orderkey % 2 = 0 THEN 0 ELSE 1 END AS r FROM orders)
SELECT o_custkey, CASE max(r) WHEN 3 THEN 'FAIL' WHEN 2 THEN 'WARN' WHEN 1 THEN 'PASS' ELSE 'SKIP' END AS verdict, count(*) AS n FROM v GROUP BY o_custkey"""),
    "mutation_detect": (mutation_detect, f"""WITH x AS (SELECT l_orderkey, l_orderkey % 50 = 0 AND l_linenumber = 1 AS hit, CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem),
g AS (SELECT l_orderkey, sum(v) AS printed, sum(CASE WHEN NOT hit THEN v END) AS dropped, sum(CASE WHEN hit THEN v + 1 ELSE v END) AS wrong, sum(CASE WHEN hit THEN 2 * v ELSE v END) AS twice FROM x GROUP BY l_orderkey),
m AS (SELECT 'drop_row' AS mutation, printed, dropped AS computed FROM g UNION ALL SELECT 'wrong_value', printed, wrong FROM g UNION ALL SELECT 'twice', printed, twice FROM g)
SELECT mutation, {STATUS} AS status, count(*) AS n FROM m GROUP BY 1, 2"""),
    "json_provenance": (json_provenance, "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS page, event_type AS kind FROM events"),
    "provenance_lookup": (provenance_lookup, "SELECT o_orderkey, 'https://example.org/' || replace(c_name, '#', '-') || '.pdf#page=' || (o_orderkey % 500) AS link FROM orders JOIN customer ON o_custkey = c_custkey"),
    "null_safe_lookup": (null_safe_lookup, """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS article FROM orders), n AS (SELECT article, count(*) AS n FROM o GROUP BY article)
SELECT o.o_orderkey, o.article, n.n FROM o JOIN n ON o.article IS NOT DISTINCT FROM n.article"""),
    "row_reference_join": (row_reference_join, """WITH u AS (SELECT user_id, min(event_id) AS first_row FROM events GROUP BY user_id)
SELECT i.event_id, i.event_id - i.event_id % 7 AS ref, a.value AS amount, u.first_row FROM events i LEFT JOIN events a ON a.event_id = i.event_id - i.event_id % 7 LEFT JOIN u ON u.user_id = a.user_id WHERE i.event_type = 'click'"""),
    "year_list": (year_list, "SELECT o_custkey, string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ',' ORDER BY CAST(year(o_orderdate) AS VARCHAR)) AS years FROM orders GROUP BY o_custkey"),
    "first_row_of_group": (first_row_of_group, "SELECT o_custkey, min(o_orderkey) AS first_order, min_by(o_orderpriority, o_orderkey) AS priority, min_by(o_totalprice, o_orderkey) AS price FROM orders GROUP BY o_custkey"),
    "rebuild_cells": (rebuild_cells, "SELECT s_suppkey, s_name || '|' || s_nationkey || CASE WHEN s_acctbal > 0 THEN '|+' ELSE '' END AS printed, CAST(CASE WHEN s_acctbal > 0 THEN 3 ELSE 2 END AS BIGINT) AS n_cells FROM supplier"),
    "continuation_merge": (continuation_merge, """WITH r AS (SELECT *, count(CASE WHEN event_type <> 'error' THEN 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS record FROM events)
SELECT user_id, record, string_agg(event_type, ' ' ORDER BY ts, event_id) AS text FROM r GROUP BY user_id, record"""),
}
