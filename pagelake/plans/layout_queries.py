"""Queries of page geometry, of the catalogue's shapes, and of small operators on facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.functions.numbers import money
from pagelake.functions.text import deaccent, decode, undecoded
from pagelake.operators import catalog, detect, extract, geometry, query, verify
from pagelake.plans.made import dealt, told
from pagelake.sources import sinks
from pagelake.sources.tables import table

C = F.col


def _words(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each supplier as words of its page; those of every fifth supplier run upwards, some words of others do."""
    x = table(spark, d, "lineitem")
    up = (C("l_suppkey") % 5 == 0) != (C("l_linenumber") == 7)
    n, m = (C("l_partkey") % 60).cast("double"), (C("l_linenumber") * 10).cast("double")
    return x.select("l_suppkey", F.col("l_returnflag").alias("text"), F.when(up, 0.0).otherwise(1.0).alias("dir_x"), F.when(up, -1.0).otherwise(0.0).alias("dir_y"), n.alias("x0"), m.alias("y0"), (n + 5).alias("x1"), (m + 9).alias("y1"))


def main_direction(spark: SparkSession, d: str) -> DataFrame:
    return geometry.dominant_direction(_words(spark, d), ["l_suppkey"])


def reading_space(spark: SparkSession, d: str) -> DataFrame:
    r = geometry.to_reading_space(_words(spark, d))
    return r.groupBy("l_suppkey").agg(F.min("u0").alias("u0"), F.max("u1").alias("u1"), F.min("v0").alias("v0"), F.max("v1").alias("v1"))


SPACE_SQL = """WITH w AS (SELECT l_suppkey, (l_suppkey % 5 = 0) <> (l_linenumber = 7) AS up, CAST(l_partkey % 60 AS DOUBLE) AS x, CAST(l_linenumber * 10 AS DOUBLE) AS y FROM lineitem)
SELECT l_suppkey, min(CASE WHEN up THEN -(y + 9) ELSE x END) AS u0, max(CASE WHEN up THEN -y ELSE x + 5 END) AS u1, min(CASE WHEN up THEN x ELSE y END) AS v0, max(CASE WHEN up THEN x + 5 ELSE y + 9 END) AS v1 FROM w GROUP BY 1"""


def _rules(spark: SparkSession, d: str) -> DataFrame:
    """Parts as drawings of their brand's page: boxes with strokes, thin boxes, filled ones."""
    n = (C("p_partkey") % 40 * 10).cast("double")
    kind = C("p_partkey") % 4
    w, h = F.when(kind == 1, 1.0).otherwise((C("p_size") * 2).cast("double")), F.when(kind == 2, 1.5).otherwise(30.0)
    return table(spark, d, "part").select("p_brand", n.alias("x0"), (n / 2).alias("y0"), (n + w).alias("x1"), (n / 2 + h).alias("y1"), (kind == 0).alias("stroked"))


def drawn_rules(spark: SparkSession, d: str) -> DataFrame:
    s = geometry.rule_segments(_rules(spark, d), ["p_brand"])
    return s.groupBy("p_brand", "kind").agg(F.count("*").alias("n"), F.sum("pos").alias("at"), F.sum(C("hi") - C("lo")).alias("length"))


RULES_SQL = """WITH r AS (SELECT p_brand, CAST(p_partkey % 40 * 10 AS DOUBLE) AS x, CAST(p_partkey % 40 * 5 AS DOUBLE) AS y, p_partkey % 4 AS k, CASE WHEN p_partkey % 4 = 1 THEN 1.0 ELSE p_size * 2 END AS w, CASE WHEN p_partkey % 4 = 2 THEN 1.5 ELSE 30.0 END AS h FROM part),
e AS (SELECT p_brand, 'wall' AS kind, x AS pos, h AS len FROM r WHERE (k = 0 AND least(w, h) > 2) OR (least(w, h) <= 2 AND w <= h) UNION ALL SELECT p_brand, 'wall', x + w, h FROM r WHERE k = 0 AND least(w, h) > 2
  UNION ALL SELECT p_brand, 'floor', y, w FROM r WHERE (k = 0 AND least(w, h) > 2) OR (least(w, h) <= 2 AND w > h) UNION ALL SELECT p_brand, 'floor', y + h, w FROM r WHERE k = 0 AND least(w, h) > 2)
SELECT p_brand, kind, count(*) AS n, CAST(sum(pos) AS DOUBLE) AS at, CAST(sum(len) AS DOUBLE) AS length FROM e WHERE len >= 4 GROUP BY 1, 2"""


def ruled_columns(spark: SparkSession, d: str) -> DataFrame:
    """Walls to separators to columns."""
    s = geometry.rule_segments(_rules(spark, d), ["p_brand"])
    return geometry.columns_between(geometry.separators(s, ["p_brand"]), ["p_brand"])


COLUMNS_SQL = """WITH r AS (SELECT p_brand, CAST(p_partkey % 40 * 10 AS DOUBLE) AS x, p_partkey % 4 AS k, CASE WHEN p_partkey % 4 = 1 THEN 1.0 ELSE p_size * 2 END AS w, CASE WHEN p_partkey % 4 = 2 THEN 1.5 ELSE 30.0 END AS h FROM part),
e AS (SELECT p_brand, x AS pos FROM r WHERE h >= 4 AND ((k = 0 AND least(w, h) > 2) OR (least(w, h) <= 2 AND w <= h)) UNION ALL SELECT p_brand, x + w FROM r WHERE h >= 4 AND k = 0 AND least(w, h) > 2),
c AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY p_brand ORDER BY pos) > 3 THEN 1 ELSE 0 END AS cut FROM e), g AS (SELECT *, sum(cut) OVER (PARTITION BY p_brand ORDER BY pos) AS c FROM c), m AS (SELECT p_brand, round(avg(pos), 1) AS pos FROM g GROUP BY p_brand, c),
l AS (SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY pos) AS ordinal, CAST(pos AS DOUBLE) AS lo, CAST(lead(pos) OVER (PARTITION BY p_brand ORDER BY pos) AS DOUBLE) AS hi FROM m) SELECT * FROM l WHERE hi IS NOT NULL"""


def joined_floors(spark: SparkSession, d: str) -> DataFrame:
    """Floors of each brand's page, joined to levels; a level's head may gather floors that are far from each other's end."""
    f = table(spark, d, "part").select("p_brand", F.lit("floor").alias("kind"), (C("p_partkey") % 97 * 1.5).alias("pos"), C("p_size").cast("double").alias("lo"), (C("p_size") + 9).cast("double").alias("hi"))
    return geometry.join_floors(f, ["p_brand"])


FLOORS_SQL = """WITH RECURSIVE f AS (SELECT p_brand, p_partkey % 97 * 1.5 AS pos, p_size AS lo FROM part), h(p_brand, pos) AS (SELECT p_brand, min(pos) FROM f GROUP BY 1 UNION ALL SELECT f.p_brand, min(f.pos) FROM h JOIN f ON f.p_brand = h.p_brand AND f.pos - h.pos > 2.5 GROUP BY f.p_brand, h.pos),
n AS (SELECT p_brand, pos, lead(pos) OVER (PARTITION BY p_brand ORDER BY pos) AS nxt FROM h)
SELECT n.p_brand, CAST(n.pos AS DOUBLE) AS pos, CAST(min(lo) AS DOUBLE) AS lo, CAST(max(lo) + 9 AS DOUBLE) AS hi FROM n JOIN f ON f.p_brand = n.p_brand AND f.pos >= n.pos AND (nxt IS NULL OR f.pos < nxt) GROUP BY 1, 2"""


def words_in_columns(spark: SparkSession, d: str) -> DataFrame:
    """Words to the column that they overlap most, else the nearest."""
    w = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (C("l_suppkey") % 4).alias("page"), (C("l_partkey") % 400).cast("double").alias("u0"), (C("l_partkey") % 400 + C("l_linenumber") * 7).cast("double").alias("u1"))
    cols = table(spark, d, "region").filter("r_regionkey < 4").select(C("r_regionkey").alias("page")).withColumn("c", F.explode(F.array(*[F.struct(F.lit(k).cast("bigint").alias("ordinal"), F.lit(100.0 * k - 80).alias("lo"), F.lit(100.0 * k).alias("hi")) for k in (1, 2, 3)]))).select("page", "c.*")
    return geometry.place_in_columns(w, cols, ["page"]).groupBy("page", "column").agg(F.count("*").alias("n"))


PLACE_SQL = """WITH w AS (SELECT l_suppkey % 4 AS page, l_partkey % 400 AS a, l_partkey % 400 + l_linenumber * 7 AS z, row_number() OVER () AS id FROM lineitem), c AS (SELECT unnest([1, 2, 3]) AS k, unnest([20, 120, 220]) AS lo, unnest([100, 200, 300]) AS hi),
s AS (SELECT id, page, k, CASE WHEN least(z, hi) - greatest(a, lo) > 0.3 THEN least(z, hi) - greatest(a, lo) ELSE 0 END AS o, greatest(lo - z, a - hi, 0) AS gap FROM w, c)
SELECT page, k AS "column", count(*) AS n FROM (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY o DESC, gap, k) = 1) GROUP BY 1, 2"""


def column_signatures(spark: SparkSession, d: str) -> DataFrame:
    """Orders as sampled pages, their first lines' quantities as widths: the commonest tuple of each customer."""
    from pyspark.sql import Window as W

    x = table(spark, d, "lineitem").withColumn("ordinal", F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice"))).filter("ordinal <= 2")
    x = x.select((C("l_orderkey") % 40).alias("key"), C("l_orderkey").alias("page"), "ordinal", (F.floor(C("l_quantity") / 20) * 10 + 0.2).alias("width"))
    s = catalog.signatures(x)
    return s.select("key", F.array_join(F.transform("widths", lambda w: w.cast("int").cast("string")), ",").alias("widths"), "n", "first_page", "kinds", "stable")


SIGNATURE_SQL = """WITH x AS (SELECT l_orderkey % 40 AS key, l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) AS o, CAST(floor(l_quantity / 20) * 10 AS INT) AS w FROM lineitem),
t AS (SELECT key, page, string_agg(CAST(w AS VARCHAR), ',' ORDER BY o) AS widths, list(CAST(w AS DOUBLE) ORDER BY o) AS l FROM x WHERE o <= 2 GROUP BY 1, 2), n AS (SELECT key, widths, count(*) AS n, min(page) AS first_page FROM t GROUP BY 1, 2), k AS (SELECT *, count(*) OVER (PARTITION BY key) AS kinds, row_number() OVER (PARTITION BY key ORDER BY n DESC, first_page) AS r FROM n)
SELECT key, widths, n, first_page, kinds, kinds = 1 AS stable FROM k WHERE r = 1"""


def page_statistics(spark: SparkSession, d: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, ("legible", "garbled", "ciphered", "empty"))), (C("p_size") % 4 + 1).cast("int"))
    return catalog.page_stats(table(spark, d, "part").select(C("p_brand").alias("key"), C("p_partkey").alias("page"), kind.alias("status")))


def sampled_pages(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return n.select("n_nationkey", F.array_join(F.transform(catalog.sample_pages(C("n_nationkey"), C("n_nationkey") * 4 + 8, 5), lambda p: p.cast("string")), ",").alias("pages"))


def labels_by_year(spark: SparkSession, d: str) -> DataFrame:
    """Columns of two editions, compared by place with years relative to their own."""
    def side(year: int) -> DataFrame:
        label = F.when(C("p_size") % 3 == 0, F.concat(F.lit("Valore "), F.lit(year).cast("string"))).when(C("p_size") % 3 == 1, F.concat(F.lit("Anno "), F.lit(2024))).otherwise(C("p_type"))
        return table(spark, d, "part").filter(C("p_partkey") % 7 != year % 7).select(F.lit("MAE").alias("authority"), F.when(C("p_partkey") % 2 == 0, "A5").alias("article"), C("p_name").alias("code"), C("p_partkey").alias("ordinal"), label.alias("label"))

    out = catalog.year_diff(side(2024), side(2025), 2024, 2025)
    return out.groupBy("change").agg(F.count("*").alias("n"))


YEAR_SQL = """WITH p AS (SELECT p_partkey % 7 <> 2024 % 7 AS o, p_partkey % 7 <> 2025 % 7 AS n, p_size % 3 AS k FROM part)
SELECT CASE WHEN o AND n THEN CASE WHEN k = 1 THEN 'differs' ELSE 'same' END WHEN n THEN 'added' ELSE 'dropped' END AS change, count(*) AS n FROM p WHERE o OR n GROUP BY 1"""


def kept_spans(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "customer").select(F.floor(C("c_custkey") / 2).alias("key"), "c_custkey", (C("c_custkey") % 2 + 1).alias("volume"), (C("c_nationkey") % 2 + 1).alias("start"), (C("c_custkey") % 3 == 0).alias("to_end"), F.element_at(F.array(*map(F.lit, ("bookmark", "title", "header"))), (C("c_nationkey") % 3 + 1).cast("int")).alias("evidence"))
    return detect.keep_best(x, ["key"]).select("c_custkey", "kept")


SPANS_SQL = """WITH x AS (SELECT c_custkey // 2 AS key, c_custkey, c_custkey % 2 + 1 AS v, c_nationkey % 2 = 0 AS first, c_custkey % 3 = 0 AS e, c_nationkey % 3 AS r, c_nationkey % 2 + 1 AS s FROM customer),
c AS (SELECT *, row_number() OVER w = 1 OR coalesce(lag(e) OVER w AND v = lag(v) OVER w + 1 AND first, false) AS ch, row_number() OVER (PARTITION BY key ORDER BY r, e, v, s) AS place FROM x WINDOW w AS (PARTITION BY key ORDER BY v))
SELECT c_custkey, bool_and(ch) OVER (PARTITION BY key) OR place = 1 AS kept FROM c"""


def explained_gaps(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(C("l_suppkey").alias("t"), C("l_orderkey").alias("row_ord"), money(C("l_extendedprice")).alias("value"))
    gaps = rows.groupBy("t").agg(F.max("value").alias("gap")).withColumn("gap", (C("gap") + F.when(C("t") % 2 == 0, 0).otherwise(F.lit("0.01").cast("decimal(4,2)"))).cast("decimal(19,2)"))
    return verify.explain_gap(rows, gaps, ["t"]).select("t", "row_ord")


def listed_late(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    key = [(C("c_nationkey") % 4).alias("volume"), C("c_custkey").alias("key")]
    return verify.against_index(c.filter("c_custkey % 9 > 0").select(*key, (C("c_custkey") * 37 % 101).alias("page")), c.filter("c_custkey % 8 > 0").select(*key, C("c_custkey").alias("page"))).select("key", "verdict")


LATE_SQL = """WITH c AS (SELECT c_nationkey % 4 AS v, c_custkey AS k, CASE WHEN c_custkey % 9 > 0 THEN c_custkey * 37 % 101 END AS seen, CASE WHEN c_custkey % 8 > 0 THEN c_custkey END AS due FROM customer), b AS (SELECT *, lead(seen) OVER (PARTITION BY v ORDER BY due NULLS FIRST, k) AS nxt FROM c WHERE seen IS NOT NULL OR due IS NOT NULL)
SELECT k AS key, CASE WHEN seen IS NULL OR due IS NULL THEN 'FAIL' WHEN nxt < seen THEN 'WARN' ELSE 'PASS' END AS verdict FROM b"""


def year_columns(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "orders").select("o_orderkey", F.when(C("o_orderkey") % 2 == 0, C("o_totalprice")).alias("2024"), F.when(C("o_orderkey") % 3 == 0, C("o_totalprice") + 1).alias("2025"))
    return extract.unpivot_years(x, ["o_orderkey"], [2024, 2025]).withColumn("anno", C("anno").cast("bigint"))


def upserted(spark: SparkSession, d: str) -> DataFrame:
    """New rows take the place of old ones of the same key; a missing article is a key like others."""
    c = table(spark, d, "customer")
    art = F.when(C("c_nationkey") % 3 > 0, C("c_nationkey").cast("string"))
    old = c.select((C("c_custkey") % 50).alias("code"), art.alias("article"), C("c_custkey").alias("v")).groupBy("code", "article").agg(F.max("v").alias("v"))
    new = c.filter("c_custkey % 4 = 0").select((C("c_custkey") % 50).alias("code"), art.alias("article"), (-C("c_custkey")).alias("v")).groupBy("code", "article").agg(F.max("v").alias("v"))
    return sinks.upsert(old, new, ["code", "article"])


UPSERT_SQL = """WITH c AS (SELECT c_custkey % 50 AS code, CASE WHEN c_nationkey % 3 > 0 THEN CAST(c_nationkey AS VARCHAR) END AS article, c_custkey AS v FROM customer), o AS (SELECT code, article, max(v) AS v FROM c GROUP BY 1, 2), n AS (SELECT code, article, max(-v) AS v FROM c WHERE v % 4 = 0 GROUP BY 1, 2)
SELECT o.code, o.article, coalesce(n.v, o.v) AS v FROM o LEFT JOIN n ON n.code = o.code AND n.article IS NOT DISTINCT FROM o.article"""


def data_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return query.dictionary(table(spark, d, "nation").select("n_nationkey", "n_name"), "nation").select("table_name", C("ordinal").cast("bigint").alias("ordinal"), "column_name", "data_type")


GLYPHS = [("Q.tà' Numero", "q.ta numero", 0, "Q.tà' Numero"), ("ﬁne", "fine", 0, "ﬁne"), ("x", "x", 2, "Ax"), ("", "", 0, "")]


def comparable_labels(spark: SparkSession, d: str) -> DataFrame:
    x = dealt(spark, d, {"t": [g[0] for g in GLYPHS]})
    return x.select("p_partkey", deaccent(C("t")).alias("plain"), undecoded(C("t")).cast("bigint").alias("undecoded"), decode(C("t"), F.create_map(F.lit(""), F.lit("A"))).alias("decoded"))


QUERIES = {
    "main_direction": (main_direction, """WITH n AS (SELECT l_suppkey, (l_suppkey % 5 = 0) <> (l_linenumber = 7) AS up, count(*) AS n FROM lineitem GROUP BY 1, 2), t AS (SELECT *, sum(n) OVER (PARTITION BY l_suppkey) AS a, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, NOT up) AS r FROM n)
SELECT l_suppkey, CASE WHEN up THEN 0.0 ELSE 1.0 END::DOUBLE AS dir_x, CASE WHEN up THEN -1.0 ELSE 0.0 END::DOUBLE AS dir_y, a - n > 0.2 * a AS mixed FROM t WHERE r = 1"""),
    "reading_space": (reading_space, SPACE_SQL),
    "drawn_rules": (drawn_rules, RULES_SQL),
    "ruled_columns": (ruled_columns, COLUMNS_SQL),
    "joined_floors": (joined_floors, FLOORS_SQL),
    "words_in_columns": (words_in_columns, PLACE_SQL),
    "column_signatures": (column_signatures, SIGNATURE_SQL),
    "page_statistics": (page_statistics, "SELECT p_brand AS key, count(*) AS pages, count(*) FILTER (p_size % 4 = 0) AS legible, count(*) FILTER (p_size % 4 = 1) AS garbled, count(*) FILTER (p_size % 4 = 2) AS ciphered, count(*) FILTER (p_size % 4 = 3) AS \"empty\", count(*) FILTER (p_size % 4 = 0) / CAST(count(*) AS DOUBLE) AS share FROM part GROUP BY 1"),
    "sampled_pages": (sampled_pages, "SELECT n_nationkey, array_to_string(list_distinct_ordered, ',') AS pages FROM (SELECT n_nationkey, list_transform(range(5), lambda k: CAST(round(n_nationkey + k * (n_nationkey * 3 + 8) / 4.0) AS INT)) AS list_distinct_ordered FROM nation)"),
    "labels_by_year": (labels_by_year, YEAR_SQL),
    "kept_spans": (kept_spans, SPANS_SQL),
    "explained_gaps": (explained_gaps, "WITH r AS (SELECT l_suppkey AS t, l_orderkey AS row_ord, CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem), g AS (SELECT t, max(v) + CASE WHEN t % 2 = 0 THEN 0 ELSE 0.01 END AS gap FROM r GROUP BY t) SELECT r.t, row_ord FROM r JOIN g ON g.t = r.t WHERE abs(v - gap) < 0.005"),
    "listed_late": (listed_late, LATE_SQL),
    "year_columns": (year_columns, "SELECT o_orderkey, 2024 AS anno, o_totalprice AS value FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 2025, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 = 0"),
    "upserted": (upserted, UPSERT_SQL),
    "data_dictionary": (data_dictionary, "SELECT 'nation' AS table_name, k AS ordinal, n AS column_name, t AS data_type FROM (VALUES (0, 'n_nationkey', 'int'), (1, 'n_name', 'string')) v(k, n, t)"),
    "comparable_labels": (comparable_labels, told({"plain": [g[1] for g in GLYPHS], "undecoded": [g[2] for g in GLYPHS], "decoded": [g[3] for g in GLYPHS]})),
}
