"""Queries of the verifier, of escalation, of mutations that checks must see, of the catalogue and of the query surface."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.numbers import parse_number, status
from pagelake.operators import catalog, checks, query, verify
from pagelake.plans.made import dealt, told
from pagelake.sources.tables import table

C = F.col


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Parts of each brand as the pages of a table: page is a running number by brand."""
    return table(spark, d, "part").withColumn("page", F.row_number().over(W.partitionBy("p_brand").orderBy("p_partkey")))


PAGE = "p AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS page, count(*) OVER (PARTITION BY p_brand) AS n FROM part)"
FILES = [  # folder, stem, authority, article, code, year, volume, page, origin volume and page, failing checks
    ("A1", "A12025V1P60", "", None, "A1", 2025, 1, 60, 1, 60, "layout"),
    ("A2", "A12024V1P60", "", None, "A1", 2025, 1, 60, None, None, "layout.folder_name,layout.year_suffix"),
    ("x", "relazione", "MAE", None, "A1", 2025, 1, 60, 1, 60, "layout.file_stem"),
    ("x", "B22025V1P9", "MAE", None, "A1", 2030, 1, 9, 2, 9, "layout.file_stem,layout.known_year,layout.origin_suffix,layout.year_suffix"),
    ("x", "UEX-2025V1P9", "MEF", "REL", "UEX-", 2025, 1, 9, None, None, "layout"),
    ("x", "UEX-2025V1P9", "MEF", None, "UEX-", 2025, 1, 9, None, None, "layout.code_shape"),
    ("x", "3A2025V1P9", "DIFESA", "A2C6", "3A", 2025, 1, 9, None, None, "layout"),
]


def layout_checks(spark: SparkSession, d: str) -> DataFrame:
    names = ["folder", "stem", "authority", "article", "code", "year", "volume", "page", "origin_volume", "origin_page"]
    f = dealt(spark, d, {n: [x[k] for x in FILES] for k, n in enumerate(names)}).withColumnRenamed("p_partkey", "key")
    g = verify.layout(f, [2024, 2025]).groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list("check_id")), lambda x: x), ",").alias("found"))
    return g.withColumnRenamed("key", "p_partkey")


def uniqueness_checks(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d).select(C("p_brand").alias("key"), "page", F.lit("A1").alias("own"), F.when(C("p_size") % 5 == 0, "A1").when(C("p_size") == 7, F.concat(F.lit("B"), (C("p_partkey") % 9).cast("string"))).alias("found"), (C("p_size") > 45).alias("blank"), (C("p_size") % 3 != 1).alias("readable"))
    return verify.uniqueness(p)


UNIQUE_SQL = """WITH p AS (SELECT p_brand AS key, CASE WHEN p_size % 5 = 0 THEN 'A1' WHEN p_size = 7 THEN 'B' || (p_partkey % 9) END AS f, p_size > 45 AS b, p_size % 3 <> 1 AS r FROM part),
n AS (SELECT key, f, count(*) AS n FROM p WHERE f <> 'A1' GROUP BY 1, 2), m AS (SELECT key, max(n) >= 2 AS rep, min(n) < 2 AS men FROM n GROUP BY key),
g AS (SELECT p.key, count(*) FILTER (f = 'A1') AS own, count(*) FILTER (NOT b) AS leg, count(*) FILTER (NOT b AND r) AS can FROM p GROUP BY 1),
x AS (SELECT g.*, coalesce(rep, false) AS rep, coalesce(men, false) AS men, leg > 0 AND can >= 0.1 * leg AS j FROM g LEFT JOIN m ON m.key = g.key)
SELECT key, 'uniqueness.code_run' AS check_id, 'SKIP' AS verdict FROM x WHERE NOT j UNION ALL SELECT key, 'uniqueness.foreign_table', CASE WHEN rep THEN 'FAIL' ELSE 'PASS' END FROM x WHERE j UNION ALL SELECT key, 'uniqueness.foreign_table_mention', 'WARN' FROM x WHERE j AND men
UNION ALL SELECT key, 'uniqueness.own_code_absent', CASE WHEN can >= 0.9 * leg THEN 'FAIL' ELSE 'WARN' END FROM x WHERE j AND own = 0 UNION ALL SELECT key, 'uniqueness.own_code_run', 'PASS' FROM x WHERE j AND own > 0"""


def stamp_checks(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d).withColumn("n", F.count("*").over(W.partitionBy("p_brand")))
    kind = F.substring("p_brand", 7, 2).cast("int") % 5
    nth, total = C("page").cast("string"), C("n").cast("string")
    gap = (kind == 1) & (C("page") == 2) | (kind == 2) & (C("page") == 5) | (kind == 4)
    p = p.withColumns({"first": F.when(~gap, F.when(kind == 3, total).otherwise(nth)), "second": F.when(~gap, F.when(kind == 3, nth).when((kind == 2) & (C("page") == 4), "999").otherwise(total))})
    return verify.stamp(p.select(C("p_brand").alias("key"), "page", "first", "second"))


STAMP_SQL = f"""WITH {PAGE}, k AS (SELECT p_brand AS key, CAST(substr(p_brand, 7, 2) AS INT) % 5 AS kind, max(n) AS n FROM p GROUP BY 1, 2)
SELECT key, 'completeness.stamp' AS check_id, 'SKIP' AS verdict FROM k WHERE kind = 4
UNION ALL SELECT key, 'uniqueness.stamp_total_varies', CASE WHEN kind = 2 AND n >= 4 THEN 'FAIL' ELSE 'PASS' END FROM k WHERE kind <> 4
UNION ALL SELECT key, 'completeness.stamp_total', 'PASS' FROM k WHERE kind <> 4
UNION ALL SELECT key, 'completeness.first_page_is_one', CASE WHEN kind = 3 AND n = 1 THEN 'PASS' ELSE 'PASS' END FROM k WHERE kind <> 4
UNION ALL SELECT key, 'completeness.stamp_coverage', CASE WHEN kind = 1 AND n >= 2 THEN 'FAIL' WHEN kind = 2 AND n >= 5 THEN CASE WHEN n <= 7 THEN 'FAIL' ELSE 'WARN' END ELSE 'PASS' END FROM k WHERE kind <> 4"""


def edge_checks(spark: SparkSession, d: str) -> DataFrame:
    k = (C("p_size") + C("page")) % 11
    p = _pages(spark, d).select(C("p_brand").alias("key"), "page", F.when(C("page") <= C("p_size") % 3, "header_only").when(k == 0, "blank").when(k == 1, "unreadable").when(k == 2, "header_only").otherwise("content").alias("class"))
    return verify.edges(p)


EDGE_SQL = f"""WITH {PAGE}, c AS (SELECT p_brand AS key, page, CASE WHEN page <= p_size % 3 THEN 'h' WHEN (p_size + page) % 11 = 0 THEN 'b' WHEN (p_size + page) % 11 = 1 THEN 'u' WHEN (p_size + page) % 11 = 2 THEN 'h' ELSE 'c' END AS c FROM p),
e AS (SELECT *, min(CASE WHEN c = 'c' THEN page END) OVER (PARTITION BY key) AS a, max(CASE WHEN c = 'c' THEN page END) OVER (PARTITION BY key) AS z FROM c),
g AS (SELECT key, count(*) FILTER (c = 'c') AS n, count(*) FILTER (c = 'u') AS u, count(*) FILTER (page < a AND c = 'b') AS lb, count(*) FILTER (page < a AND c = 'h') AS lh, count(*) FILTER (page > z AND c = 'b') AS tb, count(*) FILTER (page > z AND c = 'h') AS th, count(*) FILTER (page > a AND page < z AND c IN ('b', 'h')) AS i FROM e GROUP BY key)
SELECT key, 'edges.no_content_page' AS check_id, CASE WHEN u > 0 THEN 'SKIP' ELSE 'FAIL' END AS verdict FROM g WHERE n = 0 UNION ALL SELECT key, 'edges.unreadable_pages', 'WARN' FROM g WHERE n > 0 AND u > 0
UNION ALL SELECT key, 'edges.leading_junk', CASE WHEN lb > 0 THEN 'FAIL' WHEN lh > 0 THEN 'WARN' ELSE 'PASS' END FROM g WHERE n > 0 UNION ALL SELECT key, 'edges.trailing_junk', CASE WHEN tb > 0 THEN 'FAIL' WHEN th > 0 THEN 'WARN' ELSE 'PASS' END FROM g WHERE n > 0
UNION ALL SELECT key, 'edges.interior_noncontent', CASE WHEN i > 0 THEN 'WARN' ELSE 'PASS' END FROM g WHERE n > 0 AND (i > 0 OR u = 0)"""


def folio_checks(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d)
    n = F.when(C("p_size") % 4 == 0, F.array().cast("array<int>")).when(C("p_size") == 13, F.array(F.lit(3), F.lit(5))).otherwise(F.array(F.lit(2), C("page") + 100))
    return verify.folios(p.select(C("p_brand").alias("key"), "page", n.alias("numbers")))


FOLIO_SQL = f"""WITH {PAGE}, k AS (SELECT p_brand AS key, page, CASE WHEN p_size = 13 THEN [3, 5] ELSE [2, page + 100] END AS x FROM p WHERE p_size % 4 <> 0), l AS (SELECT *, lag(x) OVER (PARTITION BY key ORDER BY page) AS was FROM k),
g AS (SELECT key, count(was) AS n, count(*) FILTER (was IS NOT NULL AND NOT list_has_any(x, list_transform(was, lambda v: v + 1))) AS bad FROM l GROUP BY key)
SELECT b.key, 'completeness.folio' AS check_id, CASE WHEN coalesce(n, 0) = 0 THEN 'SKIP' WHEN bad > 0 THEN 'WARN' ELSE 'PASS' END AS verdict FROM (SELECT DISTINCT p_brand AS key FROM part) b LEFT JOIN g ON g.key = b.key"""

TITLES = [  # title, text of the first pages, verdict
    ("Esportazione definitiva", "ESPORTAZIONI DEFINITIVE per operatore", "PASS"),
    ("Esportazione definitiva", "altro testo", "FAIL"),
    ("Esportazione definitiva", "Pagina 1 di 5 TAB N1", "SKIP"),
    ("Esportazione definitiva", "Pagina 1 di 5 TAB N12", "FAIL"),
    (None, "testo", "SKIP"),
    ("di la", "testo", "SKIP"),
    ("Riepilogo generale", "-- ..", "SKIP"),
    ("Paesi e ditte UE", "paesi, UE e ditte", "PASS"),
]


def title_checks(spark: SparkSession, d: str) -> DataFrame:
    t = dealt(spark, d, {"title": [x[0] for x in TITLES], "text": [x[1] for x in TITLES]}).select(C("p_partkey").alias("key"), F.lit("N1").alias("code"), F.lit(5).alias("total"), "title", "text")
    return verify.titles(t).select(C("key").alias("p_partkey"), "verdict")


OWNERS = [([], "lost"), (["whole"], "ok"), (["trash"], "ok"), (["whole", "trash"], "claimed_twice"), (["cut", "cut", "leftover"], "ok"), (["cut", "leftover", "leftover"], "claimed_twice"), (["whole", "cut"], "claimed_twice"), (["no_provenance", "whole"], "no_provenance"), (["leftover"], "claimed_twice")]


def page_verdicts(spark: SparkSession, d: str) -> DataFrame:
    x = dealt(spark, d, {"kinds": [o[0] for o in OWNERS]})
    return verify.page_verdict(x.select("p_partkey", F.explode("kinds").alias("kind")), x, ["p_partkey"])


INDEX_PAGE = "INDICE\nVolume I\nMINISTERO DEGLI AFFARI ESTERI ........ Pag. 12\nTabelle ..... » 40\nRelazione sull'attività .... 55\n1.2 Premessa ....... 7\nab ..... 3\nVolume II\nPRESIDENZA ....... 90\nsenza punti 5"
LIST_PAGE = "ELENCO TABELLE\nTabella AA Esportazione definitiva\nTabella BB\nTitolo sulla riga dopo\nTab. CC\nTab. DD Altro   titolo\nTabella AA doppia"
COUNT_PAGE = "1 12 TAB. A1 Esportazioni definitive 60\n2 3 TAB DI Importazioni 72\nriga qualsiasi\n3 5 TAB A1 ancora 99"


def _volumes(spark: SparkSession, d: str, text: str) -> DataFrame:
    return table(spark, d, "nation").select(C("n_nationkey").alias("volume"), F.lit(3).alias("page"), F.lit(text).alias("text"))


def general_index(spark: SparkSession, d: str) -> DataFrame:
    more = _volumes(spark, d, "INDICE\nMINISTERO ..... 5").withColumn("page", F.lit(2))
    pages = _volumes(spark, d, INDEX_PAGE).unionByName(more).withColumnRenamed("volume", "nation")
    return verify.general_index(pages, ["nation"]).drop("ord").withColumn("page", C("page").cast("bigint"))


def listed_titles(spark: SparkSession, d: str) -> DataFrame:
    return verify.listed_titles(_volumes(spark, d, LIST_PAGE), ["volume"]).withColumn("page", C("page").cast("bigint"))


def counted_rows(spark: SparkSession, d: str) -> DataFrame:
    return verify.counted_rows(_volumes(spark, d, COUNT_PAGE), ["volume"]).select("volume", "code", C("pages").cast("bigint").alias("pages"), C("at_page").cast("bigint").alias("at_page"), "title")


def read_index(spark: SparkSession, d: str) -> DataFrame:
    long = "\n".join(f"{k} {k + 1} TAB. A{k} titolo {k * 9}" for k in range(1, 7)) + "\nTabella BI\nTabella CC"
    pages = _volumes(spark, d, COUNT_PAGE).unionByName(_volumes(spark, d, long).withColumn("page", F.lit(8)))
    r = verify.read_index(pages, ["volume"])
    return r.select("volume", C("page").cast("bigint").alias("page"), F.array_join("codes", ",").alias("codes"), F.array_join(F.transform("counts", lambda c: F.concat(c["code"], F.lit("="), c["n"].cast("string"))), ",").alias("counts"))


def located_spans(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    spans = c.select(C("c_mktsegment").alias("authority"), F.when(C("c_nationkey") % 2 == 0, "A5").alias("article"), (C("c_custkey") % 40).cast("string").alias("code"), C("c_name").alias("report"), C("c_custkey").alias("start"), (C("c_custkey") + C("c_nationkey")).alias("end"), C("c_nationkey").alias("pages"), F.when(C("c_custkey") % 3 == 0, "continued").otherwise("header").alias("source"), C("c_custkey").alias("place"))
    wanted = table(spark, d, "nation").select(F.lit("BUILDING").alias("authority"), F.when(C("n_nationkey") % 2 == 0, "A5").otherwise("").alias("article"), C("n_nationkey").cast("string").alias("code"))
    return verify.locate(spans, wanted)


LOCATE_SQL = """WITH s AS (SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'A5' ELSE '' END AS article, CAST(c_custkey % 40 AS VARCHAR) AS code, c_custkey AS k, c_name, c_nationkey AS n, c_custkey % 3 = 0 AS c FROM customer WHERE c_mktsegment = 'BUILDING'),
f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY article, code ORDER BY c, k) = 1), w AS (SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'A5' ELSE '' END AS article, CAST(n_nationkey AS VARCHAR) AS code FROM nation)
SELECT 'BUILDING' AS authority, w.article, w.code, c_name AS report, k AS start, k + n AS "end", n AS pages, CASE WHEN c THEN 'continued' WHEN NOT c THEN 'header' END AS source FROM w LEFT JOIN f ON f.article = w.article AND f.code = w.code"""


def failed_files(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    found = o.select(C("o_custkey").alias("key"), C("o_orderpriority").alias("check_id"), F.when(C("o_orderkey") % 5 == 0, "FAIL").otherwise("PASS").alias("verdict"))
    c = table(spark, d, "customer")
    files = c.select(C("c_custkey").alias("key"), C("c_nationkey").alias("pages"))
    where = c.filter("c_custkey % 2 = 0").select(C("c_custkey").alias("key"), C("c_name").alias("report"), F.lit(1).alias("start"), C("c_nationkey").alias("end"), C("c_nationkey").alias("pages"))
    return verify.findings(found, files, where)


FAILED_SQL = """WITH f AS (SELECT o_custkey AS key, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS failed FROM orders WHERE o_orderkey % 5 = 0 GROUP BY 1)
SELECT key, c_nationkey AS pages, CASE WHEN key % 2 = 0 THEN c_nationkey END AS expected_pages, CASE WHEN key % 2 = 0 THEN c_name || ' p1-' || c_nationkey ELSE 'unknown' END AS source, failed FROM f JOIN customer ON c_custkey = key"""


def pages_to_look_at(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select((C("o_custkey") % 25).alias("table_key"), F.when(C("o_orderkey") % 2 == 0, "subtotal").otherwise("total").alias("kind"), C("o_orderkey").alias("pdf_page"), F.when(C("o_orderkey") % 50 == C("o_custkey") % 25, "FAIL").otherwise("PASS").alias("status"))
    figures = table(spark, d, "lineitem").select((C("l_suppkey") % 25).alias("table_key"), F.when(C("l_linenumber") == 1, "total").otherwise("subtotal").alias("kind"), C("l_partkey").alias("pdf_page"))
    hints = table(spark, d, "nation").select(C("n_nationkey").alias("table_key"), (C("n_nationkey") + 9000).alias("pdf_page"))
    out = verify.failing_pages(o, figures, hints)
    return verify.review_pages(out).withColumn("pdf_page", C("pdf_page"))


LOOK_SQL = """WITH o AS (SELECT DISTINCT o_custkey % 25 AS t, o_orderkey % 2 = 0 AS sub, o_orderkey AS p FROM orders WHERE o_orderkey % 50 = o_custkey % 25),
u AS (SELECT t, p FROM o WHERE sub UNION SELECT n_nationkey, n_nationkey + 9000 FROM nation WHERE n_nationkey IN (SELECT t FROM o WHERE sub) UNION SELECT l_suppkey % 25, l_partkey FROM lineitem WHERE l_linenumber = 1 AND l_suppkey % 25 IN (SELECT t FROM o WHERE NOT sub)),
r AS (SELECT t, p, row_number() OVER (PARTITION BY t ORDER BY p) - 1 AS k, count(*) OVER (PARTITION BY t) AS n FROM u)
SELECT t AS table_key, p AS pdf_page FROM r WHERE k = 0 OR k = n // 2 OR k = n - 1"""


def exhibit_copies(spark: SparkSession, d: str) -> DataFrame:
    x = dealt(spark, d, {"rel": [e[0] for e in EXHIBITS], "annex": [e[1] for e in EXHIBITS], "rel_total": [e[2] for e in EXHIBITS], "annex_total": [e[3] for e in EXHIBITS]})
    return x.select("p_partkey", checks.compare_exhibit(C("rel"), C("annex"), C("rel_total"), C("annex_total")).alias("note"))


EXHIBITS = [  # text of the exhibit, of the annex, their totals, what it is
    ("1,00 2,00 0,00", "2,00 1,00 3,00", [], [], "copy"),
    ("1,00", "1,00 2,00 3,00", [], [], "summary"),
    ("9,00", "1,00 2,00", [], [], "differs"),
    ("1,00 2,00", "1,00 2,00", ["3,00"], ["4,00"], "differs"),
    ("1,00 2,00", "1,00 2,00 3,00", ["3,00"], ["3,00", "5,00"], "copy"),
    ("nessun importo", "1,00", [], [], "differs"),
]

NOTED = [  # article, code, text, what the grand total prints
    ("", "LGP", "AEREA € 1.059,91\nASE € 312,23\nTotale Complessivo € 1.372,14", ["1.372,14"]), ("REL", "LGP", "AEREA € 1.059,91\nASE € 312,23\nTotale Complessivo € 1.372,14", ["1.372,14"]),
    ("", "FG", "X € 1,00", ["4.315,69"]), ("REL", "FG", "X € 1,00", ["4.380,68"]),
    ("", "KK1", "A € 1,00\nB € 2,00\nC € 3,00\nD € 4,00", ["44,06", "2.722,40"]), ("REL", "KK1", "A € 1,00", ["2.722,40"]),
    ("REL", "T83", "A € 1,00", []), ("", "AA", "x", ["4.553,28"]), ("", "BB", "x", ["6,00", "5,00"]),
    ("REL", "SALDI", "AA \nper Istituti € 4.553,94 € 377,39\nBB \nEsportazioni € 5,00 € 6,00\nTotale Esportazioni € 11,00\naltro 8,00\nTotali 9,00", []),
]
NOTES = [  # article, code, the note; # is the authority
    ("REL", "LGP", "copy of #/LGP: all 3 amounts match"), ("", "LGP", "relation exhibit #/REL/LGP: copy of #/LGP: all 3 amounts match"),
    ("REL", "FG", "differs from #/FG: relation total € 4.380,68; #/FG total € 4.315,69"), ("", "FG", "relation exhibit #/REL/FG: differs from #/FG: relation total € 4.380,68; #/FG total € 4.315,69"),
    ("REL", "KK1", "summary of #/KK1, matches: its 1 amount(s) all appear in #/KK1; relation total € 2.722,40; #/KK1 total € 44,06 / € 2.722,40"),
    ("", "KK1", "relation exhibit #/REL/KK1: summary of #/KK1, matches: its 1 amount(s) all appear in #/KK1; relation total € 2.722,40; #/KK1 total € 44,06 / € 2.722,40"),
    ("REL", "T83", "no annex table #/T83"),
    ("REL", "SALDI", "AA differs: relation € 4.553,94 / € 377,39; #/AA total € 4.553,28"), ("", "AA", "row of #/REL/SALDI: AA differs: relation € 4.553,94 / € 377,39; #/AA total € 4.553,28"),
    ("REL", "SALDI", "BB matches #/BB total € 6,00 / € 5,00"), ("", "BB", "row of #/REL/SALDI: BB matches #/BB total € 6,00 / € 5,00"),
]


def exhibit_notes(spark: SparkSession, d: str) -> DataFrame:
    """An authority a nation, each with the same tables."""
    made = F.array(*[F.struct(F.lit(t[0]).alias("article"), F.lit(t[1]).alias("code"), F.lit(t[2]).alias("text"), F.array(*map(F.lit, t[3])).cast("array<string>").alias("total")) for t in NOTED])
    t = table(spark, d, "nation").select(C("n_name").alias("authority"), F.explode(made).alias("t")).select("authority", "t.*")
    return checks.exhibit_notes(t.withColumn("key", F.concat_ws("/", "authority", F.nullif("article", F.lit("")), "code")))


NOTES_SQL = "SELECT n_name || CASE WHEN article = '' THEN '' ELSE '/REL' END || '/' || code AS key, replace(note, '#', n_name) AS note FROM nation, (VALUES " + ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in NOTES) + ") v(article, code, note)"


def grand_totals(spark: SparkSession, d: str) -> DataFrame:
    """A page an order; a third of the orders have a total row, a third of them turned upwards."""
    x = table(spark, d, "orders").select("o_orderkey", (C("o_orderkey") % 3 == 0).alias("total"), (F.floor(C("o_orderkey") / 3) % 3 == 0).alias("up"), F.concat((C("o_orderkey") % 900 + 100).cast("string"), F.lit(",50")).alias("a"))
    cells = [(1, "Totale Esportazioni", 20, 100), (1, "7,00", 90, 100), (2, "9,00", 90, 30), (1, None, 90, 50.5), (2, "0,00", 60, 51), (1, "Totale Complessivo", 20, 50), (2, None, 120, 53.5), (1, "8,00", 95, 60)]
    made = F.array(*[F.struct(F.lit(k).alias("line"), F.lit(c[1]).cast("string").alias("text"), F.lit(float(c[2])).alias("u"), F.lit(float(c[3])).alias("v")) for k, c in enumerate(cells)])
    x = x.withColumn("c", F.explode(made)).select("o_orderkey", "total", "up", "a", "c.*").filter(C("total") | ~C("text").startswith("Totale C") | C("text").isNull())
    u, v, up = C("u"), C("v"), C("up")
    box = {"x0": F.when(up, v).otherwise(u), "y0": F.when(up, 800 - u - 30).otherwise(v), "x1": F.when(up, v + 9).otherwise(u + 30), "y1": F.when(up, 800 - u).otherwise(v + 9), "dir_x": F.when(up, 0.0).otherwise(1.0), "dir_y": F.when(up, -1.0).otherwise(0.0)}
    t = x.withColumn("text", F.coalesce("text", F.concat(F.lit("€ "), "a"))).withColumns(box).withColumn("page", F.lit(1))
    return checks.grand_totals(t, ["o_orderkey"]).select("o_orderkey", F.array_join("amounts", " ").alias("amounts"))


STATES = [  # first, second, checked, current, failed contents, action, reason
    (None, None, None, "h", 0, "check", "no verdict yet"),
    (("PASS", None), None, "h", "h2", 0, "recheck", "content changed"),
    (("PASS", None), None, None, "h", 0, "recheck", "content changed"),
    (("PASS", None), None, "h", "h", 0, "done", ""),
    (("FAIL", "code"), None, "h", "h", 1, "fix", ""),
    (("FAIL", None), None, "h", "h", 3, "human", "still failing"),
    (("FAIL", "convention"), None, "h", "h", 0, "human", "convention"),
    (("FAIL", "checker"), None, "h", "h", 0, "second-check", "checker unsure"),
    (("FAIL", "checker"), ("PASS", None), "h", "h", 0, "human", "checkers disagree"),
    (("FAIL", "checker"), ("FAIL", "checker"), "h", "h", 0, "human", "both unsure"),
    (("FAIL", "checker"), ("FAIL", "code"), "h", "h", 2, "fix", ""),
    (("PASS", None), ("PASS", None), "h", "h", 9, "done", ""),
]


def escalation_state(spark: SparkSession, d: str) -> DataFrame:
    part = lambda k, j: [None if s[k] is None else s[k][j] for s in STATES]
    x = dealt(spark, d, {"v1": part(0, 0), "k1": part(0, 1), "v2": part(1, 0), "k2": part(1, 1), "checked": [s[2] for s in STATES], "now": [s[3] for s in STATES], "failed": [s[4] for s in STATES]})
    verdict = lambda v, k: F.when(C(v).isNotNull(), F.struct(C(v).alias("verdict"), C(k).cast("string").alias("kind")))
    return x.select("p_partkey", checks.escalation(verdict("v1", "k1"), verdict("v2", "k2"), C("checked"), C("now"), C("failed")).alias("a")).select("p_partkey", "a.action", "a.reason")


QUEUE = [(False, False, True, True, "fix"), (False, True, False, True, "human"), (False, False, False, False, "columns"), (True, False, False, False, "extract"), (True, False, True, True, "done")]


def queue_action(spark: SparkSession, d: str) -> DataFrame:
    x = dealt(spark, d, {n: [q[k] for q in QUEUE] for k, n in enumerate(("agreed", "proposed", "drafted", "extracted"))})
    return x.select("p_partkey", checks.next_action(C("agreed"), C("proposed"), C("drafted"), C("extracted"), F.lit("done")).alias("action"))


def failed_contents(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    h = e.select("user_id", (C("event_id") % 7).alias("content"), F.when(C("event_type") == "purchase", "PASS").otherwise("FAIL").alias("verdict"), F.when(C("event_type") == "error", "code").when(C("event_type") == "view", "checker").alias("kind"))
    return checks.failed_on(h, ["user_id"])


def misread_cells(spark: SparkSession, d: str) -> DataFrame:
    """Every line's printed amount misread: the checks see each one."""
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", C("l_extendedprice").alias("printed"), F.concat(F.floor("l_extendedprice").cast("bigint").cast("string"), F.lit(",50")).alias("raw")).withColumn("value", parse_number(C("raw")))
    y = checks.misread_value(x, C("l_linenumber") % 2 == 1, "raw", "value", parse_number)
    name = checks.misread(F.when(C("l_orderkey") % 2 == 0, "REPUBBLICA GERMANIA").otherwise("STATI UNITI"))
    seen = status(parse_number(F.concat(F.floor("printed").cast("bigint").cast("string"), F.lit(",50"))), C("value"))
    return y.select("l_orderkey", "l_linenumber", "raw", seen.alias("status"), name.alias("country"))


MISREAD_SQL = """WITH x AS (SELECT l_orderkey, l_linenumber, CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) || ',50' AS raw FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 1 THEN CAST((CAST(substr(raw, 1, 1) AS INT) + 3) % 10 AS VARCHAR) || substr(raw, 2) ELSE raw END AS raw, CASE WHEN l_linenumber % 2 = 1 THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN l_orderkey % 2 = 0 THEN 'REPUBBLICA FRANCIA' ELSE 'STATI GERMANIA' END AS country FROM x"""


def split_and_merged(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each order: one split below itself, then two merged, one read as a figure, cells swapped."""
    nth = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag", "l_linestatus"))
    x = table(spark, d, "lineitem").select("l_orderkey", nth.cast("double").alias("ord"), C("l_returnflag").alias("a"), C("l_linestatus").alias("b"))
    cut = checks.split_row(x, (C("ord") == 2) & (C("l_orderkey") % 3 == 0), "ord", ["a"], ["l_orderkey"])
    one = checks.merge_rows(cut, (C("ord") == 1) & (C("l_orderkey") % 3 == 1), ["l_orderkey"], "ord", ["a", "b"])
    rows, figures = checks.as_figure(one, (C("ord") == 3) & (C("l_orderkey") % 3 == 2), ["a", "b"], "subtotal", ["l_orderkey"], "ord")
    rows = checks.swap(rows, (C("ord") == 4), "a", "b")
    return rows.select("l_orderkey", "ord", F.lit("data").alias("kind"), "a", "b").unionByName(figures.groupBy("l_orderkey", "ord", "kind").agg(F.max(F.when(C("ordinal") == 0, C("value_raw"))).alias("a"), F.max(F.when(C("ordinal") == 1, C("value_raw"))).alias("b")))


SPLIT_SQL = """WITH x AS (SELECT l_orderkey AS o, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice, l_returnflag, l_linestatus) AS DOUBLE) AS ord, l_returnflag AS a, l_linestatus AS b FROM lineitem),
s AS (SELECT o, ord, CASE WHEN ord = 2 AND o % 3 = 0 THEN NULL ELSE a END AS a, b FROM x UNION ALL SELECT o, 2.5, a, NULL FROM x WHERE ord = 2 AND o % 3 = 0),
l AS (SELECT *, lead(a) OVER (PARTITION BY o ORDER BY ord) AS na, lead(b) OVER (PARTITION BY o ORDER BY ord) AS nb, lag(ord) OVER (PARTITION BY o ORDER BY ord) AS was FROM s),
m AS (SELECT o, ord, CASE WHEN ord = 1 AND o % 3 = 1 AND na IS NOT NULL THEN a || ' ' || na ELSE a END AS a, CASE WHEN ord = 1 AND o % 3 = 1 AND nb IS NOT NULL THEN b || ' ' || nb ELSE b END AS b FROM l WHERE NOT coalesce(was = 1 AND o % 3 = 1, false))
SELECT o AS l_orderkey, ord, CASE WHEN ord = 3 AND o % 3 = 2 THEN 'subtotal' ELSE 'data' END AS kind, CASE WHEN ord = 4 THEN b ELSE a END AS a, CASE WHEN ord = 4 THEN a ELSE b END AS b FROM m"""


CUTS = [("none", "0"), ("drop-last", "0"), ("add-next", "0"), ("add-prev", "0"), ("printed", "7"), ("code", "ZZ"), ("article", "A9"), ("authority", "DOG")]


def wrong_cuts(spark: SparkSession, d: str) -> DataFrame:
    x = dealt(spark, d, {"m": [c[0] for c in CUTS], "v": [c[1] for c in CUTS]})
    s = x.select("p_partkey", F.lit("MAE").alias("authority"), F.lit("").alias("article"), F.lit("A1").alias("code"), C("p_partkey").alias("start"), (C("p_partkey") + 5).alias("end"), (C("p_partkey") + 50).alias("printed_from"), (C("p_partkey") + 55).alias("printed_to"), "m", "v")
    return checks.recut(s, C("m"), C("v")).select("p_partkey", "start", "end", "printed_from", "printed_to", "pages", "key")


CUT_SQL = """WITH p AS (SELECT p_partkey AS k, p_partkey % 8 AS m FROM part), s AS (SELECT k, m, CASE WHEN m = 3 THEN -1 ELSE 0 END AS a, CASE m WHEN 1 THEN -1 WHEN 2 THEN 1 ELSE 0 END AS z, CASE WHEN m = 4 THEN 7 ELSE 0 END AS q FROM p)
SELECT k AS p_partkey, k + a AS start, k + 5 + z AS "end", k + 50 + a + q AS printed_from, k + 55 + z + q AS printed_to, 6 + z - a AS pages, CASE m WHEN 5 THEN 'MAE/ZZ' WHEN 6 THEN 'MAE/A9/A1' WHEN 7 THEN 'DOG/A1' ELSE 'MAE/A1' END AS key FROM s"""

# ---------------------------------------------------------------- catalogue

ROLES = [("Numero autorizzazione", ["code"], "key"), ("Valore Euro", ["currency"], "measure"), ("Quantità", ["number"], "measure"), ("Cat.", ["code", "empty"], "key"), ("Materiale", ["text"], "dimension"), ("", ["text"], "meta"), (None, [], "meta"), ("Paesi", [], "dimension"), ("N. operazioni", ["number"], "key")]


def column_roles(spark: SparkSession, d: str) -> DataFrame:
    x = dealt(spark, d, {"label": [r[0] for r in ROLES], "shapes": [r[1] for r in ROLES]})
    return x.select("p_partkey", catalog.column_role(C("label"), C("shapes")).alias("role"))


EXTRACTABLE = [(9, 9, "flat", 3, False, True, ""), (9, 7, "flat", 3, False, True, "partial: 2/9 pages illegible"), (9, 0, "flat", 3, False, False, "illegible"), (9, 9, "unknown", 0, True, False, "a chart"), (9, 9, "unknown", 0, False, False, "no header"), (9, 0, "unknown", 0, False, False, "illegible")]


def extraction_status(spark: SparkSession, d: str) -> DataFrame:
    x = dealt(spark, d, {n: [e[k] for e in EXTRACTABLE] for k, n in enumerate(("pages", "legible", "grammar", "n_columns", "charted"))})
    return x.select("p_partkey", catalog.extraction_status(C("pages"), C("legible"), C("grammar"), C("n_columns"), C("charted")).alias("s")).select("p_partkey", "s.extractable", "s.reason")


def catalogue_census(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select((C("p_size") % 3 + 2023).alias("year"), C("p_brand").alias("authority"), C("p_name").alias("key"), C("p_size").alias("pages"), (C("p_size") - C("p_partkey") % 3).alias("legible"), F.substring("p_type", 1, 5).alias("grammar"), F.when(C("p_partkey") % 4 == 0, "rot90").otherwise("upright").alias("orientation"), (C("p_partkey") % 6).cast("string").alias("widths"), (C("p_partkey") % 5 > 0).alias("extractable"), F.lit("r").alias("reason"))
    c = catalog.census(p)
    line = lambda n, k, v: c[n].select(F.lit(n).alias("report"), k.cast("string").alias("name"), v.cast("bigint").alias("n"))
    return line("coverage", F.concat_ws("/", "year", "authority"), C("legible") * 1000 + C("extractable")).unionByName(line("grammars", C("grammar"), C("n"))).unionByName(line("orientations", C("orientation"), C("pages"))).unionByName(line("signatures", C("widths"), C("n"))).unionByName(c["unreadable"].groupBy("year").agg(F.count("*").alias("n")).select(F.lit("unreadable").alias("report"), C("year").cast("string").alias("name"), "n"))


CENSUS_SQL = """SELECT 'coverage' AS report, (p_size % 3 + 2023) || '/' || p_brand AS name, CAST(sum(p_size - p_partkey % 3) * 1000 + count(*) FILTER (p_partkey % 5 > 0) AS BIGINT) AS n FROM part GROUP BY 2 UNION ALL SELECT 'grammars', substr(p_type, 1, 5), count(*) FROM part GROUP BY 2
UNION ALL SELECT 'orientations', CASE WHEN p_partkey % 4 = 0 THEN 'rot90' ELSE 'upright' END, CAST(sum(p_size) AS BIGINT) FROM part GROUP BY 2 UNION ALL SELECT 'signatures', CAST(p_partkey % 6 AS VARCHAR), count(*) FROM part GROUP BY 2 UNION ALL SELECT 'unreadable', CAST(p_size % 3 + 2023 AS VARCHAR), count(*) FROM part WHERE p_partkey % 5 = 0 GROUP BY 2"""

# ---------------------------------------------------------------- the query surface


def intersect_codes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(C("c_nationkey").cast("bigint").alias("k")).intersect(table(spark, d, "supplier").select(C("s_nationkey").cast("bigint").alias("k")))


def second_page(spark: SparkSession, d: str) -> DataFrame:
    return query.page(table(spark, d, "customer").select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), "c_custkey"], 1, 50)


def sorted_view(spark: SparkSession, d: str) -> DataFrame:
    """Places in a client's order: rows without a value last, up and down."""
    x = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", F.when(C("s_acctbal") > 0, C("s_acctbal")).alias("v"))
    top = query.bars(query.sorted_rows(x, "v", ["s_suppkey"], descending=True), "s_suppkey", "v", 5).select("s_suppkey", F.lit(True).alias("bar"))
    up = F.row_number().over(W.partitionBy("s_nationkey").orderBy(C("v").asc_nulls_last(), "s_suppkey"))
    return x.withColumn("place", up.cast("bigint")).join(top, "s_suppkey", "left").select("s_suppkey", "place", F.coalesce("bar", F.lit(False)).alias("bar"))


def filtered_rows(spark: SparkSession, d: str) -> DataFrame:
    return query.contains_anywhere(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), "build")


QUERIES = {
    "layout_checks": (layout_checks, told({"found": [f[10] for f in FILES]})),
    "uniqueness_checks": (uniqueness_checks, UNIQUE_SQL),
    "stamp_checks": (stamp_checks, STAMP_SQL),
    "edge_checks": (edge_checks, EDGE_SQL),
    "folio_checks": (folio_checks, FOLIO_SQL),
    "title_checks": (title_checks, told({"verdict": [t[2] for t in TITLES]})),
    "page_verdicts": (page_verdicts, told({"verdict": [o[1] for o in OWNERS]})),
    "general_index": (general_index, "SELECT n_nationkey AS nation, name, page, ditto, volume, kind FROM nation, (VALUES ('MINISTERO DEGLI AFFARI ESTERI', 12, false, 'I', 'authority'), ('Tabelle', 40, true, 'I', 'tables'), ('Relazione sull''attività', 55, false, 'I', 'relation'), ('PRESIDENZA', 90, false, 'II', 'authority')) v(name, page, ditto, volume, kind)"),
    "listed_titles": (listed_titles, "SELECT n_nationkey AS volume, code, title, 3 AS page FROM nation, (VALUES ('AA', 'Esportazione definitiva'), ('BB', 'Titolo sulla riga dopo'), ('CC', ''), ('DD', 'Altro titolo')) v(code, title)"),
    "counted_rows": (counted_rows, "SELECT n_nationkey AS volume, code, pages, at_page, title FROM nation, (VALUES ('A1', 5, 99, 'ancora'), ('D1', 3, 72, 'Importazioni')) v(code, pages, at_page, title)"),
    "read_index": (read_index, "SELECT n_nationkey AS volume, 8 AS page, 'A1,A2,A3,A4,A5,A6,B1,CC' AS codes, 'A1=2,A2=3,A3=4,A4=5,A5=6,A6=7' AS counts FROM nation"),
    "located_spans": (located_spans, LOCATE_SQL),
    "failed_files": (failed_files, FAILED_SQL),
    "pages_to_look_at": (pages_to_look_at, LOOK_SQL),
    "exhibit_copies": (exhibit_copies, told({"note": [e[4] for e in EXHIBITS]})),
    "exhibit_notes": (exhibit_notes, NOTES_SQL),
    "grand_totals": (grand_totals, "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 900 + 100) || ',50 ' || (o_orderkey % 900 + 100) || ',50' ELSE '' END AS amounts FROM orders"),
    "escalation_state": (escalation_state, told({"action": [s[5] for s in STATES], "reason": [s[6] for s in STATES]})),
    "queue_action": (queue_action, told({"action": [q[4] for q in QUEUE]})),
    "failed_contents": (failed_contents, "SELECT user_id, count(DISTINCT CASE WHEN event_type NOT IN ('purchase', 'view') THEN event_id % 7 END) AS n FROM events GROUP BY user_id"),
    "misread_cells": (misread_cells, MISREAD_SQL),
    "split_and_merged": (split_and_merged, SPLIT_SQL),
    "wrong_cuts": (wrong_cuts, CUT_SQL),
    "column_roles": (column_roles, told({"role": [r[2] for r in ROLES]})),
    "extraction_status": (extraction_status, told({"extractable": [e[5] for e in EXTRACTABLE], "reason": [e[6] for e in EXTRACTABLE]})),
    "catalogue_census": (catalogue_census, CENSUS_SQL),
    "intersect_codes": (intersect_codes, "SELECT CAST(c_nationkey AS BIGINT) AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier"),
    "second_page": (second_page, "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 50 OFFSET 50"),
    "sorted_view": (sorted_view, """WITH x AS (SELECT s_suppkey, s_nationkey, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS v FROM supplier), t AS (SELECT s_suppkey FROM x WHERE v >= 0 ORDER BY v DESC, s_suppkey LIMIT 5)
SELECT s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY v ASC NULLS LAST, s_suppkey) AS place, s_suppkey IN (FROM t) AS bar FROM x"""),
    "filtered_rows": (filtered_rows, "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE contains(lower(c_name), 'build') OR contains(lower(c_mktsegment), 'build') OR contains(CAST(c_custkey AS VARCHAR), 'build')"),
}
