"""Queries of placement: printed indexes, whose page, spans by steps, trims, continuations, copies, the list, the trash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.operators import placement as p
from pagelake.operators import verify
from pagelake.plans.made import dealt, told
from pagelake.sources.tables import table

C = F.col

# ---------------------------------------------------------------- the printed index

INDEXES = [  # text of a page, blocks as name:folio:tables
    ("INDICE\nMINISTERO DEGLI AFFARI ESTERI E DELLA COOPERA-\nZIONALE ..... Pag. 12\nTabelle ..... » 40\nMINISTERO DELL'ECONOMIA » 55", "MAE:12:40,MEF:55:-"),
    ("I N D I C E\nPRESIDENZA DEL CONSIGLIO DEI MINISTRI ... Pag. 3\nMINISTERO DELLA DIFESA ... Pag.\n9\nTabelle Pag. 30\nTabelle Pag. 20", "DIFESA:9:20"),
    ("INDICE\nRelazione sull'attività dell'Agenzia delle Dogane » 70\nMINISTERO DELL'INTERNO » 80\nRelazione sull'attività dell'Agenzia delle dogane (segue) Pag. 1043\nTabelle » 1050", "DOG:70:1050,INTERNO:80:-"),
    ("INDICE\nuna riga qualsiasi » 5", None),
    ("MINISTERO DELLA DIFESA » 9", None),
]


def index_blocks(spark: SparkSession, d: str) -> DataFrame:
    pages = dealt(spark, d, {"text": [x[0] for x in INDEXES]}).select(C("p_partkey").alias("volume"), F.lit(5).alias("page"), "text")
    b = p.merge_blocks(p.find_index(pages))
    one = F.struct("ord", F.concat_ws(":", "name", C("folio").cast("string"), F.coalesce(C("tables").cast("string"), F.lit("-"))).alias("s"))
    g = b.groupBy("volume").agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["s"]), ",").alias("blocks"))
    return pages.select("volume").join(g, "volume", "left").select(C("volume").alias("p_partkey"), "blocks")


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select((C("s_nationkey") % 25).alias("volume"), F.element_at(F.array(*map(F.lit, ("MAE", "MEF", "DOG", "DIFESA", "INTERNO"))), (C("s_suppkey") % 5 + 1).cast("int")).alias("name"), C("s_suppkey").alias("ord"), F.when(C("s_nationkey") % 3 == 0, C("s_suppkey") * 7).otherwise((C("s_suppkey") * 37) % 400).cast("int").alias("folio"))


def _folios(spark: SparkSession, d: str) -> DataFrame:
    n = C("n_nationkey")
    return table(spark, d, "nation").select(n.alias("volume"), F.lit(300).alias("pages"), F.when(n % 7 != 6, n % 5).cast("int").alias("offset"), F.when(n % 4 == 3, 0.25).otherwise(0.75).alias("coverage"))


B_SQL = "b AS (SELECT CAST(s_nationkey % 25 AS BIGINT) AS volume, ['MAE', 'MEF', 'DOG', 'DIFESA', 'INTERNO'][CAST(s_suppkey % 5 + 1 AS INT)] AS name, s_suppkey AS ord, CASE WHEN s_nationkey % 3 = 0 THEN s_suppkey * 7 ELSE (s_suppkey * 37) % 400 END AS folio FROM supplier)"
F_SQL = "f AS (SELECT n_nationkey AS volume, 300 AS pages, CASE WHEN n_nationkey % 7 <> 6 THEN n_nationkey % 5 END AS off, CASE WHEN n_nationkey % 4 = 3 THEN 0.25 ELSE 0.75 END AS coverage FROM nation)"


def index_valid(spark: SparkSession, d: str) -> DataFrame:
    return p.validate(_blocks(spark, d), _folios(spark, d))


def index_edges(spark: SparkSession, d: str) -> DataFrame:
    return p.block_edges(_blocks(spark, d), _folios(spark, d)).select("volume", C("page").cast("bigint").alias("page"), "name")


def owner_by_index(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "orders").select((C("o_custkey") % 25).alias("volume"), (C("o_orderkey") % 300 + 1).alias("page")).distinct()
    return p.owner_by_index(pages, _blocks(spark, d), _folios(spark, d))


def folio_offsets(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    shown = F.when(C("o_orderkey") % 5 == 0, "senza numero").otherwise(F.concat(F.lit("testo\n– "), (C("o_orderkey") + F.when(C("o_orderkey") % 3 == 0, 9).otherwise(C("o_custkey") % 2)) % 9999, F.lit(" –")))
    return p.folio_map(o.select((C("o_custkey") % 50).alias("volume"), C("o_orderkey").cast("int").alias("page"), shown.alias("text"))).select("volume", "pages", C("offset").cast("bigint").alias("offset"), "coverage")


def placement_votes(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").select("l_suppkey", F.when(C("l_linenumber") < 3, "DOG").when(C("l_linenumber") == 3, "MAE").when(C("l_linenumber") == 4, "MEF").alias("authority"), F.when(C("l_returnflag") == "R", "A1C2").when(C("l_returnflag") == "A", "A5").alias("article"))
    return p.resolve_placement(x, ["l_suppkey"])


# ---------------------------------------------------------------- spans

KEY = ["authority", "code"]


def _detections(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem")
    return x.select((C("l_suppkey") % 10).alias("volume"), F.when(C("l_returnflag") == "R", "DOG").otherwise("MAE").alias("authority"), F.concat(F.lit("A"), "l_linestatus", C("l_linenumber").cast("string")).alias("code"), (C("l_partkey") * 3 + C("l_linenumber")).alias("page"), F.when(C("l_quantity") < 10, "title").when(C("l_quantity") < 25, "header").otherwise("inline").alias("evidence")).groupBy("volume", *KEY, "page").agg(F.max("evidence").alias("evidence"))


def _lists(spark: SparkSession, d: str) -> DataFrame:
    s = C("s_suppkey")
    return table(spark, d, "supplier").select((s % 10).alias("volume"), (s * 41).alias("page"), F.array(F.concat(F.lit("AO"), (s % 7).cast("string")), F.lit("AF3")).alias("codes"))


def _marks(spark: SparkSession, d: str) -> DataFrame:
    n = C("n_nationkey")
    return table(spark, d, "nation").select((n % 10).alias("volume"), F.concat(F.lit("AF"), (n % 7).cast("string")).alias("code"), (n * 23 + 5).alias("page")).groupBy("volume", "code").agg(F.min("page").alias("page"))


D_SQL = "t AS (SELECT l_suppkey % 10 AS volume, CASE WHEN l_returnflag = 'R' THEN 'DOG' ELSE 'MAE' END AS authority, 'A' || l_linestatus || l_linenumber AS code, l_partkey * 3 + l_linenumber AS page, max(CASE WHEN l_quantity < 10 THEN 'title' WHEN l_quantity < 25 THEN 'header' ELSE 'inline' END) AS evidence FROM lineitem GROUP BY 1, 2, 3, 4)"
L_SQL = "li AS (SELECT s_suppkey % 10 AS volume, s_suppkey * 41 AS page, ['AO' || (s_suppkey % 7), 'AF3'] AS codes FROM supplier)"
M_SQL = "m AS (SELECT n_nationkey % 10 AS volume, 'AF' || (n_nationkey % 7) AS code, min(n_nationkey * 23 + 5) AS mark FROM nation GROUP BY 1, 2)"
SAME = "(a = b OR (abs(length(a) - length(b)) = 1 AND regexp_replace(a, '^[A-Za-z]*', '') = regexp_replace(b, '^[A-Za-z]*', '') AND starts_with(regexp_extract(CASE WHEN length(a) > length(b) THEN a ELSE b END, '^[A-Za-z]*'), regexp_extract(CASE WHEN length(a) > length(b) THEN b ELSE a END, '^[A-Za-z]*')) AND length(regexp_extract(CASE WHEN length(a) > length(b) THEN b ELSE a END, '^[A-Za-z]*')) >= 2))"
CLUSTER_SQL = f"""{D_SQL}, {L_SQL}, {M_SQL},
i AS (SELECT volume, authority, code, page, page - row_number() OVER (PARTITION BY volume, authority, code ORDER BY page) AS g FROM t),
r AS (SELECT volume, authority, code, min(page) AS a, max(page) AS z, count(*) AS n FROM i GROUP BY volume, authority, code, g),
w AS (SELECT *, lag(z) OVER (PARTITION BY volume, authority, code ORDER BY a) AS was FROM r),
c AS (SELECT *, CASE WHEN a - was > 40 OR EXISTS (SELECT 1 FROM li WHERE li.volume = w.volume AND li.page > was AND li.page < a) THEN 1 ELSE 0 END AS cut FROM w),
k AS (SELECT *, sum(cut) OVER (PARTITION BY volume, authority, code ORDER BY a) AS cluster FROM c),
q AS (SELECT DISTINCT code AS a FROM t), u AS (SELECT volume, page, unnest(codes) AS b FROM li), pr AS (SELECT volume, a AS code, max(page) AS last_list FROM q, u WHERE {SAME} GROUP BY 1, 2),
x AS (SELECT k.volume, k.authority, k.code, cluster, min(a) AS first, max(z) AS last, sum(n) AS pages, bool_or(coalesce(mark BETWEEN a AND z, false)) AS marked, coalesce(max(z) > max(last_list), false) AS after FROM k LEFT JOIN pr ON pr.volume = k.volume AND pr.code = k.code LEFT JOIN m ON m.volume = k.volume AND m.code = k.code GROUP BY 1, 2, 3, 4),
cl AS (SELECT volume, authority, code, CAST(cluster AS BIGINT) AS cluster, first, last, CAST(pages AS BIGINT) AS pages, row_number() OVER (PARTITION BY volume, authority, code ORDER BY after DESC, marked DESC, pages DESC, first) = 1 AS kept FROM x)"""


def run_clusters(spark: SparkSession, d: str) -> DataFrame:
    return p.clusters(_detections(spark, d), KEY, _lists(spark, d), _marks(spark, d)).withColumn("cluster", C("cluster").cast("bigint"))


def _kept(spark: SparkSession, d: str) -> DataFrame:
    c = run_clusters(spark, d).filter("kept").select("volume", *KEY, F.explode(F.sequence("first", "last")).alias("page"))
    return _detections(spark, d).join(c, ["volume", *KEY, "page"], "left_semi")


def span_starts(spark: SparkSession, d: str) -> DataFrame:
    titled = table(spark, d, "part").select((C("p_partkey") % 10).alias("volume"), F.lit("MAE").alias("authority"), F.concat(F.lit("AX"), (C("p_partkey") % 4).cast("string")).alias("code"), C("p_partkey").alias("page"))
    marks = _marks(spark, d).select("volume", F.lit("MAE").alias("authority"), "code", "page")
    return p.starts(_kept(spark, d), KEY, titled, marks)


START_SQL = f"""{CLUSTER_SQL},
kt AS (SELECT t.* FROM t JOIN cl ON cl.volume = t.volume AND cl.authority = t.authority AND cl.code = t.code AND t.page BETWEEN cl.first AND cl.last AND cl.kept),
h AS (SELECT volume, authority, code, min(page) AS start, max(page) AS floor FROM kt GROUP BY 1, 2, 3 HAVING NOT (min_by(evidence, page) = 'inline' AND count(*) < 2 AND authority <> 'DOG')),
tt AS (SELECT p_partkey % 10 AS volume, 'MAE' AS authority, 'AX' || (p_partkey % 4) AS code, min(p_partkey) AS tp FROM part GROUP BY 1, 2, 3), bm AS (SELECT volume, 'MAE' AS authority, code, mark AS bp FROM m),
st AS (SELECT volume, authority, code, coalesce(bp, start, tp) AS start, CASE WHEN bp IS NOT NULL THEN 'embedded' WHEN start IS NOT NULL THEN 'header' ELSE 'title' END AS source, coalesce(floor, coalesce(bp, start, tp)) AS floor FROM h FULL JOIN tt USING (volume, authority, code) FULL JOIN bm USING (volume, authority, code))"""


def span_ends(spark: SparkSession, d: str) -> DataFrame:
    volumes = table(spark, d, "part").groupBy((C("p_partkey") % 10).alias("volume")).agg((F.max("p_partkey") * 3 + 20).alias("pages"))
    edges = table(spark, d, "nation").select((C("n_nationkey") % 10).alias("volume"), (C("n_nationkey") * 17).alias("page"), F.when(C("n_nationkey") % 3 == 0, "MAE").otherwise("MEF").alias("name"))
    sections = table(spark, d, "supplier").select((C("s_suppkey") % 10).alias("volume"), (C("s_suppkey") * 29).alias("page"))
    s = span_starts(spark, d).withColumn("floor", F.least("floor", C("start") + 2))
    return p.ends(s, volumes, edges, sections, _lists(spark, d)).select("volume", "authority", "code", "start", "end0", "end1", "end2", "end3", "clamps")


ENDS_SQL = f"""WITH {START_SQL}, s0 AS (SELECT volume, authority, code, start, least(floor, start + 2) AS floor FROM st), vp AS (SELECT p_partkey % 10 AS volume, max(p_partkey) * 3 + 20 AS pages FROM part GROUP BY 1),
ed AS (SELECT n_nationkey % 10 AS volume, n_nationkey * 17 AS page, CASE WHEN n_nationkey % 3 = 0 THEN 'MAE' ELSE 'MEF' END AS name FROM nation),
e0 AS (SELECT s0.*, greatest(start, coalesce(lead(start) OVER (PARTITION BY s0.volume ORDER BY start, code) - 1, pages)) AS end0 FROM s0 JOIN vp ON vp.volume = s0.volume),
e1 AS (SELECT *, (SELECT max_by(name, (page, name)) FROM ed WHERE ed.volume = e0.volume AND ed.page <= e0.start) AS mine FROM e0),
pg AS (SELECT e1.volume, authority, code, start, unnest(range(floor + 1, end0 + 1)) AS q, mine FROM e1 WHERE mine IS NOT NULL AND floor < end0),
bl AS (SELECT pg.volume, authority, code, start, q, mine, max_by(name, (page, name)) AS here FROM pg JOIN ed ON ed.volume = pg.volume AND ed.page <= q GROUP BY 1, 2, 3, 4, 5, 6),
b1 AS (SELECT volume, authority, code, start, min(q) - 1 AS e FROM bl WHERE here <> mine GROUP BY 1, 2, 3, 4),
x1 AS (SELECT e1.*, coalesce(e, end0) AS end1 FROM e1 LEFT JOIN b1 USING (volume, authority, code, start)),
x2 AS (SELECT *, coalesce((SELECT min(s_suppkey * 29) - 1 FROM supplier WHERE s_suppkey % 10 = x1.volume AND s_suppkey * 29 > greatest(floor, start) AND s_suppkey * 29 <= end1), end1) AS end2 FROM x1),
x3 AS (SELECT *, (SELECT min(page) FROM li WHERE li.volume = x2.volume AND page BETWEEN start AND end2) AS lp FROM x2)
SELECT volume, authority, code, start, end0, end1, end2, CASE WHEN lp > floor THEN lp - 1 ELSE end2 END AS end3, array_to_string(list_filter([CASE WHEN end1 < end0 THEN 'index' END, CASE WHEN end2 < end1 THEN 'section' END, CASE WHEN lp > floor AND lp - 1 < end2 THEN 'listing' END], lambda v: v IS NOT NULL), ',') AS clamps FROM x3"""


# ---------------------------------------------------------------- trims: one volume a supplier, pages 1 to 10, written-out stamps

TRIMS = [  # stamps (page, first, second), end4, note, named codes by page, end5, blank pages, end6
    ([(k, str(k), "8") for k in range(1, 9)], 8, "trimmed", {9: "VALORE", 10: None}, 8, [8], 7),
    ([(k, "8", str(k)) for k in range(1, 9)], 8, "trimmed", {8: "VALORE"}, 7, [], 7),
    ([(k, "8", str(k)) for k in range(1, 9)] + [(9, "1", "1")], 10, "not page one", {8: "VALORE"}, 10, [], 10),
    ([(1, "1", "5")], 10, "one page only", {10: "VALORE", 9: "ALTRO", 8: "A1"}, 8, [], 8),
    ([(k, str(k + 2), "9") for k in range(1, 9)], 10, "not page one", {10: None, 9: "X"}, 10, [10, 9], 8),
    ([], 10, "", {}, 10, [], 10),
    ([(k, str(k), "8") for k in range(1, 9)] + [(9, "1", "30"), (12, "4", "30")], 10, "another table begins", {10: "A1"}, 10, [2, 3], 10),
]


def _trimmed(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select(C("s_suppkey").alias("volume"), (C("s_suppkey") % len(TRIMS)).cast("int").alias("kind"))

    def each(rows: list[list[tuple]], schema: str) -> DataFrame:
        made = spark.createDataFrame([(k, *r) for k, rs in enumerate(rows) for r in rs] or [], "kind int, " + schema)
        return s.join(F.broadcast(made), "kind").drop("kind")  # a few written-out rows

    spans = s.select("volume", F.lit("A1").alias("code"), F.lit(1).cast("bigint").alias("start"), F.lit(10).cast("bigint").alias("end"))
    out = p.trim_stamps(spans, each([t[0] for t in TRIMS], "page bigint, first string, second string"), ["code"])
    out = p.trim_foreign(out, each([list(t[3].items()) for t in TRIMS], "page bigint, named string"), ["code"])
    blank = each([[(k, k in t[5]) for k in range(1, 11)] for t in TRIMS], "page bigint, blank boolean")
    return p.trim_blanks(out, blank)


def span_trims(spark: SparkSession, d: str) -> DataFrame:
    return _trimmed(spark, d).select(C("volume").alias("s_suppkey"), "end4", "note", "end5", "end6")


COVERED = [  # code, first page, second page, cover page, start
    ("M", "Esportazione\nTAB. M", "TAB. M\n1,00", 4, 5),
    ("M", "Esportazione\nTAB. M", "TAB. M1\n1,00", None, 4),
    ("M1", "TAB. M1\n" + "riga\n" * 9, "TAB. M1", None, 4),
    ("MAPPENDICE", "T\nAB. M - APPENDICE", "TAB. M - APPENDICE\n1,00", 4, 5),
]


def table_covers(spark: SparkSession, d: str) -> DataFrame:
    x = dealt(spark, d, {"code": [c[0] for c in COVERED], "one": [c[1] for c in COVERED], "two": [c[2] for c in COVERED]})
    spans = x.select(C("p_partkey").alias("volume"), "code", F.lit(4).alias("start"), F.lit(9).alias("end"))
    pages = x.select(C("p_partkey").alias("volume"), F.lit(4).alias("page"), C("one").alias("text")).unionByName(x.select(C("p_partkey").alias("volume"), F.lit(5).alias("page"), C("two").alias("text")))
    return p.drop_covers(spans, pages).select(C("volume").alias("p_partkey"), C("cover").cast("bigint").alias("cover"), C("start").cast("bigint").alias("start"))


def defence_articles(spark: SparkSession, d: str) -> DataFrame:
    """Pages 1 to 3 of every volume; the cited article stands on page `p_partkey % 4` (0: on none)."""
    x = table(spark, d, "part").select(C("p_partkey").alias("volume"), F.when(C("p_partkey") % 5 == 0, "MAE").otherwise("DIFESA").alias("authority"), F.lit("OLD").alias("article"), F.lit("3A").alias("code"), F.lit(1).alias("start"), F.lit(3).alias("end"))
    pages = x.select("volume", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("page")).withColumn("text", F.when(C("page") >= F.when(C("volume") % 4 == 0, 9).otherwise(C("volume") % 4), F.concat(F.lit("art. "), C("page").cast("string"), F.lit(" comma 6 L. 185"))).otherwise("prosa"))
    return p.filed_articles(x, pages).select(C("volume").alias("p_partkey"), "article")


def declared_overlap(spark: SparkSession, d: str) -> DataFrame:
    declared = table(spark, d, "nation").select((C("n_nationkey") % 5).alias("volume"), C("n_name").alias("code"), (C("n_nationkey") * 10).alias("start"), (C("n_nationkey") * 10 + 4).alias("end"))
    spans = table(spark, d, "supplier").select((C("s_suppkey") % 5).alias("volume"), C("s_name").alias("code"), (C("s_suppkey") * 13).alias("start"), (C("s_suppkey") * 13 + C("s_nationkey") % 6).alias("end"))
    return p.overlapping(declared, spans)


def next_volume(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of volumes, one a part: ten pages, then eight before the first table. What varies: numbers, headers."""
    k = C("p_partkey") % 5
    x = table(spark, d, "part").select((C("p_partkey") * 2).alias("v"), k.alias("kind"))
    one = x.select(C("v").alias("volume"), F.explode(F.sequence(F.lit(1), F.lit(10))).alias("page"), "kind").withColumn("numbers", F.when((C("page") == 10) & (C("kind") == 1), F.array().cast("array<int>")).otherwise(F.array(C("page") + 90))).withColumn("header", F.lit("TAB F"))
    two = x.select((C("v") + 1).alias("volume"), F.explode(F.sequence(F.lit(1), F.lit(12))).alias("page"), "kind").withColumn("numbers", F.when(C("page") < 3, F.array().cast("array<int>")).when((C("kind") == 2) & (C("page") == 6), F.array(F.lit(7))).otherwise(F.array(C("page") + 98, F.lit(3)))).withColumn("header", F.when(C("kind") == 3, "ALTRO").when(C("page") <= 5, "TAB F").otherwise("x"))
    spans = x.select(C("v").alias("volume"), F.lit("F").alias("code"), F.lit(4).alias("start"), F.when(C("kind") == 4, 8).otherwise(10).alias("end")).unionByName(x.select((C("v") + 1).alias("volume"), F.lit("G").alias("code"), F.lit(11).alias("start"), F.lit(12).alias("end")))
    return p.continued(spans, one.drop("kind").unionByName(two.drop("kind"))).filter("code = 'F'").select((C("from_volume") / 2).cast("bigint").alias("p_partkey"), C("start").cast("bigint").alias("start"), C("end").cast("bigint").alias("end"))


def kept_copies(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    found = c.select((C("c_custkey") % 4 + 1).alias("volume"), F.lit("MAE").alias("authority"), F.when(C("c_nationkey") % 2 == 0, "A5").alias("article"), C("c_custkey").alias("id"), (F.floor(C("c_custkey") / 3)).cast("string").alias("code"), (C("c_custkey") % 3 + 1).alias("start"), (C("c_custkey") % 2 + 9).alias("end"), F.element_at(F.array(F.lit("embedded"), F.lit("header"), F.lit("title")), (C("c_nationkey") % 3 + 1).cast("int")).alias("source"), (C("c_custkey") % 5 == 0).alias("index_agrees"))
    folios = table(spark, d, "region").filter("r_regionkey < 4").select((C("r_regionkey") + 1).alias("volume"), F.lit(2).alias("first"), F.lit(10).alias("last"))
    return p.keep_copies(found, ["authority", "article", "code"], folios).select("id", "kept")


KEPT_SQL = """WITH f AS (SELECT c_custkey % 4 + 1 AS volume, CASE WHEN c_nationkey % 2 = 0 THEN 'A5' ELSE '' END AS article, c_custkey AS id, CAST(c_custkey // 3 AS VARCHAR) AS code, c_custkey % 3 + 1 <= 2 AS head, c_custkey % 2 + 9 >= 10 AS tail, 3 - c_nationkey % 3 AS rank, c_custkey % 5 = 0 AS agrees FROM customer),
c AS (SELECT *, lag(tail) OVER w AS was, lag(volume) OVER w AS pv, row_number() OVER w AS nth FROM f WINDOW w AS (PARTITION BY article, code ORDER BY volume)),
k AS (SELECT *, bool_and(nth = 1 OR (head AND was AND pv = volume - 1)) OVER (PARTITION BY article, code) AS chained, row_number() OVER (PARTITION BY article, code ORDER BY rank DESC, tail, agrees DESC, volume) AS best FROM c)
SELECT id, chained OR best = 1 AS kept FROM k"""


# ---------------------------------------------------------------- the list and the rest


def _listed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, d, "customer")
    spans = c.select(F.lit("MAE").alias("authority"), F.when(C("c_nationkey") % 2 == 0, "A5").alias("article"), F.concat(F.lit("C"), F.floor(C("c_custkey") / 2).cast("string")).alias("code"), (C("c_custkey") % 3).alias("volume"), (C("c_custkey") % 50).alias("start"), (C("c_custkey") % 50 + C("c_nationkey")).alias("end"), (C("c_custkey") % 7 != 0).alias("kept"), (C("c_acctbal") < 0).alias("provisional"))
    more = c.filter("c_mktsegment = 'BUILDING'").select(F.lit("MAE").alias("authority"), F.when(C("c_nationkey") % 2 == 0, "A5").alias("article"), F.concat(F.lit("C"), F.floor(C("c_custkey") / 2).cast("string")).alias("code"), F.lit(9).cast("bigint").alias("volume"), F.lit(1).cast("bigint").alias("start"), F.lit(3).cast("bigint").alias("end"))
    return spans, more


def table_list(spark: SparkSession, d: str) -> DataFrame:
    spans, more = _listed(spark, d)
    plan = p.table_plan(spans, more)
    pr = spans.filter("kept").groupBy("authority", F.coalesce("article", F.lit("")).alias("art"), "code").agg(F.max("provisional").alias("provisional"))
    plan = plan.withColumn("art", F.coalesce("article", F.lit(""))).join(pr, ["authority", "art", "code"], "left").drop("art")
    missing = table(spark, d, "nation").select(F.concat(F.lit("Z"), "n_name").alias("code"))
    return p.table_list(plan, spans, missing)


LIST_SQL = """WITH s AS (SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'MAE/A5/C' ELSE 'MAE/C' END || (c_custkey // 2) AS key, c_custkey % 3 AS volume, c_custkey % 50 AS a, c_custkey % 50 + c_nationkey AS z, c_custkey % 7 <> 0 AS kept, c_acctbal < 0 AS pr, 0 AS c FROM customer),
m AS (SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'MAE/A5/C' ELSE 'MAE/C' END || (c_custkey // 2) AS key, 9 AS volume, 1 AS a, 3 AS z, true AS kept, NULL AS pr, 1 AS c FROM customer WHERE c_mktsegment = 'BUILDING'),
u AS (SELECT * FROM s WHERE kept UNION ALL SELECT * FROM m)
SELECT key, CASE WHEN coalesce(bool_or(pr), false) THEN 'provisional' ELSE 'ok' END AS status, string_agg('V' || volume || ':' || a || '-' || z, '+' ORDER BY volume, c, a) AS segments, CAST(sum(z - a + 1) AS BIGINT) AS pages FROM u GROUP BY key
UNION ALL SELECT key, 'reprint', 'V' || volume || ':' || a || '-' || z, z - a + 1 FROM s WHERE NOT kept UNION ALL SELECT 'Z' || n_name, 'listed-missing', '', 0 FROM nation"""


def listed_missing(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "part").select((C("p_partkey") % 7).alias("volume"), F.concat(F.substring("p_type", 1, 2), F.when(C("p_size") % 3 == 0, "A").otherwise("")).alias("code"))
    found = table(spark, d, "part").filter("p_size > 25").select((C("p_partkey") % 7).alias("volume"), F.substring("p_type", 1, 2).alias("code"))
    return p.listed_missing(listed, found)


def trash_runs(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    pages = o.select((C("o_custkey") % 3).alias("volume"), C("o_orderkey").alias("page"))
    claimed = o.filter("o_orderstatus = 'F'").select((C("o_custkey") % 3).alias("volume"), C("o_orderkey").alias("page"))
    marks = o.select((C("o_custkey") % 3).alias("volume"), C("o_orderkey").alias("page"), F.when(C("o_orderpriority") == "1-URGENT", "gazette").when(C("o_orderpriority") == "2-HIGH", "listing").alias("mark")).filter("mark IS NOT NULL")
    start = C("o_orderkey")
    ranges = o.filter("o_orderkey % 4 < 2").select((C("o_custkey") % 3).alias("volume"), start.alias("start"), (start + C("o_orderkey") % 4).alias("end"), F.element_at(F.array(*map(F.lit, ("dropped-copy", "given-up-reprint", "cut-at-boundary", "trimmed-tail"))), (C("o_custkey") % 4 + 1).cast("int")).alias("reason"), (C("o_custkey") % 4).alias("rank"))
    return p.trash(pages, claimed, marks, ranges)


TRASH_SQL = """WITH o AS (SELECT o_custkey % 3 AS volume, o_orderkey AS page, o_orderstatus = 'F' AS claimed, CASE o_orderpriority WHEN '1-URGENT' THEN 'g' WHEN '2-HIGH' THEN 'l' END AS mark, o_custkey % 4 AS rank, o_orderkey % 4 AS more FROM orders),
u AS (SELECT *, page - row_number() OVER (PARTITION BY volume ORDER BY page) AS g FROM o WHERE NOT claimed),
r AS (SELECT volume, min(page) AS first, max(page) AS last, count(*) AS n, count(*) FILTER (mark = 'g') AS gz, count(*) FILTER (mark = 'l') AS ls FROM u GROUP BY volume, g),
x AS (SELECT r.volume, r.first, min(rank) AS rank FROM r JOIN o ON o.volume = r.volume AND o.page = r.first WHERE more < 2 AND CASE WHEN rank < 2 THEN last = page + more WHEN rank = 3 THEN last <= page + more ELSE true END GROUP BY 1, 2),
v AS (SELECT volume, max(page) AS pages FROM o GROUP BY 1)
SELECT r.volume, r.first, last, n, CASE WHEN gz = n THEN 'gazette-pasted' WHEN ls = n THEN 'listing' WHEN rank IS NOT NULL THEN ['dropped-copy', 'given-up-reprint', 'cut-at-boundary', 'trimmed-tail'][CAST(rank + 1 AS INT)] WHEN r.first = 1 THEN 'front-matter' WHEN last = pages THEN 'volume-tail' ELSE 'no-detector' END AS reason
FROM r JOIN v ON v.volume = r.volume LEFT JOIN x ON x.volume = r.volume AND x.first = r.first"""


def closed_accounting(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    pages = o.select((C("o_custkey") % 30).alias("volume"), C("o_orderkey").alias("page"))
    claimed = o.filter("o_orderstatus = 'F'").select((C("o_custkey") % 30).alias("volume"), (C("o_orderkey") + F.when(C("o_custkey") % 30 == 7, 1_000_000_000).otherwise(0)).alias("page"))
    kept = claimed.filter("volume <> 7")
    from pagelake.operators.account import unclaimed

    return p.accounting(pages, claimed, unclaimed(pages, kept, ["volume"], "page").filter("volume <> 8 OR n > 1"))


ACCOUNT_SQL = """WITH o AS (SELECT o_custkey % 30 AS volume, o_orderkey AS page, o_orderstatus = 'F' AND o_custkey % 30 <> 7 AS claimed FROM orders),
u AS (SELECT *, page - row_number() OVER (PARTITION BY volume ORDER BY page) AS g FROM o WHERE NOT claimed), r AS (SELECT volume, count(*) AS n FROM u GROUP BY volume, g),
t AS (SELECT volume, sum(n) AS trashed FROM r WHERE volume <> 8 OR n > 1 GROUP BY volume)
SELECT o.volume, count(*) AS pages, count(*) FILTER (claimed) AS claimed, CAST(coalesce(max(trashed), 0) AS BIGINT) AS trashed, count(*) FILTER (claimed) + coalesce(max(trashed), 0) = count(*) AS closed FROM o LEFT JOIN t ON t.volume = o.volume GROUP BY o.volume"""


def printed_pages(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").groupBy((C("l_suppkey") % 40).alias("volume"), C("l_partkey").alias("page")).agg(F.max("l_linenumber").alias("m"))
    off = F.when(C("volume") % 4 != 3, C("volume") % 4)
    label = F.when(C("m") % 3 == 0, "iv").when((C("volume") % 2 == 0) | (C("m") % 2 == 0), (C("page") + off).cast("string")).otherwise((C("page") + 50).cast("string"))
    x = x.withColumns({"offset": off, "label": label})
    a = p.labels_agree(x)
    return x.join(a, "volume").select("volume", "page", "agree", p.printed_page(C("page"), C("label"), C("agree"), C("offset")).cast("bigint").alias("printed"))


PRINTED_SQL = """WITH x AS (SELECT l_suppkey % 40 AS volume, l_partkey AS page, max(l_linenumber) AS m FROM lineitem GROUP BY 1, 2), o AS (SELECT *, CASE WHEN volume % 4 <> 3 THEN volume % 4 END AS off FROM x),
l AS (SELECT *, CASE WHEN m % 3 = 0 THEN NULL WHEN volume % 2 = 0 OR m % 2 = 0 THEN page + off ELSE page + 50 END AS num FROM o),
a AS (SELECT volume, max(off) IS NULL OR 2 * count(*) FILTER (num = page + off) >= count(num) AS agree FROM l GROUP BY volume)
SELECT l.volume, page, agree, CAST(CASE WHEN num IS NOT NULL AND agree THEN num ELSE page + coalesce(off, 0) END AS BIGINT) AS printed FROM l JOIN a ON a.volume = l.volume"""


def plan_walk(spark: SparkSession, d: str) -> DataFrame:
    plan = table(spark, d, "part").select((C("p_partkey") % 9).alias("volume"), C("p_partkey").alias("ord"), C("p_name").alias("name"), C("p_partkey").cast("string").alias("code"), C("p_size").cast("bigint").alias("pages"))
    anchors = plan.filter("pages % 6 = 0").select("volume", "code", (C("ord") * 40).alias("start"))
    return p.place_from_plan(plan.drop("name"), anchors).select(C("ord").alias("p_partkey"), "start", "how")


def reconciled_index(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    key = F.concat(F.lit("K"), C("c_custkey").cast("string")).alias("key")
    files = c.filter("c_custkey % 5 <> 0").select((C("c_nationkey") % 5).alias("volume"), key)
    listed = c.filter("c_custkey % 7 <> 0").select((C("c_nationkey") % 5).alias("volume"), key, ((C("c_custkey") * 31) % 97).alias("ord"))
    marks = c.filter("c_custkey % 3 <> 0").select((C("c_nationkey") % 5).alias("volume"), key, C("c_custkey").alias("page"))
    return verify.reconcile(files, listed, marks, ["volume"])


RECONCILE_SQL = """WITH c AS (SELECT c_nationkey % 5 AS volume, c_custkey AS k, 'K' || c_custkey AS key, c_custkey % 5 <> 0 AS f, c_custkey % 7 <> 0 AS l, c_custkey % 3 <> 0 AS b, (c_custkey * 31) % 97 AS ord FROM customer),
n AS (SELECT volume, key, lead(ord) OVER (PARTITION BY volume ORDER BY k, key) < ord AS bad FROM c WHERE f AND l AND b)
SELECT volume, key, 'missing' AS finding FROM c WHERE (l OR b) AND NOT f UNION ALL SELECT volume, key, 'unattested' FROM c WHERE f AND NOT l AND NOT b UNION ALL SELECT volume, key, 'index_or_bookmark' FROM c WHERE l <> b UNION ALL SELECT volume, key, 'order_conflict' FROM n WHERE bad"""

QUERIES = {
    "index_blocks": (index_blocks, told({"blocks": [x[1] for x in INDEXES]})),
    "index_valid": (index_valid, f"""WITH {B_SQL}, {F_SQL}, u AS (SELECT *, coalesce(folio > lag(folio) OVER (PARTITION BY volume ORDER BY ord), true) AS up FROM b)
SELECT f.volume, CASE WHEN count(name) = 0 THEN 'no index' WHEN count(name) < 3 THEN 'too few blocks' WHEN NOT coalesce(bool_and(up), true) THEN 'folios not increasing' WHEN any_value(off) IS NULL THEN 'no folios' WHEN any_value(coverage) < 0.5 THEN 'folios hardly legible' WHEN count(*) FILTER (folio BETWEEN 1 + off AND 300 + off) = 0 THEN 'no block in this volume' ELSE 'ok' END AS reason FROM f LEFT JOIN u ON u.volume = f.volume GROUP BY f.volume"""),
    "index_edges": (index_edges, f"WITH {B_SQL}, {F_SQL} SELECT b.volume, CAST(folio - off AS BIGINT) AS page, name FROM b JOIN f ON f.volume = b.volume WHERE folio - off BETWEEN 1 AND pages"),
    "owner_by_index": (owner_by_index, f"""WITH {B_SQL}, {F_SQL}, q AS (SELECT DISTINCT o_custkey % 25 AS volume, o_orderkey % 300 + 1 AS page FROM orders)
SELECT q.volume, q.page, (SELECT max_by(name, (folio, name)) FROM b WHERE b.volume = q.volume AND name <> 'INTERNO' AND folio <= q.page + off) AS authority FROM q JOIN f ON f.volume = q.volume"""),
    "folio_offsets": (folio_offsets, """WITH o AS (SELECT o_custkey % 50 AS volume, CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey + CASE WHEN o_orderkey % 3 = 0 THEN 9 ELSE o_custkey % 2 END) % 9999 - o_orderkey END AS off FROM orders),
n AS (SELECT volume, off, count(*) AS n FROM o WHERE off IS NOT NULL GROUP BY 1, 2), t AS (SELECT volume, off FROM n QUALIFY row_number() OVER (PARTITION BY volume ORDER BY n DESC, off) = 1)
SELECT o.volume, count(*) AS pages, any_value(t.off) AS offset, count(o.off) / CAST(count(*) AS DOUBLE) AS coverage FROM o LEFT JOIN t ON t.volume = o.volume GROUP BY o.volume"""),
    "placement_votes": (placement_votes, """WITH x AS (SELECT l_suppkey, CASE WHEN l_linenumber < 3 THEN 'DOG' WHEN l_linenumber = 3 THEN 'MAE' WHEN l_linenumber = 4 THEN 'MEF' END AS a, CASE l_returnflag WHEN 'R' THEN 'A1C2' WHEN 'A' THEN 'A5' END AS r FROM lineitem),
a AS (SELECT l_suppkey, a FROM x WHERE a IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, a) = 1), r AS (SELECT l_suppkey, r FROM x WHERE r IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, r) = 1)
SELECT s.l_suppkey, coalesce(a, 'UNKNOWN') AS authority, CASE WHEN a IN ('DOG', 'DIFESA') THEN r END AS article FROM (SELECT DISTINCT l_suppkey FROM x) s LEFT JOIN a ON a.l_suppkey = s.l_suppkey LEFT JOIN r ON r.l_suppkey = s.l_suppkey"""),
    "run_clusters": (run_clusters, f"WITH {CLUSTER_SQL} SELECT * FROM cl"),
    "span_starts": (span_starts, f"WITH {START_SQL} SELECT * FROM st"),
    "span_ends": (span_ends, ENDS_SQL),
    "span_trims": (span_trims, told({"end4": [t[1] for t in TRIMS], "note": [t[2] for t in TRIMS], "end5": [t[4] for t in TRIMS], "end6": [t[6] for t in TRIMS]}, "supplier", "s_suppkey")),
    "table_covers": (table_covers, told({"cover": [c[3] for c in COVERED], "start": [c[4] for c in COVERED]})),
    "defence_articles": (defence_articles, "SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'OLD' WHEN p_partkey % 4 > 0 THEN 'A' || (p_partkey % 4) || 'C6' END AS article FROM part"),
    "declared_overlap": (declared_overlap, """SELECT n_nationkey % 5 AS volume, n_name AS declared, s_name AS code, greatest(n_nationkey * 10, s_suppkey * 13) AS first, least(n_nationkey * 10 + 4, s_suppkey * 13 + s_nationkey % 6) - greatest(n_nationkey * 10, s_suppkey * 13) + 1 AS n
FROM nation JOIN supplier ON n_nationkey % 5 = s_suppkey % 5 AND n_nationkey * 10 <= s_suppkey * 13 + s_nationkey % 6 AND s_suppkey * 13 <= n_nationkey * 10 + 4"""),
    "next_volume": (next_volume, "SELECT p_partkey, 3::BIGINT AS start, (CASE WHEN p_partkey % 5 = 2 THEN 5 ELSE 7 END)::BIGINT AS \"end\" FROM part WHERE p_partkey % 5 IN (0, 2)"),
    "kept_copies": (kept_copies, KEPT_SQL),
    "table_list": (table_list, LIST_SQL),
    "listed_missing": (listed_missing, f"""WITH l AS (SELECT DISTINCT p_partkey % 7 AS volume, substr(p_type, 1, 2) || CASE WHEN p_size % 3 = 0 THEN 'A' ELSE '' END AS a FROM part), h AS (SELECT DISTINCT p_partkey % 7 AS volume, substr(p_type, 1, 2) AS b FROM part WHERE p_size > 25)
SELECT volume, a AS code FROM l WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.volume = l.volume AND {SAME})"""),
    "trash_runs": (trash_runs, TRASH_SQL),
    "closed_accounting": (closed_accounting, ACCOUNT_SQL),
    "printed_pages": (printed_pages, PRINTED_SQL),
    "plan_walk": (plan_walk, """WITH q AS (SELECT p_partkey % 9 AS volume, p_partkey, CAST(p_size AS BIGINT) AS n, CASE WHEN p_size % 6 = 0 THEN p_partkey * 40 END AS a FROM part),
s AS (SELECT *, count(a) OVER (PARTITION BY volume ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM q)
SELECT p_partkey, CAST(CASE WHEN g > 0 THEN max(a) OVER (PARTITION BY volume, g) + coalesce(sum(n) OVER (PARTITION BY volume, g ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS BIGINT) AS start, CASE WHEN a IS NOT NULL THEN 'anchor' WHEN g > 0 THEN 'counted' ELSE 'unplaced' END AS how FROM s"""),
    "reconciled_index": (reconciled_index, RECONCILE_SQL),
}
