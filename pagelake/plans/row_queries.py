"""Queries of rows of tables: links of items, headers, bodies read from words and rules, bands, figures and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.numbers import parse_number, status
from pagelake.operators import extract, grammar, reader
from pagelake.plans.made import dealt, told
from pagelake.sources.tables import table

C = F.col


def link_items(spark: SparkSession, d: str) -> DataFrame:
    e, t = table(spark, d, "events"), C("event_type")
    text = lambda cond, c: F.when(cond, c).otherwise("")
    n = C("event_id").cast("string")
    e = e.select("user_id", "event_id", (F.floor(C("event_id") / 400) % 2).cast("string").alias("grp"), text(t == "signup", F.lit("x")).alias("opener"), text((t == "purchase") | ((t == "click") & (C("event_id") % 13 == 0)), n).alias("amount"), text(t == "click", F.concat(F.lit("q"), n)).alias("item"), text(C("event_id") % 3 == 0, F.concat(F.lit("n"), n)).alias("note"))
    return extract.link_items(e, ["user_id"], "event_id", "grp", "opener", "amount", "item", ["note"], ["item", "note"]).select("user_id", "event_id", "item", "note", "unit", "link", "implied", "copied_from", "issues")


LINK_SQL = """WITH e AS (SELECT user_id, event_id AS n, CAST((event_id // 400) % 2 AS VARCHAR) AS grp, event_type = 'signup' AS op, event_type = 'purchase' OR (event_type = 'click' AND event_id % 13 = 0) AS a, event_type = 'click' AS i, CASE WHEN event_id % 3 = 0 THEN 'n' || event_id ELSE '' END AS note FROM events),
o AS (SELECT *, op OR grp IS DISTINCT FROM lag(grp) OVER (PARTITION BY user_id ORDER BY n) AS opens FROM e),
u AS (SELECT *, max(CASE WHEN opens THEN n END) OVER (PARTITION BY user_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS unit FROM o),
b AS (SELECT *, max(CASE WHEN i THEN n END) OVER (PARTITION BY user_id, unit ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above, count(*) FILTER (a) OVER (PARTITION BY user_id, unit) AS na, count(*) FILTER (i) OVER (PARTITION BY user_id, unit) AS ni FROM u),
m AS (SELECT user_id, above AS n, string_agg(note, ' ' ORDER BY n) AS more FROM b WHERE a AND NOT i AND above IS NOT NULL AND note <> '' GROUP BY 1, 2),
t AS (SELECT b.*, CASE WHEN a AND NOT i AND above IS NOT NULL THEN '' WHEN i THEN concat_ws(' ', nullif(note, ''), more) ELSE note END AS text FROM b LEFT JOIN m ON m.user_id = b.user_id AND m.n = b.n),
c AS (SELECT t.*, s.text AS stext, t.na > t.ni AND t.ni > 0 AND t.a AND NOT t.i AND t.above IS NOT NULL AS copies FROM t LEFT JOIN t s ON s.user_id = t.user_id AND s.n = t.above),
x AS (SELECT *, i OR copies AS item2, CASE WHEN i THEN 'q' || n WHEN copies THEN 'q' || above ELSE '' END AS item, CASE WHEN copies AND text = '' THEN stext ELSE text END AS note2 FROM c),
k AS (SELECT *, count(*) FILTER (item2) OVER (PARTITION BY user_id, unit) AS nx, count(*) FILTER (item2) OVER v AS ki, count(*) FILTER (a) OVER v AS ka, max(CASE WHEN a THEN n END) OVER v AS cover FROM x WINDOW v AS (PARTITION BY user_id, unit ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
l AS (SELECT k.*, CASE WHEN k.ni = 0 OR NOT k.item2 OR k.na > k.nx THEN NULL WHEN k.na = 0 THEN k.n WHEN k.na = k.nx THEN y.n ELSE k.cover END AS link FROM k LEFT JOIN (SELECT user_id, unit, ka, n FROM k WHERE a) y ON y.user_id = k.user_id AND y.unit = k.unit AND y.ka = k.ki AND k.item2),
g AS (SELECT DISTINCT user_id, unit, link FROM l WHERE link IS NOT NULL)
SELECT l.user_id, n AS event_id, item, note2 AS note, l.unit, l.link, item2 AND na = 0 AS implied, CASE WHEN copies THEN above END AS copied_from,
  array_to_string(list_filter([CASE WHEN n = l.unit AND ni = 0 THEN 'no_item' END, CASE WHEN n = l.unit AND ni > 0 AND na > nx THEN 'too_many_amounts' END, CASE WHEN a AND NOT i AND above IS NULL AND note <> '' THEN 'text_without_item' END, CASE WHEN na > 0 AND na < nx AND item2 AND cover IS NULL THEN 'above_first' END, CASE WHEN na > 0 AND na < nx AND a AND g.link IS NULL THEN 'covers_none' END], lambda v: v IS NOT NULL), ',') AS issues
FROM l LEFT JOIN g ON g.user_id = l.user_id AND g.unit = l.unit AND g.link = l.n"""


# ---------------------------------------------------------------- tables printed as words and rules, and read back

SPEC = reader.Agreed([("operatore", "text", ["operatore"]), ("codice", "code", ["cod."]), ("euro", "amount", ["valore y"])], group=True)
EDGES = [10.0, 110.0, 210.0, 310.0]
LINES, FIRST = 14, 30.0  # lines on a page, and where the first one stands


def italian(c: Column) -> Column:
    """An amount as it is printed: points between thousands, a comma before the cents."""
    cents = F.abs(F.round(c * 100).cast("bigint"))
    whole = F.regexp_replace(F.floor(cents / 100).cast("bigint").cast("string"), r"(?<=\d)(?=(\d{3})+$)", ".")
    return F.concat(F.when(c < 0, "-").otherwise(""), whole, F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))


def printed_tables(spark: SparkSession, d: str) -> DataFrame:
    """Customers of each nation as a table over pages: a header, five records a group under a heading, the second one wrapped, and a
    total. Pages after the first have no header and lie five points further right; notes stand under the last page.
    """
    c = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name", "c_acctbal")
    c = c.withColumn("rn", F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) - 1)
    g, k = F.floor(C("rn") / 5).cast("int"), (C("rn") % 5).cast("int")
    at = g * 7 + F.element_at(F.array(*map(F.lit, (1, 2, 4, 5, 6))), k + 1)
    word = lambda t, col: F.struct(t.alias("text"), F.lit(col).alias("col"))
    line = lambda n, *ws: F.struct(n.cast("int").alias("line"), F.array(*ws).alias("ws"))
    code = F.lpad((C("c_custkey") % 1000).cast("string"), 3, "0")
    rows = F.array(line(at, word(C("c_name"), 0), word(code, 1), word(italian(C("c_acctbal")), 2)))
    heading, wrap = F.array(line(g * 7, word(F.concat(F.lit("Gruppo "), g.cast("string")), 0))), F.array(line(g * 7 + 3, word(F.lit("bis"), 1)))
    none = F.array().cast("array<struct<line:int,ws:array<struct<text:string,col:int>>>>")
    lines = c.select("c_nationkey", F.explode(F.concat(F.when(k == 0, heading).otherwise(none), rows, F.when(k == 1, wrap).otherwise(none))).alias("l")).select("c_nationkey", "l.*")
    last = c.groupBy("c_nationkey").agg(F.sum(C("c_acctbal").cast("decimal(18,2)")).alias("s"), (F.max(at) + 2).alias("n"))
    total = last.select("c_nationkey", C("n").cast("int").alias("line"), F.array(word(F.lit("Totale"), 0), word(italian(C("s")), 2)).alias("ws"))
    lines = lines.unionByName(total).withColumn("page", F.floor((C("line") + 1) / LINES) + 1)
    v = F.lit(FIRST) + ((C("line") + 1) % LINES) * 14.0
    moved = F.when(C("page") > 1, 5.0).otherwise(0.0)
    boxes = F.transform("ws", lambda w: F.struct(w["text"].alias("text"), (moved + 14.0 + 100.0 * w["col"]).alias("u0"), (moved + 90.0 + 100.0 * w["col"]).alias("u1"), v.alias("v0"), (v + 9.0).alias("v1"), F.lit(9.0).alias("size")))
    pages = lines.select("c_nationkey", "page", boxes.alias("ws"), v.alias("v")).groupBy("c_nationkey", "page").agg(F.flatten(F.collect_list("ws")).alias("ws"), F.max("v").alias("low"))
    head = F.array(*[F.struct(F.lit(t).alias("text"), F.lit(EDGES[i] + 4).alias("u0"), F.lit(EDGES[i] + 60).alias("u1"), F.lit(12.0).alias("v0"), F.lit(20.0).alias("v1"), F.lit(9.0).alias("size")) for i, t in enumerate(("Operatore", "Cod.", "Valore 2025"))])
    stamp = F.array(F.struct((F.lit("Pagina 1 di 2")).alias("text"), F.lit(20.0).alias("u0"), F.lit(80.0).alias("u1"), (C("low") + 60).alias("v0"), (C("low") + 69).alias("v1"), F.lit(9.0).alias("size")))
    shift = F.when(C("page") > 1, 5.0).otherwise(0.0)
    walls = F.transform(F.array(*map(F.lit, EDGES)), lambda u: F.struct((u + shift).alias("u"), F.lit(10.0).alias("v0"), (C("low") + 12).alias("v1")))
    floors = F.array(*[F.struct(x.alias("v"), (F.lit(EDGES[0]) + shift).alias("u0"), (F.lit(EDGES[-1]) + shift).alias("u1")) for x in (F.lit(10.0), F.lit(24.0), C("low") + 12)])
    only_top = F.array(*[F.struct(x.alias("v"), (F.lit(EDGES[0]) + shift).alias("u0"), (F.lit(EDGES[-1]) + shift).alias("u1")) for x in (C("low") + 12,)])
    return pages.select("c_nationkey", C("page").cast("int").alias("page"), F.lit(2025).alias("year"), F.concat(F.when(C("page") == 1, head).otherwise(F.array().cast(reader.WORDS)), "ws", stamp).alias("words"), walls.alias("walls"), F.when(C("page") == 1, floors).otherwise(only_top).alias("floors"))


def _placed(spark: SparkSession, d: str) -> DataFrame:
    read = reader.headers(printed_tables(spark, d), ["c_nationkey"], SPEC, "year")
    return reader.place(reader.page_rows(read, ["c_nationkey"], SPEC), ["c_nationkey"], SPEC)


def read_pages(spark: SparkSession, d: str) -> DataFrame:
    read = reader.headers(printed_tables(spark, d), ["c_nationkey"], SPEC, "year")
    return read.select("c_nationkey", C("page").cast("bigint").alias("page"), "kind", F.array_join("labels", "|").alias("labels"), F.array_join(F.transform("edges", lambda e: F.round(e).cast("int").cast("string")), ",").alias("edges"))


def read_tables(spark: SparkSession, d: str) -> DataFrame:
    cell = lambda k: F.get("cells", F.lit(k))
    return _placed(spark, d).select("c_nationkey", "row_ord", "kind", "group", cell(0).alias("operatore"), cell(1).alias("codice"), parse_number(cell(2)).cast("double").alias("euro"))


ORDERED = """r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS rn FROM customer), f AS (SELECT *, rn // 5 AS g, rn + rn // 5 + 2 AS ord FROM r)"""
TABLES_SQL = f"""WITH {ORDERED}
SELECT c_nationkey, CAST(ord AS BIGINT) AS row_ord, 'data' AS kind, 'Gruppo ' || g AS "group", c_name AS operatore, lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || CASE WHEN rn % 5 = 1 THEN ' bis' ELSE '' END AS codice, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS euro FROM f
UNION ALL SELECT c_nationkey, CAST(min(ord) - 1 AS BIGINT), 'group', 'Gruppo ' || g, NULL, NULL, NULL FROM f GROUP BY c_nationkey, g
UNION ALL SELECT c_nationkey, CAST(max(ord) + 1 AS BIGINT), 'total', NULL, 'Totale', '', CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) FROM f GROUP BY c_nationkey"""
PAGES_SQL = f"""WITH {ORDERED}, n AS (SELECT c_nationkey, max(g * 7 + [1, 2, 4, 5, 6][CAST(rn % 5 + 1 AS INT)]) + 2 AS last FROM f GROUP BY 1), p AS (SELECT c_nationkey, unnest(range(1, (last + 1) // 14 + 2)) AS page FROM n)
SELECT c_nationkey, page, CASE WHEN page = 1 THEN 'header' ELSE 'continuation' END AS kind, 'Operatore|Cod.|Valore 2025' AS labels, CASE WHEN page = 1 THEN '10,110,210,310' ELSE '15,115,215,315' END AS edges FROM p"""


def read_totals(spark: SparkSession, d: str) -> DataFrame:
    p = _placed(spark, d).withColumn("v", parse_number(F.get("cells", F.lit(2))))
    out = reader.figure_checks(p.withColumns({"value": F.when(C("kind") == "data", C("v")), "printed": F.when(C("kind") != "data", C("v"))}), ["c_nationkey"], "value", "printed")
    return out.select("c_nationkey", "kind", C("printed").cast("double").alias("printed"), C("computed").cast("double").alias("computed"), status(C("printed"), C("computed")).alias("status"))


def outside_tables(spark: SparkSession, d: str) -> DataFrame:
    """Pages with a note, a stray line or an amount put under the table of each nation."""
    p = printed_tables(spark, d).filter("page = 1")
    low = F.array_max(F.transform("walls", lambda w: w["v1"]))
    say = lambda t, dv: F.struct(t.alias("text"), F.lit(20.0).alias("u0"), F.lit(90.0).alias("u1"), (low + dv).alias("v0"), (low + dv + 9).alias("v1"), F.lit(9.0).alias("size"))
    k = C("c_nationkey") % 3
    more = F.array(say(F.when(k == 0, "(*) nota").when(k == 1, "riga estranea").otherwise("Pag. 2 di 9"), 20.0), say(F.lit("seguito"), 34.0))
    p = p.withColumn("words", F.concat("words", more))
    read = reader.headers(p, ["c_nationkey"], SPEC, "year")
    return reader.page_notes(read, ["c_nationkey"], SPEC).select("c_nationkey", C("seq").cast("bigint").alias("seq"), "kind", "text")


OUTSIDE_SQL = """WITH n AS (SELECT DISTINCT c_nationkey, c_nationkey % 3 AS k FROM customer)
SELECT c_nationkey, 0 AS seq, CASE k WHEN 0 THEN 'note' ELSE 'line' END AS kind, CASE k WHEN 0 THEN '(*) nota' ELSE 'riga estranea' END AS text FROM n WHERE k < 2
UNION ALL SELECT c_nationkey, CASE WHEN k < 2 THEN 1 ELSE 0 END, CASE k WHEN 0 THEN 'note' ELSE 'line' END, 'seguito' FROM n UNION ALL SELECT c_nationkey, 2, 'note', 'Pagina 1 di 2' FROM n WHERE k = 0"""

SUMMARY = [["Numero", "autorizzazioni:", "2.066"], ["Di cui relativi a"], ["temporanee", ":", "10,5", "%"], ["Totali parziali:"], ["AED", "1.000,00"], ["BGN", "€ 2,50"], ["Pagina 3 di 9"], ["Valore", "3,00", "4,00"]]


def summary_pages(spark: SparkSession, d: str) -> DataFrame:
    """A page after the table without columns: labels over lines, sections, percents, two values in a line."""
    words = [(t, 20.0 + 80 * i, 60.0 + 80 * i, 40.0 + 14 * k, 49.0 + 14 * k, 9.0) for k, ws in enumerate(SUMMARY) for i, t in enumerate(ws)]
    page = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(w, ("text", "u0", "u1", "v0", "v1", "size"), strict=True)]) for w in words])
    first = printed_tables(spark, d).filter("page = 1")
    after = first.select("c_nationkey", F.lit(2).alias("page"), "year", page.alias("words"), F.array().cast("array<struct<u:double,v0:double,v1:double>>").alias("walls"), F.array().cast("array<struct<v:double,u0:double,u1:double>>").alias("floors"))
    read = reader.headers(first.unionByName(after), ["c_nationkey"], SPEC, "year")
    return reader.page_summary(read, ["c_nationkey"]).select("c_nationkey", C("seq").cast("bigint").alias("seq"), "label", "value_raw")


SUMMARY_SQL = "WITH n AS (SELECT DISTINCT c_nationkey FROM customer) SELECT c_nationkey, seq, label, value_raw FROM n, (VALUES (0, 'Numero autorizzazioni', '2.066'), (1, 'Di cui relativi a temporanee (%)', '10,5'), (2, 'Totali parziali: AED', '1.000,00'), (3, 'Totali parziali: BGN', '€ 2,50'), (4, 'Totali parziali: Valore', '3,00'), (5, 'Totali parziali: Valore', '4,00')) v(seq, label, value_raw)"

LABELS = [(["Operatore", "Cod.", "Valore 2025"], 2025, True), (["OPERATORE", "Cod.", "Valore 2024"], 2025, False), (["Operatore", "Cod."], 2025, False), (["Operatore", "Valore 2025", "Cod."], 2025, False), ([" operatore ", "cod.", "VALORE  2023"], 2023, True)]
YEARS = [(["Voce", "2024", "2025"], True), (["Voce"], False), (["Voce", "2024", "Totale"], False), (["voce", "2025"], True), (["Altro", "2025"], False)]


def accepted_headers(spark: SparkSession, d: str) -> DataFrame:
    p = dealt(spark, d, {"labels": [x[0] for x in LABELS], "year": [x[1] for x in LABELS], "by_year": [x[0] for x in YEARS]})
    spec = reader.Agreed([("voce", "text", ["voce"]), ("valore", "years", [])], years=True)
    return p.select("p_partkey", reader.accepts(C("labels"), SPEC, C("year")).alias("accepted"), reader.accepts(C("by_year"), spec, F.lit(2025)).alias("years_accepted"), reader.fold_label(F.element_at("labels", -1), C("year")).alias("folded"))


CARRIED = [("Alfa", "1,00"), ("", "2,00"), ("Alfa Totale", "3,00"), ("", "4,00"), ("Beta", "5,00"), ("Gamma Totale", "9,00"), ("Totale complessivo", "12,00")]


def carried_rows(spark: SparkSession, d: str) -> DataFrame:
    """Seven written-out lines a table, one table a supplier: company, its lines, subtotals that name it or another."""
    spec = reader.Agreed([("ditta", "carry", ["ditta"]), ("totale", "amount", ["totale"])])
    made = F.array(*[F.struct(F.array(F.lit(a), F.lit(b)).alias("cells")) for a, b in CARRIED])
    x = table(spark, d, "supplier").select("s_suppkey", F.posexplode(made).alias("seq", "r")).select("s_suppkey", F.lit(1).alias("page"), "seq", "r.cells", F.lit(None).cast("string").alias("heading"), F.lit(False).alias("first"), F.lit(False).alias("boxed"))
    return reader.place(x, ["s_suppkey"], spec).select("s_suppkey", "row_ord", "kind", "group", F.get("cells", F.lit(0)).alias("ditta"), (F.size("carried") > 0).alias("filled"), "issue")


CARRIED_SQL = "SELECT s_suppkey, row_ord, kind, \"group\", ditta, filled, issue FROM supplier, (VALUES (1, 'data', NULL, 'Alfa', false, NULL), (2, 'data', NULL, 'Alfa', true, NULL), (3, 'subtotal', 'Alfa', 'Alfa Totale', false, NULL), (4, 'data', NULL, '', false, NULL), (5, 'data', NULL, 'Beta', false, NULL), (6, 'subtotal', 'Gamma', 'Gamma Totale', false, 'carry'), (7, 'total', NULL, 'Totale complessivo', false, NULL)) v(row_ord, kind, \"group\", ditta, filled, issue)"

RULES = [reader.SummaryRule("^Numero di ordini", "count", "v"), reader.SummaryRule("^Totale priorità (.+)$", "sum", "v", where="priority"), reader.SummaryRule("^Totale senza P$", "sum", "v", unless="p"), reader.SummaryRule("^Totale dei subtotali", "subtotals", "v")]


def summary_rules(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select((C("o_custkey") % 20).alias("k"), C("o_orderpriority").alias("priority"), C("o_totalprice").cast("decimal(38,4)").alias("v"), F.when(C("o_orderstatus") == "P", "P").alias("p"))
    labels = F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(t).alias("label")) for i, t in enumerate(("Numero di ordini", "Totale priorità 1-URGENT", "Totale senza P", "Totale dei subtotali", "Incidenza"))])
    lines = o.select("k").distinct().select("k", F.explode(labels).alias("x")).select("k", "x.*")
    subtotals = o.groupBy("k", "priority").agg(F.sum("v").alias("v"))
    return reader.summary_checks(lines, o, subtotals, ["k"], RULES).select("k", C("seq").cast("bigint").alias("seq"), "label", C("computed").cast("double").alias("computed"))


RULES_SQL = """WITH o AS (SELECT o_custkey % 20 AS k, o_orderpriority AS pr, CAST(o_totalprice AS DECIMAL(18,4)) AS v, o_orderstatus = 'P' AS p FROM orders), g AS (SELECT k, count(*) AS n, coalesce(sum(v) FILTER (pr = '1-URGENT'), 0) AS u, coalesce(sum(v) FILTER (NOT p), 0) AS w, sum(v) AS s FROM o GROUP BY k)
SELECT k, 0 AS seq, 'Numero di ordini' AS label, CAST(n AS DOUBLE) AS computed FROM g UNION ALL SELECT k, 1, 'Totale priorità 1-URGENT', CAST(u AS DOUBLE) FROM g UNION ALL SELECT k, 2, 'Totale senza P', CAST(w AS DOUBLE) FROM g UNION ALL SELECT k, 3, 'Totale dei subtotali', CAST(s AS DOUBLE) FROM g UNION ALL SELECT k, 4, 'Incidenza', NULL FROM g"""

# ---------------------------------------------------------------- bands and grammars

BANDS = [  # bands of cells, widths, kinds
    ([["A.C.S.A. STEEL", "", ""], ["EUR", "1.000,00", "03/03/2025"], ["", "3.700,00", "0,00"]], [50.0, 50.0, 50.0], "group,data,subtotal"),
    ([["Totale complessivo", "5,00", ""], ["", "", ""], ["1", "testo", "2,00"]], [50.0, 50.0, 50.0], "total,blank,data"),
    ([["1", "", ""], ["", "", "DITTA UNO SPA"], ["", "", "ALTRA DITTA"], ["", "", "5,00"]], [20.0, 25.0, 110.0], "data,data,data,continuation"),
    ([["", "", "5,00"], ["", "", "seguito"], ["", "", "ancora"]], [20.0, 25.0, 110.0], "continuation,wrapped,wrapped"),
    ([["testo", "altro", ""]], [50.0, 50.0, 50.0], "group"),
]
HEADS = [(["Valuta", "Ammontare", "2025"], True, True), (["86788", "INDIA", "€ 0,00"], False, True), (["", "", ""], False, False), (["x" * 61, "a", ""], False, False), (["Totale", "", ""], True, False)]


def band_kinds(spark: SparkSession, d: str) -> DataFrame:
    widths = F.element_at(F.array(*[F.array(*map(F.lit, b[1])) for b in BANDS]), C("kind") + 1)
    rows = F.element_at(F.array(*[F.array(*[F.array(*map(F.lit, r)) for r in b[0]]) for b in BANDS]), C("kind") + 1)
    x = dealt(spark, d, {"n": list(range(len(BANDS)))})
    return x.select("p_partkey", F.array_join(grammar.band_kinds(rows, widths), ",").alias("kinds"), F.array_join(F.transform(grammar.wide_columns(widths), lambda i: i.cast("string")), ",").alias("wide"))


def header_rows(spark: SparkSession, d: str) -> DataFrame:
    x = dealt(spark, d, {"cells": [h[0] for h in HEADS]})
    return x.select("p_partkey", grammar.is_label_row(C("cells")).alias("label_row"), grammar.is_header(C("cells"), F.lit(4)).alias("header"))


def repeated_columns(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").select("l_suppkey", (C("l_orderkey") * 10 + C("l_linenumber")).alias("o"), F.array("l_returnflag", F.floor(C("l_orderkey") / 500).cast("string"), F.when(C("l_linenumber") > 5, "x").otherwise("")).alias("cells"))
    return grammar.repeated_columns(x, ["l_suppkey"], "o").select("l_suppkey", C("ordinal").cast("bigint").alias("ordinal"), "filled", "distinct", "change_ratio")


REPEATED_SQL = """WITH c AS (SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS o, unnest([0, 1, 2]) AS ordinal, unnest([l_returnflag, CAST(l_orderkey // 500 AS VARCHAR), CASE WHEN l_linenumber > 5 THEN 'x' ELSE '' END]) AS v FROM lineitem),
w AS (SELECT *, lag(v) OVER (PARTITION BY l_suppkey, ordinal ORDER BY o) AS was FROM c WHERE v <> ''),
g AS (SELECT l_suppkey, ordinal, count(*) AS filled, count(DISTINCT v) AS "distinct", count(*) FILTER (was <> v) / CAST(nullif(count(*) - 1, 0) AS DOUBLE) AS change_ratio FROM w GROUP BY 1, 2)
SELECT * FROM g WHERE filled >= 2 AND change_ratio <= 0.34"""


def table_grammar(spark: SparkSession, d: str) -> DataFrame:
    q = C("l_quantity")
    kind = F.when(C("l_suppkey") % 6 == 0, F.when(q < 20, "wrapped").otherwise("data")).when(C("l_suppkey") % 6 == 1, F.when(q < 20, "group").when(q < 25, "subtotal").otherwise("data")).when(C("l_suppkey") % 6 == 2, "group").when(C("l_suppkey") % 6 == 3, F.when(q < 30, "continuation").otherwise("data")).when(C("l_suppkey") % 6 == 4, F.when(q < 10, "group").otherwise("data")).otherwise("data")
    c = grammar.kind_counts(table(spark, d, "lineitem").select("l_suppkey", kind.alias("kind")), ["l_suppkey"])
    return grammar.grammar(c.withColumns({"wide": F.lit(1), "varied": F.when(C("l_suppkey") % 12 >= 6, 3).otherwise(0)})).select("l_suppkey", "n", "grammar")


GRAMMAR_SQL = """WITH n AS (SELECT l_suppkey, l_suppkey % 6 AS m, l_suppkey % 12 >= 6 AS varied, count(*) AS n, count(*) FILTER (l_quantity < 20) AS q20, count(*) FILTER (l_quantity >= 20 AND l_quantity < 25) AS q25, count(*) FILTER (l_quantity < 30) AS q30, count(*) FILTER (l_quantity < 10) AS q10 FROM lineitem GROUP BY 1)
SELECT l_suppkey, n, CASE m WHEN 0 THEN CASE WHEN q20 = n OR q20 >= 0.3 * n THEN 'wrapped-list' WHEN varied THEN 'repeated-subdimension' ELSE 'flat' END
 WHEN 1 THEN CASE WHEN q20 + q25 = n THEN 'unknown' WHEN q20 > 0 AND q25 > 0 THEN 'group+subtotal' WHEN varied THEN 'repeated-subdimension' WHEN q20 > 0 THEN 'group+subtotal' ELSE 'flat' END WHEN 2 THEN 'unknown'
 WHEN 3 THEN CASE WHEN q30 = n THEN 'unknown' WHEN q30 >= 0.3 * n AND n - q30 <= 0.5 * n THEN 'wrapped-list' WHEN varied THEN 'repeated-subdimension' ELSE 'flat' END
 WHEN 4 THEN CASE WHEN q10 = n THEN 'unknown' WHEN varied THEN 'repeated-subdimension' WHEN q10 > 0 THEN 'group+subtotal' ELSE 'flat' END ELSE CASE WHEN varied THEN 'repeated-subdimension' ELSE 'flat' END END AS grammar FROM n"""

QUERIES = {
    "link_items": (link_items, LINK_SQL),
    "read_pages": (read_pages, PAGES_SQL),
    "read_tables": (read_tables, TABLES_SQL),
    "read_totals": (read_totals, "SELECT c_nationkey, 'total' AS kind, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS printed, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS computed, 'PASS' AS status FROM customer GROUP BY 1"),
    "outside_tables": (outside_tables, OUTSIDE_SQL),
    "summary_pages": (summary_pages, SUMMARY_SQL),
    "accepted_headers": (accepted_headers, told({"accepted": [x[2] for x in LABELS], "years_accepted": [x[1] for x in YEARS], "folded": ["valore y", "valore y-1", "cod.", "cod.", "valore y"]})),
    "carried_rows": (carried_rows, CARRIED_SQL),
    "summary_rules": (summary_rules, RULES_SQL),
    "band_kinds": (band_kinds, told({"kinds": [b[2] for b in BANDS], "wide": ["", "", "2", "2", ""]})),
    "header_rows": (header_rows, told({"label_row": [h[1] for h in HEADS], "header": [h[2] for h in HEADS]})),
    "repeated_columns": (repeated_columns, REPEATED_SQL),
    "table_grammar": (table_grammar, GRAMMAR_SQL),
}
