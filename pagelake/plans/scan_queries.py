"""Queries of scanning: detections of pages, promised codes, starts in the body, tables located end to end, unruled headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.operators import headers, scan
from pagelake.plans.made import dealt, told
from pagelake.sources.tables import spread, table

C = F.col
LIST = "ELENCO TABELLE\n" + "\n".join(f"Tabella {c} - titolo" for c in ("AA", "BB", "CC", "UE", "FG", "KK1"))
BANNER = "Dipartimento del Tesoro Direzione V\n"
#: Pages of a volume: text, what they name, what opens a section, authority.
PAGES = [
    ("MINISTERO\nrelazione", "", "MINISTERO", None),
    (LIST, "", None, None),
    ("Tabella AA\nriga 1,00 di testo\n- 3 -", "AA:title", None, "MEF"),
    ("Tabella AA\nriga 2,00 di testo\n- 4 -", "AA:title", None, "MEF"),
    (BANNER + "KK1\nx\ny", "KK1:promised", None, "MEF"),
    ("GAZZETTA UFFICIALE\nTabella AA", "", None, None),
    ("Tabella 8.1\nGrafico 2\ntesto", "T81:exhibit", None, None),
    ("si veda la tabella BB nel testo", "BB:inline", None, None),
    ("Agenzia delle Entrate\nsezione", "", "Agenzia delle Entrate", None),
    ("Riepilogo TAB. MG1 operatore\n5,00", "MG1:inline", None, "DOG"),
    ("", "", None, None),
    ("MAECI - UAMA - CENTRO INFORMATICO Pagina 1 di 2 TAB A1", "A1:stamp", None, "MAE"),
]


def _volumes(spark: SparkSession, d: str) -> DataFrame:
    """One volume a nation, of the written-out pages."""
    pages = F.array(*[F.lit(p[0]) for p in PAGES])
    return table(spark, d, "nation").select(C("n_nationkey").alias("volume"), F.posexplode(pages).alias("page", "text")).withColumn("page", C("page") + 1)


def _vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(C("n_nationkey").alias("volume"), F.array(*map(F.lit, ("AA", "BB", "CC", "A1"))).alias("codes"), F.lit(1).alias("family"))


def scanned_pages(spark: SparkSession, d: str) -> DataFrame:
    facts = scan.page_facts(_volumes(spark, d))
    found, sections = scan.promised(facts, scan.detections(facts, _vocabulary(spark, d)))
    named = found.groupBy("volume", "page").agg(F.array_join(F.sort_array(F.collect_list(F.concat("code", F.lit(":"), "evidence"))), ",").alias("named"))
    out = facts.select("volume", "page", "authority").join(named, ["volume", "page"], "left").join(sections, ["volume", "page"], "left")
    return out.select("volume", C("page").cast("bigint").alias("page"), F.coalesce("named", F.lit("")).alias("named"), "body", "authority")


def _values(rows: list[tuple]) -> str:
    say = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(map(say, r)) + ")" for r in rows)


SCAN_SQL = f"SELECT n_nationkey AS volume, page, named, body, authority FROM nation, (VALUES {_values([(k + 1, p[1], p[2], p[3]) for k, p in enumerate(PAGES)])}) v(page, named, body, authority)"


def body_starts(spark: SparkSession, d: str) -> DataFrame:
    """Four pages a part: a title over prose, a title over a title, one over a short line, and one of an unknown code."""
    texts = F.array(F.lit("Tabella BB\nAA"), F.lit("Tabella CI\nuna riga di prosa lunga"), F.lit("x\nTabella AA\nuna riga di prosa lunga\nTabella BB"), F.lit("Tabella ZZ\nuna riga di prosa lunga"), F.lit("Tabella AA\nuna riga di prosa lunga"))
    part = spread(table(spark, d, "part").select("p_partkey"), "p_partkey")
    p = part.select(C("p_partkey").alias("volume"), F.posexplode(texts).alias("page", "text"))
    v = part.select(C("p_partkey").alias("volume"), F.array(*map(F.lit, ("AA", "BB", "C1"))).alias("codes"))
    return scan.body_starts(scan.page_facts(p), v).select("volume", "code", C("page").cast("bigint").alias("page"))


#: Codes of a volume's list, whether it mixes bodies, what its pages name, and its family.
FAMILIES = [
    (["A1", "A2", "B1", "C1"], None, "x", 2), (["A", "B", "F", "G", "H1", "N1", "Q", "R"], False, "x", 3), (["A", "B", "F", "G", "AA", "BB", "CC", "DD2", "EE", "FF"], True, "x", 1),
    (["A", "B", "F", "G", "AA", "BB", "CC", "DD2"], False, "x", 1), ([], None, "Tabella Q e Tabella R", 3), (None, None, "Tabella Q e Tabella R1", 1), (None, None, "Tabella Q e Tabella A1", 2), (["AA"], None, "prosa", 1),
    (None, None, "TAB. A1", 1), (None, True, "TAB. A1", 2)]


def volume_families(spark: SparkSession, d: str) -> DataFrame:
    """A volume a part, of 60 pages, one of which names codes; every second page is looked at, so its place counts."""
    deal = lambda k, t: F.element_at(F.array(*[F.lit(f[k]).cast(t) if not isinstance(f[k], list) else F.array(*map(F.lit, f[k])).cast(t) for f in FAMILIES]), (C("p_partkey") % len(FAMILIES) + 1).cast("int"))
    v = spread(table(spark, d, "part").select("p_partkey", "p_size"), "p_partkey").select(C("p_partkey").alias("volume"), deal(0, "array<string>").alias("codes"), deal(1, "boolean").alias("mixed"), deal(2, "string").alias("t"), (C("p_size") % 2).alias("odd"))
    p = v.withColumn("page", F.explode(F.sequence(F.lit(1), F.lit(60)))).select("volume", "page", F.when(C("page") == 31 + C("odd"), C("t")).otherwise("prosa").alias("text"))
    return scan.families(p, v.filter("codes IS NOT NULL OR mixed IS NOT NULL")).select("volume", C("family").cast("bigint").alias("family"))


FAMILY_SQL = f"SELECT p_partkey AS volume, CASE WHEN named AND p_size % 2 = 1 THEN 1 ELSE family END AS family FROM part JOIN (VALUES {_values([(k, f[3], bool(f[2] not in ('x', 'prosa'))) for k, f in enumerate(FAMILIES)])}) v(k, family, named) ON k = p_partkey % {len(FAMILIES)}"


#: Pages of a volume whose tables are located: three of AA, two of M1 with its stamps, one stray page, blank leaves.
LOCATED = ["Tabella AA\nuna riga di testo", "Tabella AA\naltra riga", "Tabella AA\nultima riga", "TAB. M1 Pagina 1 di 2", "TAB. M1 Pagina 2 di 2", "Pagina 1 di 1 altro documento", "", "Pagina bianca"]


def located_tables(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "nation").select(C("n_nationkey").alias("volume"), F.posexplode(F.array(*map(F.lit, LOCATED))).alias("page", "text")).withColumn("page", (C("page") + 1).cast("bigint"))
    vocabulary = table(spark, d, "nation").select(C("n_nationkey").alias("volume"), F.array(F.lit("AA")).alias("codes"), F.lit(1).alias("family"))
    marks = table(spark, d, "nation").filter("n_nationkey % 2 = 0").select(C("n_nationkey").alias("volume"), F.lit("AA").alias("code"), F.lit(2).cast("bigint").alias("page"))
    t = scan.located(pages, vocabulary, marks)
    return t.select("volume", "authority", "article", "code", "start", C("end0").cast("bigint").alias("end0"), C("end4").cast("bigint").alias("end4"), C("end6").cast("bigint").alias("end6"), "source", "note")


LOCATED_SQL = """SELECT n_nationkey AS volume, 'MEF' AS authority, NULL::VARCHAR AS article, 'AA' AS code, CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END AS start, 3 AS end0, 3 AS end4, 3 AS end6, CASE WHEN n_nationkey % 2 = 0 THEN 'embedded' ELSE 'header' END AS source, '' AS note FROM nation
UNION ALL SELECT n_nationkey, 'DOG', 'A1C2', 'M1', 4, 8, 5, 5, 'header', 'trimmed' FROM nation"""

# ---------------------------------------------------------------- headers without a grid

W = lambda t, u, v, width=40.0: (t, u, u + width, v, v + 9.0, 9.0)
BODY = [W("Alfa", 20.0, 80.0), W("1,00", 120.0, 80.0), W("INDIA", 220.0, 80.0), W("5", 320.0, 80.0)] + [W(t, u, 94.0) for t, u in (("Beta", 20.0), ("2,00", 120.0), ("OMAN", 220.0), ("6", 320.0))] + [W(t, u, 108.0) for t, u in (("Gamma", 20.0), ("3,00", 120.0), ("CINA", 220.0), ("7", 320.0))]
HEADS = [  # words above the body, rules, labels, paths
    ([W("Camera dei Deputati", 20.0, 20.0, 100.0), W("Operatore", 20.0, 60.0), W("Importo", 120.0, 60.0), W("Paese", 220.0, 60.0), W("Tipo", 320.0, 60.0)], [], "Operatore|Importo|Paese|Tipo", "Operatore|Importo|Paese|Tipo"),
    ([W("Anagrafica", 20.0, 40.0, 140.0), W("Destinazione", 220.0, 40.0, 140.0), W("Operatore", 20.0, 60.0), W("Importo", 120.0, 60.0), W("Paese", 220.0, 60.0), W("Tipo", 320.0, 60.0)], [], "Operatore|Importo|Paese|Tipo", "Anagrafica / Operatore|Anagrafica / Importo|Destinazione / Paese|Destinazione / Tipo"),
    ([W("Operatore", 20.0, 46.0), W("Importo", 120.0, 46.0), W("Paese", 220.0, 60.0), W("Tipo", 320.0, 60.0)], [], "Operatore|Importo|Paese|Tipo", "Operatore|Importo|Paese|Tipo"),
    ([W("Operatore", 20.0, 60.0), W("Importo", 120.0, 60.0, 140.0), W("Tipo", 320.0, 60.0)], [18.0, 115.0, 215.0, 315.0, 362.0], "Operatore|Importo|Importo|Tipo", "Operatore|Importo|Importo|Tipo"),
    ([W("Solo prosa", 20.0, 60.0, 90.0)], [], None, None),
]


def unruled_headers(spark: SparkSession, d: str) -> DataFrame:
    """Every part a page: words of one of five written-out headers over the same body."""
    word = lambda w: F.struct(*[F.lit(x).alias(n) for x, n in zip(w, ("text", "u0", "u1", "v0", "v1", "size"), strict=True)])
    words = F.element_at(F.array(*[F.array(*map(word, h[0] + BODY)) for h in HEADS]), C("kind") + 1)
    rules = F.element_at(F.array(*[F.array(*map(F.lit, h[1])) if h[1] else F.array().cast("array<double>") for h in HEADS]), C("kind") + 1)
    x = dealt(spark, d, {"n": list(range(len(HEADS)))}).select("p_partkey", words.alias("words"), rules.alias("rules"))
    return headers.unruled_headers(x, ["p_partkey"]).select("p_partkey", F.array_join("labels", "|").alias("labels"), F.array_join("paths", "|").alias("paths"))


def ruled_pages(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem")
    n = C("l_partkey") % 50
    kind = F.when(C("l_returnflag") == "R", "l").when(C("l_returnflag") == "A", "re").otherwise("c")
    shapes = x.select("l_suppkey", kind.alias("kind"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.when(C("l_linenumber") % 2 == 0, n).otherwise(1).cast("double").alias("x1"), F.when(C("l_linenumber") % 2 == 0, 2).otherwise(n).cast("double").alias("y1"))
    c = headers.rule_census(shapes, ["l_suppkey"])
    return c.select("l_suppkey", "rects", "rules", "vertical", "horizontal", "curves", F.round("longest", 1).alias("longest"), "ruled", "charted")


RULED_SQL = """WITH x AS (SELECT l_suppkey, CASE l_returnflag WHEN 'R' THEN 'l' WHEN 'A' THEN 're' ELSE 'c' END AS k, CAST(CASE WHEN l_linenumber % 2 = 0 THEN l_partkey % 50 ELSE 1 END AS DOUBLE) AS w, CAST(CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE l_partkey % 50 END AS DOUBLE) AS h FROM lineitem),
s AS (SELECT *, CASE WHEN k = 'l' THEN sqrt(w * w + h * h) WHEN k = 're' AND least(w, h) <= 3 THEN greatest(w, h) END AS span FROM x)
SELECT l_suppkey, count(*) FILTER (k = 're') AS rects, count(*) FILTER (k = 'l') AS rules, count(*) FILTER (k = 'l' AND span >= 20 AND h > w) AS vertical, count(*) FILTER (k = 'l' AND span >= 20 AND w >= h) AS horizontal, count(*) FILTER (k = 'c') AS curves,
  round(coalesce(max(CASE WHEN span >= 20 THEN span END), 0), 1) AS longest, coalesce(max(CASE WHEN span >= 20 THEN span END), 0) >= 20 AS ruled, count(*) FILTER (k = 'c') >= 200 AS charted FROM s GROUP BY 1"""

DIRECTIONS = [((1.0, 0.0), "upright"), ((0.0, 1.0), "rot270"), ((-1.0, 0.02), "rot180"), ((0.01, -1.0), "rot90"), ((0.7, 0.7), "other")]


def orientations(spark: SparkSession, d: str) -> DataFrame:
    x = dealt(spark, d, {"x": [v[0][0] for v in DIRECTIONS], "y": [v[0][1] for v in DIRECTIONS]})
    return x.select("p_partkey", headers.orientation(C("x"), C("y")).alias("name"))


QUERIES = {
    "scanned_pages": (scanned_pages, SCAN_SQL),
    "body_starts": (body_starts, "SELECT p_partkey AS volume, code, page FROM part, (VALUES ('C1', 1), ('AA', 2)) v(code, page)"),
    "volume_families": (volume_families, FAMILY_SQL),
    "located_tables": (located_tables, LOCATED_SQL),
    "unruled_headers": (unruled_headers, told({"labels": [h[2] for h in HEADS], "paths": [h[3] for h in HEADS]})),
    "ruled_pages": (ruled_pages, RULED_SQL),
    "orientations": (orientations, told({"name": [v[1] for v in DIRECTIONS]})),
}
