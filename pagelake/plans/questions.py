"""The thirteen published questions, answered by the engine's operators over fact tables.

Facts hold data rows only, each with year, row_ord, source_file and pdf_page. A question takes the tables by name and
what it asks about (an edition, a company, a word); its answer names a label and a value where it can be drawn.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.numbers import money
from pagelake.operators import checks, ordered
from pagelake.sources.tables import table

Facts = dict[str, DataFrame]
C = F.col
SOURCE = ["source_file", "pdf_page"]
#: Companies and countries that an answer names where it asks for the largest.
LARGEST = 15


def _edition(facts: Facts, name: str, year: int) -> DataFrame:
    return facts[name].filter(C("year") == year)


def _first_source() -> list[Column]:
    """Where the first row of a group is printed."""
    return [F.min("row_ord").alias("first_row"), *[F.min_by(c, "row_ord").alias(c) for c in SOURCE]]


def _largest(df: DataFrame, value: str, tie: str, n: int = LARGEST) -> DataFrame:
    return df.orderBy(C(value).desc_nulls_last(), tie).limit(n)


def _by_unit(df: DataFrame, value: str) -> DataFrame:
    """A table that prints an authorisation, and `value` with it, on its first row: both on every row."""
    by, order = ["year"], ["row_ord"]
    out = ordered.unit_in_blocks(df, C("numero_autorizzazione").isNotNull(), by, "row_ord", "unit")
    return out.withColumn(value, ordered.carry(C(value), [*by, "unit"], order))


def trend(facts: Facts, year: int) -> DataFrame:
    """What was authorised, year by year, as the edition prints it."""
    t = _edition(facts, "mae_t2", year).filter(F.lower("voce").startswith("valore autorizzazioni"))
    return t.select("anno", C("valore").alias("amount"), *SOURCE)


def blocs(facts: Facts, year: int) -> DataFrame:
    """Shares of the alliances' members and of other countries: the lines printed in percent."""
    return _edition(facts, "mae_t2", year).filter(C("voce").endswith("(%)")).select("voce", "anno", C("valore_raw").alias("share"), *SOURCE)


def companies(facts: Facts, year: int) -> DataFrame:
    return _largest(_edition(facts, "mae_a2", year).select("operatore", "autorizzazioni", C("valore_euro").alias("amount"), *SOURCE), "amount", "operatore")


def concentration(facts: Facts, year: int) -> DataFrame:
    """Each company's place by value and the share that it and all larger ones have together; equal values share it."""
    w = W.partitionBy("year")
    falling = w.orderBy(C("valore_euro").desc())
    a = _edition(facts, "mae_a2", year).filter("valore_euro IS NOT NULL")
    place = F.row_number().over(w.orderBy(C("valore_euro").desc(), "operatore")).cast("bigint")
    return a.select(place.alias("place"), "operatore", C("valore_euro").alias("amount"), F.round(100 * F.sum("valore_euro").over(falling) / F.sum("valore_euro").over(w), 2).alias("share"))


def licences(facts: Facts, year: int, company: str) -> DataFrame:
    """What a company asked to export, item by item."""
    a = _edition(facts, "mae_a1", year).filter(C("operatore") == company)
    return a.select("row_ord", C("data_raw").alias("day"), "valuta", C("ammontare_raw").alias("amount"), C("euro_raw").alias("euro"), "materiale", *SOURCE)


def material(facts: Facts, year: int, word: str) -> DataFrame:
    """Companies whose items mention a word, whatever its case."""
    a = _edition(facts, "mae_a1", year).filter(F.lower("materiale").contains(word.lower()))
    return a.groupBy("operatore").agg(F.count("*").alias("items"), *_first_source())


def authorised_exported(facts: Facts, year: int) -> DataFrame:
    """What customs saw leave beside what was newly authorised; names are compared without case and outer blanks."""
    name = lambda c: F.upper(F.trim(c))
    out = _edition(facts, "dog_a1c2_m1", year).select(name(C("denominazione_operatore")).alias("operatore"), C("avanzamento_annuale").alias("exported"), *SOURCE)
    new = _edition(facts, "mae_a2", year).select(name(C("operatore")).alias("operatore"), C("valore_euro").alias("authorised"))
    return _largest(out.join(new, "operatore", "left"), "exported", "operatore")


def money_countries(facts: Facts, year: int) -> DataFrame:
    """Payments that banks reported, by country."""
    rows = _by_unit(_edition(facts, "mef_ee", year), "utilizzatore_finale").withColumnRenamed("utilizzatore_finale", "country")
    return rows.groupBy("country").agg(F.count_distinct("unit").alias("authorisations"), F.sum("importi_segnalati").alias("amount"), F.sum("importi_accessori_segnalati").alias("extra"), *_first_source())


def money_reasons(facts: Facts, year: int) -> DataFrame:
    nothing = F.lit(0).cast("decimal(38,4)")
    g = _edition(facts, "mef_ee", year).groupBy("causale").agg(F.count("*").alias("n"), F.coalesce(F.sum("importi_segnalati"), nothing).alias("amount"), F.coalesce(F.sum("importi_accessori_segnalati"), nothing).alias("extra"))
    return g.withColumn("total", C("amount") + C("extra"))


def brokerage(facts: Facts, year: int) -> DataFrame:
    """Fees of brokers by company and country; a row has its company, and its country by its authorisation."""
    rows = _by_unit(_edition(facts, "mef_ii", year), "utilizzatore_finale").filter(F.lower("causale") == "compensi intermediazione")
    return rows.groupBy("ditta", C("utilizzatore_finale").alias("country")).agg(F.count("*").alias("n"), F.sum("totale").alias("paid"), *_first_source())


def programmes(facts: Facts, year: int, company: str) -> DataFrame:
    """Programmes of several governments in which a company takes part."""
    return _edition(facts, "difesa_4", year).filter(F.upper("ditte").contains(company.upper())).select("nr", "programma", "tipologia", "paesi", *SOURCE)


def totals(facts: Facts, year: int) -> DataFrame:
    """How many printed totals the rows confirm, table by table."""
    kinds = {"passed": "PASS", "rounded": "ROUNDING", "unchecked": "UNCHECKED"}
    of = {n: F.count_if(C("status") == k).alias(n) for n, k in kinds.items()}
    return _edition(facts, "check_result", year).groupBy("table_key").agg(*of.values(), F.count_if(~C("status").isin(*kinds.values())).alias("differs"))


def detail_summary(facts: Facts, year: int) -> DataFrame:
    """The licences added up by company, by the rule of their column, against the summary's line; null without a licence."""
    rule = checks.rule_sum("euro", unless="val_fini_dog_raw", when="valuta = 'EUR'", instead="ammontare")
    detail = _edition(facts, "mae_a1", year).groupBy("operatore").agg(F.sum(F.expr(rule)).alias("detail"))
    summary = _edition(facts, "mae_a2", year).select("operatore", C("valore_euro").alias("summary"), *SOURCE)
    return summary.join(detail, "operatore", "left").withColumn("gap", C("detail") - C("summary"))


@dataclass(frozen=True)
class Question:
    """A question, its answer, what it asks about besides the edition, and what it draws."""

    id: str
    title: str
    answer: Callable[..., DataFrame]
    asks: tuple[str, ...] = ()
    label: str | None = None
    value: str | None = None


QUESTIONS = [
    Question("trend", "What is authorised, year by year?", trend, (), "anno", "amount"),
    Question("blocs", "What share goes inside and outside the alliances?", blocs),
    Question("companies", "Which companies have most?", companies, (), "operatore", "amount"),
    Question("concentration", "How much do the largest have together?", concentration, (), "place", "share"),
    Question("licences", "What did a company ask to export?", licences, ("company",)),
    Question("material", "Who may export a material?", material, ("word",), "operatore", "items"),
    Question("authorised-exported", "What left, and what was authorised?", authorised_exported, (), "operatore", "exported"),
    Question("money-countries", "Which countries do payments go to?", money_countries, (), "country", "amount"),
    Question("money-reasons", "What is paid for?", money_reasons, (), "causale", "total"),
    Question("brokerage", "Who pays brokers, and for which country?", brokerage, (), "ditta", "paid"),
    Question("programmes", "Which programmes is a company part of?", programmes, ("company",)),
    Question("totals", "Do the printed totals hold?", totals, (), "table_key", "passed"),
    Question("detail-summary", "Does the summary agree with the detail?", detail_summary, (), "operatore", "gap"),
]


def check_question(q: Question, facts: Facts, year: int, **about: str) -> list[str]:
    """What is wrong with a question: it fails, gives no row, or lacks the columns that it draws."""
    try:
        df = q.answer(facts, year, **{k: about[k] for k in q.asks})
        wrong = [f"no column {c}" for c in (q.label, q.value) if c and c not in df.columns]
        return wrong or ([] if df.limit(1).count() else ["no rows"])
    except Exception as e:  # the report names it
        return [str(e).split("\n")[0]]


# ---------------------------------------------------------------- over facts made of the driver's tables


def made_facts(spark: SparkSession, d: str) -> Facts:
    """Every row of the driver's tables as a fact: customers as companies, orders as licences, events as payments."""
    meta = lambda row: [F.lit(2025).alias("year"), row.alias("row_ord"), F.lit("v1.pdf").alias("source_file"), (row % 900).cast("int").alias("pdf_page")]
    c, o, e, n = (table(spark, d, t) for t in ("customer", "orders", "events", "nation"))
    name = F.concat(F.lit("Customer#"), F.lpad(C("o_custkey").cast("string"), 9, "0"))
    price, value = money(C("o_totalprice")), money(C("value"))
    signs = C("event_type") == "signup"
    pay = [F.when(signs, C("event_id").cast("string")).alias("numero_autorizzazione"), F.when(signs, F.concat(F.lit("P"), (C("user_id") % 7).cast("string"))).alias("utilizzatore_finale")]
    return {
        "mae_t2": n.select(*meta(C("n_nationkey")), F.when(C("n_regionkey") == 0, "Valore autorizzazioni (mld)").otherwise(F.concat("n_name", F.lit(" (%)"))).alias("voce"), (2020 + C("n_nationkey") % 5).cast("int").alias("anno"), C("n_nationkey").cast("decimal(18,2)").alias("valore"), C("n_nationkey").cast("string").alias("valore_raw")),
        "mae_a2": c.select(*meta(C("c_custkey")), C("c_name").alias("operatore"), C("c_nationkey").cast("int").alias("autorizzazioni"), F.round(money(C("c_acctbal")) + 1000, 0).cast("decimal(18,2)").alias("valore_euro")),
        "mae_a1": o.select(*meta(C("o_orderkey")), name.alias("operatore"), F.when(C("o_orderkey") % 2 == 0, "EUR").otherwise("USD").alias("valuta"), price.alias("ammontare"), price.cast("string").alias("ammontare_raw"), F.when(C("o_orderkey") % 3 == 0, price).alias("euro"), F.when(C("o_orderkey") % 3 == 0, price.cast("string")).alias("euro_raw"), F.when(C("o_orderkey") % 11 == 0, "x").alias("val_fini_dog_raw"), C("o_orderdate").cast("string").alias("data_raw"), F.concat(F.lit("Merce "), "o_orderpriority").alias("materiale")),
        "mef_ee": e.select(*meta(C("event_id")), *pay, C("event_type").alias("causale"), value.alias("importi_segnalati"), F.when(C("event_id") % 2 == 0, value).alias("importi_accessori_segnalati")),
        "mef_ii": e.select(*meta(C("event_id")), *pay, (C("user_id") % 5).cast("string").alias("ditta"), F.when(C("event_type") == "error", "Compensi Intermediazione").otherwise("merce").alias("causale"), value.alias("totale")),
        "dog_a1c2_m1": c.select(*meta(C("c_custkey")), F.concat(F.lit(" "), F.lower("c_name"), F.lit(" ")).alias("denominazione_operatore"), money(C("c_acctbal")).alias("avanzamento_annuale")).filter("row_ord % 2 = 0"),
        "difesa_4": n.select(*meta(C("n_nationkey")), C("n_nationkey").cast("int").alias("nr"), C("n_name").alias("programma"), F.lit("T").alias("tipologia"), F.lit("A, B").alias("paesi"), F.when(C("n_nationkey") % 3 == 0, "Leonardo, Altra").otherwise("Altra").alias("ditte")),
        "check_result": o.select(*meta(C("o_orderkey")), C("o_orderpriority").alias("table_key"), F.when(C("o_orderkey") % 5 == 0, "PASS").when(C("o_orderkey") % 5 == 1, "ROUNDING").when(C("o_orderkey") % 5 == 2, "UNCHECKED").otherwise("FAIL").alias("status")),
    }


ABOUT = {"licences": {"company": "Customer#000000007"}, "material": {"word": "urgent"}, "programmes": {"company": "LEONARDO"}}


def _query(q: Question) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        out = q.answer(made_facts(spark, d), 2025, **ABOUT.get(q.id, {}))
        plain = {"decimal": "double", "int": "bigint"}
        return out.select(*[C(n).cast(plain[k]).alias(n) if (k := t.split("(")[0]) in plain else C(n) for n, t in out.dtypes])

    return run


def _src(row: str) -> str:
    return f"'v1.pdf' AS source_file, {row} % 900 AS pdf_page"


A2 = "a2 AS (SELECT c_name AS operatore, c_nationkey AS n, c_custkey AS k, CAST(round(CAST(c_acctbal AS DECIMAL(18,2)) + 1000, 0) AS DOUBLE) AS v FROM customer)"
PAID = "e AS (SELECT *, CAST(value AS DECIMAL(18,2)) AS v, count(*) FILTER (event_type = 'signup') OVER (ORDER BY event_id) AS unit FROM events), u AS (SELECT unit, max(CASE WHEN event_type = 'signup' THEN 'P' || (user_id % 7) END) AS country FROM e GROUP BY unit), r AS (SELECT e.*, country FROM e JOIN u ON u.unit = e.unit)"
SQL = {
    "trend": f"SELECT 2020 + n_nationkey % 5 AS anno, CAST(n_nationkey AS DOUBLE) AS amount, {_src('n_nationkey')} FROM nation WHERE n_regionkey = 0",
    "blocs": f"SELECT n_name || ' (%)' AS voce, 2020 + n_nationkey % 5 AS anno, CAST(n_nationkey AS VARCHAR) AS share, {_src('n_nationkey')} FROM nation WHERE n_regionkey <> 0",
    "companies": f"WITH {A2} SELECT operatore, n AS autorizzazioni, v AS amount, {_src('k')} FROM a2 ORDER BY v DESC, operatore LIMIT 15",
    "concentration": f"WITH {A2} SELECT row_number() OVER (ORDER BY v DESC, operatore) AS place, operatore, v AS amount, (SELECT round(100 * CAST(sum(y.v) AS DECIMAL(38,4)) / (SELECT CAST(sum(v) AS DECIMAL(38,4)) FROM a2), 2) FROM a2 y WHERE y.v >= a2.v)::DOUBLE AS share FROM a2",
    "licences": f"SELECT o_orderkey AS row_ord, CAST(o_orderdate AS VARCHAR) AS day, CASE WHEN o_orderkey % 2 = 0 THEN 'EUR' ELSE 'USD' END AS valuta, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount, CASE WHEN o_orderkey % 3 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS euro, 'Merce ' || o_orderpriority AS materiale, {_src('o_orderkey')} FROM orders WHERE o_custkey = 7",
    "material": f"SELECT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS operatore, count(*) AS items, min(o_orderkey) AS first_row, {_src('min(o_orderkey)')} FROM orders WHERE o_orderpriority ILIKE '%urgent%' GROUP BY o_custkey",
    "authorised-exported": f"WITH {A2}, d AS (SELECT upper(c_name) AS operatore, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS exported, c_custkey AS k FROM customer WHERE c_custkey % 2 = 0) SELECT d.operatore, exported, v AS authorised, {_src('d.k')} FROM d LEFT JOIN a2 ON upper(a2.operatore) = d.operatore ORDER BY exported DESC, d.operatore LIMIT 15",
    "money-countries": f"WITH {PAID} SELECT country, count(DISTINCT unit) AS authorisations, CAST(sum(v) AS DOUBLE) AS amount, CAST(sum(v) FILTER (event_id % 2 = 0) AS DOUBLE) AS extra, min(event_id) AS first_row, {_src('min(event_id)')} FROM r GROUP BY country",
    "money-reasons": "WITH e AS (SELECT event_type AS causale, event_id, CAST(value AS DECIMAL(18,2)) AS v FROM events) SELECT causale, count(*) AS n, CAST(coalesce(sum(v), 0) AS DOUBLE) AS amount, CAST(coalesce(sum(v) FILTER (event_id % 2 = 0), 0) AS DOUBLE) AS extra, CAST(coalesce(sum(v), 0) + coalesce(sum(v) FILTER (event_id % 2 = 0), 0) AS DOUBLE) AS total FROM e GROUP BY causale",
    "brokerage": f"WITH {PAID} SELECT CAST(user_id % 5 AS VARCHAR) AS ditta, country, count(*) AS n, CAST(sum(v) AS DOUBLE) AS paid, min(event_id) AS first_row, {_src('min(event_id)')} FROM r WHERE event_type = 'error' GROUP BY user_id % 5, country",
    "programmes": f"SELECT n_nationkey AS nr, n_name AS programma, 'T' AS tipologia, 'A, B' AS paesi, {_src('n_nationkey')} FROM nation WHERE n_nationkey % 3 = 0",
    "totals": "SELECT o_orderpriority AS table_key, count(*) FILTER (o_orderkey % 5 = 0) AS passed, count(*) FILTER (o_orderkey % 5 = 1) AS rounded, count(*) FILTER (o_orderkey % 5 = 2) AS unchecked, count(*) FILTER (o_orderkey % 5 > 2) AS differs FROM orders GROUP BY 1",
    "detail-summary": f"WITH {A2}, d AS (SELECT o_custkey AS k, CAST(sum(CASE WHEN o_orderkey % 11 = 0 THEN 0 WHEN o_orderkey % 3 = 0 OR o_orderkey % 2 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS detail FROM orders GROUP BY 1) SELECT operatore, v AS summary, {_src('a2.k')}, CAST(detail AS DOUBLE) AS detail, CAST(detail - CAST(v AS DECIMAL(18,2)) AS DOUBLE) AS gap FROM a2 LEFT JOIN d ON d.k = a2.k",
}
QUERIES = {"question_" + q.id.replace("-", "_"): (_query(q), SQL[q.id]) for q in QUESTIONS}
