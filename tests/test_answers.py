"""Verification, catalogue and the published questions."""

from decimal import Decimal

from pagelake.operators import catalog, checks, verify
from pagelake.plans.questions import QUESTIONS, Question, check_question, made_facts


def rows(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


def test_checks_can_fail(spark):
    stamps = spark.createDataFrame([("a", 1, "1", "2"), ("a", 2, "2", "2"), ("b", 1, "1", "3"), ("b", 2, "2", "3"), ("c", 1, None, None), ("d", 1, "1", "2"), ("d", 2, None, None)], "key string, page int, first string, second string")
    worst = lambda df: rows(df.groupBy("key").agg(checks.fold(df["verdict"]).alias("v")))
    assert worst(verify.stamp(stamps)) == [("a", "PASS"), ("b", "FAIL"), ("c", "SKIP"), ("d", "FAIL")]
    f = spark.createDataFrame([("a", 1, [3]), ("a", 2, [4, 9]), ("a", 3, []), ("a", 4, [10]), ("b", 1, [5]), ("b", 2, [7]), ("c", 1, [])], "key string, page int, numbers array<int>")
    assert rows(verify.folios(f), "key", "verdict") == [("a", "PASS"), ("b", "WARN"), ("c", "SKIP")]
    c = spark.createDataFrame([("a", 1, "A1", "A1", False, True), ("a", 2, "A1", "B", False, True), ("b", 1, "B", "C", False, True), ("b", 2, "B", "C", False, True), ("c", 1, "C", None, False, True), ("d", 1, "D", None, False, False), ("e", 1, "E", "E", False, True)], "key string, page int, own string, found string, blank boolean, readable boolean")
    assert worst(verify.uniqueness(c)) == [("a", "WARN"), ("b", "FAIL"), ("c", "FAIL"), ("d", "SKIP"), ("e", "PASS")]
    t = spark.createDataFrame([("a", "A", 1, "Autorizzazioni individuali", "ELENCO AUTORIZZAZIONI INDIVIDUALI"), ("b", "B", 1, "Autorizzazioni individuali", "altro"), ("c", "C", 1, "di", "xyz")], "key string, code string, total int, title string, text string")
    assert rows(verify.titles(t), "key", "verdict") == [("a", "PASS"), ("b", "FAIL"), ("c", "SKIP")]
    o = spark.createDataFrame([("a", "h1"), ("b", "h1"), ("b", "h2"), ("c", "h3"), ("c", "h3")], "key string, content string")
    assert rows(verify.overlaps(o), "key", "verdict") == [("a", "FAIL"), ("b", "FAIL"), ("c", "PASS")]
    at, due = (spark.createDataFrame([(1, *r) for r in x], "volume int, key string, page int") for x in ([("a", 5), ("b", 3), ("x", 9)], [("a", 1), ("b", 2), ("c", 3)]))
    index = verify.against_index(at, due)
    assert rows(index, "key", "verdict") == [("a", "WARN"), ("b", "PASS"), ("c", "FAIL"), ("x", "FAIL")]
    every = checks.verdicts([verify.stamp(stamps), verify.folios(f), index])
    assert worst(every) == [("a", "WARN"), ("b", "FAIL"), ("c", "FAIL"), ("d", "FAIL"), ("x", "FAIL")]
    lines, gaps = spark.createDataFrame([("t", 1, Decimal("2.00")), ("t", 2, Decimal("7.50"))], "k string, row_ord int, value decimal(18,2)"), spark.createDataFrame([("t", Decimal("7.50"))], "k string, gap decimal(18,2)")
    assert rows(verify.explain_gap(lines, gaps, ["k"]), "row_ord") == [(2,)]


def test_catalogue(spark):
    s = spark.createDataFrame([("a", 1, 1, 10.2), ("a", 1, 2, 30.0), ("a", 2, 1, 10.0), ("a", 2, 2, 29.8), ("a", 3, 1, 50.0)], "key string, page int, ordinal int, width double")
    r = catalog.signatures(s).first()
    assert (r["widths"], r["n"], r["first_page"], r["stable"]) == ([10.0, 30.0], 2, 1, False)
    col = "authority string, article string, code string, ordinal int, label string"
    old, new = spark.createDataFrame([("MAE", None, "T2", 1, "Anno 2024"), ("MAE", None, "T2", 2, "Euro"), ("MAE", "A5", "X", 1, "v")], col), spark.createDataFrame([("MAE", None, "T2", 1, "Anno 2025"), ("MAE", None, "T2", 2, "Valore"), ("DOG", None, "X", 1, "v")], col)
    assert rows(catalog.year_diff(old, new, 2024, 2025), "authority", "code", "ordinal", "change") == [("DOG", "X", 1, "added"), ("MAE", "T2", 1, "same"), ("MAE", "T2", 2, "differs"), ("MAE", "X", 1, "dropped")]
    p = spark.createDataFrame([("a", 1, "legible"), ("a", 2, "empty")], "key string, page int, status string")
    assert rows(catalog.page_stats(p), "pages", "legible", "empty", "share") == [(2, 1, 1, 0.5)]
    from pyspark.sql import functions as F

    assert spark.range(1).select(catalog.sample_pages(F.lit(10), F.lit(20), 3).alias("s")).first()["s"] == [10, 15, 20]


def test_questions_run_and_draw(spark):
    facts = made_facts(spark, "/root/testdata/sf0.001")
    for q in QUESTIONS:
        assert check_question(q, facts, 2025, company="LEONARDO" if q.id == "programmes" else "Customer#000000007", word="urgent") == []
    assert check_question(Question("q", "Q", lambda f, y: f["mae_t2"].select("anno"), (), "anno", "missing"), facts, 2025) == ["no column missing"]
    assert check_question(QUESTIONS[0], facts, 1999) == ["no rows"]
