import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.operators import account, checks, match, ordered, query, sets
from pagelake.sources import sinks, tables


def rows(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


def test_runs_and_unclaimed(spark):
    pages = spark.createDataFrame([("v", n) for n in (1, 2, 3, 5, 6, 9, 9)], "vol string, page long")
    assert rows(ordered.runs(pages, ["vol"], "page")) == [("v", 1, 3, 3), ("v", 5, 6, 2), ("v", 9, 9, 1)]
    claimed = spark.createDataFrame([("v", 2), ("v", 9)], "vol string, page long")
    assert rows(account.unclaimed(pages, claimed, ["vol"], "page")) == [("v", 1, 1, 1), ("v", 3, 3, 1), ("v", 5, 6, 2)]
    ranges = spark.createDataFrame([("a", 1, 2), ("b", 2, 2), ("c", 5, 4)], "k string, a int, b int")
    verdicts = account.exactly_once(pages, account.claims(ranges, F.col("a"), F.col("b"), "page"), "page")
    assert rows(verdicts) == [(1, 1, "ok"), (2, 2, "double"), (3, 0, "lost"), (5, 0, "lost"), (6, 0, "lost"), (9, 0, "lost")]


def test_carry_until_reset(spark):
    df = spark.createDataFrame([(1, "x", False), (2, None, False), (3, None, True), (4, None, False), (5, "y", False)], "k int, v string, ends boolean")
    out = ordered.carry_until(df.withColumn("g", F.lit(1)), F.col("v"), F.col("ends"), ["g"], ["k"], "got")
    assert [(r["segment"], r["got"]) for r in out.orderBy("k").collect()] == [(0, "x"), (0, "x"), (0, "x"), (1, None), (1, "y")]


def test_gap_fill_needs_agreement(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (1, 3, "a"), (1, 4, None), (1, 5, "b"), (1, 6, None)], "g int, k int, v string")
    got = df.select("k", ordered.fill_where_agreed(F.col("v"), ["g"], ["k"]).alias("f")).orderBy("k").collect()
    assert [r["f"] for r in got] == ["a", "a", "a", None, "b", "b"]


def test_bands_follow_their_head(spark):
    df = spark.createDataFrame([([10.0, 0.0, 4.0, 9.0, 5.5, 14.9],), ([],)], "v array<double>")
    got = [[(b["head"], b["n"]) for b in r["b"]] for r in df.select(ordered.band_heads(F.col("v"), 5.0).alias("b")).collect()]
    assert got == [[(0.0, 2), (5.5, 3), (14.9, 1)], []]


def test_as_of_takes_equal_starts(spark):
    left = spark.createDataFrame([(1, 5), (1, 10), (1, 2)], "g int, at int")
    right = spark.createDataFrame([(1, 5, "a"), (1, 9, None)], "g int, since int, name string")
    assert sorted((r["at"], r["name"]) for r in ordered.as_of(left, right, ["g"], "at", "since", "name").collect() if r["at"] < 9) == [(2, None), (5, "a")]


def test_votes_and_precedence(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "d"), (2, "c")], "g int, v string")
    assert rows(sets.vote(df, ["g"], "v")) == [(1, "b", 2), (2, "c", 1)]
    a, b = spark.createDataFrame([(1, 10)], "k int, page int"), spark.createDataFrame([(1, 99), (2, 5)], "k int, page int")
    assert rows(sets.ranked_union([a, b], ["k"], ["page"])) == [(1, 10, 1), (2, 5, 2)]
    assert rows(sets.override(b, a, "k", "page")) == [(1, 10, "overridden"), (2, 5, "base")]


def test_verdict_fold_and_mutations(spark):
    v = spark.createDataFrame([(1, "SKIP"), (1, "SKIP"), (2, "SKIP"), (2, "PASS"), (3, "WARN"), (3, "PASS"), (4, "FAIL"), (4, "WARN")], "k int, v string")
    assert rows(v.groupBy("k").agg(checks.fold(F.col("v")).alias("f"))) == [(1, "SKIP"), (2, "PASS"), (3, "WARN"), (4, "FAIL")]
    x = spark.createDataFrame([(1, 5, 7), (2, 6, 8)], "k int, a int, b int")
    hit = F.col("k") == 1
    assert rows(checks.swap(x, hit, "a", "b")) == [(1, 7, 5), (2, 6, 8)]
    assert rows(checks.drop_row(x, hit)) == [(2, 6, 8)]
    assert checks.twice(x, hit).count() == 3


def test_names_in_three_levels(spark):
    a = spark.createDataFrame([("Alfa Spa",), ("Beta",), ("G.A.M.M.A.",), ("Delta",), ("Ep",)], "name string")
    b = spark.createDataFrame([("Alfa Spa",), ("Beta Industrie Riunite",), ("GAMMA",), ("Zeta",), ("Epsilon",), ("Ep x",)], "name string")
    got = {r["name"]: (r["match"], r["level"]) for r in match.match_names(a, b, "name").collect()}
    assert got == {"Alfa Spa": ("Alfa Spa", "exact"), "Beta": ("Beta Industrie Riunite", "prefix"), "G.A.M.M.A.": ("GAMMA", "compact"), "Delta": (None, "none"), "Ep": (None, "none")}


def test_near_codes(spark):
    df = spark.createDataFrame([("AB1",), ("AB1C",), ("A1",), ("A1B",), ("AB2",)], "code string")
    assert rows(match.near_codes(df, "code")) == [("A1", "A1B"), ("AB1", "AB1C")]


def test_guard(spark):
    spark.range(5).createOrReplaceTempView("t5")
    assert query.guarded(spark, "SELECT id FROM t5 WHERE id > :x;", x=2).count() == 2
    for bad in ("DROP VIEW t5", "SELECT 1; SELECT 2", "CREATE TABLE a AS SELECT 1", "INSERT INTO t5 VALUES (1)"):
        with pytest.raises(Exception):
            query.guarded(spark, bad)
    some, more = query.shown(spark, "SELECT id FROM t5", limit=2)
    assert some.count() == 2 and more
    assert query.guarded(spark, "WITH a AS (SELECT id FROM t5) SELECT count(*) AS n FROM a WHERE id IN (SELECT id FROM t5)").first()["n"] > 0
    for bad in ("SELECT * FROM parquet.`/root/testdata/sf0.001/nation.parquet`", "SELECT * FROM nobody", "SELECT * FROM range(3)", "SELECT (SELECT max(id) FROM nobody) FROM t5"):
        with pytest.raises(query.NotAllowed):
            query.guarded(spark, bad)
    assert query.contains_anywhere(spark.createDataFrame([("Ab", 1), (None, 23)], "a string, b int"), "B").count() == 1


def test_sources_refuse(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("# comment\n2025\t19\t1\tI\tVOLUME I.pdf\t1048\thttps://x\n")
    assert tables.manifest(spark, str(tmp_path / "m.tsv")).first()["pages"] == 1048
    with pytest.raises(tables.Refused):
        tables.agreed(spark.range(1), T.StructType([T.StructField("other", T.LongType())]))
    with pytest.raises(tables.Refused):
        tables.union_years([spark.range(1), spark.range(1).withColumnRenamed("id", "x")])
    twice = spark.createDataFrame([(2025, 1, "a"), (2025, 1, "b")], "year int, volume int, file string")
    with pytest.raises(tables.Refused):
        tables.one_file_each(twice)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2024, "a\tb"), (2025, "c")], "year int, t string")
    sinks.write_years(df, str(tmp_path / "y"))
    sinks.write_years(df.filter("year = 2025").withColumn("t", F.lit("new")), str(tmp_path / "y"))
    assert rows(spark.read.parquet(str(tmp_path / "y")), "year", "t") == [(2024, "a\tb"), (2025, "new")]
    sinks.write_tsv(df, str(tmp_path / "t"))
    assert rows(spark.read.csv(str(tmp_path / "t"), sep="\t", header=True), "t") == [("a b",), ("c",)]
    old, new = spark.createDataFrame([(1, None, "o"), (2, "x", "o")], "a int, b string, v string"), spark.createDataFrame([(1, None, "n")], "a int, b string, v string")
    assert sorted(r["v"] for r in sinks.upsert(old, new, ["a", "b"]).collect()) == ["n", "o"]
