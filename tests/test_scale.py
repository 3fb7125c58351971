"""Steps whose cost must grow with their input and no faster: what each plan may not hold, and results at the odd places."""

import duckdb
from pyspark.sql import functions as F

from pagelake.functions import numbers, text
from pagelake.operators import ordered, placement, publish, reader
from pagelake.plans import order_queries, page_queries, row_queries, scan_queries, volume_queries
from pagelake.sources import volumes

D = "/root/testdata/sf0.001"


def rows(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_words_find_their_band_in_one_sort(spark):
    bands = spark.createDataFrame([("p", "1", 0.0, 10.0), ("p", "2", 10.0, 20.0), ("p", "3", 30.0, 25.0), ("q", "4", 0.0, 5.0), (None, "5", 0.0, 9.0)], "page string, number string, lo double, hi double")
    words = spark.createDataFrame([("p", 0.0, 10.0, "a"), ("p", 9.0, 11.0, "b"), ("p", 12.0, 20.0, "c"), ("p", 31.0, 32.0, "d"), ("p", -1.0, 2.0, "e"), ("q", 1.0, 2.0, "f"), ("r", 1.0, 2.0, "g"), (None, 1.0, 2.0, "h"), ("p", None, 2.0, "i")], "page string, v0 double, v1 double, text string")
    inner, outer = publish.cut_words(words, bands)
    assert rows(inner, "number", "text") == [("1", "a"), ("2", "c"), ("4", "f")] and inner.columns == ["page", "v0", "v1", "text", "number"]
    assert rows(outer, "text") == [("b",), ("d",), ("e",), ("g",), ("h",), ("i",)] and outer.columns == words.columns
    assert "collect_list" not in plan(inner)  # a page's bands in every word's row: quadratic


def test_volumes_that_go_on_are_joined_by_sorting(spark):
    spans = spark.createDataFrame([(1, "F", 4, 10), (2, "G", 11, 12)], "volume int, code string, start int, end int")
    pages = spark.createDataFrame([(1, k, [k + 90], "h") for k in range(1, 11)] + [(2, k, [k + 98] if k > 2 else [], "h" if k < 6 else "x") for k in range(1, 13)], "volume int, page int, numbers array<int>, header string")
    out = placement.continued(spans, pages)
    assert rows(out, "volume", "code", "from_volume", "start", "end") == [(2, "F", 1, 3, 7)]
    assert "BroadcastHashJoin" not in plan(out)  # exploded pages look small to the planner and ended on the driver


def test_titles_of_equal_spans_are_collected_once(spark):
    outline = spark.createDataFrame([(1, 1, "a", 3), (1, 3, "c", 3), (1, 2, "b", 4), (1, 9, "z", 9), (2, 1, "x", 3)], "volume int, ord int, title string, page int")
    spans = spark.createDataFrame([(1, "k", 3, 4), (1, "m", 3, 4), (1, "n", 3, 3), (1, "n", 3, 4), (1, "o", 5, 6), (2, "k", 1, 3)], "volume int, key string, start int, end int")
    out = volumes.bookmarks_in(outline, spans)
    assert rows(out) == [(1, "k", "a | b | c"), (1, "m", "a | b | c"), (1, "n", "a | a | b | c | c"), (2, "k", "x")]
    joined = plan(out).split("SortMergeJoin", 1)[1].split("\n", 1)[0]
    assert "_spans" in joined  # the texts are joined to tables; collected for every table they made a row a table and entry


def test_customers_of_six_digits_keep_apart(spark, tmp_path):
    day = "1995-01-01"
    spark.createDataFrame([(k, "c", 1, 0.0, "x") for k in (10000, 100000, 100001, 100002, 100003, 100004)], "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k, c, "F", 1.0 + k, day, "p") for k, c in enumerate((10000, 100000, 100001, 100001, 100002, 100003, 100004))], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    f, sql = volume_queries.QUERIES["cross_checked"]
    duck = duckdb.connect()
    for t in ("customer", "orders"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert rows(f(spark, str(tmp_path)), "name", "printed", "computed", "status") == sorted(duck.execute(sql).fetchall(), key=str)


def test_groups_of_runs_are_dealt_to_tasks_once(spark):
    x = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("a", 4), ("b", None), ("b", None), ("b", 7), (None, 1), (None, 2)], "g string, n int")
    out = ordered.runs(x, ["g"], "n")
    assert rows(out) == sorted([("a", 1, 2, 2), ("a", 4, 4, 1), ("b", None, None, 1), ("b", 7, 7, 1), (None, 1, 2, 2)], key=str)
    assert plan(out).count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan(out)  # others are put together to 64 MB of compressed blocks
    for name in ("id_runs", "wide_gap_clusters", "two_page_runs", "cluster_positions"):
        p = plan(order_queries.QUERIES[name][0](spark, D))
        assert p.count("Exchange") == 1 and "REPARTITION_BY_NUM" in p, name


def test_units_are_counted_in_blocks(spark):
    n = ordered.BLOCK
    at = [-n - 1, -1, 0, 1, n - 1, n, n + 5, 5 * n, 5 * n + 1]
    x = spark.createDataFrame([(y, k, k % 2 == 0) for y in (1, 2, None) for k in at] + [(3, None, True), (3, 4, None)], "y int, k long, o boolean")
    got = rows(ordered.unit_in_blocks(x, F.col("o"), ["y"], "k", "u"))
    assert got == rows(x.withColumn("u", ordered.running_unit(F.col("o"), ["y"], ["k"])))


def test_made_pages_are_dealt_to_many_tasks(spark):
    for f in (row_queries.band_kinds, page_queries.page_listing, scan_queries.unruled_headers):
        assert "REPARTITION_BY_NUM" in plan(f(spark, D)), f.__name__  # a few megabytes are read by one task


def test_volumes_of_made_pages_are_dealt_to_many_tasks(spark):
    for f in (scan_queries.body_starts, scan_queries.volume_families):
        assert "REPARTITION_BY_NUM" in plan(f(spark, D)), f.__name__


def test_lists_between_runs_are_looked_up_by_block(spark):
    pages = [1, 2, 63, 66, 90, 91, 127, 129, 170, 171, 200, 250, 251, 252]
    d = spark.createDataFrame([(1, "A1", p) for p in pages] + [(2, "A1", p) for p in pages], "volume int, code string, page int")
    lists = spark.createDataFrame([(1, 64, ["A1"]), (1, 64, ["X"]), (1, 128, ["AB1"]), (1, 171, ["A1"]), (1, 90, ["Z"]), (1, 255, ["B9"])], "volume int, page int, codes array<string>")
    marks = spark.createDataFrame([(1, "A1", 200), (2, "A1", 63)], "volume int, code string, page int")
    out = placement.clusters(d, ["code"], lists, marks)
    cut = [(1, 2), (63, 63), (66, 127), (129, 129), (170, 200), (250, 252)]
    assert rows(out.filter("volume = 1"), "first", "last") == sorted(cut, key=str)
    assert rows(out.filter("volume = 2"), "first", "last") == sorted([(1, 2), (63, 129), (170, 200), (250, 252)], key=str)
    assert rows(out.filter("kept"), "volume", "first") == [(1, 170), (2, 63)]
    assert "collect_list" not in plan(out)  # a volume's lists in every run's row: quadratic


def test_spans_of_one_page_and_code_end_in_a_fixed_order(spark):
    names = ["DOG", "MAE", "MEF"]
    s = spark.createDataFrame([(1, a, "A1", 5, 5) for a in names] + [(1, "MAE", "B1", 9, 9)], "volume int, authority string, code string, start int, floor int")
    none = spark.createDataFrame([], "volume int, page int, name string, codes array<string>")
    for first in (s, s.orderBy("authority"), s.orderBy(F.desc("authority"))):
        e = placement.ends(first.coalesce(1), spark.createDataFrame([(1, 20)], "volume int, pages int"), none, none, none)
        assert rows(e, "authority", "code", "end0") == [("DOG", "A1", 8), ("MAE", "A1", 5), ("MAE", "B1", 20), ("MEF", "A1", 5)]


def test_windows_cut_a_text_into_lines_once(spark):
    df = spark.createDataFrame([(" a \n\nb\n c",), ("",), (None,), ("x",)], "t string")
    out = df.select(text.windows_of_lines(F.col("t"), 2).alias("w"))
    assert [r["w"] for r in out.collect()] == [["a b", "b c", "c"], [], None, ["x"]]
    assert plan(out).count("split(") == 1  # inside the lambda it was cut again for every line: quadratic


def test_plain_amounts_are_read_at_one_look(spark):
    cases = [("1,5", "1.5000"), ("12.345.678,90", "12345678.9000"), ("1234,5", "1234.5000"), ("1.23,4", None), ("012,5", "12.5000"), ("0,5", "0.5000"), ("1.000,5 ", "1000.5000"), ("1,50\n", "1.5000"), ("-1,5", "-1.5000"), ("016", None)]
    df = spark.createDataFrame([(a,) for a, _ in cases], "t string")
    out = df.select("t", numbers.parse_number(F.col("t")).cast("string").alias("v"))
    assert rows(out) == sorted(cases, key=str)
    assert "translate" in plan(out)


def test_pages_are_objects_a_hundred_at_a_time(spark):
    seen = reader._by_page(lambda w: [{"kind": "n", "text": str(len(w))}], "array<struct<kind:string,text:string>>", reader.OUTSIDE)
    df = spark.range(3 * reader.AT_ONCE + 1).coalesce(1).select("id", F.array_repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("w"))
    assert all(r["s"][0]["text"] == str(r["id"] % 7) for r in df.select("id", seen("w").alias("s")).collect())
