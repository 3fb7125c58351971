"""Geometry, spans, extraction and streams on small made cases."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from pagelake.operators import detect, extract, geometry
from pagelake.streaming import incremental


def rows(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


WORD = "page int, word_id long, text string, u0 double, u1 double, v0 double, v1 double, size double"


def test_words_to_cells(spark):
    words = spark.createDataFrame(
        [(1, 1, "Alfa", 0.0, 20.0, 0.0, 9.0, 9.0), (1, 2, "S.p.A.", 22.0, 45.0, 1.4, 10.0, 9.0), (1, 3, "12", 80.0, 90.0, 0.5, 9.0, 9.0), (1, 4, ",50", 90.2, 99.0, 0.5, 9.0, 9.0), (1, 5, "Beta", 0.0, 20.0, 12.0, 21.0, 9.0)], WORD
    )
    w = geometry.column_starts(geometry.row_bands(words, ["page"]), ["page"])
    assert rows(geometry.cells(w, ["page"])) == [(1, 0, 0, "Alfa S.p.A."), (1, 0, 1, "12,50"), (1, 1, 0, "Beta")]
    cols = spark.createDataFrame([(1, 1, 0.0, 50.0), (1, 2, 75.0, 120.0)], "page int, ordinal long, lo double, hi double")
    assert rows(geometry.place_in_columns(words, cols, ["page"]), "word_id", "column") == [(1, 1), (2, 1), (3, 2), (4, 2), (5, 1)]


def test_band_head_not_neighbour(spark):
    words = spark.createDataFrame([(1, k, "w", 0.0, 5.0, 3.0 * k, 3.0 * k + 9, 9.0) for k in range(5)], WORD)
    assert [b for _, b in rows(geometry.row_bands(words, ["page"]), "word_id", "band")] == [0, 0, 1, 1, 2]


def test_turned_page(spark):
    w = spark.createDataFrame([(1, "abc", 10.0, 20.0, 14.0, 60.0, 0.0, -1.0), (1, "x", 0.0, 0.0, 1.0, 1.0, 1.0, 0.0)], "page int, text string, x0 double, y0 double, x1 double, y1 double, dir_x double, dir_y double")
    assert rows(geometry.dominant_direction(w, ["page"])) == [(1, 0.0, -1.0, True)]
    r = geometry.to_reading_space(w).filter("text = 'abc'").first()
    assert (r["u0"], r["u1"], r["v0"], r["v1"]) == (-60.0, -20.0, 10.0, 14.0)


def test_rules(spark):
    r = spark.createDataFrame([(1, 0.0, 0.0, 100.0, 50.0, True), (1, 60.0, 0.0, 61.0, 50.0, False), (1, 0.0, 52.0, 120.0, 52.5, False), (1, 0.0, 0.0, 1.0, 1.0, False)], "page int, x0 double, y0 double, x1 double, y1 double, stroked boolean")
    s = geometry.rule_segments(r, ["page"])
    assert s.count() == 6
    assert rows(geometry.join_floors(s, ["page"])) == [(1, 0.0, 0.0, 100.0), (1, 50.0, 0.0, 120.0)]
    assert rows(geometry.columns_between(geometry.separators(s, ["page"]), ["page"])) == [(1, 1, 0.0, 60.0), (1, 2, 60.0, 100.0)]


def test_evidence_and_best_volume(spark):
    d = spark.createDataFrame([("v", "A", 5, "inline"), ("v", "B", 7, "inline"), ("v", "B", 8, "inline"), ("v", "C", 9, "title"), ("v", "C", 2, "header")], "volume string, code string, page long, evidence string")
    assert rows(detect.starts(detect.drop_weak(d, ["volume"]), ["volume"])) == [("v", "B", 7, "inline"), ("v", "C", 9, "title")]
    f = spark.createDataFrame([("A", 1, 90, True, "title"), ("A", 2, 1, False, "title"), ("B", 1, 3, False, "header"), ("B", 2, 4, False, "title")], "code string, volume int, start int, to_end boolean, evidence string")
    assert rows(detect.keep_best(f, ["code"]), "code", "volume", "kept") == [("A", 1, True), ("A", 2, True), ("B", 1, False), ("B", 2, True)]


def linked(spark, rows):
    schema = "t int, k int, g string, opener string, amount string, item string, text string"
    df = spark.createDataFrame([(1, k, *r) for k, r in enumerate(rows)], schema)
    out = extract.link_items(df, ["t"], "k", "g", "opener", "amount", "item", ["text"], ["item", "text"])
    return [(r["unit"], r["link"], r["implied"], r["copied_from"], r["item"], r["text"], r["issues"]) for r in out.orderBy("k").collect()]


def test_links_of_a_unit(spark):
    # more amounts than items: each bare amount takes the item above, none is lost
    got = linked(spark, [("g", "d", "", "q0", "a"), ("g", "", "1", "", ""), ("g", "", "2", "", ""), ("g", "", "3", "", "b")])
    assert [(x[1], x[3], x[4]) for x in got] == [(None, None, "q0"), (1, 0, "q0"), (2, 0, "q0"), (3, 0, "q0")] and got[0][6] == "above_first"
    got = linked(spark, [("g", "d", "1", "q0", "a"), ("g", "", "2", "", "")])
    assert got == [(0, 0, False, None, "q0", "a", ""), (0, 1, False, 0, "q0", "a", "")]
    # no amount: implied, linked to itself; a new group opens a unit
    assert linked(spark, [("g", "d", "", "q0", ""), ("h", "", "", "q1", "")]) == [(0, 0, True, None, "q0", "", ""), (1, 1, True, None, "q1", "", "")]
    # as many: k-th with k-th
    assert [x[1] for x in linked(spark, [("g", "d", "1", "", ""), ("g", "", "", "q1", ""), ("g", "", "2", "q2", "")])] == [None, 0, 2]
    # fewer: the last at or above, else an issue; an amount that no item took is one too
    got = linked(spark, [("g", "d", "", "q0", ""), ("g", "", "1", "", ""), ("g", "", "2", "q2", ""), ("g", "", "", "q3", "")])
    assert [(x[1], x[6]) for x in got] == [(None, "above_first"), (None, "covers_none"), (2, ""), (2, "")]
    # wrapped text on an amount line goes up to the item above it; without one it is an issue
    got = linked(spark, [("g", "d", "1", "q0", "a"), ("g", "", "2", "q1", ""), ("g", "", "3", "", "more")])
    assert [(x[4], x[5], x[3]) for x in got] == [("q0", "a", None), ("q1", "more", None), ("q1", "more", 1)]
    assert linked(spark, [("g", "d", "1", "", "x"), ("g", "", "", "q1", "")])[0][6] == "text_without_item"
    assert [x[6] for x in linked(spark, [("g", "d", "1", "", "")])] == ["no_item"]
    assert linked(spark, [("g", "d", "1", "", ""), ("g", "", "2", "", ""), ("g", "", "", "q2", "")])[0][6] == "too_many_amounts"


def test_values_keep_their_text(spark):
    df = spark.createDataFrame([(["Alfa", "1.000,50", "1/2/2025"],), (["", "—", "x"],), (["B", "abc", ""],)], "cells array<string>")
    got = extract.typed(df, [("name", "text"), ("euro", "amount"), ("day", "date")]).collect()
    assert [(r["name"], r["euro"], r["euro_raw"], r["day"], r["day_raw"], r["flags"]) for r in got] == [("Alfa", Decimal("1000.5"), "1.000,50", "2025-02-01", "1/2/2025", None), (None, None, "—", None, "x", "day"), ("B", None, "abc", None, None, "euro")]
    assert extract.figures(df.withColumn("row_ord", F.lit(1)), ["row_ord"]).count() == 7
    years = spark.createDataFrame([("v", 1.0, None)], "voce string, `2024` double, `2025` double")
    assert rows(extract.unpivot_years(years, ["voce"], [2024, 2025])) == [("v", 2024, 1.0)]


def test_streams_agree_with_batches(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    data = [(k, t0 + dt.timedelta(hours=k), k % 2, ["view", "error", "purchase"][k % 3], float(k)) for k in range(48)]
    e = spark.createDataFrame(data, "event_id long, ts timestamp, user_id long, event_type string, value double")
    e.coalesce(1).write.parquet(str(tmp_path / "e"))
    s = incremental.follow(spark, str(tmp_path / "e"), e)
    got = incremental.run_once(incremental.window_counts(s), str(tmp_path))
    batch = {tuple(r) for r in incremental.window_counts(e).collect()}
    assert {tuple(r) for r in got.collect()} <= batch
    assert incremental.run_once(incremental.new_contents(s, "event_type"), str(tmp_path)).count() >= 3
    last = {}
    verdicts = s.select(F.col("user_id").alias("key"), F.col("event_id").alias("seq"), (F.col("event_type") == "purchase").alias("passed"), (F.col("event_type") == "error").alias("failed"), (F.col("event_id") % 3).cast("string").alias("way"))
    for r in incremental.run_once(incremental.escalate(verdicts), str(tmp_path)).collect():
        last[r["seq"]] = r["action"]
    assert len(last) == 48 and set(last.values()) <= {"done", "human", "recheck", "wait"}
