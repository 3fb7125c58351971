"""Volumes, publishing, headers: what is refused, what is written, and what queries can't show."""

import pytest
from pyspark.sql import functions as F

from pagelake.operators import headers, placement, publish, reader
from pagelake.sources import sinks, volumes
from pagelake.sources.tables import Refused


def test_ambiguous_volumes_are_refused(spark):
    files = volumes.found_reports(spark.createDataFrame([("In/2025/VOLUME I.pdf",), ("In/2025/tomo 1.pdf",), ("In/2024/VOLUME 2.pdf",)], "path string"))
    assert volumes.jobs(files, 2024, 2).count() == 1 and volumes.jobs(files).count() == 3
    with pytest.raises(Refused):
        volumes.jobs(files, 2025, 1)
    with pytest.raises(Refused):
        volumes.only_year(files)
    assert volumes.only_year(files.filter("year = 2024")) == 2024


SEGMENTS = "year int, key string, seq int, source_file string, sha256 string, pdf_from int, pdf_to int, printed_from int, cut boolean, clip string"


def test_other_bytes_and_lost_clips_are_refused(spark):
    s = spark.createDataFrame([(2025, "K", 1, "v.pdf", "aa", 3, 4, 10, True, '{"3": [0, 0, 5, 5]}')], SEGMENTS)
    files = lambda h: spark.createDataFrame([("v.pdf", h)], "source_file string, sha256 string")
    assert volumes.checked_volumes(s, files("aa")).count() == 1
    for bad in (files("bb"), files("aa").limit(0)):
        with pytest.raises(Refused):
            volumes.checked_volumes(s, bad)
    with pytest.raises(Refused):
        volumes.table_pages(s)


def test_verifier_reads_whole_rows_only(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("# x\n2025\tXIX\t1\tI\ta.pdf\t10\thttp://a\n2025\tXIX\t1\tI\tb.pdf\t10\tnessuno\n2024\tshort\n")
    assert [r["file"] for r in volumes.verifier_manifest(spark, str(tmp_path / "m.tsv")).collect()] == ["a.pdf"]


def test_specs_are_checked(spark):
    rows = lambda *r: spark.createDataFrame([(k, *x) for k, x in enumerate(r)], "ord int, table string, col string, type string, labels string, sum string")
    with pytest.raises(Refused):
        publish.specs(rows(("T", "a", "amount", "A", "sum unless b"), ("T", "b", "text", "B", "")))
    s = publish.specs(rows(("T", "g", "group", "", ""), ("T", "a", "amount", "A|Aa", "sum")))["T"]
    assert s["group"] == "g" and s["columns"][1][2] == ["A", "Aa"] and publish.sum_sql("a", s["sums"]["a"]) == "a"


def test_site_refuses_what_is_not_listed(spark):
    key = lambda *k: spark.createDataFrame([(x, x.lower()) for x in k], "key string, sql_table string")
    urls = lambda *u: spark.createDataFrame([(x,) for x in u], "url string")
    assert publish.site_catalogue(key("A", "B").select("key"), key("A"), urls("x")).count() == 2
    with pytest.raises(Refused):
        publish.site_catalogue(key("A").select("key"), key("B"), urls("x"))
    with pytest.raises(Refused):
        publish.site_catalogue(key("A").select("key"), key("A"), urls("x", None))


def test_files_for_clients(spark, tmp_path):
    df = spark.createDataFrame([(2, 'a "b", c'), (1, None)], "k int, t string")
    sinks.write_client_csv(df, str(tmp_path / "c"), ["k"])
    (part,) = (tmp_path / "c").glob("part-*")
    assert part.read_bytes() == '﻿k,t\r\n1,\r\n2,"a ""b"", c"\r\n'.encode()
    for n in (1, 2):
        sinks.replace_table(df.limit(n), str(tmp_path / "t"))
        assert spark.read.parquet(str(tmp_path / "t")).count() == n
    assert publish.content_sum(df, ["k"]) == publish.content_sum(df.orderBy("k"), ["k"]) != publish.content_sum(df.limit(1), ["k"])


def word(text, u, v, width=40.0):
    return {"text": text, "u0": u, "u1": u + width, "v0": v, "v1": v + 9.0, "size": 9.0}


def test_grid_and_columns():
    walls, levels = reader.join_walls([(10.0, 0.0, 20.0), (10.4, 19.0, 60.0), (50.0, 0.0, 60.0), (90.0, 0.0, 60.0)]), reader.join_levels([(0.0, 10.0, 50.0), (1.0, 50.0, 90.0), (20.0, 10.0, 90.0)])
    assert [w[1:] for w in walls] == [[0.0, 60.0]] * 3 and len(levels) == 2
    labels, edges, _, bottom = reader.grid_header([word("A", 15.0, 5.0, 10.0), word("B", 55.0, 5.0, 10.0)], walls, levels)
    assert labels == ["A", "B"] and edges == [10.0, 50.0, 90.0] and bottom == 20.0
    assert reader.grid_header([], walls[:2], levels) is None
    assert reader.page_edges([10.0, 50.0, 90.0], [[13.0, 0.0, 9.0], [53.0, 0.0, 9.0], [93.0, 0.0, 9.0]]) == [13.0, 53.0, 93.0]
    assert reader.page_edges([10.0, 50.0, 90.0], [[5.0, 0.0, 9.0], [60.0, 0.0, 9.0]]) is None


def test_a_low_line_joins_the_one_above():
    edges, walls = [0.0, 50.0, 100.0], [[0.0, 0.0, 80.0], [50.0, 0.0, 80.0], [100.0, 0.0, 80.0]]
    low = word("5,00", 60.0, 14.0, 30.0) | {"v1": 17.0}
    rows, _ = reader.body([word("Alfa", 5.0, 8.0, 30.0), low, word("Beta", 5.0, 30.0, 30.0), word("6,00", 60.0, 30.0, 30.0)], walls, [[0.0, 0.0, 100.0]], edges, 0.0, [False, True], False)
    assert [r[0] for r in rows] == [["Alfa", "5,00"], ["Beta", "6,00"]]


def test_repeated_glyphs_and_gaps():
    g = lambda u, c: (u, u + 5.0, c, 0.0, 9.0, 9.0)
    assert [w[0] for w in reader.glyphs_to_words([g(0, "a"), g(0.3, "a"), g(5, "b"), g(10, "b"), g(30, "c")])] == ["abb", "c"]


def test_no_header_without_data():
    assert headers.find_header([word("Operatore", 20.0, 10.0), word("Importo", 120.0, 10.0), word("Paese", 220.0, 10.0)], []) is None


def test_walls_stop_tables_only_after_the_last_page_seen(spark):
    one = spark.createDataFrame([(1, "A", 3, 5)], "volume int, code string, start int, floor int")
    volumes_ = spark.createDataFrame([(1, 20)], "volume int, pages int")
    pages = lambda *p: spark.createDataFrame([(1, x) for x in p], "volume int, page int")
    edges = spark.createDataFrame([(1, 1, "MAE"), (1, 5, "MEF"), (1, 12, "DOG")], "volume int, page int, name string")
    r = placement.ends(one, volumes_, edges, pages(4, 9), pages(2, 8)).first()
    assert (r["end0"], r["end1"], r["end2"], r["end3"], r["clamps"]) == (20, 5, 5, 5, "index")
    r = placement.ends(one, volumes_, edges.filter("page <> 5"), pages(4, 9), pages(2, 8)).first()
    assert (r["end1"], r["end2"], r["end3"], r["clamps"]) == (11, 8, 7, "index,section,listing")


def test_clips_and_directions(spark):
    row = spark.range(1).select(volumes.direction(F.lit(0.0), F.lit(-3.0)).alias("d"), volumes.direction(F.lit(0.0), F.lit(0.0)).alias("z"), volumes.inside(F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(4.0), F.array(F.lit(5.0), F.lit(2.0), F.lit(9.0), F.lit(9.0))).alias("i")).first()
    assert tuple(row["d"]) == (0.0, -1.0) and tuple(row["z"]) == (1.0, 0.0) and row["i"]
