from decimal import Decimal

from pyspark.sql import functions as F

from pagelake.functions import numbers, text

NUMBERS = [
    ("1.234,56", "1234.56"), ("1 234,56", "1234.56"), ("1234,56", "1234.56"), ("1,234.56", None), ("016", None), ("01", None), ("0", "0"), ("0,00", "0"), ("05,5", "5.5"),
    ("0123", "123"), ("0.123", "123"), ("1.234", "1234"), ("12.5", "12.5"), ("1234.567", "1234.567"), ("-€ 142.942,72", "-142942.72"), ("€ -40,66", "-40.66"), ("(1.000,00)", "-1000"),
    ("3,43 %", "3.43"), ("—", None), ("n.d.", None), ("€ 12.877,00", "12877"), ("12,00 EUR", "12"), ("738.648,73", "738648.73"), ("1.23.456", None), ("12.345.678,9", "12345678.9"),
    ("1.2345", "1.2345"), ("− 5", "-5"), ("abc", None), ("5)", "5"), ("(5", "5"), ("00,1", "0.1"), ("000", None), ("1.000 €", "1000"), (None, None), ("", None),
]


def test_numbers(spark):
    df = spark.createDataFrame([(k, a) for k, (a, _) in enumerate(NUMBERS)], "k int, raw string")
    got = {r["k"]: r["v"] for r in df.select("k", numbers.parse_number(F.col("raw")).alias("v")).collect()}
    for k, (raw, want) in enumerate(NUMBERS):
        assert got[k] == (None if want is None else Decimal(want)), raw


def test_dates_and_shapes(spark):
    df = spark.createDataFrame([("1/2/2025",), ("31/02/2025",), ("3.4.71",), ("3-4-69",), ("1/13/2020",), (None,), ("x",)], "raw string")
    got = [r["d"] for r in df.select(numbers.parse_date(F.col("raw")).alias("d")).collect()]
    assert got == ["2025-02-01", "2025-02-31", "1971-04-03", "2069-04-03", None, None, None]
    shapes = spark.createDataFrame([("",), ("—",), ("Totale 3",), ("€ 3,00",), ("1/2/2025",), ("2024",), ("016",), ("3,4 %",), ("3,4",), ("Alfa S.p.A.",), (None,)], "c string")
    assert [r["s"] for r in shapes.select(numbers.value_shape(F.col("c")).alias("s")).collect()] == ["empty", "dash", "total_label", "currency", "date", "year", "code", "percent", "number", "text", "empty"]


def test_page_text(spark):
    df = spark.createDataFrame([("  Tab. 12 esempio  3\n\n- 45 -\n x \nTABELLA\nA1\n",), ("",), (None,)], "t string")
    r = df.select(text.header_fingerprint(F.col("t")).alias("h"), text.printed_numbers(F.col("t")).alias("n"), text.after_line(F.col("t"), "tabella").alias("c"), text.is_garbled(F.col("t")).alias("g")).collect()
    assert (r[0]["h"], r[0]["n"], r[0]["c"], r[0]["g"]) == ("Tab. esempio", [45], "A1", False)
    assert r[1]["g"] and r[2]["g"]
    t = "".join(chr(c) for c in range(32, 123) if c != 61)  # the space has no cipher, so nothing stands for "="
    one = spark.createDataFrame([(t,)], "t string").select(text.unshift(text.shift(F.col("t"))).alias("d"), text.cited_article(F.lit("vedi art. 2 comma 6 L. 185")).alias("a"), text.normalised(F.lit("ﬁne   x")).alias("n")).first()
    assert one["d"] == t and one["a"] == "A2C6" and one["n"] == "fine x"


def test_glyphs(spark):
    df = spark.createDataFrame([("ab", {"": "X"})], "t string, g map<string,string>")
    r = df.select(text.decode(F.col("t"), F.col("g")).alias("d"), text.undecoded(F.col("t")).alias("n")).first()
    assert r["d"] == "aXb" and r["n"] == 2
