import pytest
from pyspark.sql import functions as F

from pagelake.functions import pages, text


def one(spark, t, column):
    return spark.createDataFrame([(t,)], "t string").select(column(F.col("t")).alias("c")).first()["c"]


def test_whose_page(spark):
    mae = "MAECI - UAMA - CENTRO INFORMATICO Pagina 1 di 2 TAB M2"
    got = [one(spark, t, pages.classify) for t in ("MINISTERO DELLA DIFESA Annesso 4B", "x\nTAB. D1 esportazioni", "Programmi Intergovernativi\nTAB. M", "Dipartimento del Tesoro Direzione V", mae, "altro")]
    assert [c and tuple(c) for c in got] == [("DIFESA", "A2C6", "4B"), ("DOG", "A1C2", None), ("DOG", "A1C89", None), ("MEF", None, None), ("MAE", None, None), None]


def test_codes_by_precedence(spark):
    code = lambda t, family=1, vocabulary=("AA",): one(spark, t, lambda c: pages.page_code(c, F.array(*map(F.lit, vocabulary)), F.lit(family)))
    assert tuple(code("Tabella AA\nTAB. M - APPENDICE")) == ("MAPPENDICE", "appendix")
    assert tuple(code("Tabella AA\nsi veda la tabella BB")) == ("AA", "title")
    assert code("Tabella AA\nprosa", family=2) is None
    assert tuple(code("TAB. B1 x", family=2)) == ("B1", "inline")


def test_exhibits_stay_open(spark):
    df = spark.createDataFrame([(1, 1, "II", False), (1, 2, None, False), (1, 3, None, True), (1, 4, None, False), (1, 5, "EE", True), (1, 6, None, False)], "vol int, page int, opens string, closes boolean")
    got = [r["exhibit"] for r in pages.open_exhibits(df, ["vol"], "page", "opens", "closes").orderBy("page").collect()]
    assert got == ["II", "II", "II", None, "EE", None]
    assert pages.vocabulary(df.filter("opens IS NOT NULL"), ["vol"], "opens").first()["codes"] == ["EE", "II"]


def test_only_ciphered_lines_of_ciphered_pages_are_read(spark):
    hidden = one(spark, "Licenza di un operatore per sistemi elettronici militari", text.shift)
    assert one(spark, "Running header\n" + hidden, text.decipher) == "Running header\nLicenza di un operatore per sistemi elettronici militari"
    assert one(spark, "xyz", text.decipher) == "xyz"  # too short to be judged
    clear = "una pagina scritta in chiaro, con tutte le sue vocali al posto giusto"
    assert one(spark, clear, text.decipher) == clear


@pytest.mark.parametrize(("t", "shape"), [("12,00 EUR", "number"), ("€ 016", "currency"), ("-€ 142.942,72", "currency"), ("016", "code"), ("3,43 %", "percent"), ("Totale 5", "total_label"), ("2025", "year"), ("0,00", "number"), ("n.d.", "dash"), ("123456 7", "text")])
def test_shapes(spark, t, shape):
    from pagelake.functions.numbers import value_shape

    assert one(spark, t, value_shape) == shape
