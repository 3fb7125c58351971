"""What kind of line a band of cells is, and what grammar its table has. Expressions over arrays of cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.numbers import value_shape

#: Widths from this multiple of the lower quartile's on are prose; characters of a header cell; share of changes under
#: which a column repeats; share of lines that make a list of wrapped cells.
WIDE, HEADER_CHARS, CHANGES, WRAPPED_SHARE = 1.6, 60, 0.34, 0.3
NO_LABEL = ["number", "currency", "date", "percent", "code"]

PROFILE = "struct<filled:int,numeric:int,text:int,dates:int,totals:int,places:array<int>>"


def shapes(cells: Column) -> Column:
    return F.transform(cells, lambda c: value_shape(c))


def profile(cells: Column) -> Column:
    """struct of counts of a band's cells by kind, and the places of those that are filled."""
    kinds = shapes(cells)
    n = lambda *ks: F.size(F.filter(kinds, lambda k: k.isin(*ks)))
    full = F.filter(F.transform(kinds, lambda k, i: F.when(k != "empty", i)), lambda i: i.isNotNull())
    return F.struct(F.size(full).alias("filled"), n("number", "currency", "percent").alias("numeric"), n("text").alias("text"), n("date").alias("dates"), n("total_label").alias("totals"), full.alias("places"))


def wide_columns(widths: Column) -> Column:
    """Places of columns much wider than the lower quartile of all; none among fewer than three."""
    in_order = F.array_sort(widths)
    quartile = F.try_element_at(in_order, (F.floor(0.25 * (F.size(widths) - 1)) + 1).cast("int"))
    base = F.when(quartile == 0, 1.0).otherwise(quartile)
    wide = F.filter(F.transform(widths, lambda w, i: F.when(w >= WIDE * base, i)), lambda i: i.isNotNull())
    return F.when(F.size(widths) >= 3, wide).otherwise(F.array().cast("array<int>"))


def band_kind(p: Column, wide: Column, previous: Column) -> Column:
    """The kind of a band from its profile, the wide columns and the kind of the band above; rules in their order."""
    in_wide = (F.size(wide) > 0) & (p["filled"] > 0) & (F.size(F.array_except(p["places"], wide)) == 0)
    return (
        F.when(p["filled"] == 0, "blank")
        .when(p["totals"] > 0, "total")
        .when(p["dates"] > 0, "data")
        .when(in_wide & (p["numeric"] == 0), F.when(previous.isin("continuation", "wrapped"), "wrapped").otherwise("data"))
        .when((p["filled"] == 1) & (p["text"] == 1), "group")
        .when((p["filled"] >= 2) & (p["text"] == 0) & (p["numeric"] >= 2), "subtotal")
        .when(in_wide, "continuation")
        .when((p["numeric"] == 0) & (p["text"] >= 1), "group")
        .otherwise("data")
    )


def band_kinds(bands: Column, widths: Column) -> Column:
    """Kinds of a page's bands (an array of arrays of cells) in their order; each depends on the one above, so this folds."""
    wide = wide_columns(widths)
    step = lambda acc, p: F.concat(acc, F.array(band_kind(p, wide, F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit("")))))
    return F.aggregate(F.transform(bands, profile), F.array().cast("array<string>"), step)


def is_label_row(cells: Column) -> Column:
    """Some text, no cell as long as a paragraph, none shaped as a value."""
    return F.exists(cells, lambda c: c != "") & F.forall(cells, lambda c: (F.length(c) <= HEADER_CHARS) & ~value_shape(c).isin(NO_LABEL))


def is_header(cells: Column, columns: Column) -> Column:
    """Three cells, and three fifths of the columns, filled at least."""
    return (columns > 0) & (F.size(F.filter(cells, lambda c: F.trim(c) != "")) >= F.greatest(F.lit(3.0), 0.6 * columns))


def repeated_columns(rows: DataFrame, by: list[str], order: str, cells: str = "cells") -> DataFrame:
    """by, ordinal, filled, distinct, change_ratio: columns whose value seldom changes from one filled data row to the next.

    rows: data rows only. Columns with fewer than two filled cells aren't judged.
    """
    x = rows.select(*by, order, F.posexplode(cells).alias("ordinal", "v")).filter("v <> ''")
    w = W.partitionBy(*by, "ordinal").orderBy(order)
    x = x.withColumn("_was", F.lag("v").over(w))
    g = x.groupBy(*by, "ordinal").agg(F.count("*").alias("filled"), F.count_distinct("v").alias("distinct"), F.count_if(F.col("_was").isNotNull() & (F.col("_was") != F.col("v"))).alias("_c"))
    g = g.filter("filled >= 2").withColumn("change_ratio", F.col("_c") / (F.col("filled") - 1))
    return g.filter(F.col("change_ratio") <= CHANGES).select(*by, "ordinal", "filled", "distinct", "change_ratio")


def grammar(counts: DataFrame) -> DataFrame:
    """counts (kinds as columns n_data, n_group, n_subtotal, n_continuation, n_wrapped, n; wide: columns that are; varied:
    most distinct values of a repeated column, 0 without one) with the table's grammar.
    """
    c = F.col
    wrapped = (c("n_wrapped") >= WRAPPED_SHARE * c("n")) | ((c("n_continuation") >= WRAPPED_SHARE * c("n")) & (c("n_data") <= 0.5 * c("n")))
    label = (
        F.when((c("n_data") == 0) & (c("n_wrapped") > 0) & (c("wide") > 0), "wrapped-list")
        .when(c("n_data") == 0, "unknown")
        .when(wrapped & (c("wide") > 0), "wrapped-list")
        .when((c("n_group") > 0) & (c("n_subtotal") > 0), "group+subtotal")
        .when(c("varied") >= 2, "repeated-subdimension")
        .when(c("n_group") > 0, "group+subtotal")
        .otherwise("flat")
    )
    return counts.withColumn("grammar", label)


def kind_counts(bands: DataFrame, by: list[str]) -> DataFrame:
    """by and one count for each kind. bands: by, kind."""
    kinds = ["data", "group", "subtotal", "continuation", "wrapped", "total", "blank"]
    return bands.groupBy(*by).agg(F.count("*").alias("n"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds])
