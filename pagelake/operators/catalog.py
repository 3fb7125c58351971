"""Shapes of tables: page statistics, the usual column widths, roles of columns, grammar, and what changed by year."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions.text import deaccent
from pagelake.operators.sets import first_in_group, shape_diff


def page_stats(pages: DataFrame) -> DataFrame:
    """pages: key, page, status (legible, garbled, ciphered, empty). Counts by status, and the share that can be read."""
    kinds = ("legible", "garbled", "ciphered", "empty")
    return pages.groupBy("key").agg(F.count("*").alias("pages"), *[F.count_if(F.col("status") == k).alias(k) for k in kinds], F.avg(F.when(F.col("status") == "legible", 1.0).otherwise(0.0)).alias("share"))


def signatures(columns: DataFrame) -> DataFrame:
    """columns: key, page, ordinal, width. The commonest tuple of widths of a table, its first page, and how many it has."""
    tuples = columns.groupBy("key", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", F.round("width").alias("w")))), lambda c: c["w"]).alias("widths"))  # a page has a few columns
    n = tuples.groupBy("key", "widths").agg(F.count("*").alias("n"), F.min("page").alias("first_page"))
    kinds = n.groupBy("key").agg(F.count("*").alias("kinds"))
    return first_in_group(n, ["key"], [F.desc("n"), "first_page"]).join(kinds, "key").withColumn("stable", F.col("kinds") == 1)


# Words of a column's label that tell its role, tried in this order.
KEY_WORDS = ["numero", "n.", "codice", "cod.", "autorizzazione"]
MEASURE_WORDS = ["valore", "importi", "euro", "€", "quantita", "spedizioni", "movimentazioni", "prezzo", "amount", "totale"]


def column_role(label: Column, shapes: Column) -> Column:
    """key, measure, dimension, or meta for a column without a label; shapes: the kinds of values that occur in it."""
    t = deaccent(F.coalesce(label, F.lit("")))
    has = lambda words: reduce(lambda a, b: a | b, [t.contains(w) for w in words])
    codes = (F.size(shapes) > 0) & F.forall(shapes, lambda x: x.isin("code", "empty"))
    return F.when(t == "", "meta").when(has(KEY_WORDS), "key").when(has(MEASURE_WORDS), "measure").when(codes, "key").otherwise("dimension")


def extraction_status(pages: Column, legible: Column, grammar: Column, n_columns: Column, charted: Column) -> Column:
    """struct(extractable, reason) of a table, from its catalogue row."""
    out = lambda e, r: F.struct(F.lit(e).alias("extractable"), (r if isinstance(r, Column) else F.lit(r)).alias("reason"))
    none = (grammar == "unknown") & (n_columns == 0)
    part = F.concat(F.lit("partial: "), (pages - legible).cast("string"), F.lit("/"), pages.cast("string"), F.lit(" pages illegible"))
    return F.when(none & charted, out(False, "a chart")).when(legible == 0, out(False, "illegible")).when(none, out(False, "no header")).when(legible < pages, out(True, part)).otherwise(out(True, ""))


def census(tables: DataFrame) -> dict[str, DataFrame]:
    """Five reports on the catalogue: coverage by body, grammars, orientations, signatures, and what can't be read.

    tables: year, authority, key, pages, legible, grammar, orientation, widths, extractable, reason.
    """
    return {
        "coverage": tables.groupBy("year", "authority").agg(F.count("*").alias("tables"), F.sum("pages").alias("pages"), F.sum("legible").alias("legible"), F.count_if("extractable").alias("extractable")),
        "grammars": tables.groupBy("grammar").agg(F.count("*").alias("n")),
        "orientations": tables.groupBy("orientation").agg(F.count("*").alias("n"), F.sum("pages").alias("pages")),
        "signatures": tables.groupBy("widths").agg(F.count("*").alias("n"), F.min("key").alias("first_key")),
        "unreadable": tables.filter("NOT extractable").select("year", "key", "reason"),
    }


def relative_label(label: Column, year: int) -> Column:
    """A column's label with years written relative to the edition's, so that editions compare."""
    out = F.replace(F.lower(label), F.lit("’"), F.lit("'"))
    for back in range(-10, 60):
        out = F.regexp_replace(out, rf"\b{year - back}\b", "y" if back == 0 else f"y{-back:+d}")
    return out


def year_diff(old: DataFrame, new: DataFrame, old_year: int, new_year: int) -> DataFrame:
    """old, new: authority, article, code, ordinal, label. Columns added, dropped, renamed or the same, by place.

    A missing article is a key like others.
    """
    keys = ["authority", "article", "code", "ordinal"]
    side = lambda df, y: df.select("authority", F.coalesce("article", F.lit("-")).alias("article"), "code", "ordinal", relative_label(F.col("label"), y).alias("label"))
    return shape_diff(side(old, old_year), side(new, new_year), keys, "label")


def sample_pages(first: Column, last: Column, n: int) -> Column:
    """Both ends of a range and an even spread between, distinct."""
    step = (last - first) / F.lit(max(1, n - 1))
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.round(first + k * step).cast("int")))
