"""Rows of a table: units, the link of items to amounts, facts with their printed text, figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.numbers import parse_date, parse_number


def _filled(c: str) -> Column:
    return F.coalesce(F.col(c) != "", F.lit(False))


def link_items(rows: DataFrame, by: list[str], order: str, group: str, opener: str, amount: str, item: str, text: list[str], described: list[str]) -> DataFrame:
    """Data rows of tables (by) with the amount of each item: unit, link, implied, copied_from, issues, cells set right.

    A unit (the order of its first row) begins at a filled opener or where the group changes. Text on an amount line
    without an item goes up to the item above it in the unit. Then, by unit:

    no item: issue no_item on the unit's first row. No amount: an item links to itself, its amount implied (zero).
    More amounts than items: a bare amount takes the described cells it lacks from the item above it (copied_from) and
    counts as an item from then on; if there are still more amounts, issue too_many_amounts on the first row. As many:
    the k-th item with the k-th amount. Fewer: an item with the last amount at or above it, else issue above_first; an
    amount that no item took, issue covers_none. Text without an item above: issue text_without_item.
    """
    o, w = F.col(order), W.partitionBy(*by).orderBy(order)
    opens = _filled(opener) | ~F.lag(group).over(w).eqNullSafe(F.col(group)) | (F.row_number().over(w) == 1)
    r = rows.withColumn("unit", F.last(F.when(opens, o), True).over(w.rowsBetween(W.unboundedPreceding, 0)))
    r = r.withColumns({"_a": _filled(amount), "_i": _filled(item)})
    u = W.partitionBy(*by, "unit")
    upto, above = u.orderBy(order).rowsBetween(W.unboundedPreceding, 0), u.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    r = r.withColumn("_item_above", F.last(F.when(F.col("_i"), o), True).over(above))
    # text on bare amount lines goes up
    moves = F.col("_a") & ~F.col("_i") & F.col("_item_above").isNotNull()
    owner = F.when(moves, F.col("_item_above")).otherwise(o)
    loose = F.col("_a") & ~F.col("_i") & F.col("_item_above").isNull() & reduce(lambda x, y: x | y, [_filled(c) for c in text], F.lit(False))
    r = r.withColumns({"_owner": owner, "_moves": moves, "_loose": loose})
    at = W.partitionBy(*by, "unit", "_owner").orderBy(order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    for c in text:
        whole = F.array_join(F.filter(F.collect_list(F.when(_filled(c), F.col(c)).otherwise("")).over(at), lambda x: x != ""), " ")
        r = r.withColumn(f"_{c}", whole)
    r = r.withColumns({c: F.when(F.col("_moves"), "").otherwise(F.when(F.col("_i"), F.col(f"_{c}")).otherwise(F.col(c))) for c in text})
    # more amounts than items: bare amounts take from the item above
    r = r.withColumns({"_na": F.count_if("_a").over(u), "_ni": F.count_if("_i").over(u)})
    source = F.last(F.when(F.col("_i"), F.struct(o.alias("at"), *described)), True).over(above)
    r = r.withColumn("_src", source)
    takes = lambda c: ~_filled(c) & F.coalesce(F.col(f"_src.{c}") != "", F.lit(False))
    bare = (F.col("_na") > F.col("_ni")) & (F.col("_ni") > 0) & F.col("_a") & ~F.col("_i") & F.col("_src").isNotNull()
    r = r.withColumn("_copies", bare & reduce(lambda x, y: x | y, [takes(c) for c in described], F.lit(False)))
    r = r.withColumns({c: F.when(F.col("_copies") & takes(c), F.col(f"_src.{c}")).otherwise(F.col(c)) for c in described})
    r = r.withColumn("_item", F.col("_i") | F.col("_copies"))
    r = r.withColumns({"_nx": F.count_if("_item").over(u), "_k": F.when(F.col("_item"), F.count_if("_item").over(upto)), "_last": F.last(F.when(F.col("_a"), o), True).over(upto)})
    amounts = r.filter("_a").select(*by, "unit", F.count_if("_a").over(upto).alias("_k"), o.alias("_kth"))
    r = r.join(amounts, [*by, "unit", "_k"], "left")
    link = F.when((F.col("_ni") == 0) | ~F.col("_item") | (F.col("_na") > F.col("_nx")), F.lit(None)).when(F.col("_na") == 0, o).when(F.col("_na") == F.col("_nx"), F.col("_kth")).otherwise(F.col("_last"))
    r = r.withColumn("link", link)
    fewer = (F.col("_na") > 0) & (F.col("_na") < F.col("_nx"))
    covered = F.array_contains(F.collect_set("link").over(u), o)  # a unit is one authorisation
    first = o == F.col("unit")
    issues = {
        "no_item": first & (F.col("_ni") == 0),
        "too_many_amounts": first & (F.col("_ni") > 0) & (F.col("_na") > F.col("_nx")),
        "text_without_item": F.col("_loose"),
        "above_first": fewer & F.col("_item") & F.col("_last").isNull(),
        "covers_none": fewer & F.col("_a") & ~covered,
    }
    issue = F.array_join(F.array_compact(F.array(*[F.when(c, k) for k, c in issues.items()])), ",")
    out = r.withColumns({"implied": F.col("_item") & (F.col("_na") == 0), "copied_from": F.when(F.col("_copies"), F.col("_src.at")), "issues": issue})
    return out.select(*rows.columns, "unit", "link", "implied", "copied_from", "issues")


TYPES = {"amount": parse_number, "number": parse_number, "date": parse_date}


def typed(rows: DataFrame, spec: list[tuple[str, str]], cells: str = "cells") -> DataFrame:
    """Cells as columns: text as printed, or a value with its text beside it in <name>_raw; unreadable ones in `flags`."""
    out, flags = {}, []
    for k, (name, kind) in enumerate(spec):
        raw = F.nullif(F.try_element_at(F.col(cells), F.lit(k + 1)), F.lit(""))
        if kind in TYPES:
            out[name], out[f"{name}_raw"] = TYPES[kind](raw), raw
            dash = F.trim(raw).isin("-", "–", "—", "n.d.")
            flags.append(F.when(raw.isNotNull() & out[name].isNull() & ~dash, F.lit(name)))
        else:
            out[name] = raw
    return rows.withColumns(out).withColumn("flags", F.nullif(F.concat_ws(",", *flags), F.lit("")) if flags else F.lit(None).cast("string"))


def figures(rows: DataFrame, key: list[str], cells: str = "cells") -> DataFrame:
    """Printed cells that are not facts, one row each, blank ones left out."""
    return rows.select(*key, F.posexplode(cells).alias("ordinal", "value_raw")).filter("value_raw <> ''").withColumn("value", parse_number(F.col("value_raw")))


def unpivot_years(rows: DataFrame, key: list[str], years: list[int]) -> DataFrame:
    """Year columns to rows (anno, value); columns that a row leaves empty give none."""
    return rows.unpivot(key, [str(y) for y in years], "anno", "value").withColumn("anno", F.col("anno").cast("int")).filter("value IS NOT NULL")
