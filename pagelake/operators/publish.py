"""From rows to published tables: typed facts with their schema, rebuilt views with checks, the index of tables, exhibits."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.numbers import parse_date, parse_number, status, stripped
from pagelake.sources.tables import Refused

VALUED = {"amount": parse_number, "number": parse_number, "date": parse_date}


def specs(rows: DataFrame) -> dict[str, dict]:
    """Agreed tables from their rule file (table, col, type, labels, sum; in file order): columns, sum rules, links.

    A sum rule reads `sum [else <col>@<col>=<value>] [unless <col>]`; `unless` must name a valued column, else Refused. The
    file has a few dozen lines, agreed by a person.
    """
    out: dict[str, dict] = {}
    for r in rows.orderBy("ord").collect():
        t = out.setdefault(r["table"], {"columns": [], "sums": {}, "link": None, "group": None, "unit": None})
        rule = (r["sum"] or "").split()
        t["columns"].append((r["col"], r["type"], (r["labels"] or "").split("|")))
        if r["type"] in ("group", "unit"):
            t[r["type"]] = r["col"]
        if r["type"] == "link":
            t["link"] = tuple(rule)
        elif rule[:1] == ["sum"]:
            other, unless = None, rule[rule.index("unless") + 1] if "unless" in rule else None
            if rule[1:2] == ["else"]:
                col, when = rule[2].split("@")
                other = (col, *when.split("="))
            t["sums"][r["col"]] = {"else": other, "unless": unless}
    for name, t in out.items():
        valued = {c for c, k, _ in t["columns"] if k in VALUED}
        for col, rule in t["sums"].items():
            if rule["unless"] and rule["unless"] not in valued:
                raise Refused(f"{name}.{col}: unless {rule['unless']} must name a valued column")
    return out


def sum_sql(column: str, rule: dict) -> str:
    """What a row adds to a column's printed totals, as SQL that is stored beside the column."""
    expr = column
    if rule["else"]:
        col, when, value = rule["else"]
        expr = f"COALESCE({column}, CASE WHEN {when} = '{value}' THEN {col} END, 0)"
    return f"CASE WHEN {rule['unless']}_raw IS NOT NULL THEN 0 ELSE {expr} END" if rule["unless"] else expr


def records(rows: DataFrame, spec: list[tuple[str, str]], implied: dict[str, Column] | None = None, cells: str = "cells") -> DataFrame:
    """Cells of data rows as facts: a value with its printed text beside it; what can't be read is null and named in `flags`;
    an implied value has no printed text. A dash is nothing, not an error.
    """
    out, flags = {}, []
    for k, (name, kind) in enumerate(spec):
        raw = F.nullif(F.get(F.col(cells), F.lit(k)), F.lit(""))
        if kind in VALUED:
            value = VALUED[kind](raw)
            dash = stripped(raw).isin("-", "–", "—", "‐", "‑", "−", "_", ".", "n.d.", "N.D.", "nd", "ND", "n/a", "N/A", "/")
            flags.append(F.when(raw.isNotNull() & value.isNull() & ~dash, F.lit(name)))
            out[name] = F.coalesce(value, F.when(raw.isNull(), implied[name])) if implied and name in implied else value
            out[f"{name}_raw"] = raw
        else:
            out[name] = raw
    return rows.withColumns(out).withColumn("flags", F.nullif(F.concat_ws(",", *flags), F.lit("")) if flags else F.lit(None).cast("string"))


def view_def(spec: dict, kinds: set[str], summary: bool) -> str:
    """How a table is rebuilt from its rows, as JSON with sorted keys."""
    carry = next((c for c, k, _ in spec["columns"] if k == "carry"), None)
    group = spec["group"] or carry
    years = next((c for c, k, _ in spec["columns"] if k == "years"), None)
    return json.dumps({
        "group": group, "group_prints": ("heading" if spec["group"] else "first_row") if group else None, "summed": {c: sum_sql(c, r) for c, r in spec["sums"].items()},
        "years": {"year_col": "anno", "value_col": years} if years else None, "subtotals": "subtotal" in kinds, "total": "total" in kinds, "summary": summary,
        "link": dict(zip(("amount", "item", "unit"), spec["link"], strict=True)) if spec["link"] else None,
    }, sort_keys=True)


def rebuilt(facts: DataFrame, figures: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """by, row_ord, kind, group, cells: rows of the printed table again, from facts (printed texts) and figures (one row a cell).

    facts: by, row_ord, group, columns. figures: by, row_ord, kind, group, ordinal, value_raw.
    """
    data = facts.select(*by, "row_ord", F.lit("data").alias("kind"), "group", F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("cells"))
    cell = F.map_from_entries(F.collect_list(F.struct("ordinal", "value_raw")))
    figs = figures.groupBy(*by, "row_ord", "kind", "group").agg(cell.alias("_m"))
    figs = figs.select(*by, "row_ord", "kind", "group", F.transform(F.sequence(F.lit(0), F.lit(len(columns) - 1)), lambda k: F.coalesce(F.try_element_at("_m", k), F.lit(""))).alias("cells"))
    return data.unionByName(figs)


def rendered(rows: DataFrame, by: list[str], heading: bool, blank: list[int]) -> DataFrame:
    """rows with heading (the group, where it changes and prints one) and cells as printed: carried ones (`blank`) only on the
    first row of a run, and on the first after a subtotal.
    """
    o = W.partitionBy(*by).orderBy("row_ord")
    data = F.col("kind") == "data"
    closed = F.coalesce(F.count_if(F.col("kind") == "subtotal").over(o.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    r = rows.withColumn("_seg", closed)
    before = o.rowsBetween(W.unboundedPreceding, -1)
    last = F.last(F.when(data, F.struct("group", "_seg")), True).over(before)
    r = r.withColumn("_last", last)
    first = F.col("_last").isNull() | ~F.col("_last.group").eqNullSafe(F.col("group")) | (F.col("_last._seg") != F.col("_seg"))
    shows = data & (F.col("_last").isNull() | ~F.col("_last.group").eqNullSafe(F.col("group"))) if heading else F.lit(False)
    hidden = F.array(*map(F.lit, blank)) if blank else F.array().cast("array<int>")
    cells = F.when(data & ~first, F.transform("cells", lambda c, i: F.when(F.array_contains(hidden, i), "").otherwise(c))).otherwise(F.col("cells"))
    return r.withColumns({"heading": F.when(shows, F.col("group")), "cells": cells}).drop("_seg", "_last")


def cross_checks(summary: DataFrame, detail: DataFrame, matched: DataFrame) -> DataFrame:
    """name (or names), printed, computed, status: summary lines against the detail that they match; several lines of one
    detail are added up, and a line without a match fails by itself.

    summary: name, printed. detail: name, computed. matched: name, match (null: none).
    """
    s = summary.groupBy("name").agg(F.sum("printed").alias("printed")).join(matched.select("name", "match"), "name", "left")
    by = s.filter("match IS NOT NULL").groupBy("match").agg(F.array_join(F.sort_array(F.collect_list("name")), " + ").alias("name"), F.sum("printed").alias("printed"))
    d = detail.groupBy(F.col("name").alias("match")).agg(F.sum("computed").alias("computed"))
    good = by.join(d, "match").select("name", "printed", "computed", status(F.col("printed"), F.col("computed")).alias("status"))
    bad = s.filter("match IS NULL").select("name", "printed", F.lit(None).cast(good.schema["computed"].dataType).alias("computed"), F.lit("FAIL").alias("status"))
    return good.unionByName(bad)


def published(tables: DataFrame, segments: DataFrame, verdicts: DataFrame, notes: DataFrame) -> DataFrame:
    """The index of tables: key, status, sources (file:from-to, cut marked), verify_verdict, findings, check_verdict, notes.

    tables: key, status, file. segments: key, seq, source_file, pdf_from, pdf_to, cut. verdicts: file, check_id, verdict.
    notes: key, ord, note. A table without a file has no verdict; one that wasn't checked is pending.
    """
    part = F.concat("source_file", F.lit(":"), F.col("pdf_from").cast("string"), F.lit("-"), F.col("pdf_to").cast("string"), F.when(F.col("cut"), "(cut)").otherwise(""))
    texts = lambda df, by, order, c, sep: df.groupBy(by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, c.alias("t")))), lambda x: x["t"]), sep).alias("t"))
    sources = texts(segments, "key", "seq", part, "+").withColumnRenamed("t", "sources")
    noted = texts(notes, "key", "ord", F.col("note"), "; ").withColumnRenamed("t", "notes")
    is_ = lambda v: F.max(F.col("verdict") == v)
    v = verdicts.groupBy("file").agg(F.when(is_("FAIL"), "FAIL").when(is_("WARN"), "WARN").otherwise("PASS").alias("verify_verdict"), F.array_join(F.sort_array(F.collect_set(F.when(F.col("verdict").isin("FAIL", "WARN"), F.col("check_id")))), "; ").alias("findings"))
    out = tables.join(sources, "key", "left").join(v, "file", "left").join(noted, "key", "left")
    has = F.coalesce(F.col("file"), F.lit("")) != ""
    return out.select("key", "status", F.coalesce("sources", F.lit("")).alias("sources"), F.when(has, F.coalesce("verify_verdict", F.lit("PENDING"))).otherwise("").alias("verify_verdict"), F.coalesce("findings", F.lit("")).alias("findings"), F.coalesce("notes", F.lit("")).alias("notes"))


def site_catalogue(listed: DataFrame, extracted: DataFrame, sources: DataFrame) -> DataFrame:
    """Listed tables with the name of their extracted table, if any. An extracted table that isn't listed, or a source without
    an address, is refused.
    """
    stray = extracted.join(listed, "key", "left_anti").limit(1).collect()
    if stray:
        raise Refused(f"extracted and not listed: {stray[0]['key']}")
    if sources.filter("url IS NULL OR url = ''").limit(1).count():
        raise Refused("a source without an address")
    return listed.join(extracted.select("key", "sql_table"), "key", "left")


def load_report(tables: DataFrame, rows: DataFrame, issues: DataFrame, results: DataFrame) -> DataFrame:
    """key, refused, n_rows, issues, passed, rounding, failed, unchecked of every table of an edition, loaded or refused.

    tables: key. rows: key. issues: key, kind, detail. results: key, status. A table whose issue is of the kind `refused`
    has no rows; what says why is kept, and its checks count for nothing.
    """
    one = lambda v: F.count_if(F.col("status") == v)
    n = rows.groupBy("key").agg(F.count("*").alias("n_rows"))
    why = issues.groupBy("key").agg(F.max(F.when(F.col("kind") == "refused", F.col("detail"))).alias("refused"), F.count("*").alias("issues"))
    checks = results.groupBy("key").agg(one("PASS").alias("passed"), one("ROUNDING").alias("rounding"), one("FAIL").alias("failed"), one("UNCHECKED").alias("unchecked"))
    out = tables.select("key").join(n, "key", "left").join(why, "key", "left").join(checks, "key", "left")
    loaded = lambda c: F.when(F.col("refused").isNull(), F.coalesce(c, F.lit(0))).otherwise(0).alias(c)
    return out.select("key", "refused", F.coalesce("issues", F.lit(0)).alias("issues"), *[loaded(c) for c in ("n_rows", "passed", "rounding", "failed", "unchecked")])


def content_sum(df: DataFrame, key: list[str]) -> tuple[int, int]:
    """Rows and an order-free checksum of a table: equal for equal contents, however they are written."""
    every = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in [*key, *[x for x in df.columns if x not in key]]])
    r = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.pmod(every, F.lit(1 << 31))), F.lit(0)).alias("s")).first()
    return r["n"], r["s"]


# ---------------------------------------------------------------- exhibits that share a page

# Fixed values, in points: gaps over a heading, to notes and totals under a grid, and between lines of one row.
HEADING_GAP, NOTE_GAP, TOTAL_GAP, ROW_GAP = 2.0, 14.0, 24.0, 3.0
NOTE = r"(?i)^\s*(?:\(\s*\*+\s*\)|\*+|\(\d+\)|Fonte\b|Note?\b|N\.\s*B\.)"
TOTAL = r"(?i)^\s*Total[ei]\b"


def exhibit_bands(headings: DataFrame, pages: DataFrame) -> DataFrame:
    """page, kind, number, lo, hi: from a little over each heading to a little over the next one, or the page's end.

    headings: page, kind, number, top. pages: page, height.
    """
    nxt = F.lead("top").over(W.partitionBy("page").orderBy("top", "number"))
    return headings.join(pages, "page").select("page", "kind", "number", (F.col("top") - HEADING_GAP).alias("lo"), F.coalesce(nxt - HEADING_GAP, F.col("height")).alias("hi"))


def table_foot(lines: Column, grid: Column) -> Column:
    """Where a grid's table ends: at its last rule, or at the last of the lines under it that follow closely, where the first
    is a note or a total. lines: array of (y0, y1, text, x0) under the grid, by y0. A line's gap is to what ends so far,
    so this folds.
    """
    first = F.try_element_at(lines, F.lit(1))
    row = F.filter(lines, lambda x: x["y0"] - first["y0"] <= ROW_GAP)
    label = F.array_min(F.transform(row, lambda x: F.struct(x["x0"], x["text"].alias("t"))))["t"]
    gap = first["y0"] - grid
    starts = ((gap <= NOTE_GAP) & label.rlike(NOTE)) | ((gap <= TOTAL_GAP) & label.rlike(TOTAL))
    state = lambda y, on: F.struct(y.alias("y"), on.alias("on"))
    begin = state(F.greatest(grid, first["y1"]), F.lit(True))
    step = lambda s, x: F.when(s["on"] & (x["y0"] - s["y"] <= NOTE_GAP), state(F.greatest(s["y"], x["y1"]), F.lit(True))).otherwise(state(s["y"], F.lit(False)))
    return F.when(F.coalesce(starts, F.lit(False)), F.aggregate(lines, begin, step, lambda s: s["y"])).otherwise(grid)


def cut_words(words: DataFrame, bands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(words of each band: page, number, word columns; words that no band has). words: page, v0, v1.

    Of the bands that begin at or above a word, the one that reaches furthest has it if any has: one sort of a page's bands
    and words.
    """
    b = bands.filter("page IS NOT NULL AND number IS NOT NULL").select("page", F.col("lo").alias("_at"), F.lit(0).alias("_side"), F.struct("hi", "number").alias("_b"))
    w = words.select("page", F.col("v0").alias("_at"), F.lit(1).alias("_side"), F.struct(*[c for c in words.columns if c != "page"]).alias("_w"))
    reach = F.max("_b").over(W.partitionBy("page").orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, 0))
    w = b.unionByName(w, allowMissingColumns=True).withColumn("_r", reach).filter("_side = 1")
    w = w.select("page", "_w.*", F.when(F.col("_w.v1") <= F.col("_r.hi"), F.col("_r.number")).alias("number")).select(*words.columns, "number")
    return w.filter("number IS NOT NULL"), w.filter("number IS NULL").drop("number")


def source_box(u0: Column, v0: Column, u1: Column, v1: Column, turn: Column, width: Column, height: Column) -> Column:
    """struct(x0, y0, x1, y1) on the source page of a box on the turned one; turn: 0, 90, 180 or 270 degrees; width and height
    of the source page.
    """
    corner = lambda u, v: (
        F.when(turn == 0, F.struct(u.alias("x"), v.alias("y"))).when(turn == 90, F.struct(v.alias("x"), (height - u).alias("y"))).when(turn == 180, F.struct((width - u).alias("x"), (height - v).alias("y"))).otherwise(F.struct((width - v).alias("x"), u.alias("y")))
    )
    a, b = corner(u0, v0), corner(u1, v1)
    two = lambda c: F.round(c, 2)
    return F.struct(two(F.least(a["x"], b["x"])).alias("x0"), two(F.least(a["y"], b["y"])).alias("y0"), two(F.greatest(a["x"], b["x"])).alias("x1"), two(F.greatest(a["y"], b["y"])).alias("y1"))


def union_in_order(parts: list[DataFrame], key: str) -> DataFrame:
    """Tables' parts one under the other, each with its place, so that they are written in the order of the index."""
    return reduce(DataFrame.unionByName, [p.withColumn(key, F.lit(k).cast("bigint")) for k, p in enumerate(parts)])
