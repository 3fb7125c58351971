"""Reconciliation and verdicts: rule sums, summary against detail, folds, escalation, and mutations that must be seen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.numbers import status

RANKS = {"SKIP": 0, "PASS": 1, "WARN": 2, "FAIL": 3}


def rule_sum(value: str, unless: str | None = None, when: str | None = None, instead: str | None = None) -> str:
    """SQL of what a row adds: nothing where `unless` is printed, else the value, or `instead` where `when` holds, or 0."""
    other = f"CASE WHEN {when} THEN {instead} END" if when and instead else "NULL"
    term = f"COALESCE({value}, {other}, 0)"
    return f"CASE WHEN {unless} IS NOT NULL THEN 0 ELSE {term} END" if unless else term


def verdicts(parts: list[DataFrame]) -> DataFrame:
    """Checks (key, id, verdict) of all kinds, one under the other."""
    return reduce(DataFrame.unionByName, parts)


def fold(verdict: Column) -> Column:
    """FAIL if any, else WARN if any, SKIP only if all, else PASS."""
    rank = F.max(reduce(lambda c, kv: c.when(verdict == kv[0], kv[1]), list(RANKS.items())[1:], F.when(verdict == "SKIP", 0)))
    return reduce(lambda c, kv: c.when(rank == kv[1], kv[0]), list(RANKS.items())[1:], F.when(rank == 0, "SKIP"))


def summary_against_detail(summary: DataFrame, detail: DataFrame, key: str, printed: str, computed: str) -> DataFrame:
    """Each summary line with the detail's sum; lines that only one side has fail."""
    both = summary.select(key, F.col(printed).alias("printed")).join(detail.select(key, F.col(computed).alias("computed")), key, "full_outer")
    state = F.when(F.col("printed").isNull() | F.col("computed").isNull(), "FAIL").otherwise(status(F.col("printed"), F.col("computed")))
    return both.withColumn("status", state)


#: Code verdicts that may fail on different contents before a person looks.
FIXES = 2


def escalation(first: Column, second: Column, checked: Column, current: Column, failed_contents: Column) -> Column:
    """What to do with a table next: struct(action, reason).

    first, second: the two checkers' verdicts, struct(verdict, kind) or null; kind is code, convention or checker. checked,
    current: hashes of the content that was checked and of what there is now. failed_contents: contents on which a verdict
    on code has failed so far.
    """
    out = lambda a, r="": F.struct(F.lit(a).alias("action"), F.lit(r).alias("reason"))
    passed = lambda v: F.coalesce(v["verdict"] == "PASS", F.lit(False))
    word = F.when(second.isNotNull(), passed(second)).otherwise(passed(first))
    kind = F.coalesce(second["kind"], first["kind"], F.lit("code"))
    return (
        F.when(first.isNull(), out("check", "no verdict yet"))
        .when(~checked.eqNullSafe(current), out("recheck", "content changed"))
        .when(second.isNotNull() & (passed(first) != passed(second)), out("human", "checkers disagree"))
        .when(second.isNotNull() & (kind == "checker"), out("human", "both unsure"))
        .when(word, out("done"))
        .when(kind == "convention", out("human", "convention"))
        .when(kind == "checker", out("second-check", "checker unsure"))
        .when(failed_contents > FIXES, out("human", "still failing"))
        .otherwise(out("fix"))
    )


def next_action(agreed: Column, proposed: Column, drafted_code: Column, extracted: Column, decided: Column) -> Column:
    """The queue's action: columns must be agreed and rows extracted before verdicts count."""
    return F.when(~agreed & drafted_code, "fix").when(~agreed & proposed, "human").when(~agreed, "columns").when(~extracted, "extract").otherwise(decided)


def failed_on(history: DataFrame, by: list[str]) -> DataFrame:
    """by, n: contents on which a verdict on code has failed. history: by, content, verdict, kind (null: code)."""
    bad = (F.col("verdict") != "PASS") & (F.coalesce("kind", F.lit("code")) == "code")
    return history.groupBy(*by).agg(F.count_distinct(F.when(bad, F.col("content"))).alias("n"))


AMOUNT = r"\d{1,3}(?:\.\d{3})*,\d{2}"
#: Share of the annex's amounts that a copy repeats.
COPY_SHARE = 0.5
GRAND = r"(?i)^\s*(?:Totale\s+Complessivo|Totali)\b"
ROW_END = r"(?i)^\s*Total[ei]\b"
ONE_ROW = 4.0


def printed(text: Column) -> Column:
    """Amounts that a text prints, in order, zeros left out."""
    return F.filter(F.regexp_extract_all(text, F.lit(AMOUNT), F.lit(0)), lambda a: a != "0,00")


def amounts(text: Column) -> Column:
    """The same, each once."""
    return F.array_distinct(printed(text))


def compare_exhibit(exhibit: Column, annex: Column, exhibit_total: Column, annex_total: Column) -> Column:
    """What an exhibit of a relation is to the annex of the same code: copy, summary or differs. Texts, and grand totals
    as arrays of printed amounts.
    """
    a, b = amounts(exhibit), amounts(annex)
    within = lambda x, y: F.size(F.array_except(x, y)) == 0
    apart = (F.size(exhibit_total) > 0) & (F.size(annex_total) > 0) & ~within(exhibit_total, annex_total) & ~within(annex_total, exhibit_total)
    inside = (F.size(a) > 0) & within(a, b)
    return F.when(apart, "differs").when(inside & (F.size(a) >= COPY_SHARE * F.size(b)), "copy").when(inside, "summary").otherwise("differs")


def compare_rows(rows: DataFrame, totals: DataFrame, by: list[str]) -> DataFrame:
    """by, code, same: whether the amounts that a summary prints for a code are those of the annex's grand total, as often.

    rows, totals: by, code, amount (printed, one row each).
    """
    side = lambda df, n: df.groupBy(*by, "code").agg(F.sort_array(F.collect_list("amount")).alias(n))
    return side(rows, "a").join(side(totals, "b"), [*by, "code"]).select(*by, "code", (F.col("a") == F.col("b")).alias("same"))


def grand_totals(lines: DataFrame, by: list[str]) -> DataFrame:
    """by, amounts: what the last row named a grand total prints, in reading order, repeats kept; empty for none.

    lines: by, page, line (its place on the page), text, x0, y0, x1, y1, dir_x, dir_y. A row is what lies level with its
    label across the direction of writing: text streams give its cells in any order, and some tables are turned.
    """
    level = F.abs("dir_x") >= F.abs("dir_y")
    at = lines.withColumn("across", F.when(level, F.col("y0")).otherwise(F.col("x0")))
    at = at.withColumn("along", F.when(level, F.when(F.col("dir_x") > 0, F.col("x0")).otherwise(-F.col("x0"))).otherwise(F.when(F.col("dir_y") < 0, -F.col("y1")).otherwise(F.col("y0"))))
    last = at.filter(F.trim("text").rlike(GRAND)).groupBy(*by).agg(F.max(F.struct("page", "line", "across")).alias("_l"))
    row = at.join(last, by).filter((F.col("page") == F.col("_l.page")) & (F.abs(F.col("across") - F.col("_l.across")) <= ONE_ROW))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("along", "text"))), lambda x: x["text"]), " ")  # a printed row
    return lines.select(*by).distinct().join(row.groupBy(*by).agg(text.alias("_t")), by, "left").select(*by, printed(F.coalesce("_t", F.lit(""))).alias("amounts"))


def summary_rows(text: Column, codes: Column) -> Column:
    """Array of struct(code, amounts) of a summary's text: a line that is one of `codes` opens a row, any total ends it."""
    none = F.lit(None).cast("string")
    start = F.struct(none.alias("open"), F.array().cast("array<struct<code:string,amounts:array<string>>>").alias("rows"))

    def step(acc: Column, line: Column) -> Column:
        code = F.when(F.array_contains(codes, F.trim(line)), F.trim(line))
        last = F.element_at(acc["rows"], -1)
        grown = F.concat(F.slice(acc["rows"], F.lit(1), F.greatest(F.size(acc["rows"]) - 1, F.lit(0))), F.array(F.struct(last["code"].alias("code"), F.concat(last["amounts"], printed(line)).alias("amounts"))))
        opened = F.concat(F.filter(acc["rows"], lambda r: r["code"] != code), F.array(F.struct(code.alias("code"), F.array().cast("array<string>").alias("amounts"))))
        ends = line.rlike(ROW_END)
        return F.when(code.isNotNull(), F.struct(code.alias("open"), opened.alias("rows"))).when(ends, F.struct(none.alias("open"), acc["rows"].alias("rows"))).when(acc["open"].isNotNull(), F.struct(acc["open"].alias("open"), grown.alias("rows"))).otherwise(acc)

    return F.aggregate(F.split(text, "\\R"), start, step)["rows"]


def exhibit_notes(tables: DataFrame) -> DataFrame:
    """key, note: a relation's exhibits against the annex tables of their codes, told on both sides.

    tables: key, authority, article ("REL" for the relation's, empty or null for the annex), code, text, total (what its
    grand total prints). The uncoded exhibit SALDI goes row by row. Codes of an annex are unique within an authority.
    """
    euro = lambda v: F.when(F.size(v) > 0, F.array_join(F.transform(v, lambda x: F.concat(F.lit("€ "), x)), " / ")).otherwise("none printed")
    annex = tables.filter(F.coalesce("article", F.lit("")) == "").select("authority", "code", F.col("key").alias("a_key"), F.col("text").alias("a_text"), F.col("total").alias("a_total"))
    rel = tables.filter("article = 'REL'")
    met = rel.filter("code <> 'SALDI'").join(annex, ["authority", "code"], "left")
    name, n = F.concat_ws("/", "authority", "code"), F.size(printed(F.col("text"))).cast("string")
    totals = F.concat(F.lit("relation total "), euro(F.when(F.size("total") > 0, F.col("total")).otherwise(printed(F.col("text")))), F.lit("; "), name, F.lit(" total "), euro(F.col("a_total")))
    kind = compare_exhibit(F.col("text"), F.col("a_text"), F.col("total"), F.col("a_total"))
    told = F.when(kind == "copy", F.concat(F.lit("copy of "), name, F.lit(": all "), n, F.lit(" amounts match"))).when(kind == "summary", F.concat(F.lit("summary of "), name, F.lit(", matches: its "), n, F.lit(" amount(s) all appear in "), name, F.lit("; "), totals)).otherwise(F.concat(F.lit("differs from "), name, F.lit(": "), totals))
    met = met.select("key", "a_key", F.when(F.col("a_key").isNull(), F.concat(F.lit("no annex table "), name)).otherwise(told).alias("note"), F.lit("relation exhibit ").alias("side"))
    listed = annex.groupBy("authority").agg(F.collect_set("code").alias("codes"))  # an annex has a few hundred tables
    rows = rel.filter("code = 'SALDI'").join(listed, "authority").select("key", "authority", F.explode(summary_rows(F.col("text"), F.col("codes"))).alias("r")).select("key", "authority", "r.*").join(annex, ["authority", "code"])
    same = F.sort_array("amounts") == F.sort_array("a_total")
    row_note = F.when(same, F.concat("code", F.lit(" matches "), name, F.lit(" total "), euro(F.col("a_total")))).otherwise(F.concat("code", F.lit(" differs: relation "), euro(F.col("amounts")), F.lit("; "), name, F.lit(" total "), euro(F.col("a_total"))))
    rows = rows.select("key", "a_key", row_note.alias("note"), F.lit("row of ").alias("side"))
    both = met.unionByName(rows)
    return both.select("key", "note").unionByName(both.filter("a_key IS NOT NULL").select(F.col("a_key").alias("key"), F.concat("side", "key", F.lit(": "), "note").alias("note")))


# ---------------------------------------------------------------- mutations that checks must see


def drop_row(df: DataFrame, which: Column) -> DataFrame:
    return df.filter(~which)


def wrong_value(df: DataFrame, which: Column, column: str, by: Column) -> DataFrame:
    return df.withColumn(column, F.when(which, F.col(column) + by).otherwise(F.col(column)))


def swap(df: DataFrame, which: Column, a: str, b: str) -> DataFrame:
    return df.select(*[F.when(which, F.col(b)).otherwise(F.col(a)).alias(a) if c == a else F.when(which, F.col(a)).otherwise(F.col(b)).alias(b) if c == b else F.col(c) for c in df.columns])


def twice(df: DataFrame, which: Column) -> DataFrame:
    return df.unionByName(df.filter(which))


def misread(text: Column) -> Column:
    """The first digit three higher; a text without digits ends in another country."""
    at = F.regexp_instr(text, F.lit("[0-9]"))
    digit = ((F.substring(text, at, F.lit(1)).try_cast("int") + 3) % 10).cast("string")
    other = F.when(text.rlike(r"(?:^|\s)GERMANIA$"), "FRANCIA").otherwise("GERMANIA")
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), digit, F.substring(text, at + 1, F.length(text)))).otherwise(F.regexp_replace(text, r"\S+$", other))


def misread_value(df: DataFrame, which: Column, raw: str, value: str, parse) -> DataFrame:  # noqa: ANN001
    """The printed text misread, and its value with it."""
    seen = F.when(which, misread(F.col(raw))).otherwise(F.col(raw))
    return df.withColumns({raw: seen, value: F.when(which, parse(misread(F.col(raw)))).otherwise(F.col(value))})


def split_row(df: DataFrame, which: Column, order: str, moved: list[str], kept: list[str]) -> DataFrame:
    """One row's cell on a row of its own below, which keeps its place and group alone."""
    below = df.filter(which).select(*[F.col(order) + F.lit(0.5) if c == order else F.col(c) if c in moved or c in kept else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns]).toDF(*df.columns)
    above = df.select(*[F.when(which, F.lit(None)).otherwise(F.col(c)).alias(c) if c in moved else F.col(c) for c in df.columns])
    return above.unionByName(below)


def merge_rows(df: DataFrame, which: Column, by: list[str], order: str, texts: list[str]) -> DataFrame:
    """A row takes the texts of the next one, which goes."""
    w = W.partitionBy(*by).orderBy(order)
    d = df.withColumns({"_w": which, "_gone": F.coalesce(F.lag(which).over(w), F.lit(False)), **{f"_n_{c}": F.lead(c).over(w) for c in texts}})
    both = lambda c: F.when(F.col("_w") & F.col(c).isNotNull() & F.col(f"_n_{c}").isNotNull(), F.concat_ws(" ", c, f"_n_{c}")).otherwise(F.col(c))
    return d.filter(~F.col("_gone")).select(*[both(c).alias(c) if c in texts else F.col(c) for c in df.columns])


def as_figure(df: DataFrame, which: Column, columns: list[str], kind: str, by: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """A data row read as a subtotal or total: (rows without it, its cells as printed figures)."""
    cells = F.filter(F.array(*[F.struct(F.lit(k).alias("ordinal"), F.col(c).cast("string").alias("value_raw")) for k, c in enumerate(columns)]), lambda x: F.coalesce(x["value_raw"], F.lit("")) != "")
    return df.filter(~which), df.filter(which).select(*by, order, F.lit(kind).alias("kind"), F.explode(cells).alias("x")).select(*by, order, "kind", "x.*")


def relabel(columns: DataFrame, which: Column, text: str) -> DataFrame:
    """Another printed label of a column."""
    return columns.withColumn("label", F.when(which, text).otherwise(F.col("label")))


def recut(spans: DataFrame, mutation: Column, amount: Column) -> DataFrame:
    """Spans (authority, article, code, start, end, printed_from, printed_to) as a wrong cut or a wrong key would have them:
    drop-last, add-next, add-prev, printed (numbers shifted by amount), code, article, authority (amount as text); none.
    """
    m, n = mutation, amount.try_cast("int")
    step = F.when(m == "drop-last", -1).when(m == "add-next", 1).otherwise(0)
    back = F.when(m == "add-prev", 1).otherwise(0)
    shift = F.when(m == "printed", n).otherwise(0)
    put = lambda c: F.when(m == c, amount).otherwise(F.col(c))
    out = spans.withColumns({"start": F.col("start") - back, "end": F.col("end") + step, "printed_from": F.col("printed_from") - back + shift, "printed_to": F.col("printed_to") + step + shift, "authority": put("authority"), "article": put("article"), "code": put("code")})
    return out.withColumns({"pages": F.col("end") - F.col("start") + 1, "key": F.concat_ws("/", "authority", F.nullif("article", F.lit("")), "code")})
