"""Independent checks of located tables. Each gives rows (key, check_id, verdict); `checks.verdicts` and `fold` end them.

A key is the full triple of body, article and code, as one string or struct; a bare code names several tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.pages import CODE, GROUP_SUFFIX, LISTED_LEAST, RELATION, TOP, found, normalise_digit_one, parse_stem
from pagelake.functions.text import lines, stems

#: Share of a title's stems that its first page must print; of readable pages under which codes aren't judged, and from which an absent own code fails.
TITLE_SHARE, READABLE_LEAST, READABLE = 0.6, 0.1, 0.9
#: Pages at either end where a missing stamp means foreign pages; pages of a volume in which its index is looked for.
EDGE, INDEX_PAGES = 3, 20


def _each(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row for every check whose verdict is not null."""
    made = F.array(*[F.struct(F.lit(k).alias("check_id"), v.cast("string").alias("verdict")) for k, v in checks.items()])
    return df.select("key", F.explode(F.filter(made, lambda c: c["verdict"].isNotNull())).alias("c")).select("key", "c.check_id", "c.verdict")


def layout(files: DataFrame, years: list[int]) -> DataFrame:
    """files: key, folder, stem, authority, article, code, year, volume, page, origin_volume, origin_page (null: unknown).

    Name, folder and shape of the code; `layout` passes where nothing else was found.
    """
    p = files.withColumn("p", parse_stem(F.col("stem")))
    shaped = F.col("code").rlike(f"^{CODE}$|^[0-9]+[A-Z]?$|^{CODE}{GROUP_SUFFIX}$|^T\\d{{1,3}}$") | (F.coalesce("article", F.lit("")) == RELATION)
    known = F.col("p").isNotNull()
    moved = known & F.col("origin_volume").isNotNull() & ~(F.struct("volume", "page").eqNullSafe(F.struct(F.col("origin_volume").alias("volume"), F.col("origin_page").alias("page"))))
    wrong = {
        "layout.folder_name": (F.coalesce("authority", F.lit("")) == "") & (F.col("folder") != F.col("code")),
        "layout.file_stem": ~known | (F.col("p.code") != F.col("code")),
        "layout.year_suffix": known & (F.col("p.year") != F.col("year")),
        "layout.known_year": ~F.col("year").isin(years) if years else F.lit(False),
        "layout.origin_suffix": moved,
        "layout.code_shape": ~shaped,
    }
    fails = {k: F.when(F.coalesce(v, F.lit(False)), "FAIL") for k, v in wrong.items()}
    return _each(p, fails | {"layout": F.when(F.coalesce(*fails.values()).isNull(), "PASS")})


def uniqueness(pages: DataFrame) -> DataFrame:
    """pages: key, page, own (code), found (code or null), blank, readable. A foreign code on two pages fails, on one it
    warns; an own code that occurs nowhere fails where nearly all can be read. Too little to read: nothing is judged.
    """
    foreign = F.col("found").isNotNull() & (F.col("found") != F.col("own"))
    counts = pages.filter(foreign).groupBy("key", "found").agg(F.count("*").alias("n"))
    counts = counts.groupBy("key").agg(F.count_if(F.col("n") >= 2).alias("repeated"), F.count_if(F.col("n") < 2).alias("mentioned"))
    g = pages.groupBy("key").agg(F.count_if(F.col("found") == F.col("own")).alias("own"), F.count_if(~F.col("blank")).alias("legible"), F.count_if(F.col("readable") & ~F.col("blank")).alias("can"))
    g = g.join(counts, "key", "left")
    judged = (F.col("legible") > 0) & (F.col("can") >= READABLE_LEAST * F.col("legible"))
    some = lambda c: F.coalesce(F.col(c) > 0, F.lit(False))
    return _each(g, {
        "uniqueness.code_run": F.when(~judged, "SKIP"),
        "uniqueness.foreign_table": F.when(judged, F.when(some("repeated"), "FAIL").otherwise("PASS")),
        "uniqueness.foreign_table_mention": F.when(judged & some("mentioned"), "WARN"),
        "uniqueness.own_code_absent": F.when(judged & (F.col("own") == 0), F.when(F.col("can") >= READABLE * F.col("legible"), "FAIL").otherwise("WARN")),
        "uniqueness.own_code_run": F.when(judged & (F.col("own") > 0), "PASS"),
    })


def stamp(pages: DataFrame) -> DataFrame:
    """pages: key, page, first, second (the stamp's numbers as printed, null without a stamp).

    The number that doesn't vary is the total. It is one, and the table's page count; the first page is page one; no page
    at either end lacks the stamp. Numbers in a font that can't be read are only compared.
    """
    w = W.partitionBy("key")
    p = pages.withColumns({"lo": F.min("page").over(w), "hi": F.max("page").over(w)})
    stamped = F.col("first").isNotNull()
    g = p.groupBy("key", "lo", "hi").agg(
        F.count("*").alias("n"), F.count_if(stamped).alias("seen"), F.countDistinct("first").alias("d1"), F.countDistinct("second").alias("d2"),
        F.min_by(F.struct("first", "second"), F.when(stamped, F.col("page"))).alias("open"),
        F.count_if(~stamped & ((F.col("page") <= F.col("lo") + EDGE - 1) | (F.col("page") >= F.col("hi") - EDGE + 1))).alias("edge"),
    )
    turned = (F.col("d1") == 1) & (F.col("d2") > 1)
    total, nth = F.when(turned, F.col("open.first")).otherwise(F.col("open.second")), F.when(turned, F.col("open.second")).otherwise(F.col("open.first"))
    any_, read = F.col("seen") > 0, total.rlike("^[0-9]+$")
    return _each(g, {
        "completeness.stamp": F.when(~any_, "SKIP"),
        "uniqueness.stamp_total_varies": F.when(any_, F.when(F.when(turned, F.col("d1")).otherwise(F.col("d2")) == 1, "PASS").otherwise("FAIL")),
        "completeness.stamp_total": F.when(any_, F.when(~read, "WARN").when(total.try_cast("int") == F.col("n"), "PASS").otherwise("FAIL")),
        "completeness.first_page_is_one": F.when(any_ & read, F.when(nth.rlike("^[0-9]+$") & (nth != "1"), "WARN").otherwise("PASS")),
        "completeness.stamp_coverage": F.when(any_, F.when(F.col("seen") == F.col("n"), "PASS").when(F.col("edge") > 0, "FAIL").otherwise("WARN")),
    })


def edges(pages: DataFrame) -> DataFrame:
    """pages: key, page, class (blank, indice, unreadable, header_only, content). What lies before the first page with
    content, after the last one, and between.
    """
    w = W.partitionBy("key")
    content, dark = F.col("class") == "content", F.col("class") == "unreadable"
    p = pages.withColumns({"a": F.min(F.when(content, F.col("page"))).over(w), "z": F.max(F.when(content, F.col("page"))).over(w)})
    other, junk = ~content & ~dark, F.col("class").isin("blank", "indice")
    side = lambda where: F.when(F.count_if(where & other & junk) > 0, "FAIL").when(F.count_if(where & other) > 0, "WARN").otherwise("PASS")
    g = p.groupBy("key").agg(
        F.count_if(content).alias("content"), F.count_if(dark).alias("dark"), side(F.col("page") < F.col("a")).alias("lead"), side(F.col("page") > F.col("z")).alias("trail"),
        F.count_if(other & (F.col("page") > F.col("a")) & (F.col("page") < F.col("z"))).alias("inner"),
    )
    some = F.col("content") > 0
    return _each(g, {
        "edges.no_content_page": F.when(~some, F.when(F.col("dark") > 0, "SKIP").otherwise("FAIL")),
        "edges.unreadable_pages": F.when(some & (F.col("dark") > 0), "WARN"),
        "edges.leading_junk": F.when(some, F.col("lead")),
        "edges.trailing_junk": F.when(some, F.col("trail")),
        "edges.interior_noncontent": F.when(some, F.when(F.col("inner") > 0, "WARN").when(F.col("dark") == 0, "PASS")),
    })


def folios(pages: DataFrame) -> DataFrame:
    """pages: key, page, numbers (array). Of the pages that print a number, each prints one more than the one before."""
    p = pages.filter(F.size("numbers") > 0)
    was = F.lag("numbers").over(W.partitionBy("key").orderBy("page"))
    p = p.withColumn("ok", F.arrays_overlap("numbers", F.transform(was, lambda x: x + 1)))
    g = pages.select("key").distinct().join(p.groupBy("key").agg(F.count("ok").alias("n"), F.count_if(~F.col("ok")).alias("bad")), "key", "left")
    return _each(g, {"completeness.folio": F.when(F.coalesce("n", F.lit(0)) == 0, "SKIP").when(F.col("bad") > 0, "WARN").otherwise("PASS")})


def titles(first_pages: DataFrame) -> DataFrame:
    """first_pages: key, code, total (pages), title (the index's, or null), text (of the first pages).

    Six letters of each word are compared. A table that prints no title is judged by its stamp, and then not passed.
    """
    want, have = stems(F.coalesce("title", F.lit("")), "a-zÀ-ÿ0-9"), stems(F.col("text"))
    share = F.size(F.array_intersect(want, have)) / F.greatest(F.lit(1), F.size(want))
    stamped = F.rlike(F.lower("text"), F.concat(F.lit(r"\bpagina\s+1\s+di\s+"), F.col("total").cast("string"), F.lit(r"\s+tab\.?\s*"), F.lower("code"), F.lit("(?![a-z0-9])")))
    return _each(first_pages, {"identity.title": F.when((F.size(want) == 0) | (F.size(have) == 0), "SKIP").when(share >= TITLE_SHARE, "PASS").when(stamped, "SKIP").otherwise("FAIL")})


def overlaps(pages: DataFrame) -> DataFrame:
    """pages: key, content (hash). A content that two tables have fails both."""
    shared = pages.groupBy("content").agg(F.countDistinct("key").alias("n")).filter("n > 1")
    g = pages.join(shared, "content", "left").groupBy("key").agg(F.count("n").alias("bad"))
    return _each(g, {"uniqueness.page_overlap": F.when(F.col("bad") > 0, "FAIL").otherwise("PASS")})


def reconcile(files: DataFrame, listed: DataFrame, bookmarks: DataFrame, by: list[str]) -> DataFrame:
    """by, key, finding: missing (listed or bookmarked, no file), unattested (the reverse), index_or_bookmark (only one of
    both lists has it), order_conflict (an index names it before a table that is bookmarked earlier).

    files: by, key. listed: by, key, ord (place in the index). bookmarks: by, key, page.
    """
    k = [*by, "key"]
    side = lambda df, n: df.select(*k).distinct().withColumn(n, F.lit(True))
    every = side(files, "f").join(side(listed, "l"), k, "full_outer").join(side(bookmarks, "b"), k, "full_outer")
    has = lambda c: F.col(c).isNotNull()
    placed = listed.join(bookmarks, k).join(side(files, "f"), k).drop("f")
    after = F.lead("ord").over(W.partitionBy(*by).orderBy("page", "key"))
    conflict = placed.withColumn("_next", after).filter(F.col("_next") < F.col("ord")).select(*k, F.lit("order_conflict").alias("finding"))
    tags = F.array_compact(F.array(F.when((has("l") | has("b")) & ~has("f"), "missing"), F.when(has("f") & ~has("l") & ~has("b"), "unattested"), F.when(has("l") != has("b"), F.when(has("l") | has("b"), "index_or_bookmark"))))
    return every.select(*k, F.explode(tags).alias("finding")).unionByName(conflict)


def against_index(tables: DataFrame, listed: DataFrame) -> DataFrame:
    """tables, listed: volume, key, page. Missing and unattested keys fail; a table behind one that is listed later warns."""
    k = ["volume", "key"]
    both = listed.select(*k, F.col("page").alias("due")).join(tables.select(*k, F.col("page").alias("at")), k, "full_outer")
    late = F.coalesce(F.lead("at").over(W.partitionBy("volume").orderBy("due", "key")) < F.col("at"), F.lit(False))
    both = both.withColumn("late", late & F.col("due").isNotNull() & F.col("at").isNotNull())
    return _each(both, {"index": F.when(F.col("at").isNull() | F.col("due").isNull(), "FAIL").when(F.col("late"), "WARN").otherwise("PASS")})


def page_verdict(owners: DataFrame, pages: DataFrame, by: list[str]) -> DataFrame:
    """by, verdict of every page: ok, or lost, no_provenance, claimed_twice. owners: by, kind (whole, trash, cut, leftover, no_provenance).

    A page lies whole in one file or in the trash, or in cut parts with one leftover at most.
    """
    n = lambda *ks: F.count_if(F.col("kind").isin(*ks))
    g = owners.groupBy(*by).agg(n("whole", "trash").alias("whole"), n("cut").alias("cut"), n("leftover").alias("rest"), n("no_provenance").alias("bad"))
    ok = ((F.col("whole") == 1) & (F.col("cut") == 0) & (F.col("rest") == 0)) | ((F.col("whole") == 0) & (F.col("cut") >= 1) & (F.col("rest") <= 1))
    return pages.select(*by).join(g, by, "left").select(*by, F.when(F.col("whole").isNull(), "lost").when(F.col("bad") > 0, "no_provenance").when(ok, "ok").otherwise("claimed_twice").alias("verdict"))


# ---------------------------------------------------------------- indexes printed in the volumes

# How the general index and the lists of tables print a row.
INDEX_ROW = r"^([A-Za-zÀ-ÿ][^.]*?)\s*\.{2,}\s*(?:Pag\.?\s*)?(»)?\s*(\d{1,4})\s*$"
VOLUME_ROW = r"(?i)^Volume\s+(I{1,3}V?|IV)$"
LIST_ROW = rf"^(?:Tabella|Tab\.?)\s+({CODE})(?![A-Za-z0-9])\s*(.*)$"
COUNT_ROW = rf"^\s*\d+\s+(\d+)\s+TAB\.?\s+({CODE})\s+(.+?)\s+(\d+)\s*$"


def index_entry_kind(name: Column) -> Column:
    low = F.lower(F.trim(name))
    return F.when(low.rlike("^tabelle"), "tables").when(low.rlike("^(?:relazione|considerazioni|attivit|annessi)"), "relation").when(low.rlike(r"^\d+(?:\.\d+)*\b"), "section").when(((F.upper(name) == name) & (F.lower(name) != name)) | low.rlike("^(?:ministero|presidenza|agenzia)"), "authority").otherwise("other")


def general_index(pages: DataFrame, by: list[str]) -> DataFrame:
    """by, ord, name, page, ditto, volume, kind: rows of the index page with most of them, among the first pages of each volume."""
    p = pages.filter(F.col("page") <= INDEX_PAGES).withColumn("_l", lines(F.col("text"))).filter(F.exists("_l", lambda x: x.rlike(r"\bINDICE\b")))
    rows = p.select(*by, F.col("page").alias("_p"), F.posexplode("_l").alias("ord", "line"))
    volume = F.last(F.upper(found(F.col("line"), VOLUME_ROW)), True).over(W.partitionBy(*by, "_p").orderBy("ord").rowsBetween(W.unboundedPreceding, 0))
    name = F.trim(F.regexp_replace(F.regexp_extract("line", INDEX_ROW, 1), r"\s+", " "))
    rows = rows.withColumns({"volume": volume, "name": name}).filter(F.col("line").rlike(INDEX_ROW) & ~F.col("line").rlike(VOLUME_ROW) & (F.length("name") >= 3))
    rows = rows.withColumn("_n", F.count("*").over(W.partitionBy(*by, "_p")))
    rows = rows.withColumn("_best", F.max(F.struct("_n", (-F.col("_p")).alias("p"))).over(W.partitionBy(*by))).filter(F.col("_best.p") == -F.col("_p"))
    return rows.select(*by, "ord", "name", F.regexp_extract("line", INDEX_ROW, 3).cast("int").alias("page"), (F.regexp_extract("line", INDEX_ROW, 2) != "").alias("ditto"), "volume", index_entry_kind(F.col("name")).alias("kind"))


def listed_titles(pages: DataFrame, by: list[str]) -> DataFrame:
    """by, code, title, page: the first row of every code on pages that list tables; a title may be the next line."""
    p = pages.withColumn("_l", lines(F.col("text"))).filter(F.upper(F.array_join(F.slice("_l", F.lit(1), F.lit(TOP)), " ")).rlike("ELENCO TABELLE|ELENCO GRAFICI|ELENCO DELLE TABELLE"))
    rows = p.select(*by, "page", F.posexplode("_l").alias("_o", "line")).withColumn("_next", F.lead("line").over(W.partitionBy(*by, "page").orderBy("_o")))
    rows = rows.filter(F.col("line").rlike(LIST_ROW))
    rest = F.coalesce(found(F.col("line"), LIST_ROW, 2), F.when(~F.col("_next").rlike(LIST_ROW), F.col("_next")), F.lit(""))
    rows = rows.select(*by, "page", "_o", F.upper(F.regexp_extract("line", LIST_ROW, 1)).alias("code"), F.trim(F.regexp_replace(rest, r"\s+", " ")).alias("title"))
    return rows.groupBy(*by, "code").agg(F.min_by("title", F.struct("page", "_o")).alias("title"), F.min("page").alias("page"))


def counted_rows(pages: DataFrame, by: list[str]) -> DataFrame:
    """by, code, pages, at_page, title, printed_on: rows of a list that counts pages; the last one of a code stands."""
    rows = pages.select(*by, F.col("page").alias("printed_on"), F.posexplode(F.split("text", "\n")).alias("_o", "line")).filter(F.col("line").rlike(COUNT_ROW))
    part = lambda k: F.regexp_extract("line", COUNT_ROW, k)
    rows = rows.select(*by, "printed_on", "_o", normalise_digit_one(F.upper(part(2))).alias("code"), F.struct(part(1).cast("int").alias("pages"), part(4).cast("int").alias("at_page"), F.trim(part(3)).alias("title"), "printed_on").alias("r"))
    return rows.groupBy(*by, "code").agg(F.max_by("r", F.struct("printed_on", "_o")).alias("r")).select(*by, "code", "r.*")


def read_index(pages: DataFrame, by: list[str], least: int = LISTED_LEAST + 2) -> DataFrame:
    """by, page, codes, counts: the first page that names enough codes; counts (code to pages) where it prints them."""
    ls = F.split("text", "\n")
    counted = F.filter(F.transform(ls, lambda x: F.struct(F.regexp_extract(x, COUNT_ROW, 2).alias("code"), F.regexp_extract(x, COUNT_ROW, 1).try_cast("int").alias("n"))), lambda x: x["code"] != "")
    titled = F.filter(F.transform(ls, lambda x: normalise_digit_one(F.regexp_extract(F.trim(x), rf"^(?i:Tabella)\.?\s+({CODE})$", 1))), lambda c: c != "")
    p = pages.select(*by, "page", counted.alias("_c"), titled.alias("_t")).withColumn("codes", F.array_distinct(F.concat(F.transform("_c", lambda c: c["code"]), "_t")))
    p = p.filter(F.size("codes") >= least)
    return p.groupBy(*by).agg(F.min("page").alias("page"), F.min_by(F.struct(F.sort_array("codes").alias("codes"), F.col("_c").alias("counts")), "page").alias("i")).select(*by, "page", "i.codes", "i.counts")


# ---------------------------------------------------------------- findings


def locate(spans: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (authority, article, code) with where it lies: the first span by place among tables, then continuations.

    spans: authority, article, code, report, start, end, pages, source, place. A missing article equals an empty one.
    """
    art = lambda df: df.withColumn("article", F.coalesce("article", F.lit("")))
    k = ["authority", "article", "code"]
    order = F.struct((F.col("source") == "continued").alias("later"), "place")
    first = art(spans).groupBy(*k).agg(F.min_by(F.struct("report", "start", "end", "pages", "source"), order).alias("at"))
    return art(wanted).join(first, k, "left").select(*k, "at.*")


def findings(checks: DataFrame, files: DataFrame, where: DataFrame) -> DataFrame:
    """key, pages, expected_pages, source, failed: one row for every file with a check that failed.

    checks: key, check_id, verdict. files: key, pages. where: key, report, start, end, pages.
    """
    bad = checks.filter("verdict = 'FAIL'").groupBy("key").agg(F.sort_array(F.collect_set("check_id")).alias("failed"))  # a dozen checks a file
    at = where.select("key", F.col("pages").alias("expected_pages"), F.concat(F.col("report"), F.lit(" p"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string")).alias("source"))
    return bad.join(files, "key").join(at, "key", "left").select("key", "pages", "expected_pages", F.coalesce("source", F.lit("unknown")).alias("source"), F.array_join("failed", ",").alias("failed"))


def explain_gap(rows: DataFrame, gaps: DataFrame, by: list[str]) -> DataFrame:
    """Lines whose value alone is the gap of their table: rows (by, row_ord, value) joined to gaps (by, gap)."""
    return rows.join(gaps, by).filter(F.abs(F.col("value") - F.col("gap")) < F.lit("0.005").cast("decimal(4,3)"))


def failing_pages(checks: DataFrame, figures: DataFrame, hints: DataFrame) -> DataFrame:
    """table_key, pdf_page: where a person should look. A failed subtotal: its page and those of lines worth the gap;
    another failed check: every page with a total or summary figure.

    checks: table_key, kind (subtotal or other), pdf_page, status. figures: table_key, kind, pdf_page. hints: table_key, pdf_page.
    """
    bad = checks.filter("status = 'FAIL'")
    sub = bad.filter("kind = 'subtotal'")
    worth = hints.join(sub.select("table_key").distinct(), "table_key", "left_semi")
    other = figures.filter("kind <> 'subtotal'").join(bad.filter("kind <> 'subtotal'").select("table_key").distinct(), "table_key", "left_semi")
    return sub.select("table_key", "pdf_page").unionByName(worth.select("table_key", "pdf_page")).unionByName(other.select("table_key", "pdf_page")).distinct()


def review_pages(pages: DataFrame) -> DataFrame:
    """table_key, pdf_page: first, middle and last page of every table."""
    w = W.partitionBy("table_key")
    p = pages.withColumns({"_k": F.row_number().over(w.orderBy("pdf_page")) - 1, "_n": F.count("*").over(w)})
    return p.filter((F.col("_k") == 0) | (F.col("_k") == F.floor(F.col("_n") / 2)) | (F.col("_k") == F.col("_n") - 1)).select("table_key", "pdf_page")
