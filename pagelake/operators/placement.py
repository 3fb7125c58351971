"""Where tables lie: the volume's printed index, whose page it is, and spans from detections in fixed steps.

Every step adds columns or rows and keeps those of the steps before. Detections are (volume, page, code, evidence);
evidence has names, never numbers. A key is body, article and code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.pages import is_table_cover, names_table, rel_article, same_table
from pagelake.functions.text import cited_article, squeezed
from pagelake.operators.ordered import end_before_next, fill_where_agreed, runs
from pagelake.operators.sets import first_in_group
from pagelake.sources.tables import spread

# ---------------------------------------------------------------- the printed index

# How the index names bodies and prints page numbers.
BODIES = [(r"(?i)AFFARI\s+ESTERI", "MAE"), ("(?i)ECONOMIA", "MEF"), ("(?i)DIFESA", "DIFESA"), ("(?i)INTERNO", "INTERNO"), ("(?i)DOGANE", "DOG")]
BODY_HEAD = r"(?i)^\s*(?:PRESIDENZA\s+DEL\s+CONSIGLIO|MINISTERO\s+DE\w*|AGENZIA\s+DELLE\s+DOGANE)"
CUSTOMS_HEAD = r"(?i)^\s*Relazione\s+sull.attivit.\s+dell.Agenzia\s+delle\s+dogane"
TABLES_HEAD = r"(?i)^\s*Tabelle\b"
NUMBER = r"(?:»|Pag\.?)\s*(\d{1,4})\s*$"
INDEX_HEAD = "(?i)I[.]{0,4}N[.]{0,4}D[.]{0,4}I[.]{0,4}C[.]{0,4}E"
FOLIO = r"[–—-]\s*(\d{1,4})\s*[–—-]"
OWNERS = ["MAE", "MEF", "DOG", "DIFESA"]

#: Pages in which the index is looked for; blocks and share of legible folios below which it isn't used.
INDEX_WITHIN, LEAST_BLOCKS, LEAST_FOLIOS = 40, 3, 0.5
#: Pages between two runs of a key from which they are two prints; pages that a weak kind must hold on.
GAP, LEAST_RUN = 40, 2
#: Pages in a block by which lists are joined to runs; GAP at least.
BLOCK = 64
#: Trailing pages that a stamp may take away, and pages kept beyond the last match when a table goes on in the next volume.
TRAILING, TAIL = 25, 2

ENTRY = "array<struct<name:string,kind:string,folio:int>>"


def body_of(text: Column) -> Column:
    return reduce(lambda c, b: c.when(text.rlike(b[0]), b[1]), BODIES[1:], F.when(text.rlike(BODIES[0][0]), BODIES[0][1]))


def number_of(text: Column) -> Column:
    return F.regexp_extract(text, NUMBER, 1).try_cast("int")


def index_entries(text: Column) -> Column:
    """Array of (name, kind, folio) of an index page, in its order; kind is BLOCK or TABELLE.

    A body's name may run over lines, and its number stand at the end of a later one. The next name depends on what is
    still open, so this is a fold over a page's lines.
    """
    none = F.lit(None).cast("string")
    start = F.struct(F.array().cast(ENTRY).alias("found"), none.alias("open"), none.alias("text"), none.alias("last"))

    def step(s: Column, line: Column) -> Column:
        customs = line.rlike(CUSTOMS_HEAD)
        head, tables = customs | line.rlike(BODY_HEAD), line.rlike(TABLES_HEAD)
        name = F.when(customs, "DOG").otherwise(body_of(line))
        n, whole = number_of(line), F.concat(s["text"], F.lit(" "), line)
        late = number_of(whole)
        add = lambda who, kind, k: F.concat(s["found"], F.array(F.struct(who.alias("name"), F.lit(kind).alias("kind"), k.alias("folio"))))
        state = lambda f, o, t, last: F.struct(f.alias("found"), o.alias("open"), t.alias("text"), last.alias("last"))
        return (
            F.when(line == "", s)
            .when(tables, state(F.when((n > 0) & s["last"].isNotNull(), add(s["last"], "TABELLE", n)).otherwise(s["found"]), s["open"], s["text"], s["last"]))
            .when(head & name.isNull(), state(s["found"], none, none, s["last"]))
            .when(head & n.isNotNull(), state(add(name, "BLOCK", n), none, none, name))
            .when(head, state(s["found"], name, line, name))
            .when(s["open"].isNotNull() & late.isNotNull(), state(add(s["open"], "BLOCK", late), none, none, s["last"]))
            .when(s["open"].isNotNull(), state(s["found"], s["open"], whole, s["last"]))
            .otherwise(s)
        )

    return F.aggregate(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), start, step, lambda s: s["found"])


def find_index(pages: DataFrame) -> DataFrame:
    """volume, page, ord, name, kind, folio: entries of the first readable index page of each volume. pages: volume, page, text."""
    p = pages.filter((F.col("page") <= INDEX_WITHIN) & squeezed(F.col("text")).rlike(INDEX_HEAD)).select("volume", "page", index_entries(F.col("text")).alias("e")).filter(F.size("e") > 0)
    first = p.groupBy("volume").agg(F.min("page").alias("page"), F.min_by("e", "page").alias("e"))
    return first.select("volume", "page", F.posexplode("e").alias("ord", "x")).select("volume", "page", "ord", "x.*")


def merge_blocks(entries: DataFrame) -> DataFrame:
    """volume, name, ord, folio, tables: one block a body, from its first folio on; its tables' smallest folio after that."""
    blocks = entries.filter("kind = 'BLOCK'").groupBy("volume", "name").agg(F.min("ord").alias("ord"), F.min_by("folio", "ord").alias("folio"))
    lists = entries.filter("kind = 'TABELLE'").select("volume", "name", F.col("ord").alias("_o"), F.col("folio").alias("_t"))
    both = blocks.join(lists, ["volume", "name"], "left")
    return both.groupBy("volume", "name", "ord", "folio").agg(F.min(F.when(F.col("_o") > F.col("ord"), F.col("_t"))).alias("tables"))


def folio_map(pages: DataFrame) -> DataFrame:
    """volume, pages, offset, coverage: the commonest folio minus page (the smaller of equals), and the share of pages with a folio."""
    first = F.try_element_at(F.regexp_extract_all("text", F.lit(FOLIO), F.lit(1)), F.lit(1)).cast("int")
    p = pages.select("volume", "page", (first - F.col("page")).alias("offset"))
    n = p.filter("offset IS NOT NULL").groupBy("volume", "offset").agg(F.count("*").alias("n"))
    top = first_in_group(n, ["volume"], [F.desc("n"), "offset"]).select("volume", "offset")
    all_ = p.groupBy("volume").agg(F.count("*").alias("pages"), (F.count("offset") / F.count("*")).alias("coverage"))
    return all_.join(top, "volume", "left").select("volume", "pages", "offset", "coverage")


def validate(blocks: DataFrame, folios: DataFrame) -> DataFrame:
    """volume, reason: ok, or the first thing that speaks against using the index."""
    w = W.partitionBy("volume").orderBy("ord")
    b = blocks.withColumn("_up", F.coalesce(F.col("folio") > F.lag("folio").over(w), F.lit(True)))
    f = folios.join(b, "volume", "left")
    inside = F.col("folio").between(1 + F.col("offset"), F.col("pages") + F.col("offset"))
    g = f.groupBy("volume", "pages", "offset", "coverage").agg(F.count("name").alias("n"), F.coalesce(F.bool_and("_up"), F.lit(True)).alias("up"), F.count_if(inside).alias("inside"))
    reason = F.when(F.col("n") == 0, "no index").when(F.col("n") < LEAST_BLOCKS, "too few blocks").when(~F.col("up"), "folios not increasing").when(F.col("offset").isNull(), "no folios").when(F.col("coverage") < LEAST_FOLIOS, "folios hardly legible").when(F.col("inside") == 0, "no block in this volume").otherwise("ok")
    return g.select("volume", reason.alias("reason"))


def block_edges(blocks: DataFrame, folios: DataFrame) -> DataFrame:
    """volume, page, name: the first page of every block that begins in this volume."""
    at = F.col("folio") - F.col("offset")
    return blocks.join(folios, "volume").filter(at.between(1, F.col("pages"))).select("volume", at.alias("page"), "name")


def owner_by_index(pages: DataFrame, blocks: DataFrame, folios: DataFrame) -> DataFrame:
    """volume, page, authority: the last body that prints tables whose block begins at or before the page's folio."""
    p = pages.select("volume", "page").join(folios.select("volume", "offset"), "volume").withColumn("at", F.col("page") + F.col("offset"))
    b = blocks.filter(F.col("name").isin(OWNERS)).select("volume", F.col("folio").alias("at"), "name", F.lit(0).alias("_s"))
    both = p.select("volume", "at", "page", F.lit(1).alias("_s")).unionByName(b, allowMissingColumns=True)
    w = W.partitionBy("volume").orderBy("at", "_s", "name").rowsBetween(W.unboundedPreceding, 0)
    return both.withColumn("authority", F.last("name", True).over(w)).filter("_s = 1").select("volume", "page", "authority")


def owner_by_text(pages: DataFrame) -> DataFrame:
    """pages: volume, page, authority (what the page's own marks say, or null). Gaps take their neighbours' where these agree."""
    return pages.select("volume", "page", fill_where_agreed(F.col("authority"), ["volume"], ["page"]).alias("authority"))


def resolve_placement(seen: DataFrame, by: list[str]) -> DataFrame:
    """by, authority, article of a table from its pages (authority, article): the commonest, ties by name; UNKNOWN without
    any; articles count for customs and defence alone.
    """
    top = lambda c: first_in_group(seen.filter(F.col(c).isNotNull()).groupBy(*by, c).agg(F.count("*").alias("n")), by, [F.desc("n"), c]).select(*by, c)
    out = seen.select(*by).distinct().join(top("authority"), by, "left").join(top("article"), by, "left")
    who = F.coalesce("authority", F.lit("UNKNOWN"))
    return out.select(*by, who.alias("authority"), F.when(who.isin("DOG", "DIFESA"), F.col("article")).alias("article"))


# ---------------------------------------------------------------- spans


def clusters(detections: DataFrame, key: list[str], listings: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """volume, key, cluster, first, last, pages, kept: runs of pages of each key, cut where more than GAP pages or a page
    that lists tables lie between; kept is the one after the last list that promises the code, else with its bookmark,
    else the longest, else the first.

    listings: volume, page, codes (array). bookmarks: volume, code, page.
    """
    by = ["volume", *key]
    r = runs(detections, by, "page").withColumn("_was", F.lag("last").over(W.partitionBy(*by).orderBy("first")))
    # a run no more than GAP behind the one before meets only lists of its own block of pages and of the block before
    block = lambda p: F.floor(p / BLOCK)
    lists = listings.select("volume", "page", F.explode(F.array(block(F.col("page")), block(F.col("page")) + 1)).alias("_block"))
    lists = lists.groupBy("volume", "_block").agg(F.collect_set("page").alias("_at"))
    near = (F.col("first") - F.col("_was") > 1) & (F.col("first") - F.col("_was") <= GAP)
    at = r.withColumn("_block", F.when(near, block(F.col("first")))).join(lists, ["volume", "_block"], "left")
    between = F.exists(F.coalesce("_at", F.array()), lambda p: (p > F.col("_was")) & (p < F.col("first")))
    cut = F.when((F.col("first") - F.col("_was") > GAP) | F.coalesce(between, F.lit(False)), 1).otherwise(0)
    c = at.withColumn("_cut", cut).drop("_at", "_was", "_block").withColumn("cluster", F.sum("_cut").over(W.partitionBy(*by).orderBy("first")))
    c = c.join(bookmarks.select("volume", "code", F.col("page").alias("_mark")), ["volume", "code"], "left")
    last = listings.select("volume", "page", F.explode("codes").alias("_k")).groupBy("volume", "_k").agg(F.max("page").alias("_l"))
    codes = detections.select("volume", "code").distinct().join(last, "volume").filter(same_table(F.col("code"), F.col("_k"))).groupBy("volume", "code").agg(F.max("_l").alias("_p"))
    g = c.groupBy(*by, "cluster").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("pages"), F.max(F.col("_mark").between(F.col("first"), F.col("last"))).alias("_m"))
    g = g.join(codes, ["volume", "code"], "left").select(*by, "cluster", "first", "last", "pages", "_p", "_m")
    order = [F.desc(F.coalesce(F.col("last") > F.col("_p"), F.lit(False))), F.desc(F.coalesce("_m", F.lit(False))), F.desc("pages"), "first"]
    return g.withColumn("kept", F.row_number().over(W.partitionBy(*by).orderBy(*order)) == 1).drop("_p", "_m")


def starts(detections: DataFrame, key: list[str], titled: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """volume, key, start, source, floor: where each key begins. Headers first, unless they are inline mentions on too few
    pages (customs pages are exempt); a title where no header is; a bookmark overrides both.

    detections: of kept clusters. titled, bookmarks: volume, key, page. floor: the last page that it was seen on.
    """
    by = ["volume", *key]
    g = detections.groupBy(*by).agg(F.min("page").alias("start"), F.max("page").alias("floor"), F.count_distinct("page").alias("n"), F.min_by("evidence", "page").alias("evidence"))
    customs = F.col("authority") == "DOG" if "authority" in key else F.lit(False)
    held = g.filter((F.col("evidence") != "inline") | (F.col("n") >= LEAST_RUN) | customs)
    t = titled.select(*by, F.col("page").alias("_t")).groupBy(*by).agg(F.min("_t").alias("_t"))
    b = bookmarks.select(*by, F.col("page").alias("_b")).groupBy(*by).agg(F.min("_b").alias("_b"))
    full = _outer(_outer(held.select(*by, "start", "floor"), t, by), b, by)
    start = F.coalesce("_b", "start", "_t")
    return full.select(*by, start.alias("start"), F.when(F.col("_b").isNotNull(), "embedded").when(F.col("start").isNotNull(), "header").otherwise("title").alias("source"), F.coalesce("floor", start).alias("floor"))


def _outer(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """Full outer join on keys that may be null."""
    x, y = a.alias("x"), b.select(*[F.col(c).alias(f"_k_{c}") for c in by], *[c for c in b.columns if c not in by])
    cond = reduce(lambda p, q: p & q, [F.col(f"x.{c}").eqNullSafe(F.col(f"_k_{c}")) for c in by])
    out = x.join(y, cond, "full_outer")
    keys = [F.coalesce(F.col(f"x.{c}"), F.col(f"_k_{c}")).alias(c) for c in by]
    return out.select(*keys, *[F.col(f"x.{c}") for c in a.columns if c not in by], *[c for c in b.columns if c not in by])


def ends(first: DataFrame, volumes: DataFrame, edges: DataFrame, sections: DataFrame, listings: DataFrame) -> DataFrame:
    """Adds end0 (before the next start, or the volume's last page), end1 (before a page of another block of the index),
    end2 (before a page that opens another body's section), end3 (before a page that lists tables), and clamps: which of
    these took pages away. No wall counts at or before the last page that the table was seen on.

    first: volume, start, floor. volumes: volume, pages. edges: volume, page, name. sections, listings: volume, page.
    """
    s = first.join(volumes.select("volume", "pages"), "volume")
    order = ["start", "code", *[F.desc(c) for c in ("authority", "article") if c in first.columns]]  # no ties but for equal keys
    s = s.withColumn("end0", end_before_next(F.col("start"), ["volume"], order, F.col("pages")))
    lists = lambda df, x, n: df.groupBy("volume").agg(F.array_sort(F.collect_set(x)).alias(n))  # noqa: E731  a few dozen a volume
    for df, x, n in ((edges, F.struct("page", "name"), "_edges"), (sections, F.col("page"), "_sections"), (listings, F.col("page"), "_lists")):
        s = s.join(lists(df, x, n), "volume", "left")
    low = F.greatest("floor", "start")
    after = lambda arr, end, since: F.array_min(F.filter(arr, lambda p: (p > since) & (p <= end)))
    mine = F.try_element_at(F.filter("_edges", lambda e: e["page"] <= F.col("start")), F.lit(-1))["name"]
    s = s.withColumn("_mine", F.when(F.exists(F.coalesce("_edges", F.array()), lambda e: e["page"] <= F.col("start")), mine))
    other = F.transform(F.filter("_edges", lambda e: e["name"] != F.col("_mine")), lambda e: e["page"])
    # the block at the first page after the floor counts too, where the table was seen across an edge
    at_floor = F.try_element_at(F.filter("_edges", lambda e: e["page"] <= F.col("floor") + 1), F.lit(-1))["name"]
    crossed = F.when(F.col("_mine").isNotNull() & (at_floor != F.col("_mine")) & (F.col("floor") + 1 <= F.col("end0")), F.col("floor") + 1)
    wall1 = F.when(F.col("_mine").isNotNull(), F.coalesce(crossed, after(other, F.col("end0"), F.col("floor"))))
    s = s.withColumn("end1", F.coalesce(wall1 - 1, F.col("end0")))
    s = s.withColumn("end2", F.coalesce(after(F.col("_sections"), F.col("end1"), low) - 1, F.col("end1")))
    listed = F.array_min(F.filter("_lists", lambda p: (p >= F.col("start")) & (p <= F.col("end2"))))
    s = s.withColumn("end3", F.when(listed > F.col("floor"), listed - 1).otherwise(F.col("end2")))
    took = F.array_compact(F.array(*[F.when(F.col(b) < F.col(a), n) for a, b, n in (("end0", "end1", "index"), ("end1", "end2", "section"), ("end2", "end3", "listing"))]))
    return s.withColumn("clamps", F.array_join(took, ",")).drop("_edges", "_sections", "_lists", "_mine", "pages")


def trim_stamps(spans: DataFrame, stamps: DataFrame, by: list[str]) -> DataFrame:
    """spans (volume, by, start, end) with end4 and note: trailing pages go whose stamp has another total, or none.

    The number of a stamp that doesn't vary over the span is the total; one stamped page proves nothing; the first page
    must be page one; no more than TRAILING pages go, and none whose document goes on behind the span.
    stamps: volume, page, first, second (text).
    """
    k = ["volume", *by]
    on = spans.select(*k, "start", "end").join(stamps, "volume").filter(F.col("page") >= F.col("start"))  # one volume's stamps by its tables
    inside = F.col("page") <= F.col("end")
    g = on.groupBy(*k, "start", "end").agg(
        F.count_if(inside).alias("n"), F.count_distinct(F.when(inside, F.col("first"))).alias("d1"), F.count_distinct(F.when(inside, F.col("second"))).alias("d2"),
        F.max(F.when(F.col("page") == F.col("start"), F.struct("first", "second"))).alias("open"), F.collect_list(F.struct("page", "first", "second")).alias("s"),
    )
    turned = (F.col("d1") == 1) & (F.col("d2") > 1)
    slot = lambda x: F.when(F.col("turned"), x["first"]).otherwise(x["second"])
    g = g.withColumn("turned", turned).withColumns({"total": slot(F.col("open")), "nth": F.when(F.col("turned"), F.col("open.second")).otherwise(F.col("open.first"))})
    keep = F.array_max(F.transform(F.filter("s", lambda x: (x["page"] <= F.col("end")) & (slot(x) == F.col("total"))), lambda x: x["page"]))
    g = g.withColumn("keep", F.greatest(F.coalesce(keep, F.col("start")), F.col("start")))
    beyond = F.transform(F.filter("s", lambda x: x["page"] > F.col("end")), slot)
    opens = F.exists("s", lambda x: (x["page"] > F.col("keep")) & (x["page"] <= F.col("end")) & F.array_contains(beyond, slot(x)))
    note = F.when(F.col("open").isNull(), "").when(F.col("n") < 2, "one page only").when(F.col("nth").rlike("^[0-9]+$") & (F.col("nth") != "1"), "not page one").when(F.col("keep") == F.col("end"), "").when(F.col("end") - F.col("keep") > TRAILING, "too many").when(opens, "another table begins")
    g = g.withColumn("note", F.coalesce(note, F.lit("trimmed"))).select(*k, "note", "keep")
    null_safe = reduce(lambda p, q: p & q, [F.col(f"s.{c}").eqNullSafe(F.col(f"g.{c}")) for c in k])
    out = spans.alias("s").join(g.alias("g"), null_safe, "left")
    note = F.coalesce("g.note", F.lit(""))
    return out.select("s.*", F.when(note == "trimmed", F.col("keep")).otherwise(F.col("s.end")).alias("end4"), note.alias("note"))


def trim_foreign(spans: DataFrame, codes: DataFrame, by: list[str]) -> DataFrame:
    """spans with end5: trailing pages go whose stamp names another report; a page without a stamp stops this.

    codes: volume, page, named. spans: volume, by, code, start, end4.
    """
    k = ["volume", *by]
    on = spans.join(codes.select("volume", "page", "named"), "volume").filter((F.col("page") > F.col("start")) & (F.col("page") <= F.col("end4")) & F.col("named").isNotNull() & (F.col("named") != F.col("code")))
    back = on.select(*k, "end4", "page").withColumn("_r", F.col("page") + F.row_number().over(W.partitionBy(*k).orderBy(F.desc("page"))))
    gone = back.filter(F.col("_r") == F.col("end4") + 1).groupBy(*k).agg(F.min("page").alias("_from"))
    cond = reduce(lambda p, q: p & q, [F.col(f"s.{c}").eqNullSafe(F.col(f"g.{c}")) for c in k])
    return spans.alias("s").join(gone.alias("g"), cond, "left").select("s.*", F.coalesce(F.col("_from") - 1, F.col("s.end4")).alias("end5"))


def trim_blanks(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """spans with end6: blank leaves that close the volume's last table go. spans: volume, start, end5; pages: volume, page, blank."""
    last = F.col("start") == F.max("start").over(W.partitionBy("volume"))
    s = spans.withColumn("_last", last)
    full = s.filter("_last").select("volume", "start", "end5").join(pages.filter("NOT blank").select("volume", "page"), "volume").filter(F.col("page").between(F.col("start"), F.col("end5"))).groupBy("volume").agg(F.max("page").alias("_full"))
    return s.join(full, "volume", "left").withColumn("end6", F.when(F.col("_last"), F.greatest(F.col("start"), F.coalesce("_full", F.col("start")))).otherwise(F.col("end5"))).drop("_last", "_full")


def rekey(spans: DataFrame) -> DataFrame:
    """One span a key (volume, authority, article, code), the first by start; `collides` marks those that give way."""
    w = W.partitionBy("volume", "authority", F.coalesce("article", F.lit("")), "code").orderBy("start")
    return spans.withColumn("collides", F.row_number().over(w) > 1)


def filed_articles(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """Defence annexes under the first article that a page of theirs cites; others as they are. pages: volume, page, text."""
    cites = pages.select("volume", "page", cited_article(F.col("text")).alias("cited")).filter("cited IS NOT NULL")
    d = spans.filter("authority = 'DIFESA'").select("volume", "code", "start", "end").join(cites, "volume").filter(F.col("page").between(F.col("start"), F.col("end")))
    first = d.groupBy("volume", "code", "start").agg(F.min_by("cited", "page").alias("cited"))
    out = spans.join(first, ["volume", "code", "start"], "left")
    return out.withColumn("article", F.when(F.col("authority") == "DIFESA", F.col("cited")).otherwise(F.col("article"))).drop("cited").select(*spans.columns)


def overlapping(declared: DataFrame, spans: DataFrame) -> DataFrame:
    """Declared ranges (volume, code, start, end) that meet a table's pages: a reason to refuse. Joined by page."""
    each = lambda df, n: df.select("volume", F.col("code").alias(n), F.explode(F.sequence("start", "end")).alias("page"))
    return each(declared, "declared").join(each(spans, "code"), ["volume", "page"]).groupBy("volume", "declared", "code").agg(F.min("page").alias("first"), F.count("*").alias("n"))


def drop_covers(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """spans (volume, code, start, end) with cover (or null) and start after it, where the first page is the table's cover
    and the second names the table. pages: volume, page, text.
    """
    t = lambda n: pages.select("volume", F.col("page").alias(f"_p{n}"), F.col("text").alias(f"_t{n}"))
    s = spans.join(t(0).withColumnRenamed("_p0", "start"), ["volume", "start"], "left").withColumn("_p1", F.col("start") + 1).join(t(1), ["volume", "_p1"], "left")
    is_cover = (F.col("end") > F.col("start")) & is_table_cover(F.col("_t0"), F.col("code")) & names_table(F.col("_t1"), F.col("code"))
    s = s.withColumn("cover", F.when(F.coalesce(is_cover, F.lit(False)), F.col("start")))
    return s.withColumn("start", F.coalesce(F.col("cover") + 1, F.col("start"))).select(*spans.columns, "cover")


def continued(spans: DataFrame, pages: DataFrame) -> DataFrame:
    """volume, code, from_volume, start, end: a volume's last table that goes on at the head of the next one.

    It reaches the last numbered page; the next volume's numbers go on from there before its first table; the pages at
    its end and those there have the same running header. TAIL pages beyond the last such page belong to it still.
    spans: volume (1, 2, ...), code, start, end. pages: volume, page, numbers (array), header. Both are dealt by volume, and
    joined by sorting: what the planner takes for their size says nothing about rows that were exploded.
    """
    spans, pages = spread(spans, "volume"), spread(pages, "volume")
    join = lambda a, b: a.join(b.hint("merge"), "volume")
    w = W.partitionBy("volume")
    numbered = pages.filter(F.size("numbers") > 0)
    last = numbered.groupBy("volume").agg(F.max("page").alias("last"), F.max_by("numbers", "page").alias("at_end"))
    tail = spans.withColumn("_r", F.row_number().over(w.orderBy(F.desc("start"), "code"))).filter("_r = 1")
    tail = join(tail, last).filter(F.col("end") >= F.col("last"))
    heads = join(tail.select("volume", "start", "end"), pages).filter((F.col("page") >= F.greatest("start", F.col("end") - 7)) & (F.col("page") <= F.col("end")) & (F.col("header") != ""))
    usual = first_in_group(heads.groupBy("volume", "header").agg(F.count("*").alias("n"), F.min("page").alias("f")), ["volume"], [F.desc("n"), "f"]).select("volume", F.col("header").alias("expected"))
    tail = join(tail, usual).select((F.col("volume") + 1).alias("volume"), F.col("volume").alias("from_volume"), "code", "at_end", "expected")
    nxt = spans.groupBy("volume").agg(F.min("start").alias("_next"))
    p = join(join(numbered, nxt), tail)
    p = p.withColumn("_first", F.min("page").over(w)).filter(F.col("page") < F.col("_next"))
    o = w.orderBy("page")
    was = F.when(F.col("page") == F.col("_first"), F.col("at_end")).otherwise(F.lag("numbers").over(o))
    joins = F.arrays_overlap("numbers", F.transform(was, lambda x: x + 1)) & (F.col("page") == F.col("_first") + F.row_number().over(o) - 1)
    p = p.withColumn("_ok", F.min(joins).over(o.rowsBetween(W.unboundedPreceding, 0))).filter("_ok")
    p = p.withColumn("_same", F.min(F.col("header") == F.col("expected")).over(o.rowsBetween(W.unboundedPreceding, 0)))
    g = p.groupBy("volume", "from_volume", "code").agg(F.min("page").alias("start"), F.max("page").alias("_run"), F.max(F.when(F.col("_same"), F.col("page"))).alias("_match"))
    return g.filter("_match IS NOT NULL").select("volume", "code", "from_volume", "start", F.least(F.col("_match") + TAIL, "_run").alias("end"))


def keep_copies(found: DataFrame, key: list[str], folios: DataFrame) -> DataFrame:
    """found with kept: of a key in several volumes all copies, if each is the next one's first half; else the one with the
    surest source, that doesn't run to its volume's end, that the index agrees with, of the earliest volume.

    found: volume, key, start, end, source (embedded, header, title), index_agrees. folios: volume, first, last (numbered pages).
    """
    by = [F.coalesce(F.col(k), F.lit("")) for k in key]
    w = W.partitionBy(*by)
    f = found.join(folios.select("volume", F.col("first").alias("_f"), F.col("last").alias("_l")), "volume", "left")
    f = f.withColumns({"_to_end": F.coalesce(F.col("end") >= F.col("_l"), F.lit(False)), "_at_head": F.coalesce(F.col("start") <= F.col("_f"), F.lit(False))})
    o = w.orderBy("volume")
    chain = F.col("_at_head") & F.lag("_to_end").over(o) & (F.lag("volume").over(o) == F.col("volume") - 1)
    f = f.withColumn("_chain", F.when(F.row_number().over(o) == 1, True).otherwise(F.coalesce(chain, F.lit(False))))
    rank = F.when(F.col("source") == "embedded", 3).when(F.col("source") == "header", 2).when(F.col("source") == "title", 1).otherwise(0)
    best = F.row_number().over(w.orderBy(F.desc(rank), F.asc("_to_end"), F.desc(F.coalesce("index_agrees", F.lit(False))), "volume"))
    return f.withColumn("kept", (F.min("_chain").over(w)) | (best == 1)).drop("_f", "_l", "_to_end", "_at_head", "_chain")


def relation_article(spans: DataFrame) -> DataFrame:
    """Exhibits of the relation that print a code file under their own article."""
    return spans.withColumn("article", F.when(F.col("evidence") == "exhibit", F.coalesce(rel_article(F.col("code")), F.col("article"))).otherwise(F.col("article")))


def place_from_plan(plan: DataFrame, anchors: DataFrame) -> DataFrame:
    """volume, ord, code, start, how: tables of a list without a detection, from the counted lengths after the last anchor.

    plan: volume, ord, code, pages (as the list counts them). anchors: volume, code, start (detected).
    """
    p = plan.join(anchors, ["volume", "code"], "left")
    w = W.partitionBy("volume").orderBy("ord")
    p = p.withColumn("_seg", F.count("start").over(w.rowsBetween(W.unboundedPreceding, 0)))
    s = W.partitionBy("volume", "_seg").orderBy("ord").rowsBetween(W.unboundedPreceding, -1)
    counted = F.first("start").over(W.partitionBy("volume", "_seg").orderBy("ord")) + F.coalesce(F.sum("pages").over(s), F.lit(0))
    return p.select("volume", "ord", "code", F.coalesce("start", counted).alias("start"), F.when(F.col("start").isNotNull(), "anchor").when(counted.isNotNull(), "counted").otherwise("unplaced").alias("how"))


# ---------------------------------------------------------------- the list, and what nobody claims


def table_plan(spans: DataFrame, more: DataFrame) -> DataFrame:
    """key, seq, volume, start, end: the pages of every kept table, in its order; continuations after it."""
    k = ["authority", "article", "code"]
    parts = spans.filter("kept").select(*k, "volume", "start", "end", F.lit(0).alias("_c")).unionByName(more.select(*k, "volume", "start", "end", F.lit(1).alias("_c")))
    return parts.withColumn("seq", F.row_number().over(W.partitionBy("authority", F.coalesce("article", F.lit("")), "code").orderBy("volume", "_c", "start")).cast("bigint")).drop("_c")


def segments_text(segments: Column) -> Column:
    """V1:3-9+V2:1-4 from an array of (seq, volume, start, end)."""
    return F.array_join(F.transform(F.array_sort(segments), lambda s: F.concat(F.lit("V"), s["volume"].cast("string"), F.lit(":"), s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), "+")


def table_list(plan: DataFrame, spans: DataFrame, missing: DataFrame) -> DataFrame:
    """key, status, segments, pages: tables that are written (ok or provisional), copies settled away (reprint), and codes
    that a list promises and nobody found (listed-missing).

    plan: as table_plan gives it, with provisional. spans: with kept. missing: code.
    """
    key = F.concat_ws("/", "authority", F.nullif("article", F.lit("")), "code")
    written = plan.groupBy(key.alias("key")).agg(F.max(F.coalesce("provisional", F.lit(False))).alias("_p"), segments_text(F.collect_list(F.struct("seq", "volume", "start", "end"))).alias("segments"), F.sum(F.col("end") - F.col("start") + 1).alias("pages"))
    written = written.select("key", F.when(F.col("_p"), "provisional").otherwise("ok").alias("status"), "segments", F.col("pages").cast("bigint").alias("pages"))
    one = F.array(F.struct(F.lit(1).cast("bigint").alias("seq"), "volume", "start", "end"))
    again = spans.filter("NOT kept").select(key.alias("key"), F.lit("reprint").alias("status"), segments_text(one).alias("segments"), (F.col("end") - F.col("start") + 1).cast("bigint").alias("pages"))
    lost = missing.select(F.col("code").alias("key"), F.lit("listed-missing").alias("status"), F.lit("").alias("segments"), F.lit(0).cast("bigint").alias("pages"))
    return written.unionByName(again).unionByName(lost)


def listed_missing(listed: DataFrame, found: DataFrame) -> DataFrame:
    """volume, code: codes that a list promises and no table of the volume matches, one lost capital forgiven.

    The tables of a volume, a few hundred, are compared as one array a volume.
    """
    have = found.groupBy("volume").agg(F.collect_set("code").alias("_have"))
    return listed.join(have, "volume", "left").filter(~F.exists(F.coalesce("_have", F.array()), lambda k: same_table(F.col("code"), k))).select("volume", "code").distinct()


def trash(pages: DataFrame, claimed: DataFrame, marks: DataFrame, ranges: DataFrame) -> DataFrame:
    """volume, first, last, n, reason: maximal runs of pages that no table claims, each with the first reason that fits.

    marks: volume, page, mark (gazette, listing). ranges: volume, start, end, reason, in the order of precedence `rank`
    (dropped copy, reprint: both ends equal; cut at a boundary: start equal; trimmed: start equal and no longer than it).
    """
    r = runs(pages.join(claimed.select("volume", "page").distinct(), ["volume", "page"], "left_anti"), ["volume"], "page")
    size = pages.groupBy("volume").agg(F.max("page").alias("_pages"))
    held = r.select("volume", "first", "last", F.explode(F.sequence("first", "last")).alias("page")).join(marks, ["volume", "page"]).groupBy("volume", "first", "mark").agg(F.count("*").alias("k"))
    held = held.groupBy("volume", "first").agg(F.max(F.when(F.col("mark") == "gazette", F.col("k"))).alias("_g"), F.max(F.when(F.col("mark") == "listing", F.col("k"))).alias("_l"))
    by_range = r.join(ranges.withColumnRenamed("reason", "_why"), (r.volume == ranges.volume) & (r["first"] == ranges.start)).drop(ranges.volume)
    fits = F.when(F.col("_why").isin("dropped-copy", "given-up-reprint"), F.col("last") == F.col("end")).when(F.col("_why") == "trimmed-tail", F.col("last") <= F.col("end")).otherwise(True)
    first = by_range.filter(fits).groupBy("volume", "first").agg(F.min_by("_why", "rank").alias("_why"))
    out = r.join(size, "volume").join(held, ["volume", "first"], "left").join(first, ["volume", "first"], "left")
    reason = F.when(F.col("_g") == F.col("n"), "gazette-pasted").when(F.col("_l") == F.col("n"), "listing").when(F.col("_why").isNotNull(), F.col("_why")).when(F.col("first") == 1, "front-matter").when(F.col("last") == F.col("_pages"), "volume-tail").otherwise("no-detector")
    return out.select("volume", "first", "last", "n", reason.alias("reason"))


def accounting(pages: DataFrame, claimed: DataFrame, runs_: DataFrame) -> DataFrame:
    """volume, pages, claimed, trashed, closed: pages claimed and pages thrown away are all there are."""
    a = pages.groupBy("volume").agg(F.count_distinct("page").alias("pages"))
    b = claimed.join(pages.select("volume", "page").distinct(), ["volume", "page"], "left_semi").groupBy("volume").agg(F.count_distinct("page").alias("claimed"))
    c = runs_.groupBy("volume").agg(F.sum("n").alias("trashed"))
    out = a.join(b, "volume", "left").join(c, "volume", "left").na.fill(0, ["claimed", "trashed"])
    return out.withColumn("closed", F.col("claimed") + F.col("trashed") == F.col("pages"))


def printed_page(page: Column, label: Column, labels_agree: Column, offset: Column) -> Column:
    """The page's own label where labels can be trusted, else the folio, else the page itself."""
    return F.when(label.rlike("^[0-9]+$") & labels_agree, label.try_cast("int")).otherwise(page + F.coalesce(offset, F.lit(0)))


def labels_agree(pages: DataFrame) -> DataFrame:
    """volume, agree: labels are trusted if half of the numeric ones at least equal page and offset, or no folio is known.

    pages: volume, page, label, offset.
    """
    n = F.col("label").rlike("^[0-9]+$")
    return pages.groupBy("volume").agg((F.max("offset").isNull() | (2 * F.count_if(n & (F.col("label").try_cast("int") == F.col("page") + F.col("offset"))) >= F.count_if(n))).alias("agree"))
