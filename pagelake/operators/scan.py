"""Pages to detections: what each page names, which codes the volume's lists promise, and tables located end to end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions import pages as pg
from pagelake.functions import text as tx
from pagelake.operators import placement


def page_facts(pages: DataFrame) -> DataFrame:
    """pages (volume, page, text) with lines, blank, numbers, header, stamped, garbled, ciphered, pasted, and whose page it is
    where the text can be read: authority, article.
    """
    t = F.coalesce("text", F.lit(""))
    p = pages.withColumn("text", tx.decipher(t)).withColumn("lines", tx.lines(F.col("text")))
    garbled, pasted = tx.is_garbled(F.col("text")), pg.is_pasted(F.col("text"))
    ciphered = ~garbled & tx.is_ciphered(F.col("text"))
    p = p.withColumns({"garbled": garbled & ~pasted, "ciphered": ciphered & ~pasted, "pasted": pasted, "blank": pg.is_blank(F.col("lines")), "numbers": tx.printed_numbers(F.col("text")), "header": tx.header_fingerprint(F.col("text")), "stamped": pg.stamp_code(F.col("lines"))})
    owner = F.when(~F.col("garbled") & ~F.col("ciphered") & ~F.col("pasted"), pg.classify(F.col("text")))
    return p.withColumn("_o", owner).withColumns({"authority": F.col("_o.authority"), "article": F.col("_o.article")}).drop("_o")


def listings(facts: DataFrame) -> DataFrame:
    """volume, page, codes: pages that list tables."""
    return facts.filter("NOT pasted").select("volume", "page", pg.listing_codes(F.col("text")).alias("codes")).filter(F.size("codes") > 0)


#: About how many pages of a volume without a list are looked at.
LOOKED_AT = 25


def families(facts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """vocabulary (volume, codes, mixed: lists of several bodies, may be null) with family, of each volume of `facts`.

    Where the list leaves it open, pages at even steps show it: 2 for a code of that family, 3 for single letters without
    a digit behind any, else 1. Customs pages have codes of their own and don't count, but where lists are mixed.
    """
    v = facts.groupBy("volume").agg(F.count("*").alias("n")).join(vocabulary.select("volume", "codes", "mixed"), "volume", "left")
    v = v.withColumns({"codes": F.coalesce("codes", F.array().cast("array<string>")), "mixed": F.coalesce("mixed", F.lit(False))})
    v = v.withColumn("listed", pg.listed_family(F.col("codes"), F.col("mixed"))).withColumn("step", F.greatest(F.lit(1), F.floor(F.col("n") / LOOKED_AT)))
    at = facts.withColumn("at", F.row_number().over(W.partitionBy("volume").orderBy("page")) - 1)
    p = at.join(v.filter("listed IS NULL"), "volume").filter((F.col("at") % F.col("step") == 0) & (F.col("mixed") | ~F.coalesce(pg.classify(F.col("text"))["authority"] == "DOG", F.lit(False))))
    c = F.col("c")
    seen = p.select("volume", F.explode(pg.inline_codes(F.col("text"))).alias("c")).groupBy("volume")
    seen = seen.agg(F.when(F.bool_or(c.isin(pg.FAMILY_2)), 2).when(F.bool_or(c.rlike("^[A-Z]$")) & ~F.bool_or(c.rlike(r"^[A-Z]\d$")), 3).alias("shown"))
    return v.join(seen, "volume", "left").select("volume", "codes", "mixed", F.coalesce("listed", "shown", F.lit(1)).alias("family"))


def detections(facts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """volume, page, code, evidence: what pages name. Exhibits of the relation count before codes; charts are not tables.

    Pasted pages, pages without lines, lists, indexes and supplements name nothing. vocabulary: volume, codes, family.
    """
    lists = listings(facts).select("volume", "page")
    p = facts.filter(~F.col("pasted") & (F.size("lines") > 0) & ~pg.is_index_page(F.col("lines")) & ~pg.is_allegato_page(F.col("text"))).join(lists, ["volume", "page"], "left_anti")
    p = p.join(vocabulary, "volume", "left").withColumns({"codes": F.coalesce("codes", F.array().cast("array<string>")), "family": F.coalesce("family", F.lit(1))})
    p = p.withColumn("own", pg.page_code(F.col("text"), F.col("codes"), F.col("family")))
    mef = pg.relation_exhibits(p, ["volume"])
    p = p.join(mef, ["volume", "page"])
    one = lambda c, e: F.struct(c.alias("code"), F.lit(e).alias("evidence"))
    tables = F.filter(pg.rel_headings(F.col("lines")), lambda h: F.lower(h["kind"]) == "tabella")
    found = F.when(F.size("exhibits") > 0, F.transform("exhibits", lambda x: one(pg.rel_code(x["code"]), "exhibit"))).when(F.col("own").isNotNull(), F.array(F.col("own"))).otherwise(F.transform(tables, lambda h: one(pg.rel_code(h["number"]), "exhibit")))
    return p.select("volume", "page", F.explode(F.array_distinct(found)).alias("d")).select("volume", "page", "d.*")


def promised(facts: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(detections with those of promised codes, sections): pages without a code, or with an inline mention alone, are read
    again with all codes that the volume's lists promise; what names one takes the mention's place. Others may open another
    body's section: volume, page, body.
    """
    codes = listings(facts).groupBy("volume").agg(F.array_distinct(F.flatten(F.collect_list("codes"))).alias("promised"))  # a few hundred a volume
    sure = found.filter("evidence <> 'inline'").select("volume", "page").distinct()
    c = facts.filter(~F.col("pasted") & (F.size("lines") > 0)).join(sure, ["volume", "page"], "left_anti").join(codes, "volume").withColumn("banner", pg.is_mef_section(F.col("text")))
    c = c.withColumn("code", pg.page_code_listed(F.col("lines"), F.col("promised"), F.col("banner")))
    again = c.filter("code IS NOT NULL").select("volume", "page", "code", F.lit("promised").alias("evidence"))
    sections = c.filter("code IS NULL").select("volume", "page", pg.section_open(F.col("lines"), F.col("promised"), F.col("banner")).alias("body")).filter("body IS NOT NULL")
    rest = found.join(again.select("volume", "page"), ["volume", "page"], "left_anti")
    return rest.unionByName(again), sections


def body_starts(facts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """volume, code, page: the first page whose first title (among six lines) names a known code, followed by a line of prose."""
    p = facts.filter(~F.col("garbled") & ~F.col("ciphered") & ~pg.is_index_page(F.col("lines"))).join(vocabulary, "volume")
    pairs = F.arrays_zip(F.slice("lines", 1, 6).alias("a"), F.slice(F.concat("lines", F.array(F.lit(""))), 2, 6).alias("b"))
    first = pg.first_of(pairs, lambda x: F.when(x["a"].rlike(pg.TITLED), F.struct(pg.normalise_digit_one(F.upper(F.regexp_extract(x["a"], pg.TITLED, 1))).alias("code"), x["b"].alias("next"))))
    p = p.withColumn("_f", first).filter(F.col("_f").isNotNull() & (F.length("_f.next") > 12) & ~F.col("_f.next").rlike(pg.TITLED))
    known = F.array_contains(F.transform("codes", lambda c: pg.normalise_digit_one(c)), F.col("_f.code"))
    return p.filter(known).groupBy("volume", F.col("_f.code").alias("code")).agg(F.min("page").alias("page"))


def located(pages: DataFrame, vocabulary: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """Tables of volumes, from their pages: volume, authority, article, code, start, end0 to end6, source, clamps, note, collides.

    The steps are those of `placement`, one after the other. bookmarks: volume, code, page.
    """
    facts = page_facts(pages).persist()
    lists = listings(facts)
    found, sections = promised(facts, detections(facts, vocabulary).persist())
    owner = placement.owner_by_text(facts.select("volume", "page", "authority"))
    own = facts.select("volume", "page", F.col("article").alias("_article")).join(owner, ["volume", "page"])
    keyed = lambda df: df.join(own, ["volume", "page"], "left").withColumns({"authority": F.coalesce("authority", F.lit("UNKNOWN")), "article": F.col("_article")}).drop("_article")
    key = ["authority", "article", "code"]
    d = placement.relation_article(keyed(found)).withColumn("article", F.coalesce("article", F.lit(""))).persist()
    c = placement.clusters(d, key, lists, bookmarks).filter("kept")
    kept = d.join(c.select("volume", *key, F.explode(F.sequence("first", "last")).alias("page")), ["volume", *key, "page"], "left_semi")
    flat = lambda df: df.withColumn("article", F.coalesce("article", F.lit("")))
    s = placement.starts(kept, key, flat(keyed(body_starts(facts, vocabulary))), flat(keyed(bookmarks)))
    volumes = facts.groupBy("volume").agg(F.max("page").alias("pages"))
    edges = facts.select("volume", "page", F.lit("").alias("name")).limit(0)
    e = placement.ends(s, volumes, edges, sections.select("volume", "page"), lists).persist()
    stamps = facts.select("volume", "page", pg.stamp_tokens(F.col("text")).alias("s")).filter("s IS NOT NULL").select("volume", "page", "s.first", "s.second")
    t = placement.trim_stamps(e.withColumn("end", F.col("end3")), stamps, key).persist()
    t = placement.trim_foreign(t, facts.select("volume", "page", F.col("stamped").alias("named")), key)
    t = placement.trim_blanks(t, facts.select("volume", "page", "blank"))
    return placement.rekey(t).withColumn("article", F.nullif("article", F.lit(""))).drop("end", "floor")


def continued_text(facts: DataFrame, spans: DataFrame) -> DataFrame:
    """What `placement.continued` finds between volumes, from the pages' facts."""
    return placement.continued(spans, facts.select("volume", "page", "numbers", "header"))


def evidence_rank(evidence: Column) -> Column:
    """The surest first: bookmark, title, header, stamp, inline, cover and the others by name."""
    order = ["annex", "appendix", "listed", "after_heading", "title", "promised", "exhibit", "stamp", "inline", "cover"]
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), evidence), F.lit(0)), F.lit(len(order) + 1))
