"""Volumes, their pages and what is known of them: jobs, the page cache, segments with clips, bookmarks, manifests, fonts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.pages import CODE, parse_stem
from pagelake.operators.sets import first_in_group
from pagelake.sources.tables import MANIFEST, Refused, path_year, spread, volume_ordinal

#: The first edition that is read, and where on a page, and how large, the export's stamp stands.
FIRST_YEAR, STAMP_SIZE, STAMP_BAND = 2016, (8.5, 10.0), (0.30, 0.52)


def _refuse(df: DataFrame, why: str) -> None:
    bad = df.limit(1).collect()
    if bad:
        raise Refused(f"{why}: {bad[0].asDict()}")


# ---------------------------------------------------------------- which files


def found_reports(files: DataFrame) -> DataFrame:
    """files (path) with year (of the folder), stem, volume (null where the name doesn't tell). Only PDF files count."""
    f = files.filter(F.lower("path").endswith(".pdf"))
    f = f.withColumn("stem", F.regexp_extract("path", r"([^/]+)\.[^.]*$", 1))
    return f.withColumns({"year": path_year(F.col("path")), "volume": volume_ordinal(F.col("stem"))})


def in_order(reports: DataFrame) -> DataFrame:
    """reports with place: volumes of a year by ordinal (none first), then by path."""
    w = W.partitionBy("year").orderBy(F.coalesce("volume", F.lit(0)), "path")
    return reports.withColumn("place", F.row_number().over(w).cast("bigint"))


def jobs(reports: DataFrame, year: int | None = None, volume: int | None = None) -> DataFrame:
    """The files to read: one volume, one year, or all from FIRST_YEAR on. A year and volume of several files is refused."""
    r = reports.filter(F.col("year").isNotNull() & (F.col("year") >= FIRST_YEAR))
    if year is not None:
        r = reports.filter(F.col("year") == year)
    if volume is not None:
        r = r.filter(F.col("volume") == volume)
        _refuse(r.groupBy("year", "volume").count().filter("count > 1"), "several files for one volume")
    return r


def only_year(reports: DataFrame) -> int:
    """The year, if the reports are of one; otherwise Refused."""
    years = [r["year"] for r in reports.select("year").distinct().limit(2).collect()]
    if len(years) != 1 or years[0] is None:
        raise Refused(f"not one year: {years}")
    return years[0]


def with_sibling(indexes: DataFrame) -> DataFrame:
    """indexes (year, volume, entries or null): a volume without an index of its own borrows that of volume 1."""
    one = indexes.filter("volume = 1").select("year", F.col("entries").alias("_first"))
    return indexes.join(one, "year", "left").withColumn("borrowed", F.col("entries").isNull() & F.col("_first").isNotNull()).withColumn("entries", F.coalesce("entries", "_first")).drop("_first")


def written_files(paths: DataFrame) -> DataFrame:
    """paths of written tables (folders body/article/name): path, authority, article, code, year, volume, page; strays have null codes."""
    p = paths.withColumn("_s", parse_stem(F.regexp_extract("path", r"([^/]+)\.PDF$", 1))).withColumn("_d", F.split(F.regexp_extract("path", r"^(.*)/[^/]+$", 1), "/"))
    two = F.size("_d") >= 2
    return p.select("path", F.get("_d", F.lit(0)).alias("authority"), F.when(two, F.get("_d", F.lit(1))).alias("article"), "_s.code", "_s.year", "_s.volume", "_s.page")


def strays(written: DataFrame, listed: DataFrame) -> DataFrame:
    """Files that no row of the table list names (path)."""
    return written.join(listed.select("path").distinct(), "path", "left_anti")


# ---------------------------------------------------------------- pages, read once


def page_key(content: Column, library: Column, reader: Column) -> Column:
    """What a page's extraction depends on: its bytes, the library's version and the reader's source."""
    return F.sha2(F.concat_ws("\u0000", F.sha2(content, 256), library, reader), 256)


def cache_plan(pages: DataFrame, cache: DataFrame) -> DataFrame:
    """key, todo: read (a page that the cache hasn't), keep, or drop (an entry that no page has any more)."""
    both = pages.select("key").distinct().withColumn("_p", F.lit(True)).join(cache.select("key").distinct().withColumn("_c", F.lit(True)), "key", "full_outer")
    return both.select("key", F.when(F.col("_c").isNull(), "read").when(F.col("_p").isNull(), "drop").otherwise("keep").alias("todo"))


def page_texts(external: DataFrame, library: DataFrame) -> DataFrame:
    """volume, page, text, extractor, error: a volume's texts from the external tool if it gave any text, else from the library.

    A page that couldn't be read keeps its error as a value. Both: volume, page, text, error.
    """
    whole = external.groupBy("volume").agg(F.max(F.trim(F.coalesce("text", F.lit(""))) != "").alias("_ok")).filter("_ok").select("volume")
    tool = external.join(whole, "volume", "left_semi").withColumn("extractor", F.lit("external"))
    own = library.join(whole, "volume", "left_anti").withColumn("extractor", F.lit("library"))
    cols = ["volume", "page", F.when(F.col("error").isNull(), F.coalesce("text", F.lit(""))).alias("text"), "extractor", "error"]
    return tool.select(*cols).unionByName(own.select(*cols))


def stamp_chunk(spans: Column, height: Column) -> Column:
    """Text of the first span that is as large, and stands where, the export's stamp does. spans: array of (text, size, y)."""
    fits = F.filter(spans, lambda s: s["size"].between(*STAMP_SIZE) & (s["y"] > STAMP_BAND[0] * height) & (s["y"] < STAMP_BAND[1] * height) & (F.trim(s["text"]) != ""))
    return F.trim(F.try_element_at(fits, F.lit(1))["text"])


# ---------------------------------------------------------------- pages of tables


def segments_of(segments: DataFrame, year: int, key: str) -> DataFrame:
    """A table's segments in their order."""
    return segments.filter((F.col("year") == year) & (F.col("key") == key)).orderBy("seq")


def table_keys(segments: DataFrame) -> DataFrame:
    """year, key, place: every table once, in the order of the index (ord)."""
    k = segments.groupBy("year", "key").agg(F.min("ord").alias("_o"))
    return k.select("year", "key", F.row_number().over(W.partitionBy("year").orderBy("_o")).cast("bigint").alias("place"))


def checked_volumes(segments: DataFrame, volumes: DataFrame) -> DataFrame:
    """segments, if every file is there and has the bytes that the index was made from (sha256); otherwise Refused."""
    v = volumes.select("source_file", F.col("sha256").alias("_now"))
    _refuse(segments.select("source_file", "sha256").distinct().join(v, "source_file", "left").filter(~F.col("sha256").eqNullSafe(F.col("_now"))), "not the volume that the index was made from")
    return segments


def table_pages(segments: DataFrame) -> DataFrame:
    """year, key, seq, source_file, pdf_page, printed_page, clip: every page of every segment; the clip of a cut page.

    segments: year, key, seq, source_file, pdf_from, pdf_to, printed_from, cut, clip (JSON: page to four numbers). A cut
    page without a clip is refused.
    """
    p = segments.withColumn("pdf_page", F.explode(F.sequence("pdf_from", "pdf_to")))
    clips = F.from_json("clip", "map<string,array<double>>")
    p = p.withColumn("_clip", F.try_element_at(clips, F.col("pdf_page").cast("string")))
    _refuse(p.filter(F.col("cut") & F.col("_clip").isNull()).select("key", "pdf_page"), "a cut page without a clip")
    return p.select("year", "key", "seq", "source_file", "pdf_page", (F.col("printed_from") + F.col("pdf_page") - F.col("pdf_from")).alias("printed_page"), F.col("_clip").alias("clip"))


def direction(x: Column, y: Column) -> Column:
    """struct(x, y) of unit length, to three digits; what has no length runs to the right."""
    n = F.sqrt(x * x + y * y)
    return F.when(n < 1e-9, F.struct(F.lit(1.0).alias("x"), F.lit(0.0).alias("y"))).otherwise(F.struct(F.round(x / n, 3).alias("x"), F.round(y / n, 3).alias("y")))


def inside(x0: Column, y0: Column, x1: Column, y1: Column, clip: Column) -> Column:
    """Whether a box's middle lies in the clip; without a clip everything is inside."""
    at = lambda k: F.get(clip, F.lit(k))
    x, y = (x0 + x1) / 2, (y0 + y1) / 2
    return clip.isNull() | (x.between(at(0), at(2)) & y.between(at(1), at(3)))


def clipped_glyphs(glyphs: DataFrame, by: list[str]) -> DataFrame:
    """Glyphs of a page inside its clip and along the direction that most glyphs of the page have, decoded where their
    font's map names one character.

    glyphs: by, x0, y0, x1, y1, dir_x, dir_y, char, clip, decoded (or null).
    """
    g = glyphs.withColumn("_d", direction(F.col("dir_x"), F.col("dir_y")))
    n = g.groupBy(*by, "_d").agg(F.count("*").alias("n"))
    main = first_in_group(n, by, [F.desc("n"), F.col("_d.x"), F.col("_d.y")]).select(*by, F.col("_d").alias("_main"))
    kept = g.join(main, by).filter((F.col("clip").isNull() | (F.col("_d") == F.col("_main"))) & inside(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), F.col("clip")))
    return kept.withColumn("char", F.when(F.length("decoded") == 1, F.col("decoded")).otherwise(F.col("char"))).select(*glyphs.columns)


# ---------------------------------------------------------------- outlines and manifests

TITLED = rf"(?i)(?:(?<![A-Za-z])TAB[ ._]+|tabella)({CODE})(?![A-Za-z0-9])"


def bookmark_codes(outline: DataFrame) -> DataFrame:
    """volume, code, page: the first outline entry (by ord) that names a table; entries without a page don't count."""
    o = outline.withColumn("code", F.upper(F.regexp_extract("title", TITLED, 1))).filter((F.col("code") != "") & (F.col("page") > 0))
    return o.groupBy("volume", "code").agg(F.min_by("page", "ord").alias("page"))


def bookmarks_in(outline: DataFrame, spans: DataFrame) -> DataFrame:
    """volume, key, titles: outline entries inside each table's pages, in their order. Joined by page.

    Tables of the same pages have the same entries, which are collected once for all of them; an entry that several spans
    of a table have is counted until the text is written out, a row at a time. What is written still grows with tables times
    entries.
    """
    own = spans.groupBy("volume", "key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    pages = own.select("volume", "_spans").distinct().select("volume", "_spans", F.explode("_spans").alias("s"))
    pages = pages.select("volume", "_spans", F.explode(F.sequence("s.start", "s.end")).alias("page")).groupBy("volume", "_spans", "page").agg(F.count("*").cast("int").alias("n"))
    found = outline.join(pages, ["volume", "page"]).groupBy("volume", "_spans").agg(F.array_sort(F.collect_list(F.struct("ord", "title", "n"))).alias("_t"))
    titles = F.array_join(F.flatten(F.transform("_t", lambda x: F.array_repeat(x["title"], x["n"]))), " | ")
    by = ["volume", "_spans"]
    return spread(own, *by).join(spread(found, *by).hint("merge"), by).select("volume", "key", titles.alias("titles"))


def verifier_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Years and files of the archive's manifest as the verifier reads it: seven fields, the last a web address."""
    rows = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != "")).select(F.split("value", "\t").alias("f"))
    names = [x.split()[0] for x in MANIFEST.split(", ")]
    ok = rows.filter((F.size("f") >= 7) & F.element_at("f", -1).startswith("http"))
    return ok.select(*[F.get("f", F.lit(k)).alias(n) for k, n in enumerate(names)]).withColumn("year", F.col("year").try_cast("int")).filter("year IS NOT NULL")


def latest_reports(lines: DataFrame) -> DataFrame:
    """report, ord, row: the last row of every report in a JSON-lines manifest (value, ord); lines that can't be read don't count."""
    r = lines.withColumn("report", F.try_variant_get(F.try_parse_json("value"), "$.report", "string")).filter("report IS NOT NULL AND report <> ''")
    return r.groupBy("report").agg(F.max("ord").alias("ord"), F.max_by("value", "ord").alias("row"))


SPAN = "struct<authority:string,article:string,code:string,start:int,end:int,pages:int,source:string,kept:boolean>"


def manifest_tables(latest: DataFrame) -> DataFrame:
    """report, code, start, end, pages, source: tables of manifests in either of two shapes, a list of records or records by code."""
    as_list = F.from_json(F.get_json_object("row", "$.tables"), f"array<{SPAN}>")
    as_map = F.from_json(F.get_json_object("row", "$.tables"), f"map<string,{SPAN}>")
    is_list = F.get_json_object("row", "$.tables").startswith("[")
    named = F.transform(F.map_entries(as_map), lambda e: F.struct(e["value"]["authority"].alias("authority"), e["value"]["article"].alias("article"), e["key"].alias("code"), e["value"]["start"].alias("start"), e["value"]["end"].alias("end"), e["value"]["pages"].alias("pages"), e["value"]["source"].alias("source"), e["value"]["kept"].alias("kept")))
    return latest.select("report", F.explode(F.when(is_list, as_list).otherwise(named)).alias("t")).select("report", "t.*")


# ---------------------------------------------------------------- fonts


def font_maps(fonts: DataFrame) -> DataFrame:
    """page, font, glyph, char: what a font's map says, where all fonts of that name on the page say the same.

    fonts: page, font (name as spans have it), object (which font), glyph, char. A name that two fonts share gets no map.
    """
    objects = fonts.groupBy("page", "font").agg(F.count_distinct("object").alias("n")).filter("n = 1").select("page", "font")
    return fonts.join(objects, ["page", "font"], "left_semi").select("page", "font", "glyph", "char").distinct()


#: Witnesses of what an outline stands for, the surest first.
WITNESSES = ["person", "archive", "reference"]


def named_outlines(witnesses: DataFrame) -> DataFrame:
    """face, outline, char, witness, reason: an outline's character by the surest witness that names exactly one; else why not.

    witnesses: face, outline, witness, char (null: seen and not named).
    """
    rank = F.array_position(F.array(*map(F.lit, WITNESSES)), F.col("witness"))
    said = witnesses.filter("char IS NOT NULL").groupBy("face", "outline", "witness").agg(F.count_distinct("char").alias("n"), F.min("char").alias("char")).withColumn("rank", rank)
    best = said.groupBy("face", "outline").agg(F.min_by(F.struct("n", "char", "witness"), "rank").alias("b"))
    every = witnesses.select("face", "outline").distinct().join(best, ["face", "outline"], "left")
    one = F.col("b.n") == 1
    return every.select("face", "outline", F.when(one, F.col("b.char")).alias("char"), F.when(one, F.col("b.witness")).alias("witness"), F.when(F.col("b").isNull(), "no witness").when(~one, "witnesses differ").otherwise("").alias("reason"))
