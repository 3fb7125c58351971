"""Queries of column functions: numbers, dates, page text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.functions import numbers, text
from pagelake.sources.tables import table


def _grouped(whole: Column) -> Column:
    """A whole number with points between thousands."""
    return F.regexp_replace(whole.cast("string"), r"(?<=\d)(?=(\d{3})+$)", ".")


def _printed(o: DataFrame) -> DataFrame:
    """Orders with their price as a report would print it, in seven manners."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    whole, rest = (cents / 100).cast("bigint"), F.lpad((cents % 100).cast("string"), 2, "0")
    amount = F.concat(_grouped(F.floor(cents / 100).cast("bigint")), F.lit(","), rest)
    kind = F.col("o_orderkey") % 7
    shown = F.when(kind == 0, amount).when(kind == 1, F.concat(F.lit("€ "), amount)).when(kind == 2, F.concat(F.lit("("), amount, F.lit(")"))).when(kind == 3, F.concat(F.lit("-€ "), amount)).when(kind == 4, "—").when(kind == 5, F.lpad((F.col("o_orderkey") % 100).cast("string"), 3, "0")).otherwise(F.concat(amount, F.lit(" EUR")))
    return o.select("o_orderkey", "o_orderdate", kind.alias("kind"), shown.alias("raw"))


def italian_number_parse(spark: SparkSession, d: str) -> DataFrame:
    p = _printed(table(spark, d, "orders"))
    return p.select("o_orderkey", "raw", numbers.parse_number(F.col("raw")).cast("double").alias("value"))


def value_shape_census(spark: SparkSession, d: str) -> DataFrame:
    p = _printed(table(spark, d, "orders"))
    cells = p.select(F.explode(F.array("raw", F.concat(F.lit("€ "), F.lpad((F.col("o_orderkey") % 100).cast("string"), 3, "0")), F.concat(F.col("raw"), F.lit(" %")), F.date_format("o_orderdate", "dd/MM/yyyy"), F.year("o_orderdate").cast("string"), F.concat(F.lit("Totale "), F.col("kind")), F.lit(""))).alias("cell"))
    return cells.groupBy(numbers.value_shape(F.col("cell")).alias("shape")).agg(F.count("*").alias("n"))


def date_parse(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "d-M-yy")).otherwise("31/02/2025").alias("raw"))
    return o.select("o_orderkey", numbers.parse_date(F.col("raw")).alias("iso"), numbers.real_date(F.col("raw")).isNotNull().alias("is_real"))


def header_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(text.header_fingerprint(F.coalesce("text", F.lit(""))).alias("header")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


def garbled_ratio(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select("doc_id", text.share(t, r"[^\p{L}\p{N}\s]", r"[\p{L}\p{N}]").alias("odd_share"), text.is_garbled(t).alias("garbled"))


def vowel_ratio(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select("doc_id", text.vowel_share(t).alias("vowels"), text.is_ciphered(t).alias("ciphered"))


def shift_decipher(spark: SparkSession, d: str) -> DataFrame:
    """Texts shifted line by line and read back; those too short to be judged stay as they are."""
    t = table(spark, d, "benchmark").select("item_id", "text", text.shift(F.col("text")).alias("hidden"))
    return t.select("item_id", F.length("text").cast("bigint").alias("n"), (text.decipher(F.col("hidden")) == F.col("text")).alias("read"), (text.decipher(F.col("text")) == F.col("text")).alias("clear_stays"))


def title_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Every document against one benchmark passage as its title: the share of the title's stems that it has."""
    b = table(spark, d, "benchmark")
    n = b.count()
    titles = b.select((F.col("item_id") % n).alias("k"), "item_id", text.stems(F.col("text"), "a-zÀ-ÿ0-9").alias("a"))
    docs = table(spark, d, "documents").select((F.col("doc_id") % n).alias("k"), "doc_id", text.stems(F.coalesce("text", F.lit(""))).alias("b"))
    return docs.join(titles, "k").select("doc_id", "item_id", (F.size(F.array_intersect("a", "b")) / F.greatest(F.lit(1), F.size("a"))).alias("overlap"))


def lines_array_probe(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    ls, pairs = text.lines(t), text.windows_of_lines(t, 2)
    long = F.size(F.filter(pairs, lambda x: F.length(x) > 400))
    return table(spark, d, "documents").select("doc_id", F.size(ls).cast("bigint").alias("n_lines"), long.cast("bigint").alias("n_long_pairs"))


def html_table_rows(spark: SparkSession, d: str) -> DataFrame:
    cells = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"<li>([^\n]*?)</li>"), F.lit(1))
    return table(spark, d, "pages").select("page_id", F.size(cells).cast("bigint").alias("n_items"), F.coalesce(F.array_join(F.transform(cells, lambda c: F.regexp_replace(c, "<[^>]*>", "")), "|"), F.lit("")).alias("items"))


def keyword_hits(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").filter(F.col("text").ilike("%license%"))
    return x.groupBy("source").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"), F.min_by("lang", "doc_id").alias("first_lang"))


def volume_names(spark: SparkSession, d: str) -> DataFrame:
    from pagelake.sources.tables import path_year, volume_ordinal

    n = F.col("n_nationkey")
    stem = F.when(n % 4 == 0, F.concat(F.lit("Relazione VOLUME "), F.element_at(F.array(*map(F.lit, ("I", "II", "III", "IV", "V"))), (n % 5 + 1).cast("int")))).when(n % 4 == 1, F.concat(F.lit("tomo_"), n % 5 + 1)).when(n % 4 == 2, "Documento unico").otherwise("altro")
    x = table(spark, d, "nation").select("n_nationkey", stem.alias("stem"), F.concat(F.lit("In/"), F.lit(2000) + n, F.lit("/a.pdf")).alias("path"))
    return x.select("n_nationkey", volume_ordinal(F.col("stem")).cast("bigint").alias("volume"), path_year(F.col("path")).cast("bigint").alias("year"))


def sql_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", text.sql_name(F.concat_ws("/", "p_brand", "p_name")).alias("sql_name"))


AMOUNT = "regexp_replace(reverse(regexp_replace(reverse(CAST(c // 100 AS VARCHAR)), '([0-9]{3})', '\\1.', 'g')), '^\\.', '') || ',' || lpad(CAST(c % 100 AS VARCHAR), 2, '0')"
PRINTED = f"""c AS (SELECT o_orderkey, o_orderdate, o_orderkey % 7 AS kind, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders),
p AS (SELECT *, CASE kind WHEN 0 THEN {AMOUNT} WHEN 1 THEN '€ ' || {AMOUNT} WHEN 2 THEN '(' || {AMOUNT} || ')' WHEN 3 THEN '-€ ' || {AMOUNT} WHEN 4 THEN '—' WHEN 5 THEN lpad(CAST(o_orderkey % 100 AS VARCHAR), 3, '0') ELSE {AMOUNT} || ' EUR' END AS raw FROM c)"""

QUERIES = {
    "italian_number_parse": (italian_number_parse, f"WITH {PRINTED} SELECT o_orderkey, raw, CASE WHEN kind IN (0, 1, 6) THEN CAST(CAST(c AS DECIMAL(18,2)) / 100 AS DOUBLE) WHEN kind IN (2, 3) THEN CAST(-CAST(c AS DECIMAL(18,2)) / 100 AS DOUBLE) END AS value FROM p"),
    "value_shape_census": (value_shape_census, """WITH k AS (SELECT o_orderkey % 7 AS kind FROM orders),
c AS (SELECT CASE WHEN kind IN (0, 2, 6) THEN 'number' WHEN kind IN (1, 3) THEN 'currency' WHEN kind = 4 THEN 'dash' ELSE 'code' END AS shape FROM k
  UNION ALL SELECT CASE kind WHEN 0 THEN 'percent' WHEN 1 THEN 'currency' WHEN 2 THEN 'percent' WHEN 3 THEN 'currency' WHEN 5 THEN 'percent' ELSE 'text' END FROM k
  UNION ALL SELECT unnest(['date', 'year', 'total_label', 'empty', 'currency']) FROM k)
SELECT shape, count(*) AS n FROM c GROUP BY shape"""),
    "date_parse": (date_parse, "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN '2025-02-31' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso, o_orderkey % 3 <> 2 AS is_real FROM orders"),
    "header_fingerprint": (header_fingerprint, r"""WITH l AS (SELECT doc_id, coalesce(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')[1], '') AS f FROM documents)
SELECT substr(trim(regexp_replace(regexp_replace(f, '\d+', ' ', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g')), 1, 80) AS header, count(*) AS n, min(doc_id) AS first_doc FROM l GROUP BY 1"""),
    "garbled_ratio": (garbled_ratio, r"""SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[\p{L}\p{N}\s]', '', 'g')) / CAST(greatest(1, length(regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}]', '', 'g'))) AS DOUBLE) AS odd_share,
  length(coalesce(text, '')) = 0 OR length(regexp_replace(coalesce(text, ''), '[^\x{e000}-\x{f8ff}]', '', 'g')) > 0.15 * greatest(1, length(regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}]', '', 'g'))) AS garbled FROM documents"""),
    "vowel_ratio": (vowel_ratio, r"""WITH n AS (SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^aeiouAEIOU]', '', 'g')) AS v, length(regexp_replace(coalesce(text, ''), '[^\p{L}]', '', 'g')) AS l, length(regexp_replace(coalesce(text, ''), '[^\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')) AS k FROM documents)
SELECT doc_id, v / CAST(greatest(1, l) AS DOUBLE) AS vowels, l >= 40 AND (k / CAST(greatest(1, l) AS DOUBLE) > 0.05 OR v / CAST(greatest(1, l) AS DOUBLE) < 0.08) AS ciphered FROM n"""),
    "shift_decipher": (shift_decipher, r"""SELECT item_id, length(text) AS n, length(regexp_replace(text, '[^\p{L}]', '', 'g')) >= 40 AS read, true AS clear_stays FROM benchmark"""),
    "title_overlap": (title_overlap, r"""WITH c AS (SELECT count(*) AS n FROM benchmark), s AS (SELECT item_id, item_id % n AS k, list_distinct(list_transform(regexp_extract_all(lower(text), '[a-zÀ-ÿ0-9]{3,}'), lambda w: substr(w, 1, 6))) AS a FROM benchmark, c),
d AS (SELECT doc_id, doc_id % n AS k, list_distinct(list_transform(regexp_extract_all(lower(coalesce(text, '')), '[a-zà-ÿ0-9]{3,}'), lambda w: substr(w, 1, 6))) AS b FROM documents, c)
SELECT doc_id, item_id, len(list_intersect(a, b)) / CAST(greatest(1, len(a)) AS DOUBLE) AS overlap FROM d JOIN s USING (k)"""),
    "lines_array_probe": (lines_array_probe, r"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS l FROM documents)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(list_filter(range(1, len(l) + 1), lambda i: length(array_to_string(l[i:i + 1], ' ')) > 400)) AS BIGINT) AS n_long_pairs FROM l"""),
    "html_table_rows": (html_table_rows, r"""WITH c AS (SELECT page_id, regexp_extract_all(coalesce(html, ''), '<li>([^\n]*?)</li>', 1) AS c FROM pages)
SELECT page_id, CAST(len(c) AS BIGINT) AS n_items, array_to_string(list_transform(c, lambda x: regexp_replace(x, '<[^>]*>', '', 'g')), '|') AS items FROM c"""),
    "keyword_hits": (keyword_hits, "SELECT source, count(*) AS n, min(doc_id) AS first_doc, min_by(lang, doc_id) AS first_lang FROM documents WHERE text ILIKE '%license%' GROUP BY source"),
    "volume_names": (volume_names, "SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN n_nationkey % 5 + 1 WHEN 1 THEN n_nationkey % 5 + 1 WHEN 2 THEN 1 END::BIGINT AS volume, CAST(2000 + n_nationkey AS BIGINT) AS year FROM nation"),
    "sql_names": (sql_names, "SELECT p_partkey, trim(regexp_replace(lower(p_brand || '/' || p_name), '[^a-z0-9]+', '_', 'g'), '_') AS sql_name FROM part"),
}
