"""What a page is: whose it is, which table it names, and whether it lists, covers, opens or carries one.

Every function is an expression over one page's text, or over its trimmed lines; editions differ by arguments and
rule tables, not by forked functions. Rules are tried in their order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.functions.text import is_ciphered, is_garbled, lines, squeezed
from pagelake.operators.ordered import upto

# ---------------------------------------------------------------- fixed values: what the archive prints

#: A table's code: capitals, then digits.
CODE = r"[A-Z]{1,3}\d{0,2}"
DIFESA = r"(?i:MINISTERO\s+DELLA\s+DIFESA)\s*[-–—]?\s*(?i:Annesso)\s*([0-9]+[A-Z]?)"
DOGANE = rf"(?m)(?:\b|(?<=[a-z]))T\s*A\s*B\s*\.(?:[^\n]{{0,40}}?\b({CODE})\b|[ \t]*\n[ \t]*({CODE})[ \t]*(?:[-–—][ \t]*APPENDICE[ \t]*)?$)"
MEF = rf"(?m)^\s*Tabella\s+({CODE})\s*$|(?i:Dipartimento\s+del\s+Tesoro\s+Direzione\s+V|Operazioni\s+disciplinate\s+dall'\s*art\.\s*27\b)"
MAE = r"(?i:MAECI[^\S\n]*[-–][^\S\n]*UAMA[^\S\n]*-[^\S\n]*CENTRO[^\S\n]+INFORMATICO|Unit[ae]\w*\s+Autorizzazioni\s+Materiali\s+Armamento)|\bTAB\s+(?![.\w])([A-Z]{1,2}\d{1,2})\b"
#: The customs tables file under the article that their title qualifies, else under the last one.
QUALIFIED = [(r"(?i)Autorizzazioni\s+Globali\s+di\s+Trasferimento", "A10QUATER"), (r"(?i)Licenze\s+Globali\s+di\s+Progetto", "A11C5BIS"), (r"(?i)Programmi\s+(?:di\s+Coproduzione\s+)?Intergovernativi", "A1C89"), ("", "A1C2")]
FAMILY_2 = ["A1", "A2", "A3", "A4", "B1", "B2", "B3", "B4", "B5", "B6", "B7", "C1", "C2", "D", "E", "F1", "F2", "G1", "G2", "H1", "H2", "I", "L", "M1", "M2", "N1", "N2", "O1", "O2", "P1", "P2"]
PROSE = ["DEI", "DEL", "DELLA", "DELLE", "DI", "LA", "LE", "IL", "UN", "UNA", "CODICI", "CODICE", "DESCRIZIONE", "VALORI", "RIEPILOGO", "DETTAGLIATO"]
FURNITURE = r"Senato della Repubblica|Camera dei Deputati|LEGISLA\s*TURA"
PAGE_NUMBER = r"^\s*[–—-]?\s*(\d{1,4})\s*[–—-]?\s*$"
TITLED = rf"^(?i:Tabella)\.?\s+({CODE})$"
INLINE = rf"(?:\b(?i:TAB|TABELLA)\b\.?|(?<=[a-z])TAB\.)[^\S\n]+({CODE})\b"
APPENDED = rf"(?i:T\s*A\s*B\s*\.\s*)({CODE})\s*[-–—]\s*APPENDICE\s*$"
CUT_KEYWORD = r"(?i:T\s*a\s*b\s*e\s*l\s*l\s*a|TAB)\s*\.\s*$"
BELOW_KEYWORD = rf"^({CODE})(?![A-Za-z0-9])(?:\s*[-–—]\s*APPENDICE)?$"
STAMPED = rf"CENTRO\s+INFORMATICO\b.*?(?:\bTAB\.?\s+({CODE})|\b([A-Z]{{2,}}))\s*$"
LISTED_ROW = rf"^(?i:T\s*a\s*b\s*e\s*l\s*l\s*a|TAB\s*\.\s*)\s+({CODE})(?![A-Za-z0-9])"
LISTED_TITLE = LISTED_ROW + r"\s*[-–—:]\s*\S"
EXHIBIT = r"^(?i:SEGUE\s+)?((?i:Tabella|Grafico))\s+(\d+(?:\.\d+)?)(?:\s*\(\s*(?i:parte)\s+\d+\s+(?i:di)\s+\d+\s*\))?\s*$"
MEF_EXHIBIT = rf"Tabella\s+({CODE})\s+[-–]\s|Riepilogo saldi esportazioni ed? importazioni"
MEF_TITLES = [("Riepilogo saldi importazioni intracomunitarie", "UE"), ("Licenze Globali di programma di cooperazione", "LGP"), (r"Intermediazioni per Aziende\s*[-–]\s*Riepilogo generale", "IAA"), (r"Finanziamenti-Garanzie per (?:intermediari|istituti di credito)\s*[-–]\s*Riepilogo generale", "FG")]
CLOSED = r"(?i)Totale Complessivo|Totali\b"
GROUP_SUFFIX, SALDI, RELATION = "APPENDICE", "SALDI", "REL"
AMOUNT = r"\d{1,3}(?:\.\d{3})*,\d{2}"

#: Lines at the top, codes that make a list, body lines and characters of a cover, lines in which headings are looked for.
TOP, LISTED_LEAST, COVER_LINES, COVER_CHARS, HEADING_LINES, TITLE_LINES, BARE_LINES, SECTION_LINES = 12, 6, 8, 160, 40, 6, 8, 3


def _none() -> Column:
    return F.lit(None).cast("string")


def found(text: Column, rule: str, group: int = 1) -> Column:
    """A group of the first match, null where there is no match or the group is empty."""
    return F.nullif(F.regexp_extract(text, rule, group), F.lit(""))


def first_of(values: Column, take) -> Column:  # noqa: ANN001
    """The first that take() makes of the values and that isn't null."""
    return F.try_element_at(F.filter(F.transform(values, take), lambda x: x.isNotNull()), F.lit(1))


def head(ls: Column, n: int) -> Column:
    return F.slice(ls, F.lit(1), F.lit(n))


def joined(ls: Column, n: int = 2) -> Column:
    """Every line with those after it, n in all, blank between; codes and keywords break across lines."""
    return F.transform(ls, lambda _, i: F.array_join(F.slice(ls, i + 1, F.lit(n)), " "))


# ---------------------------------------------------------------- whose


def classify(text: Column) -> Column:
    """struct(authority, article, annex): the first body whose own marks the page carries, null for none."""
    one = lambda a, b, x=None: F.struct(F.lit(a).alias("authority"), F.lit(b).cast("string").alias("article"), (_none() if x is None else x).alias("annex"))
    dogane = reduce(lambda rest, q: F.when(text.rlike(q[0]), one("DOG", q[1])).otherwise(rest), reversed(QUALIFIED[:-1]), one("DOG", QUALIFIED[-1][1]))
    return F.when(text.rlike(DIFESA), one("DIFESA", "A2C6", F.upper(F.regexp_extract(text, DIFESA, 1)))).when(text.rlike(DOGANE), dogane).when(text.rlike(MEF), one("MEF", None)).when(text.rlike(MAE), one("MAE", None))


def is_mef_section(text: Column) -> Column:
    """The ministry's banner, however its letters are spaced."""
    s = squeezed(text)
    return s.contains("DipartimentodelTesoroDirezioneV") | s.contains("art.27")


# ---------------------------------------------------------------- what kind of page


def is_blank(ls: Column) -> Column:
    """No line, barcodes alone, or the one line that says so."""
    return (F.size(ls) == 0) | F.forall(ls, lambda x: x.rlike(r"^\s*\*\d{6,}\*\s*$")) | ((F.size(ls) == 1) & F.upper(ls[0]).contains("BIANCA"))


def no_text_layer(ls: Column) -> Column:
    """A scanned page: lines, but only the act's running header and folio."""
    return (F.size(ls) > 0) & F.forall(ls, lambda x: x.rlike(FURNITURE) | x.rlike(PAGE_NUMBER) | x.contains("LXVII"))


def body_lines(text: Column) -> Column:
    return F.filter(lines(text), lambda x: ~x.rlike(FURNITURE) & ~x.rlike(PAGE_NUMBER))


def caption(code: Column) -> Column:
    """What a customs page prints for a code, blanks squeezed out."""
    base = F.regexp_replace(code, f"^(.+){GROUP_SUFFIX}$", "$1")
    return F.upper(F.concat(F.lit("TAB."), base, F.when(base != code, f"-{GROUP_SUFFIX}").otherwise("")))


def is_table_cover(text: Column, code: Column) -> Column:
    """A few short lines that end in the table's own caption: its cover, not a page of data."""
    body = body_lines(text)
    size = F.aggregate(F.transform(body, F.length), F.lit(0), lambda a, x: a + x)
    return F.size(body).between(1, COVER_LINES) & (size <= COVER_CHARS) & F.endswith(F.upper(squeezed(F.array_join(body, ""))), caption(code))


def names_table(text: Column, code: Column) -> Column:
    """The page prints the code's caption, letters spaced as they may be, and not as the start of a longer one."""
    letters = F.regexp_replace(F.regexp_replace(caption(code), r"(.)(?!$)", r"$1\\s*"), r"\.", "[.]")
    longer = F.when(F.endswith(code, F.lit(GROUP_SUFFIX)), "").otherwise(r"(?!\s*-\s*" + r"\s*".join(GROUP_SUFFIX) + ")")
    return F.rlike(F.upper(text), F.concat(letters, F.lit("(?![A-Z0-9])"), longer))


def is_allegato_page(text: Column) -> Column:
    return squeezed(text).rlike(r"All\.\d+[-:]")


def is_index_page(ls: Column) -> Column:
    return F.exists(head(ls, TOP), lambda x: x.contains("SEGNALAZIONI"))


def is_pasted(text: Column) -> Column:
    """A page of the official gazette, bound into the volume."""
    return squeezed(text).rlike("(?i)GAZZETTAUFFICIALE")


def listing_codes(text: Column) -> Column:
    """Distinct codes, in printed order, of a page that lists tables; none for other pages.

    The heading stands in the top lines, and a list has enough codes to be no mention. A row may break anywhere, so
    each line is read with the two after it.
    """
    ls = lines(text)
    codes = F.array_distinct(F.filter(F.transform(joined(ls, 3), lambda x: F.upper(F.regexp_extract(x, LISTED_ROW, 1))), lambda c: c != ""))
    listed = F.upper(squeezed(F.array_join(head(ls, TOP), "\n"))).rlike("ELENCOTABELLE|ELENCOGRAFICI|ELENCODELLETABELLE")
    return F.when(listed & (F.size(codes) >= LISTED_LEAST), codes).otherwise(F.array().cast("array<string>"))


def named_codes(ls: Column, top: int = TOP) -> Column:
    """All codes that the top lines name, inline or as a title."""
    some = head(ls, top)
    return F.array_distinct(F.concat(F.flatten(F.transform(some, lambda x: F.regexp_extract_all(x, F.lit(INLINE), F.lit(1)))), F.filter(F.transform(some, lambda x: F.regexp_extract(x, TITLED, 1)), lambda c: c != "")))


def page_class(text: Column, header_lines: int = 4) -> Column:
    """blank, indice, unreadable, header_only or content."""
    ls = lines(F.coalesce(text, F.lit("")))
    n = F.size(named_codes(ls))
    marked = F.upper(F.array_join(head(ls, TOP), " ")).rlike("ELENCO TABELLE|ELENCO GRAFICI|ELENCO DELLE TABELLE")
    numbered = F.exists(ls, lambda x: x.rlike(PAGE_NUMBER) & x.rlike("[-–—]"))
    return F.when(is_blank(ls), "blank").when((n >= 2) | (marked & (n >= 1)), "indice").when(is_garbled(text) | is_ciphered(text), "unreadable").when((F.size(ls) <= header_lines) & ~numbered, "header_only").otherwise("content")


def table_like(text: Column) -> Column:
    """Why an unclaimed page looks like a table: a mark of one, and content to go with it. Null for other pages."""
    body = body_lines(text)
    flat, run = F.array_join(body, "\n"), F.array_join(body, "")
    thin = (F.regexp_count(flat, F.lit(AMOUNT)) < 3) & (F.size(body) <= COVER_LINES)
    heading = F.exists(body, lambda x: x.rlike(EXHIBIT) & F.lower(x).startswith("tabella"))
    return F.when(~thin, F.when(run.rlike(MEF_EXHIBIT), "exhibit caption").when(flat.rlike(DOGANE), "code").when(heading, "numbered heading").when(flat.rlike(r"(?i)\bPag(?:ina|\.)?\s*\d+\s*di\s*\d+"), "stamp"))


# ---------------------------------------------------------------- which table


def normalise_digit_one(code: Column) -> Column:
    """A capital I in the place of a digit is one."""
    return F.when(code.rlike("^.I$"), F.concat(F.substring(code, 1, 1), F.lit("1"))).otherwise(code)


def same_table(a: Column, b: Column) -> Column:
    """Equal, or one has one more capital at the end of its letters, of which the other has two at least. Digits decide."""
    part = lambda c, k: F.regexp_extract(c, "^([A-Za-z]*)(.*)$", k)
    short, long = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    near = (F.length(long) == F.length(short) + 1) & (part(short, 2) == part(long, 2)) & F.startswith(part(long, 1), part(short, 1)) & (F.length(part(short, 1)) >= 2)
    return (a == b) | near


def appendix_code(ls: Column) -> Column:
    """The appendix that a page opens, as a code of its own; its keyword may break onto the next line."""
    probe = lambda x, pair: F.coalesce(found(x, APPENDED), found(pair, APPENDED))
    code = first_of(F.arrays_zip(ls.alias("a"), joined(ls).alias("b")), lambda p: probe(p["a"], p["b"]))
    return F.concat(code, F.lit(GROUP_SUFFIX))


def cover_code(ls: Column) -> Column:
    """The code on the line after a keyword that a cover cut off."""
    after = F.concat(F.slice(ls, F.lit(2), F.greatest(F.size(ls), F.lit(1))), F.array(_none()))
    pick = lambda p: F.when(p["a"].rlike(CUT_KEYWORD) & p["b"].rlike(BELOW_KEYWORD), F.concat(F.regexp_extract(p["b"], BELOW_KEYWORD, 1), F.when(F.upper(p["b"]).contains(GROUP_SUFFIX), GROUP_SUFFIX).otherwise("")))
    return first_of(F.arrays_zip(ls.alias("a"), after.alias("b")), pick)


def stamp_code(ls: Column) -> Column:
    """What the export stamp names: a code, or a bare word of a report."""
    return first_of(ls, lambda x: F.coalesce(found(x, STAMPED, 1), found(x, STAMPED, 2)))


def stamp_tokens(chunk: Column) -> Column:
    """struct(word, first, second) of "Pagina N di X"; of a stamp in a font that can't be read, its stable shapes."""
    tokens = F.filter(F.split(chunk, r"\s+"), lambda x: x != "")
    at = F.array_position(F.transform(tokens, lambda x: x.rlike(r"(?i)^pagina\.*$")), F.lit(True)).cast("int")
    numbers = F.regexp_extract_all(F.array_join(F.slice(tokens, at + 1, F.lit(3)), " "), F.lit(r"\d+"), F.lit(0))
    made = lambda a, b, c: F.struct(a.alias("word"), b.alias("first"), c.alias("second"))
    tok, space = (lambda k: F.try_element_at(tokens, F.lit(k))), "\ue000"  # what the subsetted fonts print for a blank
    ends = lambda x, lo, hi: F.length(x).between(lo, hi) & x.endswith(space)
    shape = (F.size(tokens) >= 4) & ends(tok(1), 5, 8) & ends(tok(2), 2, 3) & (F.length(tok(3)) <= 4) & ~tok(3).contains(space) & (F.length(tok(4)) <= 4) & ~tok(4).contains(space)
    return F.when(at > 0, F.when(F.size(numbers) == 2, made(F.try_element_at(tokens, F.greatest(at, F.lit(1))), F.try_element_at(numbers, F.lit(1)), F.try_element_at(numbers, F.lit(2))))).when(shape, made(tok(1), tok(3), tok(4)))


def page_code(text: Column, vocabulary: Column, family: Column) -> Column:
    """struct(code, evidence) of the surest way in which a page names its one table; null for none.

    In this order: annex, appendix, listed (family 3), after_heading and title (not family 2), stamp, inline, cover. A
    mention inside a line counts for codes of the vocabulary; customs pages number their tables in a space of their own.
    """
    ls, nothing = lines(text), F.size(vocabulary) == 0
    title = lambda n: first_of(head(ls, n), lambda x: found(x, TITLED))
    heading = F.array_position(F.transform(head(ls, 14), lambda x: x.contains("Operazioni disciplinate")), F.lit(True)).cast("int")
    under = first_of(F.slice(ls, heading + 1, F.lit(3)), lambda x: F.when(x.rlike(f"^{CODE}$"), x))
    stamp = first_of(ls, lambda x: found(x, STAMPED, 1))
    known = lambda c: c.isin(FAMILY_2)
    named = F.flatten(F.transform(ls, lambda x: F.regexp_extract_all(x, F.lit(INLINE), F.lit(1))))
    free = F.when(nothing, ~F.lit(False)).otherwise(F.coalesce(classify(text)["authority"] == "DOG", F.lit(False)))
    inline = F.try_element_at(F.filter(named, lambda c: known(c) | ((family != 2) & F.when(nothing, ~c.isin(PROSE)).otherwise(F.array_contains(vocabulary, c) | free))), F.lit(1))
    styles = {
        "annex": F.upper(found(text, DIFESA)),
        "appendix": appendix_code(ls),
        "listed": F.when((family == 3) & ~nothing, normalise_digit_one(title(6))),
        "after_heading": F.when((family != 2) & (heading > 0), under),
        "title": F.when(family != 2, title(8)),
        "stamp": F.when(known(stamp) | ((family != 2) & F.array_contains(vocabulary, stamp)), stamp),
        "inline": inline,
        "cover": cover_code(ls),
    }
    return F.coalesce(*[F.when(c.isNotNull(), F.struct(c.alias("code"), F.lit(k).alias("evidence"))) for k, c in styles.items()])


def page_code_listed(ls: Column, listed: Column, banner: Column) -> Column:
    """The code of a table that the volume's own list promises and this page of the ministry opens; null for none."""
    is_listed = lambda c: F.exists(listed, lambda k: same_table(c, k))
    start = F.greatest(F.array_position(F.transform(ls, lambda x: x.contains("disciplinate") | x.contains("ipartimento")), F.lit(True)).cast("int"), F.lit(1))
    titled = first_of(F.slice(joined(ls, 3), start, F.lit(TITLE_LINES + 2)), lambda x: F.when(is_listed(found(x, LISTED_TITLE)), found(x, LISTED_TITLE)))
    bare = first_of(F.slice(ls, F.lit(1), start - 1 + BARE_LINES), lambda x: F.when(x.rlike(f"^{CODE}$") & is_listed(x), x))
    return F.when((F.size(listed) > 0) & banner, F.coalesce(titled, bare))


def section_open(ls: Column, promised: Column, banner: Column) -> Column:
    """The body whose section a page opens, no table named on it; null for other pages."""
    top_ = head(ls, SECTION_LINES)
    word = r"(?i)ministero|direzione|agenzia"
    code = F.exists(ls, lambda x: F.regexp_replace(x, r"\.+$", "").rlike(f"^{CODE}$") & F.exists(promised, lambda k: same_table(F.regexp_replace(x, r"\.+$", ""), k)))
    titled = F.exists(head(ls, SECTION_LINES + 2), lambda x: x.rlike(LISTED_TITLE) | x.rlike(TITLED))
    whole = first_of(top_, lambda x: F.when(x.rlike(word), x))
    shredded = found(F.regexp_replace(squeezed(F.array_join(top_, "\n")), r"^[0-9 .\-]+", ""), r"^(\p{Lu}+)")
    return F.when(squeezed(F.array_join(top_, "\n")).rlike(word) & ~code & ~titled & ~banner, F.coalesce(whole, shredded))


def verifier_code(ls: Column, vocabulary: Column) -> Column:
    """The verifier's own reading: only codes of the vocabulary, as printed before with the digit folded."""
    fold = lambda c: F.when(F.array_contains(vocabulary, F.upper(c)), F.upper(c)).when(F.array_contains(vocabulary, normalise_digit_one(F.upper(c))), normalise_digit_one(F.upper(c)))
    exhibit = first_of(head(ls, HEADING_LINES), lambda x: fold(rel_code(found(x, EXHIBIT.replace("|Grafico", ""), 2))))
    titled = first_of(ls, lambda x: fold(found(x, TITLED)))
    pairs = F.arrays_zip(ls.alias("a"), F.concat(F.slice(ls, F.lit(2), F.greatest(F.size(ls), F.lit(1))), F.array(_none())).alias("b"))
    below = first_of(pairs, lambda p: F.when(p["a"].rlike(r"(?i)^(?:tabella|tab\.|tab)$") & p["b"].rlike(f"^{CODE}$"), fold(p["b"])))
    inline = first_of(F.flatten(F.transform(ls, lambda x: F.regexp_extract_all(x, F.lit(INLINE), F.lit(1)))), fold)
    bare = first_of(head(ls, BARE_LINES), lambda x: F.when(x.rlike(f"^{CODE}$"), fold(x)))
    return F.coalesce(F.upper(found(F.array_join(ls, "\n"), DIFESA)), appendix_code(ls), cover_code(ls), exhibit, titled, below, inline, bare)


# ---------------------------------------------------------------- exhibits of the relation


def rel_code(number: Column) -> Column:
    """8.1 is T81; a printed code stays."""
    return F.when(number.rlike("^[0-9]"), F.concat(F.lit("T"), F.replace(number, F.lit("."), F.lit("")))).otherwise(number)


def rel_article(code: Column) -> Column:
    return F.when(~code.rlike(r"^T\d{1,3}$"), RELATION)


def rel_headings(ls: Column) -> Column:
    """Distinct (kind, number) that whole lines among the first forty open, in printed order."""
    one = lambda x: F.when(x.rlike(EXHIBIT), F.struct(F.regexp_extract(x, EXHIBIT, 1).alias("kind"), F.regexp_extract(x, EXHIBIT, 2).alias("number")))
    return F.array_distinct(F.filter(F.transform(head(ls, HEADING_LINES), one), lambda x: x.isNotNull()))


def relation_exhibits(pages: DataFrame, by: list[str], page: str = "page", text: str = "text") -> DataFrame:
    """by, page, exhibits (array of kind and code): what the ministry's relation opens on each page, or carries on.

    An exhibit stays open from its last caption until its grand total; on a page that neither opens another nor
    prints an amount it is lost. A title on its own opens one, unless the page is an annex or a caption just did.
    """
    titles = "|".join(p for p, _ in MEF_TITLES)
    coded, both = rf"(?:{MEF_EXHIBIT}(?:.{{0,2}}(?:{titles}))?)", rf"(?:Tabella\s+{CODE}\s+[-–]\s(?:.{{0,2}}(?:{titles}))?|Riepilogo saldi esportazioni ed? importazioni|{titles})"
    flat = F.replace(F.col(text), F.lit("\n"), F.lit(""))
    annex = F.col(text).rlike(r"ELENCO\s+TABELLE")
    marks = F.when(annex, F.regexp_extract_all(flat, F.lit(coded), F.lit(0))).otherwise(F.regexp_extract_all(flat, F.lit(both), F.lit(0)))
    code = lambda m: reduce(lambda rest, t: F.when(m.rlike(f"^{t[0]}"), t[1]).otherwise(rest), MEF_TITLES, F.coalesce(found(m, rf"^Tabella\s+({CODE})"), F.lit(SALDI)))
    cut = lambda rule: F.when(annex, F.regexp_extract(flat, rule(coded), 1)).otherwise(F.regexp_extract(flat, rule(both), 1))
    p = pages.select(*by, page, F.transform(marks, code).alias("_codes"), cut(lambda m: f"^(.*?)(?:{m}|$)").alias("_head"), cut(lambda m: f"^.*({m}.*)$").alias("_tail"))
    opens, closed = F.size("_codes") > 0, F.col("_head").rlike(CLOSED)
    more = F.col("_head").contains("€") | closed
    settles = opens | ~(more & ~closed)  # what is open afterwards doesn't depend on what was before
    after = F.when(opens & ~F.col("_tail").rlike(CLOSED), F.element_at("_codes", -1))
    p = p.withColumn("_after", F.when(settles, F.struct(after.alias("v"))))
    was = F.last("_after", True).over(W.partitionBy(*by).orderBy(page).rowsBetween(W.unboundedPreceding, -1))["v"]
    p = p.withColumn("_was", was)
    one = lambda kind, c: F.struct(F.lit(kind).alias("kind"), c.alias("code"))
    none = F.array().cast("array<struct<kind:string,code:string>>")
    carried = F.when(F.col("_was").isNotNull() & more, F.array(one("Segue", F.col("_was")))).otherwise(none)
    return p.select(*by, page, F.concat(carried, F.transform("_codes", lambda c: one("Tabella", c))).alias("exhibits"))


# ---------------------------------------------------------------- vocabulary, names


def vocabulary(pages: DataFrame, by: list[str], code: str) -> DataFrame:
    """The codes of each volume, as one sorted array."""
    return pages.groupBy(*by).agg(F.sort_array(F.collect_set(code)).alias("codes"))  # a volume has a few hundred tables


def listed_family(codes: Column, by_doubles: Column | None = None) -> Column:
    """2 where four codes and more are of the second family alone, 3 where single letters abound, null for unknown.

    by_doubles: of editions whose lists mix bodies; there codes of two letters count too, and 1 is where they prevail.
    """
    count = lambda rule: F.size(F.filter(codes, lambda c: c.rlike(f"^{rule}$")))
    own = F.size(F.array_except(F.array_intersect(F.array_distinct(codes), F.array(*map(F.lit, FAMILY_2))), F.array(*map(F.lit, "DEILM"))))
    mixed = F.lit(False) if by_doubles is None else F.coalesce(by_doubles, F.lit(False))
    doubles, singles = count(r"[A-Z]{2}\d{0,2}"), count("[A-Z]")
    shaped = F.when(mixed, count(r"[A-Z]{1,2}\d{0,2}")).otherwise(count(r"[A-Z]\d?"))
    enough = (F.size(codes) >= 8) & (shaped >= 6)
    return F.when(own >= 4, 2).when(enough & mixed & (doubles >= 3) & (doubles >= singles), 1).when(enough & (singles >= 4), 3)


def family(codes: Column) -> Column:
    """listed_family, 1 for unknown."""
    return F.coalesce(listed_family(codes), F.lit(1))


def inline_codes(text: Column) -> Column:
    """All codes that a page names behind the word for table."""
    return F.regexp_extract_all(text, F.lit(INLINE), F.lit(1))


def safe_code(code: Column) -> Column:
    c = F.regexp_replace(F.upper(code), "[^A-Z0-9]+", "")
    return F.when(c == "", "TAB").otherwise(c)


def relative_path(authority: Column, article: Column, code: Column, year: Column, volume: Column, page: Column) -> Column:
    """Where a table's file lies: body, article if any, then code, year, volume and first page."""
    name = F.concat(safe_code(code), year.cast("string"), F.lit("V"), volume.cast("string"), F.lit("P"), page.cast("string"), F.lit(".PDF"))
    return F.concat_ws("/", authority, F.nullif(article, F.lit("")), name)


def parse_stem(stem: Column) -> Column:
    """struct(code, year, volume, page) of a file's name, null for other names."""
    rule = r"^(.+?)(\d{4})V(\d+)P(\d+)$"
    part = lambda k: F.regexp_extract(stem, rule, k)
    return F.when(stem.rlike(rule), F.struct(part(1).alias("code"), part(2).try_cast("int").alias("year"), part(3).try_cast("int").alias("volume"), part(4).try_cast("int").alias("page")))


# What the articles are about.
ARTICLES = {"A1C2": "art. 1 comma 2 -- operazioni a licenza", "A1C89": "art. 1 commi 8 lett. a) e 9 lett. a) -- coproduzione", "A11C5BIS": "art. 11 comma 5-bis -- licenze globali di progetto", "A10QUATER": "art. 10 quater -- autorizzazioni globali di trasferimento"}


def article_label(authority: Column, article: Column) -> Column:
    named = reduce(lambda rest, a: F.when(article == a, ARTICLES[a]).otherwise(rest), ARTICLES, article)
    return F.when(F.coalesce(article, F.lit("")) == "", "").when(authority == "DOG", named).when(authority == "DIFESA", "art. 2 comma 6 -- manutenzione e addestramento").otherwise(article)


def table_key(authority: Column, article: Column, code: Column) -> Column:
    return F.concat_ws("/", *[F.nullif(c, F.lit("")) for c in (authority, article, code)])


def open_exhibits(pages: DataFrame, by: list[str], order: str, opens: str, closes: str) -> DataFrame:
    """Adds `exhibit`: what a page opens, or what an earlier page opened and none has closed since.

    opens: name or null; closes: whether the page ends what is open (it still belongs to it).
    """
    before = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    closed = F.coalesce(F.sum(F.when(F.col(closes), 1).otherwise(0)).over(before), F.lit(0))
    p = pages.withColumn("_part", closed)
    return p.withColumn("exhibit", F.last(opens, True).over(upto([*by, "_part"], [order]))).drop("_part")


def any_of(text: Column, patterns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.rlike(p) for p in patterns])
