"""Queries of page predicates: whose page, which kind, which table, lists, covers, stamps, exhibits, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.functions import pages, text
from pagelake.plans.made import dealt, told
from pagelake.sources.tables import table

C = F.col


def _lines() -> Column:
    return text.lines(C("text"))


# ---------------------------------------------------------------- whose page

OWNERS = {
    "MINISTERO DELLA difesa - Annesso 3A\nTAB. D1": ("DIFESA", "A2C6", "3A"),
    "x\nTAB. M esportazioni": ("DOG", "A1C2", None),
    "Licenze  Globali di Progetto\nTAB. MG1": ("DOG", "A11C5BIS", None),
    "Programmi di Coproduzione Intergovernativi\nT AB .\nM2\n": ("DOG", "A1C89", None),
    "autorizzazioni globali di trasferimento TAB. T": ("DOG", "A10QUATER", None),
    "testo\nTabella AA\nriga": ("MEF", None, None),
    "Dipartimento del  Tesoro Direzione V": ("MEF", None, None),
    "MAECI - UAMA - CENTRO INFORMATICO  Pagina 1 di 2": ("MAE", None, None),
    "elenco TAB A1 riga": (None, None, None),
    "Dipartimento del Tesoro, in prosa": (None, None, None),
    "Annesso 3 senza ministero": (None, None, None),
}
BANNERS = [False, False, False, False, False, False, True, False, False, False, False]


def page_owner(spark: SparkSession, d: str) -> DataFrame:
    p = dealt(spark, d, {"text": list(OWNERS)}).withColumn("c", pages.classify(C("text")))
    return p.select("p_partkey", "c.authority", "c.article", "c.annex", pages.is_mef_section(C("text")).alias("banner"))


# ---------------------------------------------------------------- kinds of pages

KINDS = [  # text, blank, scanned, class, table_like, pasted, allegato, index
    ("", True, False, "blank", None, False, False, False),
    ("*190670036670*\n *1906700*", True, False, "blank", None, False, False, False),
    ("Pagina Bianca", True, False, "blank", None, False, False, False),
    ("XIX LEGISLA TURA\n- 12 -\nDOC. LXVII", False, True, "content", None, False, False, False),
    ("ELENCO TABELLE SEGNALAZIONI\nTabella AA\naltro testo qui", False, False, "indice", None, False, False, True),
    ("TAB. A1 e TAB. B2\nprosa\nprosa\nprosa\nprosa", False, False, "indice", None, False, False, False),
    (" a\nb\nc\nd\ne", False, False, "unreadable", None, False, False, False),
    ("Titolo\nsolo", False, False, "header_only", None, False, False, False),
    ("TAB. A1\n1.000,00\n2,00\n3,10\n4,00", False, False, "content", "code", False, False, False),
    ("Tabella 8.1\n1.000,00 e 2,00 e 3,10\nx\ny\nz", False, False, "content", "numbered heading", False, False, False),
    ("Pagina 3 di 9\n" + "\n".join(f"riga {k}" for k in "abcdefghi"), False, False, "content", "stamp", False, False, False),
    ("Riepilogo saldi esportazioni e importazioni\n1,00\n2,00\n3,00\nx", False, False, "content", "exhibit caption", False, False, False),
    ("G A Z Z E T T A  U F F I C I A L E\na\nb\nc\nd", False, False, "content", None, True, False, False),
    ("All . 3 - Riepilogo\na\nb\nc\nd", False, False, "content", None, False, True, False),
]


def page_kind(spark: SparkSession, d: str) -> DataFrame:
    p = dealt(spark, d, {"text": [k[0] for k in KINDS]})
    t = C("text")
    return p.select("p_partkey", pages.is_blank(_lines()).alias("blank"), pages.no_text_layer(_lines()).alias("scanned"), pages.page_class(t).alias("class"), pages.table_like(t).alias("like_table"), pages.is_pasted(t).alias("pasted"), pages.is_allegato_page(t).alias("allegato"), pages.is_index_page(_lines()).alias("index"))


# ---------------------------------------------------------------- codes

CODES = [  # text, vocabulary, family, code, evidence, verifier's code
    ("Ministero della Difesa Annesso 4\nTAB. A1", ["A1"], 1, "4", "annex", "4"),
    ("x\nT AB. M -\nAPPENDICE", [], 1, "MAPPENDICE", "appendix", "MAPPENDICE"),
    ("Tabella DI\nriga", ["D1", "E"], 3, "D1", "listed", "D1"),
    ("Operazioni disciplinate dall'art. 27\nAA\nx", ["AA"], 1, "AA", "after_heading", "AA"),
    ("Operazioni disciplinate\nuno\ndue\ntre\nAA", [], 2, None, None, None),
    ("testo\nTabella AA1\nriga", ["AA1"], 1, "AA1", "title", "AA1"),
    ("riga\nMAECI CENTRO INFORMATICO Pagina 2 di 5 TAB M1", [], 2, "M1", "stamp", None),
    ("si veda la tabella KK1 oltre", ["KK1"], 1, "KK1", "inline", "KK1"),
    ("si veda la tabella KK1 oltre", ["AA"], 1, None, None, None),
    ("si veda la TABELLA DEI prezzi", [], 1, None, None, None),
    ("Riepilogo TAB. MG1 operatore", ["AA"], 1, "MG1", "inline", None),
    ("Riepilogo\nTabella .\nF2 - APPENDICE", ["F2"], 1, "F2APPENDICE", "cover", "F2APPENDICE"),
    ("Tabella 8.1 (parte 1 di 2)\nx", ["T81"], 1, None, None, "T81"),
    ("tab\nB3\nx", ["B3"], 1, None, None, "B3"),
    ("niente di niente", ["B3"], 1, None, None, None),
]


def page_code(spark: SparkSession, d: str) -> DataFrame:
    p = dealt(spark, d, {"text": [c[0] for c in CODES], "vocabulary": [c[1] for c in CODES], "family": [c[2] for c in CODES]})
    p = p.withColumn("c", pages.page_code(C("text"), C("vocabulary"), C("family")))
    return p.select("p_partkey", "c.code", "c.evidence", pages.verifier_code(_lines(), C("vocabulary")).alias("own_reading"))


BANNER = "Dipartimento del Tesoro Direzione V\n"
PROMISED = ["UE", "IAA", "FG", "KK1"]
LISTED = [  # text, code, section
    (BANNER + "Ta\nbella FG - Finanziamenti\nx", "FG", None),
    (BANNER + "Tabella IA - Intermediazioni", "IA", None),
    (BANNER + "\n".join("abcde") + "\nKK1\nx", "KK1", None),
    (BANNER + "Tabella ZZ - altro", None, None),
    ("Tabella FG - senza banner", None, None),
    ("DIR\nEZIONE DOG\nANE\nUfficio", None, "DIREZIONEDOGANE"),
    ("12\nMinistero della Difesa\nrelazione", None, "Ministero della Difesa"),
    ("Ministero della Difesa\nUE.\nx", None, None),
    ("Ministero della Difesa\nTabella UE - titolo", None, None),
    ("Prosa senza nomi", None, None),
]


def page_promised(spark: SparkSession, d: str) -> DataFrame:
    p = dealt(spark, d, {"text": [k[0] for k in LISTED]})
    promised, banner = F.array(*map(F.lit, PROMISED)), pages.is_mef_section(C("text"))
    return p.select("p_partkey", pages.page_code_listed(_lines(), promised, banner).alias("code"), pages.section_open(_lines(), promised, banner).alias("section"))


LISTINGS = [
    ("ELENCO TABELLE\n" + "\n".join(f"Tabella A{k} titolo" for k in range(1, 8)), "A1,A2,A3,A4,A5,A6,A7"),
    ("Elenco delle\ntabelle\n" + "\n".join(f"Ta\nbella\nB{k}\ntitolo" for k in range(1, 8)), "B1,B2,B3,B4,B5,B6,B7"),
    ("ELENCO TABELLE\n" + "\n".join(f"TAB. {c} x" for c in ("II", "II1", "I", "II", "AA", "BB", "C")), "II,II1,I,AA,BB,C"),
    ("ELENCO TABELLE\nTabella A1\nTabella A2", ""),
    ("\n".join(f"riga {k}" for k in range(12)) + "\nELENCO TABELLE\n" + "\n".join(f"Tabella A{k}" for k in range(1, 8)), ""),
]


def page_listing(spark: SparkSession, d: str) -> DataFrame:
    p = dealt(spark, d, {"text": [k[0] for k in LISTINGS]})
    return p.select("p_partkey", F.array_join(pages.listing_codes(C("text")), ",").alias("codes"))


COVERS = [  # text, code, cover, names
    ("Senato della Repubblica\n- 3 -\nRiesportazione (RE)\nT\nAB. M - APPENDICE", "MAPPENDICE", True, True),
    ("Riesportazione\nTAB. M1", "M", False, False),
    ("Riesportazione\nTAB. M - APPENDICE", "M", False, False),
    ("Riesportazione\nT A B . M\nriga 5,00", "M", False, True),
    ("\n".join(f"riga {k}" for k in range(9)) + "\nTAB. M", "M", False, True),
    ("x" * 170 + "\nTAB. M", "M", False, True),
    ("Esportazione\nTAB. M", "M", True, True),
    ("XIX LEGISLA TURA\n- 4 -", "M", False, False),
]


def page_cover(spark: SparkSession, d: str) -> DataFrame:
    p = dealt(spark, d, {"text": [c[0] for c in COVERS], "code": [c[1] for c in COVERS]})
    return p.select("p_partkey", pages.is_table_cover(C("text"), C("code")).alias("cover"), pages.names_table(C("text"), C("code")).alias("names"))


STAMPS = [  # chunk, word, first, second, stamp code, printed numbers
    ("MAECI - CENTRO INFORMATICO Pagina 80 di 537 TAB A1", "Pagina", "80", "537", "A1", ""),
    ("pagina 5 5di", "pagina", "5", "5", None, ""),
    ("Pagina 7", None, None, None, None, ""),
    ("abcdef xy 12 345 A1", "abcdef", "12", "345", None, ""),
    ("CENTRO INFORMATICO riepilogo VALORE", None, None, None, "VALORE", ""),
    ("– 1103 –\n- 12 -\n2015\n– III –\n– 1103 –", None, None, None, None, "1103,12"),
]


def page_stamp(spark: SparkSession, d: str) -> DataFrame:
    p = dealt(spark, d, {"text": [c[0] for c in STAMPS]}).withColumn("s", pages.stamp_tokens(C("text")))
    return p.select("p_partkey", "s.word", "s.first", "s.second", pages.stamp_code(_lines()).alias("code"), F.array_join(text.printed_numbers(C("text")), ",").alias("numbers"))


# ---------------------------------------------------------------- names of tables

SAME = [("AA", "AA", True), ("IA", "IAA", True), ("IAA", "IA", True), ("AA", "AA1", False), ("F", "FG", False), ("II", "II1", False), ("AB1", "ABC1", True), ("AB", "CD", False)]


def same_table_pair(spark: SparkSession, d: str) -> DataFrame:
    p = dealt(spark, d, {"a": [x[0] for x in SAME], "b": [x[1] for x in SAME]})
    return p.select("p_partkey", pages.same_table(C("a"), C("b")).alias("same"), pages.normalise_digit_one(C("a")).alias("folded"))


NAMES = [  # authority, article, code, path, label, key
    ("MAE", None, "A1", "MAE/A12025V2P80.PDF", "", "MAE/A1"),
    ("DOG", "A1C2", "m-appendice", "DOG/A1C2/MAPPENDICE2025V2P80.PDF", "art. 1 comma 2 -- operazioni a licenza", "DOG/A1C2/m-appendice"),
    ("DIFESA", "A2C6", "3A", "DIFESA/A2C6/3A2025V2P80.PDF", "art. 2 comma 6 -- manutenzione e addestramento", "DIFESA/A2C6/3A"),
    ("MEF", "REL", "--", "MEF/REL/TAB2025V2P80.PDF", "REL", "MEF/REL/--"),
    ("DOG", "A99", "T", "DOG/A99/T2025V2P80.PDF", "A99", "DOG/A99/T"),
]


def table_names(spark: SparkSession, d: str) -> DataFrame:
    p = dealt(spark, d, {"authority": [n[0] for n in NAMES], "article": [n[1] for n in NAMES], "code": [n[2] for n in NAMES]})
    path = pages.relative_path(C("authority"), C("article"), C("code"), F.lit(2025), F.lit(2), F.lit(80))
    p = p.withColumn("path", path).withColumn("stem", pages.parse_stem(F.regexp_extract("path", r"([^/]+)\.PDF$", 1)))
    return p.select("p_partkey", "path", pages.article_label(C("authority"), C("article")).alias("label"), pages.table_key(C("authority"), C("article"), C("code")).alias("key"), C("stem.code").alias("stem_code"), C("stem.year").cast("bigint").alias("stem_year"), C("stem.page").cast("bigint").alias("stem_page"), pages.parse_stem(F.lit("relazione")).isNull().alias("other"))


CITES = [("ai sensi dell'art. 5. Legge n.185/90", "A5"), ("Art.2 co.6 L. 185", "A2C6"), ("ART.2 comma 6 L.185", "A2C6"), ("L. 185/90 art_2co6", "A2C6"), ("art. 3 del codice", None), ("art. 7 L. 185 e art. 9 L. 185", "A7")]


def cited_articles(spark: SparkSession, d: str) -> DataFrame:
    return dealt(spark, d, {"text": [c[0] for c in CITES]}).select("p_partkey", text.cited_article(C("text")).alias("article"))


# ---------------------------------------------------------------- exhibits of the relation

RELATION = [  # text; codes opened; amounts before the first; closed before the first; closed after the last
    ("Tabella UE - Riepilogo saldi importazioni intracomunitarie\n€ 10,00", "UE", False, False, False),
    ("€ 5,00\nancora", "", True, False, False),
    ("€ 6,00 Totale Complessivo € 11,00", "", True, True, False),
    ("prosa senza importi", "", False, False, False),
    ("€ 1,00 Totali\nLicenze Globali di programma di cooperazione\n€ 2", "LGP", True, True, False),
    ("Riepilogo saldi esportazioni e importazioni\n1 Totali\nTabella FG - x\nTotale complessivo", "SALDI,FG", False, False, True),
    ("ELENCO TABELLE\nLicenze Globali di programma di cooperazione\nTabella KK1 - y", "KK1", False, False, False),
]


def relation_exhibits(spark: SparkSession, d: str) -> DataFrame:
    p = dealt(spark, d, {"text": [r[0] for r in RELATION]}).join(table(spark, d, "part").select("p_partkey", "p_brand"), "p_partkey")
    out = pages.relation_exhibits(p, ["p_brand"], "p_partkey")
    return out.select("p_partkey", F.array_join(F.transform("exhibits", lambda e: F.concat(e["kind"], F.lit(":"), e["code"])), ",").alias("exhibits"))


def _case(k: int) -> str:
    return "CASE p_partkey % 7 " + " ".join(f"WHEN {i} THEN {str(r[k]).lower() if isinstance(r[k], bool) else repr(r[k])}" for i, r in enumerate(RELATION)) + " END"


RELATION_SQL = f"""WITH p AS (SELECT p_partkey, p_brand, {_case(1)} AS codes, {_case(2)} AS more, {_case(3)} AS shut, {_case(4)} AS ended FROM part),
s AS (SELECT *, CASE WHEN codes <> '' THEN CASE WHEN ended THEN '-' ELSE string_split(codes, ',')[-1] END WHEN more AND NOT shut THEN NULL ELSE '-' END AS event FROM p),
o AS (SELECT *, nullif(last_value(event IGNORE NULLS) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '-') AS was FROM s)
SELECT p_partkey, array_to_string(list_concat(CASE WHEN was IS NOT NULL AND more THEN ['Segue:' || was] ELSE [] END, CASE WHEN codes = '' THEN [] ELSE list_transform(string_split(codes, ','), lambda c: 'Tabella:' || c) END), ',') AS exhibits FROM o"""

HEADINGS = [("Tabella 8.3\nx\nTabella 8.4", "Tabella 8.3,Tabella 8.4", "T83,T84"), ("SEGUE Tabella 18 (parte 1 di 2)\nTabella 18 (parte 2 di 2)", "Tabella 18", "T18"), ("Tabella 3\nGrafico 2", "Tabella 3,Grafico 2", "T3,T2"), ("Nella Tabella 6 si vede", "", ""), ("\n".join("x" * 40) + "\nTabella 9", "", "")]


def relation_headings(spark: SparkSession, d: str) -> DataFrame:
    p = dealt(spark, d, {"text": [h[0] for h in HEADINGS]}).withColumn("h", pages.rel_headings(_lines()))
    return p.select("p_partkey", F.array_join(F.transform("h", lambda x: F.concat_ws(" ", x["kind"], x["number"])), ",").alias("headings"), F.array_join(F.transform("h", lambda x: pages.rel_code(x["number"])), ",").alias("codes"), pages.rel_article(F.lit("UE")).alias("article"))


FAMILIES = [(["A1", "A2", "B1", "C1"], 2), (["D", "E", "I", "L", "M"], 1), (["A", "B", "C", "D", "E1", "F", "G", "H"], 3), (["AA", "BB"], 1), ([], 1)]


def code_family(spark: SparkSession, d: str) -> DataFrame:
    return dealt(spark, d, {"codes": [f[0] for f in FAMILIES]}).select("p_partkey", pages.family(C("codes")).cast("bigint").alias("family"))


CIPHERED = "Licenza rilasciata operatore di sistemi elettronici"
CLEAR = [  # text as printed, deciphered, garbled
    ("testo in chiaro", "testo in chiaro"), ("Running header\n" + CIPHERED, None), ("", ""), ("xxxx yyyy zzzz", "xxxx yyyy zzzz")]


def decipher_pages(spark: SparkSession, d: str) -> DataFrame:
    shown = F.when(C("kind") == 1, F.concat(F.lit("Camera dei Deputati\n"), text.shift(F.lit(CIPHERED)))).otherwise(C("text"))
    p = dealt(spark, d, {"text": [c[0] for c in CLEAR]}).withColumn("shown", shown)
    return p.select("p_partkey", text.decipher(C("shown")).alias("read"), text.is_ciphered(C("shown")).alias("ciphered"))


def _col(cases: list[tuple], k: int) -> list:
    return [c[k] for c in cases]


owners = list(OWNERS.values())
QUERIES = {
    "page_owner": (page_owner, told({"authority": _col(owners, 0), "article": _col(owners, 1), "annex": _col(owners, 2), "banner": BANNERS})),
    "page_kind": (page_kind, told({n: _col(KINDS, k + 1) for k, n in enumerate(("blank", "scanned", "class", "like_table", "pasted", "allegato", "index"))})),
    "page_code": (page_code, told({"code": _col(CODES, 3), "evidence": _col(CODES, 4), "own_reading": _col(CODES, 5)})),
    "page_promised": (page_promised, told({"code": _col(LISTED, 1), "section": _col(LISTED, 2)})),
    "page_listing": (page_listing, told({"codes": _col(LISTINGS, 1)})),
    "page_cover": (page_cover, told({"cover": _col(COVERS, 2), "names": _col(COVERS, 3)})),
    "page_stamp": (page_stamp, told({n: _col(STAMPS, k + 1) for k, n in enumerate(("word", "first", "second", "code", "numbers"))})),
    "same_table_pair": (same_table_pair, told({"same": _col(SAME, 2), "folded": ["AA", "IA", "IAA", "AA", "F", "I1", "AB1", "AB"]})),
    "table_names": (table_names, told({"path": _col(NAMES, 3), "label": _col(NAMES, 4), "key": _col(NAMES, 5), "stem_code": ["A1", "MAPPENDICE", "3A", "TAB", "T"], "stem_year": [2025] * 5, "stem_page": [80] * 5, "other": [True] * 5})),
    "cited_articles": (cited_articles, told({"article": _col(CITES, 1)})),
    "relation_exhibits": (relation_exhibits, RELATION_SQL),
    "relation_headings": (relation_headings, told({"headings": _col(HEADINGS, 1), "codes": _col(HEADINGS, 2), "article": ["REL"] * 5})),
    "code_family": (code_family, told({"family": _col(FAMILIES, 1)})),
    "decipher_pages": (decipher_pages, told({"read": ["testo in chiaro", f"Camera dei Deputati\n{CIPHERED}", "", "xxxx yyyy zzzz"], "ciphered": [False, True, False, False]})),
}
