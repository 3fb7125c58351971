"""Predicates and extracts of one page's text, as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"[ \t\n\r\f\x0B]+"


def lines(text: Column) -> Column:
    """Trimmed lines that are not empty."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")


def squeezed(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def header_fingerprint(text: Column) -> Column:
    """First line without digits, spaces collapsed, 80 characters: the same on every page of a table."""
    first = F.coalesce(F.try_element_at(lines(text), F.lit(1)), F.lit(""))
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(first, r"\d+", " "), SPACES, " ")), 1, 80)


def share(text: Column, pattern: str, of: str) -> Column:
    """Characters of one class per character of another, which counts as one at least."""
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.lit(1), F.regexp_count(text, F.lit(of)))


def is_garbled(text: Column) -> Column:
    """No text, or more than 15 % private-use characters among letters and digits."""
    return F.coalesce(F.length(text) == 0, F.lit(True)) | (share(text, r"[\x{e000}-\x{f8ff}]", r"[\p{L}\p{N}]") > 0.15)


def vowel_share(text: Column) -> Column:
    """Plain vowels by letter; accented ones don't count, as a shifted alphabet has none of either."""
    return share(text, r"[aeiouAEIOU]", r"\p{L}")


def is_ciphered(text: Column) -> Column:
    """Forty letters or more, and control characters or a lack of vowels that no language has."""
    enough = F.regexp_count(text, F.lit(r"\p{L}")) >= 40
    return F.coalesce(enough & ((share(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", r"\p{L}") > 0.05) | (vowel_share(text) < 0.08)), F.lit(False))


def is_ciphered_line(line: Column) -> Column:
    """Any control character but the tab, or eight letters and more with hardly a vowel among them."""
    return line.rlike(r"[\x00-\x08\x0a-\x1f]") | ((F.regexp_count(line, F.lit(r"\p{L}")) >= 8) & (vowel_share(line) < 0.08))


#: Characters 3 to 93, but for the space, stand for those 29 further on.
SHIFT = 29
_CIPHER = "".join(chr(c) for c in range(3, 94) if c != 32)
_PLAIN = "".join(chr(c + SHIFT) for c in range(3, 94) if c != 32)


def unshift(line: Column) -> Column:
    return F.translate(line, _CIPHER, _PLAIN)


def shift(line: Column) -> Column:
    """What a shifted font makes of a line. For tests and made pages."""
    return F.translate(line, _PLAIN, _CIPHER)


def decipher(text: Column) -> Column:
    """The shifted lines of a ciphered page, read back; other lines and other pages as they are."""
    read = F.array_join(F.transform(F.split(text, "\n", -1), lambda x: F.when(is_ciphered_line(x), unshift(x)).otherwise(x)), "\n")
    return F.when(is_ciphered(text), read).otherwise(text)


def printed_numbers(text: Column) -> Column:
    """Numbers printed between dashes on lines of their own; a page may print two."""
    found = F.filter(lines(text), lambda x: x.rlike(r"^[-–—]\s*\d{1,4}\s*[-–—]$"))
    return F.array_distinct(F.transform(found, lambda x: F.regexp_extract(x, r"(\d+)", 1).cast("int")))


def after_line(text: Column, keyword: str) -> Column:
    """The line after the first that is just the keyword, for codes cut from their label; null if there is none."""
    ls = lines(text)
    at = F.array_position(F.transform(ls, F.upper), F.lit(keyword.upper()))
    return F.when(at > 0, F.try_element_at(ls, (at + 1).cast("int")))


def windows_of_lines(text: Column, size: int) -> Column:
    """Every line joined with those after it, `size` in all. The text is cut into lines once, not again for every line."""
    joined = lambda ls: F.transform(ls, lambda _, i: F.array_join(F.slice(ls, i + 1, F.lit(size)), " "))
    return F.get(F.transform(F.array(lines(text)), joined), F.lit(0))


def stems(text: Column, letters: str = "a-zà-ÿ0-9", length: int = 6) -> Column:
    """Distinct words of three letters or digits and more, cut to their first six."""
    words = F.regexp_extract_all(F.lower(text), F.lit(f"[{letters}]{{3,}}"), F.lit(0))
    return F.array_distinct(F.transform(words, lambda w: F.substring(w, 1, length)))


def deaccent(text: Column) -> Column:
    """Lower case, without accents, ligatures and apostrophes."""
    t = F.translate(F.lower(text), "àáâãäèéêëìíîïòóôõöùúûüçñ'’`", "aaaaaeeeeiiiiooooouuuucn")
    return F.replace(F.replace(t, F.lit("ﬁ"), F.lit("fi")), F.lit("ﬂ"), F.lit("fl"))


def sql_name(key: Column) -> Column:
    """A table key as an identifier: runs of anything else become one underscore, none at either end."""
    return F.regexp_replace(F.regexp_replace(F.lower(key), "[^a-z0-9]+", "_"), "^_|_$", "")


# How the annexes cite an article of the law, before or after its number.
CITED = r"(?i)art[\s._]*(\d+)(?:[\s._]*(?:comma|co|c)[\s._]*(\d+))?[^\n]{0,25}?185|185\s*/\s*90[^\n]{0,15}?art[\s._]*(\d+)(?:[\s._]*(?:comma|co|c)[\s._]*(\d+))?"


def cited_article(text: Column) -> Column:
    """A5 or A2C6 from the first citation of an article of law 185; other articles do not count."""
    part = lambda *ks: F.concat(*[F.regexp_extract(text, CITED, k) for k in ks])
    return F.when(text.rlike(CITED), F.concat(F.lit("A"), part(1, 3), F.when(part(2, 4) != "", F.concat(F.lit("C"), part(2, 4))).otherwise("")))


def undecoded(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[\x{e000}-\x{f8ff}]"))


def decode(text: Column, glyphs: Column) -> Column:
    """Characters replaced where the map names one."""
    return F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(glyphs, c), c)), "")


def normalised(text: Column) -> Column:
    """Compatibility-composed (NFKC), spaces collapsed. The one function here that Spark has no expression for."""

    @F.pandas_udf("string")
    def nfkc(s):  # noqa: ANN001, ANN202
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))

    return F.trim(F.regexp_replace(nfkc(text), r"\s+", " "))
