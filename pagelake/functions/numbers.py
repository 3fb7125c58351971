"""Printed numbers, dates and the shapes of values, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the reports print for "nothing", for money, and how they print a number.
DASHES = ["", "-", "–", "—", "‐", "‑", "−", "_", ".", "n.d.", "N.D.", "nd", "ND", "n/a", "N/A", "/", "null", "NULL"]
MONEY = r"(?:€|EUR|euro)"
NUMBER = r"\s*([-−–—])?\s*(\()?\s*(\d{1,3}(?:[.\x{00a0} ]\d{3})*|\d+)([.,]\d{1,4})?\s*(\))?(?:\s*%)?(?:\s*(?:€|EUR|euro))?\s*"
PLAIN = r"^[1-9](?:\d{0,2}(?:\.\d{3})*|\d*),\d{1,4}\z"
TOTAL_WORDS = r"(?i)\b(?:totale|totali|complessivo|grand\s*total)\b"
DATE = r"(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{2,4})"
DECIMAL = "decimal(38,4)"
#: Cents within which a printed and a computed amount count as rounded.
TOLERANCE = "0.02"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _sign_after(text: Column) -> Column:
    """A sign before the currency, moved behind it."""
    return F.regexp_replace(stripped(text), rf"(?i)^([-−–])\s*({MONEY})\s*", "$2 $1")


def _bare(text: Column) -> Column:
    """Without the currency on either side."""
    return stripped(F.regexp_replace(F.regexp_replace(_sign_after(text), rf"(?i)\s*{MONEY}$", ""), rf"(?i)^{MONEY}\s*", ""))


def parse_number(text: Column) -> Column:
    """The amount that an Italian printed number stands for, or null. A chain of replacements, so each step is made once.

    What is no number becomes empty; the parts of a number are set apart by semicolons; whole numbers of two or three
    digits that begin with 0 are codes and become empty; points between thousands go; the sign, or both parentheses,
    come before; then the text is a decimal.
    """
    plain = F.when(text.rlike(PLAIN), F.translate(text, ",.", "."))  # most amounts: one look instead of nine replacements
    t = F.regexp_replace(_bare(text), rf"(?s)^(?!{NUMBER}$).*$", "")
    t = F.regexp_replace(t, f"^{NUMBER}$", "$1;$2;$3;$4;$5")
    t = F.regexp_replace(t, r"^[^;]*;[^;]*;0\d{1,2};(?:\.\d+)?;[^;]*$", "")
    t = F.regexp_replace(t, r"[.\x{00a0} ](?=[^;]*;[^;]*;[^;]*$)", "")
    t = F.regexp_replace(t, r"^(?:[-−–—];\(?;|;\(;(?=.*;\)$))(\d+);[.,]?(\d*);\)?$", "-$1.$2")
    t = F.regexp_replace(t, r"^;\(?;(\d+);[.,]?(\d*);\)?$", "$1.$2")
    return F.coalesce(plain, t).try_cast(DECIMAL)


def parse_date(text: Column) -> Column:
    """ISO text of day, month, year; two-digit years from 70 on are of the last century. Days are not checked by month."""
    rule = rf"^\s*{DATE}\s*$"
    d, m, y = (F.regexp_extract(text, rule, k).try_cast("int") for k in (1, 2, 3))
    year = F.when(y >= 100, y).when(y >= 70, y + 1900).otherwise(y + 2000)
    return F.when(d.between(1, 31) & m.between(1, 12), F.format_string("%04d-%02d-%02d", year, m, d))


def real_date(text: Column) -> Column:
    """The date, or null where the calendar has no such day."""
    return F.try_to_date(parse_date(text))


def value_shape(text: Column) -> Column:
    """What kind of value a cell prints; the first that fits, in this order.

    Money is money only where the currency leads; a currency that follows leaves a number.
    """
    raw, number = stripped(text), rf"^{NUMBER}$"
    signed = _sign_after(text)
    return (
        F.when(text.isNull() | (raw == ""), "empty")
        .when(raw.isin(DASHES), "dash")
        .when(signed.rlike(TOTAL_WORDS), "total_label")
        .when(signed.rlike(rf"(?i)^{MONEY}") & _bare(text).rlike(number), "currency")
        .when(signed.rlike(f"^{DATE}$"), "date")
        .when(signed.rlike(r"^(?:19|20)\d{2}$"), "year")
        .when(signed.rlike(r"^\d{1,6}$"), "code")
        .when(signed.rlike(number), F.when(signed.endswith("%"), "percent").otherwise("number"))
        .otherwise("text")
    )


def status(printed: Column, computed: Column) -> Column:
    """PASS, ROUNDING within the tolerance, FAIL, or UNCHECKED where nothing could be computed."""
    gap = F.abs(printed - computed)
    return F.when(computed.isNull() | printed.isNull(), "UNCHECKED").when(gap == 0, "PASS").when(gap <= F.lit(TOLERANCE).cast("decimal(4,2)"), "ROUNDING").otherwise("FAIL")


def money(c: Column) -> Column:
    return c.cast("decimal(18,2)")
