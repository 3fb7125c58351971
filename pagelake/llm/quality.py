"""Quality rules: counts of a text's own words and lines, and compression bands.

A text that zstandard shrinks far below its kind is repetitive; one that it cannot shrink is noise. What is
usual depends on length, so each length class has its own limits, for the whole text and for fixed chunks.
"""

from __future__ import annotations

import bisect
from collections import Counter

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import column, per_text, ship

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
NOT_STARTS = bytes(range(0x80, 0xC0))  # UTF-8 continuation bytes

#: Bytes from which a class holds (each half as long again by a factor of the square root of two), least and most
#: compressed share of a text or chunk of that length. Made by fit_limits on the labelled documents of the test data.
LIMITS = [
    (0, 0.672, 1.409), (200, 0.633, 1.024), (282, 0.596, 0.940), (400, 0.577, 0.906), (565, 0.529, 0.880), (800, 0.501, 0.821), (1_131, 0.485, 0.779), (1_600, 0.473, 0.742),
    (2_262, 0.460, 0.719), (3_200, 0.446, 0.694), (4_525, 0.432, 0.667), (6_400, 0.425, 0.658), (9_050, 0.418, 0.647), (12_800, 0.407, 0.639), (18_101, 0.401, 0.630), (25_600, 0.395, 0.621),
    (36_203, 0.389, 0.612), (51_200, 0.383, 0.603), (72_407, 0.377, 0.594), (102_400, 0.371, 0.585),
]
#: Labelled documents that limits are fitted on at most; share of the good ones that may lie below; slack below and above.
LABELLED, STRAY, SLACK_LOW, SLACK_HIGH = 20_000, 0.005, 0.004, 0.2
#: Chunks of so many bytes, the last one shorter; share of chunks outside their limits that rejects a text.
CHUNK, CHUNK_SHARE = 2_048, 0.5
LEVEL = 3
WINDOW = 5
#: Texts of more words count their windows with numpy, for bounded memory.
MANY_WORDS = 50_000


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of `width` words that occur twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    if len(words) <= MANY_WORDS:
        windows = list(zip(*(words[i:] for i in range(width)), strict=False))
        if len(set(windows)) == n:
            return 0
        seen = Counter(windows)
        again = np.fromiter((seen[x] > 1 for x in windows), bool, n)
    else:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words))
        names = ids[:n]
        for i in range(1, width):
            _, names = np.unique(names * len(number) + ids[i : i + n], return_inverse=True)
        again = np.bincount(names)[names] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(again), 1)
    np.add.at(edges, np.flatnonzero(again) + width, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def outside(size: int, share: float) -> bool:
    """Whether a compressed share lies outside the limits of its length class."""
    _, low, high = LIMITS[bisect.bisect([x[0] for x in LIMITS], size) - 1]
    return not low <= share <= high


def compression(raw: bytes) -> tuple[float, float]:
    """Compressed share of the whole text, and the share of its chunks (the last one too) that are outside their limits."""
    if not raw:
        return 0.0, 0.0
    pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress
    whole = len(pack(raw)) / len(raw)
    if len(raw) <= CHUNK:
        return whole, float(outside(len(raw), whole))
    chunks = [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]
    return whole, sum(outside(len(c), len(pack(c)) / len(c)) for c in chunks) / len(chunks)


def measure(raw: bytes) -> tuple:
    words = raw.split()
    n = len(words)
    word_chars = len(raw.translate(None, SPACE + NOT_STARTS))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    repeats = repeated_words(words)
    failed = n < 10 or 100 * repeats > 20 * n
    whole, odd = compression(raw)
    kept = not failed and not outside(len(raw), whole) and odd <= CHUNK_SHARE
    return n, word_chars, symbols, len(lines) - len(set(lines)), repeats, failed, whole, odd, kept


def classes(least: int = 200, most: int = 150_000) -> list[int]:
    """Bytes from which length classes hold: 0, then by the square root of two."""
    return [0, *[int(least * 2 ** (k / 2)) for k in range(2 * int(np.log2(most / least)) + 1)]]


def fit_limits(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> list[tuple[int, float, float]]:
    """LIMITS from labelled documents: least and most share of good ones that pass the base rules, by length class.

    labels: doc_id, quality (1: good). `most` documents at most, the first by a hash of their id; more add nothing to a
    few numbers a class. A class with fewer than 20 takes the least share a little below the class before.
    """
    good = labels.filter("quality = 1").select("doc_id").distinct()
    some = docs.join(good, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = [(r["size"], r["ratio"]) for r in per_text(some, lambda raw: (len(raw), *measure(raw)[5:7]), "size long, base_failed boolean, ratio double").filter("NOT base_failed AND size > 0").collect()]
    at, out = classes(), []
    for lo, hi in zip(at, [*at[1:], 1 << 62], strict=True):
        x = np.array([r for n, r in rows if lo <= n < hi])
        if len(x) < 20 and out:  # longer texts shrink a little better
            out.append((lo, round(out[-1][1] - 0.006, 3), round(out[-1][2] - 0.009, 3)))
        elif len(x):
            out.append((lo, round(float(np.quantile(x, STRAY)) - SLACK_LOW, 3), round(float(x.max()) + SLACK_HIGH, 3)))
    return out


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, odd_chunks double, kept boolean"


def quality(docs: DataFrame) -> DataFrame:
    """One row per row of docs: counts, base verdict, compression figures and the verdict `kept`.

    kept: the base holds, the whole text's compressed share is within the limits of its length, and no more than half of
    its chunks are outside theirs. Null or empty text: all counts 0, base_failed true. Repeated rows each get a row; a null doc_id stays
    null. Only doc_id and text are read, so other columns do not matter. No shuffle: a map over the scan.
    """
    return per_text(docs, measure, SCHEMA)


def keep(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, columns as they are; null and empty texts are rejected."""
    ship(docs.sparkSession)

    @F.pandas_udf("boolean")
    def kept(raws):  # noqa: ANN001, ANN202
        return raws.map(lambda raw: measure(raw)[-1])

    return docs.filter(kept(F.coalesce(column(docs, "text", "string"), F.lit("")).cast("binary")))
