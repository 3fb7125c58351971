"""Headers of tables without a grid: the widest line of names above data, names stacked over lines, rules and body columns
as second opinions; and how much of a page is ruled. Page-local, over words in reading order.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.operators.geometry import COLUMN_EM
from pagelake.operators.grammar import HEADER_CHARS
from pagelake.operators.reader import CODE_WORD, NUMBER_WORD, TOLERANCE, _rows, bands

# Shares, counts and points that tell a header, and what is never one.
TEXT_SHARE, FOLLOW_SHARE, FOLLOWS, STACKED_CELLS, STACKED_LINES, EDGE, CONSENSUS, CONSENSUS_SHARE, WITHIN = 0.6, 0.6, 4, 3, 3, 8.0, 12.0, 0.6, 40
FURNITURE = re.compile(r"Pagina\s+\d+\s+di\s+\d+|CENTRO\s+INFORMATICO|Camera\s+dei\s+Deputati|Senato\s+della\s+Repubblica|LEGISLATURA|DISEGNI\s+DI\s+LEGGE|^TAB\.?\s|^Annesso\s", re.I)
HAIRLINE, RULE_LENGTH, CURVES = 3.0, 20.0, 200


def columns(band: list[dict]) -> list[dict]:
    """Cells of a line by its gaps: text, u0, u1, words."""
    em = max((w["size"] for w in band), default=0.0) or 1.0
    cells: list[list[dict]] = []
    for w in sorted(band, key=lambda w: w["u0"]):
        if cells and w["u0"] - cells[-1][-1]["u1"] < COLUMN_EM * em:
            cells[-1].append(w)
        else:
            cells.append([w])
    return [_cell(c) for c in cells]


def _cell(words: list[dict]) -> dict:
    return {"text": " ".join(" ".join(w["text"] for w in words).split()), "u0": min(w["u0"] for w in words), "u1": max(w["u1"] for w in words), "words": words}


def _is_name(text: str) -> bool:
    """Text that may name a column: no number, code or money, and no paragraph."""
    return not (NUMBER_WORD.match(text) or (CODE_WORD.match(text) and not re.match(r"^(?:19|20)\d{2}$", text))) and len(text) <= HEADER_CHARS


def _names(band: list[dict]) -> bool:
    cells = columns(band)
    return len(cells) >= 3 and all(_is_name(c["text"]) for c in cells) and sum(not re.match(r"^[\d/.\-]+$", c["text"]) for c in cells) >= TEXT_SHARE * len(cells)


def _doubled(band: list[dict]) -> bool:
    """A word printed twice at one place: a shadow, not a header."""
    return any(a["text"] == b["text"] and abs(a["u0"] - b["u0"]) <= 1.0 for c in columns(band) for a, b in zip(c["words"], c["words"][1:], strict=False))


def _followed(counts: list[int], at: int, cells: int) -> bool:
    return any(n >= FOLLOW_SHARE * cells for n in counts[at : at + FOLLOWS])


def single_line(lines: list[list[dict]]) -> tuple[int, list[dict]] | None:
    """(line, cells) of the line of names with most cells, the first of equals, that data follow."""
    counts, best = [len(columns(b)) for b in lines], None
    for i, b in enumerate(lines[:WITHIN]):
        if (i and _names(lines[i - 1])) or not _names(b) or _doubled(b) or any(FURNITURE.search(w["text"]) for w in b):
            continue
        cells = columns(b)
        if _followed(counts, i + 1, len(cells)) and (best is None or len(cells) > len(best[1])):
            best = (i, cells)
    return best


def _split(cell: dict) -> list[dict]:
    """A cell cut at its widest gap, if that is as wide as one between columns."""
    w = cell["words"]
    if len(w) < 2:
        return [cell]
    gaps = [b["u0"] - a["u1"] for a, b in zip(w, w[1:], strict=False)]
    k = gaps.index(max(gaps))
    return [cell] if gaps[k] < COLUMN_EM * (max(x["size"] for x in w) or 1.0) else [_cell(w[: k + 1]), _cell(w[k + 1 :])]


def _merged(group: list[list[dict]]) -> list[dict]:
    """Cells of stacked lines, those that overlap as one."""
    out: list[dict] = []
    for c in sorted((p for b in group for x in columns(b) for p in _split(x)), key=lambda c: c["u0"]):
        if out and min(out[-1]["u1"], c["u1"]) > max(out[-1]["u0"], c["u0"]):
            out[-1] = {"text": f"{out[-1]['text']} {c['text']}".strip(), "u0": out[-1]["u0"], "u1": max(out[-1]["u1"], c["u1"]), "words": out[-1]["words"] + c["words"]}
        else:
            out.append(c)
    return out


def consensus(lines: list[list[dict]], start: int) -> list[tuple[float, float]]:
    """Columns that most lines of the body agree on, if they are as many as its widest line has."""
    seen = [columns(b) for b in lines[start : start + 12]]
    seen = [c for c in seen if len(c) >= 3]
    if len(seen) < 3:
        return []
    out: list[list[float]] = []
    for u0, u1 in sorted((c["u0"], c["u1"]) for cells in seen for c in cells):
        if out and abs(u0 - out[-1][0]) <= CONSENSUS:
            out[-1] = [(out[-1][0] + u0) / 2, max(out[-1][1], u1), out[-1][2] + 1]
        else:
            out.append([u0, u1, 1])
    kept = [(a, b) for a, b, n in out if n >= max(2, int(CONSENSUS_SHARE * len(seen)))]
    return kept if len(kept) == max(map(len, seen)) and len(kept) >= 3 else []


def _between(rules: list[float], lo: float, hi: float) -> list[tuple[float, float]]:
    at = [x for x in rules if lo - TOLERANCE <= x <= hi + TOLERANCE]
    return list(zip(at, at[1:], strict=False))


def _label(cells: list[dict], lo: float, hi: float) -> str:
    """What stands over a column: words within its edges, else the cell at its middle, else the nearest."""
    for c in cells:
        inside = sorted((w for w in c["words"] if w["u1"] >= lo - EDGE and w["u0"] <= hi + EDGE), key=lambda w: w["u0"])
        if inside:
            return " ".join(w["text"] for w in inside)
    mid = (lo + hi) / 2
    return min(cells, key=lambda c: 0 if c["u0"] <= mid <= c["u1"] else abs((c["u0"] + c["u1"]) / 2 - mid))["text"]


def _relabelled(cells: list[dict], edges: list[tuple[float, float]]) -> list[dict]:
    return [{"text": " ".join(_label(cells, a, b).split()), "u0": a, "u1": b, "words": []} for a, b in edges]


def stacked_lines(lines: list[list[dict]], rules: list[float]) -> tuple[int, list[dict]] | None:
    """(first line, cells) of a header whose names lie over up to STACKED_LINES short lines. Where the body or the rules know
    more columns, these hold, and names are put to them by place.
    """
    counts = [len(columns(b)) for b in lines]
    for i in range(min(len(lines) - 1, WITHIN)):
        j = i
        while j < len(lines) and j - i < STACKED_LINES and counts[j] <= STACKED_CELLS and (j == i or not any(FURNITURE.search(w["text"]) for w in lines[j])):
            j += 1
        if j - i < 2:
            continue
        cells, exact = _merged(lines[i:j]), False
        ruled = _between(rules, min(c["u0"] for c in cells), max(c["u1"] for c in cells)) if rules else []
        for edges in (consensus(lines, j), ruled):
            if rules and len(edges) > max(len(cells), len(ruled) - 1):
                cells, exact = _relabelled(cells, edges), True
                break
        names = [c["text"] for c in cells]
        if len(cells) >= 3 and all(names) and (exact or all(len(t) <= HEADER_CHARS for t in names)) and all(_is_name(t[:HEADER_CHARS]) for t in names) and _followed(counts, j, len(cells)):
            return i, cells
    return None


def find_header(words: list[dict], rules: list[float]) -> tuple[int, list[dict]] | None:
    """(line, cells) of a page's header: one line of names, else stacked lines; rules that know more columns overrule both."""
    lines = bands(words)
    found = single_line(lines) or stacked_lines(lines, rules)
    if found and rules:
        i, cells = found
        ruled = _between(rules, min(c["u0"] for c in cells), max(c["u1"] for c in cells))
        if len(ruled) > len(cells):
            return i, _relabelled(cells, ruled)
    return found


def over(lines: list[list[dict]], at: int, cells: list[dict]) -> list[str]:
    """Labels with those of the line above that span them: `upper / lower`. The upper line must be text and cover most columns."""
    upper = columns(lines[at - 1]) if at else []
    if len(upper) < 2 or not all(_is_name(c["text"]) for c in upper):
        return [c["text"] for c in cells]
    spans = [next((u for u in upper if min(u["u1"], c["u1"]) > max(u["u0"], c["u0"])), None) for c in cells]
    if sum(s is not None for s in spans) < max(2, 0.6 * len(cells)):
        return [c["text"] for c in cells]
    return [f"{s['text']} / {c['text']}" if s else c["text"] for s, c in zip(spans, cells, strict=True)]


def unruled_headers(pages: DataFrame, by: list[str]) -> DataFrame:
    """by, line, labels, paths, edges of every page's header; null where none is found. pages: by, words, rules (array of u)."""

    @F.pandas_udf("struct<line:int,labels:array<string>,paths:array<string>,edges:array<double>>")
    def find(words: pd.Series, rules: pd.Series) -> pd.DataFrame:
        out = []
        for w, r in zip(words, rules, strict=True):
            got = find_header(ws := _rows(w), sorted(r) if r is not None else [])
            out.append((got[0], [c["text"] for c in got[1]], over(bands(ws), *got), [c["u0"] for c in got[1]]) if got else (None, None, None, None))
        return pd.DataFrame(out, columns=["line", "labels", "paths", "edges"])

    return pages.select(*by, find("words", "rules").alias("h")).select(*by, "h.*")


def rule_census(drawings: DataFrame, by: list[str]) -> DataFrame:
    """by, rects, rules, vertical, horizontal, curves, longest, ruled, charted. drawings: by, kind (re, l, c, qu), x0, y0, x1, y1.

    A filled box is no rule; a rule has a length; a page of many curves is a chart.
    """
    w, h = F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0"))
    line, box = F.col("kind") == "l", F.col("kind") == "re"
    span = F.when(line, F.sqrt(w * w + h * h)).when(box & (F.least(w, h) <= HAIRLINE), F.greatest(w, h))
    long = F.coalesce(span >= RULE_LENGTH, F.lit(False))
    n = lambda c: F.count_if(c)
    g = drawings.groupBy(*by).agg(n(box).alias("rects"), n(line).alias("rules"), n(line & long & (h > w)).alias("vertical"), n(line & long & (w >= h)).alias("horizontal"), n(F.col("kind").isin("c", "qu")).alias("curves"), F.round(F.coalesce(F.max(F.when(long, span)), F.lit(0.0)), 1).alias("longest"))
    return g.withColumns({"ruled": F.col("longest") >= RULE_LENGTH, "charted": F.col("curves") >= CURVES})


def orientation(x, y):  # noqa: ANN001, ANN201
    """upright, rot90, rot180 or rot270 of a writing direction."""
    return F.when((F.round(x) == 1) & (F.round(y) == 0), "upright").when((F.round(x) == 0) & (F.round(y) == 1), "rot270").when((F.round(x) == -1) & (F.round(y) == 0), "rot180").when((F.round(x) == 0) & (F.round(y) == -1), "rot90").otherwise("other")
