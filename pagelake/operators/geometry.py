"""Words and ruling lines of a page to bands, columns and cells.

What only compares neighbours is a window expression. Two steps compare with the head of a growing group (bands,
floors); they run on the words of one page at a time, a few hundred rows, in applyInPandas.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.operators.ordered import cluster_near
from pagelake.operators.sets import first_in_group

# Fixed values, in points or in units of the letter size.
BAND_LEAST, BAND_EM, COLUMN_EM, FLOOR_TOLERANCE, OVERLAP_LEAST, TOUCHING = 1.5, 0.55, 1.2, 2.5, 0.30, 0.5
MIXED_SHARE = 0.2


def dominant_direction(words: DataFrame, by: list[str]) -> DataFrame:
    """by, dir_x, dir_y of most letters, and whether others have over a fifth of them."""
    n = words.groupBy(*by, F.round("dir_x", 3).alias("dir_x"), F.round("dir_y", 3).alias("dir_y")).agg(F.sum(F.length("text")).alias("n"))
    top = first_in_group(n, by, [F.desc("n"), "dir_x", "dir_y"])
    return top.join(n.groupBy(*by).agg(F.sum("n").alias("_all")), by).select(*by, "dir_x", "dir_y", ((F.col("_all") - F.col("n")) > MIXED_SHARE * F.col("_all")).alias("mixed"))


def to_reading_space(words: DataFrame) -> DataFrame:
    """Adds u0, u1 along the writing direction and v0, v1 down the page: a rotation of the box's corners."""
    u = lambda x, y: F.col(x) * F.col("dir_x") + F.col(y) * F.col("dir_y")
    v = lambda x, y: -F.col(x) * F.col("dir_y") + F.col(y) * F.col("dir_x")
    pairs = [("x0", "y0"), ("x1", "y1")]
    us, vs = [u(*p) for p in pairs], [v(*p) for p in pairs]
    return words.withColumns({"u0": F.least(*us), "u1": F.greatest(*us), "v0": F.least(*vs), "v1": F.greatest(*vs)})


def row_bands(words: DataFrame, by: list[str]) -> DataFrame:
    """Adds `band`: a word opens one if it lies lower than the band's first word by more than the letters allow."""

    def fold(page: pd.DataFrame) -> pd.DataFrame:
        page = page.sort_values(["v0", "u0", "word_id"], kind="stable").reset_index(drop=True)
        band, head, em, out = -1, 0.0, 0.0, []
        for v, size in zip(page["v0"], page["size"], strict=True):
            if band < 0 or v > head + max(BAND_LEAST, BAND_EM * em):
                band, head, em = band + 1, v, size
            em = max(em, size)
            out.append(band)
        return page.assign(band=pd.Series(out, dtype="int64"))

    schema = words.withColumn("band", F.lit(0).cast("bigint")).schema
    return words.groupBy(*by).applyInPandas(fold, schema)


def column_starts(words: DataFrame, by: list[str]) -> DataFrame:
    """Adds `column`, counted along each band: a gap wider than the letters' size by COLUMN_EM opens one."""
    w = W.partitionBy(*by, "band").orderBy("u0", "word_id")
    reach = F.max("u1").over(w.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(F.col("u0") - reach >= COLUMN_EM * F.col("size"), 1).otherwise(0)
    return words.withColumn("_o", opens).withColumn("column", F.sum("_o").over(w.rowsBetween(W.unboundedPreceding, 0)).cast("bigint")).drop("_o")


def place_in_columns(words: DataFrame, columns: DataFrame, by: list[str]) -> DataFrame:
    """Adds `column` (ordinal of columns(by, ordinal, lo, hi)): most overlap, above a least; else the nearest edge.

    Columns of a page are few: they travel as one array to each word, so no pair of word and column is a row.
    """
    cols = columns.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("ordinal", "lo", "hi"))).alias("_cols"))
    overlap = lambda c: F.least("u1", c["hi"]) - F.greatest("u0", c["lo"])
    gap = lambda c: F.greatest(c["lo"] - F.col("u1"), F.col("u0") - c["hi"], F.lit(0.0))
    best = F.array_max(F.transform("_cols", lambda c: F.struct(F.when(overlap(c) > OVERLAP_LEAST, overlap(c)).otherwise(0.0).alias("a"), (-gap(c)).alias("b"), (-c["ordinal"]).alias("o"))))
    return words.join(cols, by, "left").withColumn("column", -best["o"]).drop("_cols")


def cells(words: DataFrame, by: list[str]) -> DataFrame:
    """One row per band and column: the words in order, without a blank where they touch."""
    step = lambda acc, w: F.struct(
        F.concat(acc["text"], F.when((acc["text"] != "") & (w["u0"] - acc["end"] > TOUCHING), " ").otherwise(""), w["text"]).alias("text"), w["u1"].cast("double").alias("end")
    )
    start = F.struct(F.lit("").alias("text"), F.lit(0.0).cast("double").alias("end"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("u0").cast("double").alias("u0"), "word_id", F.col("u1").cast("double").alias("u1"), "text")))
    g = words.groupBy(*by, "band", "column").agg(ordered.alias("_w"))
    return g.select(*by, "band", "column", F.aggregate("_w", start, step)["text"].alias("cell"))


def rule_segments(rules: DataFrame, by: list[str], least: float = 4.0) -> DataFrame:
    """Walls and floors (kind, pos, lo, hi) of drawn boxes: a stroked box gives its four edges, a thin one a line."""
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    edge = lambda kind, pos, lo, hi: F.struct(F.lit(kind).alias("kind"), F.col(pos).cast("double").alias("pos"), F.col(lo).cast("double").alias("lo"), F.col(hi).cast("double").alias("hi"))
    box = F.array(edge("wall", "x0", "y0", "y1"), edge("wall", "x1", "y0", "y1"), edge("floor", "y0", "x0", "x1"), edge("floor", "y1", "x0", "x1"))
    line = F.when(w <= h, F.array(edge("wall", "x0", "y0", "y1"))).otherwise(F.array(edge("floor", "y0", "x0", "x1")))
    found = F.when(F.col("stroked") & (F.least(w, h) > 2), box).when(F.least(w, h) <= 2, line).otherwise(F.array().cast("array<struct<kind:string,pos:double,lo:double,hi:double>>"))
    return rules.select(*by, F.explode(found).alias("s")).select(*by, "s.*").filter(F.col("hi") - F.col("lo") >= least)


def join_floors(segments: DataFrame, by: list[str]) -> DataFrame:
    """Floors within the tolerance of a cluster's first one are one floor, as long as all of them together."""

    def fold(page: pd.DataFrame) -> pd.DataFrame:
        out: list[list[float]] = []
        for pos, lo, hi in page.sort_values(["pos", "lo"])[["pos", "lo", "hi"]].itertuples(index=False):
            if out and pos - out[-1][0] <= FLOOR_TOLERANCE:
                out[-1][1:] = [min(out[-1][1], lo), max(out[-1][2], hi)]
            else:
                out.append([pos, lo, hi])
        key = {k: page[k].iloc[0] for k in by}
        return pd.DataFrame([{**key, "pos": a, "lo": b, "hi": c} for a, b, c in out])

    floors = segments.filter("kind = 'floor'").select(*by, "pos", "lo", "hi")
    return floors.groupBy(*by).applyInPandas(fold, floors.schema)


def separators(segments: DataFrame, by: list[str], tolerance: float = 3.0) -> DataFrame:
    """Positions of walls, those closer than the tolerance as their mean to a tenth."""
    c = cluster_near(segments.filter("kind = 'wall'").select(*by, "pos"), by, "pos", tolerance)
    return c.groupBy(*by, "cluster").agg(F.round(F.avg("pos"), 1).alias("pos")).drop("cluster")


def columns_between(seps: DataFrame, by: list[str]) -> DataFrame:
    """Neighbouring separators as columns: by, ordinal, lo, hi."""
    w = W.partitionBy(*by).orderBy("pos")
    c = seps.withColumn("hi", F.lead("pos").over(w)).withColumn("ordinal", F.row_number().over(w).cast("bigint")).filter("hi IS NOT NULL")
    return c.select(*by, "ordinal", F.col("pos").alias("lo"), "hi")
