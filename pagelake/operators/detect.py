"""Where tables are: detections by page to spans, in fixed steps, with precedence between kinds of evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.operators.ordered import runs
from pagelake.operators.sets import first_in_group

#: Evidence, the surest first. Names, never numbers, so that editions cannot give one number two meanings.
EVIDENCE = ["bookmark", "title", "header", "stamp", "inline", "cover"]
#: A weak kind must hold on so many pages in a row.
WEAK, LEAST_RUN = ["inline"], 2


def rank_of(evidence: Column) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, EVIDENCE)), evidence), F.lit(0)), F.lit(len(EVIDENCE) + 1))


def drop_weak(detections: DataFrame, by: list[str]) -> DataFrame:
    """Detections (by, code, page, evidence) without weak ones whose run of pages is too short."""
    weak = detections.filter(F.col("evidence").isin(WEAK))
    long = runs(weak, [*by, "code"], "page").filter(F.col("n") >= LEAST_RUN)
    pages = long.select(*by, "code", F.explode(F.sequence("first", "last")).alias("page"))
    held = weak.join(pages, [*by, "code", "page"], "left_semi")
    return detections.filter(~F.col("evidence").isin(WEAK)).unionByName(held)


def starts(detections: DataFrame, by: list[str]) -> DataFrame:
    """One start per code: the first page of its surest evidence."""
    return first_in_group(detections.withColumn("_rank", rank_of(F.col("evidence"))), [*by, "code"], ["_rank", "page"]).select(*by, "code", F.col("page").alias("start"), "evidence")


def spans(first: DataFrame, pages: DataFrame, by: list[str], boundaries: DataFrame) -> DataFrame:
    """start and end0 (before the next start, or the volume's last page), then end1 (before the first boundary after
    the start) and end2 (never before the last page that was seen). All ends stay, one column a step.

    pages: by, last_page. boundaries: by, page. detections' last page a code was seen on: column last_seen of first.
    """
    w = W.partitionBy(*by).orderBy("start", "code")
    s = first.join(pages, by).withColumn("end0", F.greatest(F.col("start"), F.coalesce(F.lead("start").over(w) - 1, F.col("last_page"))))
    walls = boundaries.groupBy(*by).agg(F.array_sort(F.collect_set("page")).alias("_walls"))  # a volume has a few dozen
    s = s.join(walls, by, "left")
    wall = F.array_min(F.filter("_walls", lambda p: p > F.col("start")))
    s = s.withColumn("end1", F.when(wall.isNotNull() & (wall <= F.col("end0")), wall - 1).otherwise(F.col("end0")))
    return s.withColumn("end2", F.greatest("end1", F.coalesce("last_seen", F.col("start")))).drop("_walls", "last_page")


def keep_best(found: DataFrame, key: list[str]) -> DataFrame:
    """Of spans of one key in several volumes: all if each goes on where the last ended, else the surest, then earliest."""
    w = W.partitionBy(*key).orderBy("volume")
    follows = F.lag("to_end").over(w) & (F.col("volume") == F.lag("volume").over(w) + 1) & (F.col("start") == 1)
    chained = (F.row_number().over(w) == 1) | F.coalesce(follows, F.lit(False))
    f = found.withColumn("_chained", chained).withColumn("_all", F.min("_chained").over(W.partitionBy(*key)))
    place = F.row_number().over(W.partitionBy(*key).orderBy(rank_of(F.col("evidence")), F.col("to_end").asc(), "volume", "start"))
    return f.withColumn("kept", F.col("_all") | (place == 1)).drop("_chained", "_all")
