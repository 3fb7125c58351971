"""Best-fit packing of documents into sequences, with large items matched in pairs.

Lengths are whole numbers up to the capacity, so a histogram of lengths, whose size is bounded, is all that the
packing has to see. Items above a third of the capacity are matched, the largest with the largest that still fits,
at most two in a bin; smaller ones go, the longest first, to the bin with the smallest gap that holds them. The
plan has runs of like bins; pieces find their place in it by their rank among those of equal length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagelake.llm.common import save, ship, texts
from pagelake.llm.tokens import WORD_BPE, word_ids

CAPACITY = 2_048
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, name: str = WORD_BPE, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of every row: the text's ids and then id 0, cut only where longer than the capacity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(name)
        for batch in batches:
            rows = []
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), batch["raw"], strict=True):
                ids = memoryview(encoder.ids(raw.as_py().decode(errors="replace")) + b"\0\0\0\0")
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    ship(docs.sparkSession)
    return texts(docs).mapInArrow(run, PIECE_SCHEMA)


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, list[tuple[int, int]]]], int]:
    """Bins for a histogram of lengths: (first bin, number of bins, [(length, copies in each bin)]), and how many bins."""
    left = {k: n for k, n in counts.items() if n > 0}
    open_bins: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}  # gap -> [(bins, contents)]

    def put(gap: int, n: int, contents: list[tuple[int, int]]) -> None:
        if n:
            open_bins.setdefault(gap, []).append((n, contents))

    large = sorted((k for k in left if 3 * k > capacity), reverse=True)
    for x in large:
        while left.get(x, 0):
            mate = next((y for y in large if y <= min(x, capacity - x) and left.get(y, 0) > (x == y)), None)
            if mate is None:
                put(capacity - x, left.pop(x), [(x, 1)])
            elif mate == x:
                n = left[x] // 2
                left[x] -= 2 * n
                put(capacity - 2 * x, n, [(x, 2)])
            else:
                n = min(left[x], left[mate])
                left[x] -= n
                left[mate] -= n
                put(capacity - x - mate, n, [(x, 1), (mate, 1)])
    for x in sorted((k for k in left if 3 * k <= capacity), reverse=True):
        while left[x]:
            gap = min((g for g, bins in open_bins.items() if g >= x and bins), default=None)
            if gap is None:
                n, contents, gap = left[x], [], capacity
            else:
                n, contents = open_bins[gap].pop()
            each = gap // x
            full = min(n, left[x] // each)
            put(gap - each * x, full, [*contents, (x, each)])
            left[x] -= full * each
            if full < n and left[x]:  # fewer than fill one bin
                put(gap - left[x] * x, 1, [*contents, (x, left[x])])
                left[x], full = 0, full + 1
            if contents:
                put(gap, n - full, contents)
    plan, first = [], 0
    for gap in sorted(open_bins):
        for n, contents in open_bins[gap]:
            plan.append((first, n, contents))
            first += n
    return plan, first


def places(plan: list[tuple[int, int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first bin, copies in a bin, offset of the first copy), by rank."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    rank: dict[int, int] = {}
    for first, n, contents in plan:
        at = 0
        for length, copies in contents:
            rows.setdefault(length, []).append((rank.get(length, 0), first, copies, at))
            rank[length] = rank.get(length, 0) + n * copies
            at += length * copies
    return {k: np.array(v, np.int64) for k, v in rows.items()}


def pack(docs: DataFrame, name: str = WORD_BPE, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece of id 0. Repeated rows are packed each, a null doc_id stays null, texts are read whole;
    only doc_id and text are read, whatever other columns are called; an empty table gives no piece. The histogram of lengths (at most
    `capacity` rows) is all that reaches the driver; ranks are taken inside blocks of rows, so that a length that
    very many rows share is not counted in one task.
    """
    spark = docs.sparkSession
    cut = pieces(docs, name, capacity).withColumn("row", F.monotonically_increasing_id())
    cut = save(cut.withColumn("block", F.shiftright("row", 33)), "pieces")
    by_block = save(cut.groupBy("length", "block").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in by_block.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = pack_lengths(counts, capacity)
    found = spark.sparkContext.broadcast(places(plan))
    before = F.sum("n").over(W.partitionBy("length").orderBy("block")) - F.col("n")
    ranks = F.row_number().over(W.partitionBy("length", "block").orderBy("row")) - 1
    ranked = cut.withColumn("rank", ranks).join(by_block.select("length", "block", before.alias("before")).hint("merge"), ["length", "block"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).cast("bigint").alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = found.value
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            bins, at = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for k in np.unique(length):
                mine, runs = np.flatnonzero(length == k), table[int(k)]
                run = runs[np.searchsorted(runs[:, 0], rank[mine], "right") - 1]
                nth = rank[mine] - run[:, 0]
                bins[mine], at[mine] = run[:, 1] + nth // run[:, 2], run[:, 3] + nth % run[:, 2] * k
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(bins), pa.array(at)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{PIECE_SCHEMA}, sequence_id long, offset long")
