"""Token counts: pieces are counted once per distinct pre-token and joined to per-document frequencies.

No id is ever made. Pre-tokens that are frequent enough travel as a bounded table; all others are joined by a
shuffle, so no key can be hot there.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import frequent, lists, save, ship, texts
from pagelake.llm.tokens import BYTE_BPE, pre_tokens

#: Pre-tokens in the bounded table of frequent ones (about 3 MB), whatever the input.
FREQUENT = 100_000
#: Distinct pre-tokens a task gathers before it passes them on.
GATHER = 300_000
#: Tokens above which a document is over the limit.
LIMIT = 1_024


def one(chunk: str) -> bool:
    """Letters alone, or a space and letters: such a chunk is one pre-token."""
    return chunk.isalpha() or (chunk[:1] == " " and chunk[1:].isalpha())


def vocabulary(docs: DataFrame, name: str = BYTE_BPE) -> DataFrame:
    """Every distinct pre-token of docs with its number of occurrences and of pieces; pieces are counted once each."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, seen = pre_tokens(name), Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["pre_token", "n"])

        for batch in batches:
            chunks: Counter = Counter()
            for raw in batch["raw"]:
                chunks.update(cutter.chunks(raw.as_py().decode(errors="replace")))
            for chunk, n in chunks.items():
                if one(chunk):
                    seen[chunk] += n
                    continue
                for x in cutter[chunk]:
                    if x is not None:
                        seen[x] += n
            if len(seen) >= GATHER:
                yield out()
                seen.clear()
        if seen:
            yield out()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = pre_tokens(name)
        for batch in batches:
            got = [cutter.pieces(x.as_py()) for x in batch["pre_token"]]
            yield pa.RecordBatch.from_arrays([batch["pre_token"], batch["n"], pa.array(got, pa.int64())], names=["pre_token", "n", "pieces"])

    ship(docs.sparkSession)
    seen = texts(docs).select("raw").mapInArrow(gather, "pre_token string, n long").groupBy("pre_token").agg(F.sum("n").alias("n"))
    return seen.mapInArrow(pieces, "pre_token string, n long, pieces long")


def count_tokens(docs: DataFrame, name: str = BYTE_BPE, limit: int = LIMIT) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens).

    As the library counts, without added begin or end tokens; a special string in a text is one token. Null or
    empty text: 0. Repeated rows each get their row, a null doc_id stays null. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    vocab = save(vocabulary(docs, name), "pre-tokens")
    top = frequent(vocab, FREQUENT).select("pre_token", "pieces").toArrow()
    sent = spark.sparkContext.broadcast(dict(zip(top["pre_token"].to_pylist(), top["pieces"].to_pylist(), strict=True)))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, known = pre_tokens(name), sent.value
        split: dict[str, tuple[int, list[str]]] = {}  # chunk -> tokens of its frequent pre-tokens, the others
        for batch in batches:
            sums, sizes, keys, times, cuts = [], [], [], [], [0]
            for raw in batch["raw"]:
                raw = raw.as_py()
                total, others = 0, Counter()
                for chunk, n in Counter(cutter.chunks(raw.decode(errors="replace"))).items():
                    if (sure := known.get(chunk)) is not None:  # a pre-token by itself
                        total += n * sure
                        continue
                    if one(chunk):
                        others[chunk] += n
                        continue
                    if (got := split.get(chunk)) is None:
                        cut = cutter[chunk]
                        got = sum(1 if x is None else known.get(x, 0) for x in cut), [x for x in cut if x is not None and x not in known]
                        if len(split) < GATHER and len(chunk) <= 32:
                            split[chunk] = got
                    total += n * got[0]
                    for x in got[1]:
                        others[x] += n
                sums.append(total)
                sizes.append(len(raw))
                keys += others.keys()
                times += others.values()
                cuts.append(len(keys))
            rare = lists(cuts, pre_token=pa.array(keys, pa.string()), n=pa.array(times, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), rare], names=["doc_id", "n_bytes", "known", "rare"])

    ship(spark)
    freq = texts(docs).mapInArrow(frequencies, "doc_id long, n_bytes long, known long, rare array<struct<pre_token:string,n:long>>")
    freq = save(freq.withColumn("row", F.monotonically_increasing_id()), "frequencies")  # written, so a row keeps its number
    rare = freq.select("row", F.explode("rare").alias("r")).select("row", "r.pre_token", "r.n")
    rare = rare.join(vocab.select("pre_token", "pieces"), "pre_token").groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("more"))
    n = F.col("known") + F.coalesce("more", F.lit(0))
    out = freq.select("row", "doc_id", "n_bytes", "known").join(rare, "row", "left").select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
    return out
