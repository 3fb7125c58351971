"""Language-model scores: a smoothed unigram base over words, and a causal attention model over subword ids.

Counts of words, ids and pairs of ids come from all training rows. The attention model tells every id that occurs
in them apart: it starts from the pair counts and learns, in one pass over all training rows, what the longer
context adds. Ids that never occur share the probability of a symbol of their own.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm import attention
from pagelake.llm.common import frequent, lists, save, ship, texts
from pagelake.llm.tokens import WORD_BPE, library, word_ids

#: The end of a text among 16-bit ids.
END = (1 << 16) - 1
#: Cells in the table of pair counts, at most: it has a row for as many of the frequent ids as fit, the others share one.
CELLS = 1 << 22
#: Weight of the ids' shares in a row of the table, in counts.
PRIOR = 20.0
#: Frequent ids whose company tells which ids belong in a cluster.
FEATURES = 256
#: Rounds after which the shards' weights are averaged; together they see every window once.
ROUNDS = 2
#: Shards at most (a shard is what a task reads of the written ids), and ids that a shard lays out at once.
SHARDS, PORTION = 4_096, 1_000_000
#: Sets of weights that reach the driver at most; a task adds up four times as many.
FAN = 8
#: Frequent words in the bounded table; distinct keys that a task gathers before it passes them on.
FREQUENT, GATHER = 100_000, 300_000
HELD_OUT = 10
ALPHA = 0.1


def parted(docs: DataFrame) -> DataFrame:
    """doc_id, raw, held_out (crc32 of doc_id as text, mod 10, is 0) and a second hash that deals out shards."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return texts(docs).select("doc_id", "raw", (F.crc32(key.cast("binary")) % HELD_OUT == 0).alias("held_out"), F.xxhash64(key).alias("h"))


def encoded(rows: DataFrame, name: str) -> DataFrame:
    """rows with `ids`: the text's subword ids, 16 bits each. Written once, read by every later pass."""
    if library(name).get_vocab_size() > 1 << 16:
        raise ValueError("more ids than 16 bits hold")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(name)
        for batch in batches:
            ids = [np.frombuffer(encoder.ids(x.as_py().decode(errors="replace")), "<u4").astype("<u2").tobytes() for x in batch["raw"]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=[*batch.schema.names, "ids"])

    return rows.mapInArrow(run, "doc_id long, raw binary, held_out boolean, h long, ids binary")


def _four(keys: np.ndarray) -> pa.Array:
    """32-bit numbers as four bytes each, the highest first."""
    return pa.Array.from_buffers(pa.binary(4), len(keys), [None, pa.py_buffer(keys.astype(">u4").tobytes())]).cast(pa.binary())


def corpus_counts(train: DataFrame) -> DataFrame:
    """(kind, key, n) over all rows: words 'w' (key: the word) and pairs of ids 'p' (key: four bytes); summed in the tasks, then by key."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        pairs, times, held = np.zeros(0, np.uint32), np.zeros(0, np.int64), []

        def out(kind: str, keys: list | pa.Array, n: list | np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([kind] * len(n), pa.string()), pa.array(keys, pa.binary()), pa.array(n, pa.int64())], names=["kind", "key", "n"])

        def fold() -> None:
            nonlocal pairs, times
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            both = np.concatenate([pairs, keys])
            pairs, which = np.unique(both, return_inverse=True)
            times = np.bincount(which, np.concatenate([times, n])).astype(np.int64)

        for batch in batches:
            for raw in batch["raw"]:
                words.update(raw.as_py().lower().split())
            ids = np.frombuffer(b"".join(x + b"\xff\xff" for x in batch["ids"].to_pylist()), "<u2").astype(np.uint32)
            if len(ids):
                held.append(np.concatenate([[np.uint32(END)], ids[:-1]]) << np.uint32(16) | ids)
            if sum(map(len, held)) > 4 * PORTION:
                fold()
            if len(pairs) >= 4 * GATHER:
                yield out("p", _four(pairs), times)
                pairs, times = pairs[:0], times[:0]
            if len(words) >= GATHER:
                yield out("w", list(words), list(words.values()))
                words.clear()
        yield out("w", list(words), list(words.values()))
        if held:
            fold()
        yield out("p", _four(pairs), times)

    return train.select("raw", "ids").mapInArrow(gather, "kind string, key binary, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Vocabulary(NamedTuple):
    """number: of every 16-bit id, in the order of clusters. other: the number that all unseen ids share, and log of
    each one's share in it. begin: the end of text's number.
    """

    number: np.ndarray
    other: int
    share: float
    begin: int
    base: attention.Base


def vocabulary(counts: DataFrame, size: int) -> Vocabulary:
    """Numbers, clusters and pair table from the counts of all training rows; nothing here grows with the input."""
    pair = counts.filter("kind = 'p'").select(F.conv(F.hex(F.substring("key", 1, 2)), 16, 10).cast("int").alias("a"), F.conv(F.hex(F.substring("key", 3, 2)), 16, 10).cast("int").alias("b"), "n")
    single = pair.groupBy("b").agg(F.sum("n").alias("n")).toArrow()  # as many rows as the tokenizer has ids, at most
    ids, n = single["b"].to_numpy(), single["n"].to_numpy()
    if END not in ids:
        ids, n = np.append(ids, END), np.append(n, 0)
    order = np.lexsort((ids, -n))
    ids, n = ids[order], n[order]
    v = len(ids) + 1  # the last one stands for the ids that do not occur
    weight = np.append(n, 0) + ALPHA
    many = int(min(v, max(1, CELLS // v - 1)))
    first = np.full(1 << 16, v - 1)
    first[ids] = np.arange(len(ids))
    got = pair.filter(F.col("a").isin(ids[:many].tolist())) if many < len(ids) else pair
    got = got.toArrow()  # CELLS rows at most
    table = np.zeros((many + 1, v), np.float32)
    np.add.at(table, (np.minimum(first[got["a"].to_numpy()], many), first[got["b"].to_numpy()]), got["n"].to_numpy())
    table[many] = 0  # the others' row: shares alone
    clusters = max(1, 1 << round(math.log2(math.sqrt(v))) >> 1)  # about as many as there are ids in the cluster of a usual id
    some = min(FEATURES, many, v)
    company = np.zeros((v, 2 * some), np.float32)
    company[:, :some] = np.sqrt(table[:some].T / weight[:, None])
    company[: min(many, v), some:] = np.sqrt(table[: min(many, v), :some] / weight[: min(many, v), None])
    groups = attention.bisect(company, weight, clusters)
    groups = [g for g in groups if len(g)]
    place = np.empty(v, np.int64)
    place[np.concatenate(groups)] = np.arange(v)
    edges = np.cumsum([0, *map(len, groups)])
    share = weight / weight.sum()
    table += np.float32(PRIOR) * share.astype(np.float32)
    table /= table.sum(axis=1, keepdims=True)
    inner = np.empty_like(table)
    inner[:, place] = table
    sums = np.add.reduceat(inner, edges[:-1], axis=1)
    inner /= np.repeat(sums, np.diff(edges), axis=1)
    row = np.full(v, many)
    row[place[: min(many, v)]] = np.arange(min(many, v))
    base = attention.Base(edges, row, np.log(sums), np.log(inner))
    return Vocabulary(place[first], int(place[v - 1]), -math.log(max(1, size + 1 - len(ids))), int(place[first[END]]), base)


def laid(packed: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of ids, each text's with its end; lengths) of id strings."""
    ids = np.frombuffer(b"".join(x + b"\xff\xff" for x in packed), "<u2")
    return vocab.number[ids], np.array([len(x) // 2 + 1 for x in packed], np.int64)


def fit(train: DataFrame, tokens: int, vocab: Vocabulary) -> attention.Params:
    """Weights: shards, which together hold all training rows, learn from the same start; their averages start the next round."""
    spark = train.sparkSession
    weights = attention.fresh(len(vocab.number) and int(vocab.base.edges[-1]), len(vocab.base.edges) - 1)
    train = train.select("ids")
    shards = max(1, min(SHARDS, train.rdd.getNumPartitions()))
    train = train.coalesce(shards)
    many = tokens / attention.WINDOW / shards / ROUNDS  # windows a shard has in a round, about
    size = attention.portions(int(many))

    def packed(total: attention.Params, places: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary()), pa.array([places], pa.int64())], names=["weights", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            for x, k in zip(batch["weights"], batch["n"].to_pylist(), strict=True):
                got = pickle.loads(x.as_py())
                total = got if total is None else {name: total[name] + got[name] for name in got}
                n += k
        if n:
            yield packed(total, n)

    for r in range(ROUNDS):
        sent = spark.sparkContext.broadcast((weights, vocab))

        def shard(batches: Iterator[pa.RecordBatch], sent=sent, r=r) -> Iterator[pa.RecordBatch]:
            start, vocab = sent.value
            trainer = attention.Trainer(start, vocab.base, int(many / size))
            held, n = [], 0

            def learn() -> None:
                w = attention.windows(*laid(held, vocab), vocab.begin, attention.WINDOW)
                trainer.learn(attention.pick(w, slice(r, None, ROUNDS)), size)
                held.clear()

            for batch in batches:
                for x in batch["ids"].to_pylist():
                    held.append(x)
                    n += len(x) // 2 + 1
                    if n > PORTION:
                        learn()
                        n = 0
            if held:
                learn()
            if trainer.places:
                yield packed({k: v * np.float32(trainer.places) for k, v in trainer.p.items()}, trainer.places)

        sums, parts = train.mapInArrow(shard, "weights binary, n long"), shards
        while parts > FAN:  # sums of sums, so that neither a task nor the driver holds the weights of many shards
            parts = -(-parts // (4 * FAN))
            sums = sums.repartition(parts).mapInArrow(add, "weights binary, n long")
        got = [(pickle.loads(x["weights"]), x["n"]) for x in sums.collect()]  # FAN at most
        if got:
            n = sum(k for _, k in got)
            weights = {k: (sum(t[k] for t, _ in got) / n).astype(np.float32) for k in weights}
    return weights


def scores(docs: DataFrame, name: str = WORD_BPE) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null or empty text is its end token alone. A null doc_id counts as the empty string, so it is held out.
    Repeated rows each count and each get a row; equally frequent words are all in the table of frequent ones or all out
    of it, which changes no result; only doc_id and text are read, whatever other columns are called. An empty table gives an empty result; with no training row,
    counts are 0 and the smoothed base is 0 (one outcome). Words that are not among the frequent ones are joined
    to their counts by a shuffle on the word, with one row per document and word.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = save(encoded(parted(docs).select("doc_id", "raw", "held_out", "h"), name), "lm-tokens", "zstd")
    train = rows.filter(~F.col("held_out"))
    n_train = train.count()
    counts = save(corpus_counts(train), "lm-counts")
    vocab = vocabulary(counts, library(name).get_vocab_size())
    tokens = counts.filter("kind = 'p'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    weights = fit(train, tokens, vocab)
    words = counts.filter("kind = 'w'").select("key", "n")
    n_words, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = n_words + n_train, v + (n_train > 0)  # with the end token, once a row
    floor = total + ALPHA * (distinct + 1)
    top = frequent(words, FREQUENT).toArrow()
    sent = spark.sparkContext.broadcast((weights, vocab, dict(zip(top["key"].to_pylist(), top["n"].to_pylist(), strict=True)), n_train))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, vocab, known, ends = sent.value
        log = math.log10
        worth = {w: log(n + ALPHA) for w, n in known.items()}
        for batch in batches:
            raws, packed = batch["raw"].to_pylist(), batch["ids"].to_pylist()
            lm, n_tokens, n_known, first, keys, times, cuts = [], [], [], [], [], [], [0]
            at = 0
            while at < len(raws):  # so many bytes at a time
                end, held = at, 0
                while end < len(raws) and (end == at or held + len(raws[end]) < 500_000):
                    held += len(raws[end])
                    end += 1
                target, lengths = laid(packed[at:end], vocab)
                got = attention.score(p, vocab.base, target, lengths, vocab.begin) + vocab.share * (target == vocab.other)
                lm += (np.add.reduceat(got, np.cumsum(lengths) - lengths) / math.log(10)).tolist()
                at = end
            for raw in raws:
                words = raw.lower().split()
                found = [*map(worth.get, words)]
                if None in found:
                    bag = Counter([w for w, x in zip(words, found, strict=True) if x is None])
                    keys += bag.keys()
                    times += bag.values()
                    found = [x for x in found if x is not None]
                n_tokens.append(len(words) + 1)
                n_known.append(len(found) + int(ends > 0))
                first.append(sum(found, log(ends + ALPHA)))
                cuts.append(len(keys))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            rare = lists(cuts, key=pa.array(keys, pa.binary()), n=pa.array(times, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], *(pa.array(c, t) for c, t in zip((n_tokens, n_known, first, lm), kinds, strict=True)), rare], names=["doc_id", "held_out", "n_tokens", "known", "logs", "score", "rare"])

    got = rows.drop("h").mapInArrow(measure, "doc_id long, held_out boolean, n_tokens long, known long, logs double, score double, rare array<struct<key:binary,n:long>>")
    got = save(got.withColumn("row", F.monotonically_increasing_id()), "lm-rows")  # written, so a row keeps its number
    rare = got.select("row", F.explode("rare").alias("r")).select("row", "r.key", F.col("r.n").alias("times"))
    c = F.coalesce("n", F.lit(0))
    rare = rare.join(words, "key", "left").groupBy("row").agg(F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"), F.sum(F.col("times") * F.log10(c + F.lit(ALPHA))).alias("more_logs"))
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(floor) if floor > 0 else 0.0)
    out = got.drop("rare").join(rare, "row", "left")
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("bigint").alias("train_tokens"), logs.alias("base_score"), "score")
