"""SimHash near-duplicates, found by the generalised pigeonhole principle.

The 64 bits are split into parts, correlated bits together, so that the parts are unlike each other. If thresholds
t_i (-1: the part is not searched) sum to radius - parts + 1, two fingerprints within the radius are within t_i in
some part i. A dynamic programme gives each part its threshold by the number of candidates a bounded sample
suggests. Every fingerprint is then looked up in each part under all values within t_i; what meets is verified.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import column, per_text, save, ship, small
from pagelake.llm.components import connected_components

SEED, BITS, SHINGLE, RADIUS = 42, 64, 3, 2
#: Distinct fingerprints in the sample that the parts and thresholds are fitted on, at most.
SAMPLE = 4_096
#: What dealing out one probe costs, in comparisons of two fingerprints that already lie together.
PROBE = 64
#: Buckets of more fingerprints are split again by the bits that their part leaves.
CROWD = 4_096
#: Buckets of more rows are split before they are dealt out, so that no task gets one whole.
ROOM = 65_536
#: What a bucket's rows share, once dealt out.
KEY = ("part", "value", "cell", "sub")


def shingle_hashes(raw: bytes, width: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles, repeats included, in parts of bounded size; a shorter text is one shingle."""
    words = raw.lower().split()
    if not words:
        return
    hashed = functools.partial(xxhash.xxh64_intdigest, seed=SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else iter([b" ".join(words)])
    while part := list(itertools.islice(shingles, 65_536)):
        yield np.fromiter(map(hashed, part), np.uint64, len(part))


def majority(parts: list[np.ndarray]) -> int:
    ones, n = np.zeros(BITS, np.int64), 0
    for h in parts:
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint(raw: bytes, width: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half the hashes of the text's shingles; no words: 0."""
    return majority(list(shingle_hashes(raw, width)))


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row."""
    return per_text(docs, lambda raw: (np.uint64(fingerprint(raw, width)).astype(np.int64).item(),), "fp long")


def extract(fps: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(fps), np.uint64)
    for j, b in enumerate(bits):
        out |= (fps >> np.uint64(b) & np.uint64(1)) << np.uint64(j)
    return out


def group_bits(sample: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Parts of nearly equal width: the bit least like the others opens one, those most correlated with it follow."""
    free = list(range(BITS))
    if len(sample) > 1:
        bits = (sample[:, None] >> np.arange(BITS, dtype=np.uint64) & np.uint64(1)).astype(float)
        spread = bits.std(axis=0)
        like = np.abs(np.nan_to_num((bits - bits.mean(axis=0)).T @ (bits - bits.mean(axis=0)) / len(sample) / np.maximum(np.outer(spread, spread), 1e-12)))
    else:
        like = np.eye(BITS)
    out = []
    for k in range(parts):
        size = len(free) // (parts - k)
        mine = [min(free, key=lambda b: (like[b, free].sum(), b))]
        free.remove(mine[0])
        while len(mine) < size:
            best = max(free, key=lambda b: (like[b, mine].mean(), -b))
            mine.append(best)
            free.remove(best)
        out.append(tuple(sorted(mine)))
    return out


def allocate(costs: list[dict[int, float]], total: int) -> list[int]:
    """Thresholds, one of each part's, that sum to `total` at least cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for s, (c, chosen) in best.items():
            for t, more in cost.items():
                if s + t not in new or c + more < new[s + t][0]:
                    new[s + t] = (c + more, [*chosen, t])
        best = new
    return best[total][1]


def plan(sample: np.ndarray, n: int, radius: int = RADIUS) -> list[tuple[tuple[int, ...], int]]:
    """(bits, threshold) of the parts to search, from a sample of the n distinct fingerprints."""
    found = []
    few = sample[:512]
    for parts in range(2, radius + 3):
        groups = group_bits(sample, parts)
        costs = []
        for bits in groups:
            value = extract(sample, bits)
            apart = np.bincount(np.bitwise_count(value[: len(few), None] ^ value[None]).ravel(), minlength=BITS + 1) / max(1, len(few) * len(sample))
            costs.append({t: PROBE * sum(math.comb(len(bits), d) for d in range(t + 1)) + (n * float(apart[: t + 1].sum()) if t >= 0 else 0.0) for t in range(-1, radius + 1)})
        chosen = allocate(costs, radius - parts + 1)
        found.append((sum(c[t] for c, t in zip(costs, chosen, strict=True)), [(b, t) for b, t in zip(groups, chosen, strict=True) if t >= 0]))
    return min(found, key=lambda x: x[0])[1]


def variants(value: np.ndarray, width: int, radius: int) -> Iterator[np.ndarray]:
    """All values 1 to `radius` bits away."""
    for d in range(1, radius + 1):
        for flips in itertools.combinations(range(width), d):
            yield value ^ np.uint64(sum(1 << b for b in flips))


def link(fps: np.ndarray, radius: int, bits: tuple[int, ...]) -> list[tuple[np.ndarray, int]]:
    """Fingerprints of one bucket that hang together within the radius: (members, root). bits: not yet matched.

    A search from each fingerprint takes what it reaches out of the rest, so a dense bucket costs little; a large
    one is first split by parts of the bits that are left, one of which must match.
    """
    if len(fps) > CROWD and len(bits) > radius:
        out = []
        for part in (bits[k :: radius + 1] for k in range(radius + 1)):
            rest = tuple(b for b in bits if b not in part)
            value = extract(fps, part)
            order = np.argsort(value, kind="stable")
            for run in np.split(order, np.flatnonzero(np.diff(value[order])) + 1):
                if len(run) > 1:
                    out += link(fps[run], radius, rest)
        return out
    out, left = [], fps
    while len(left) > 1:
        root, edge, left, members = left[0], left[:1], left[1:], []
        while len(edge) and len(left):
            near = np.zeros(len(left), bool)
            for x in edge:
                near |= np.bitwise_count(left ^ x) <= radius
            edge, left = left[near], left[~near]
            members.append(edge)
        if members and (got := np.concatenate(members)).size:
            out.append((got, root))
    return out


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that join all of `distinct` (fp) within the radius, a spanning star for each bucket's groups."""
    spark = distinct.sparkSession
    n = distinct.count()
    if n < 2:
        return spark.createDataFrame([], "a long, b long")
    sample = np.array([r["fp"] for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64).view(np.uint64)
    parts = plan(sample, n, radius)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch["fp"].to_numpy().view(np.uint64)
            for k, (bits, t) in enumerate(parts):
                value = extract(fps, bits)
                for probe, values in itertools.chain([(False, value)], ((True, v) for v in variants(value, len(bits), t))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fps), k, np.int32)), pa.array(values.view(np.int64)), pa.array(np.full(len(fps), probe)), batch["fp"]], names=["part", "value", "probe", "fp"])

    def left(part: int, cell: int) -> tuple[int, ...]:
        """Bits that neither the part nor the cell (-1: none) has matched."""
        rest = tuple(b for b in range(BITS) if b not in parts[part][0])
        return rest if cell < 0 else tuple(b for b in rest if b not in rest[cell :: radius + 1])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bucket(part: int, cell: int, fps: np.ndarray, probe: np.ndarray) -> list[tuple[np.ndarray, int]]:
            if len(fps) < 2 or probe.all():
                return []
            if parts[part][1] == 0:
                return link(np.unique(fps), radius, left(part, cell))
            out = []
            asked = np.unique(fps[probe])
            for x in np.unique(fps[~probe]):  # those within t meet as one's own value and the other's variant
                near = asked[(np.bitwise_count(asked ^ x) <= radius) & (asked != x)]
                if len(near):
                    out.append((near, x))
            return out + link(np.unique(fps[~probe]), radius, left(part, cell))

        def rows(found: list[tuple[np.ndarray, int]]) -> Iterator[pa.RecordBatch]:
            if found:
                b = np.concatenate([m for m, _ in found])
                a = np.repeat(np.array([r for _, r in found], np.uint64), [len(m) for m, _ in found])
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held: list[pa.RecordBatch] = []

        def breaks(table: pa.Table | pa.RecordBatch) -> np.ndarray:
            """Places whose row is of another bucket than the next one's."""
            return np.flatnonzero(np.any([np.diff(table[c].to_numpy()) != 0 for c in KEY], axis=0))

        def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
            part, cell = table["part"].to_numpy(), table["cell"].to_numpy()
            fps, probe = table["fp"].to_numpy().view(np.uint64), table["probe"].to_numpy(zero_copy_only=False)
            found = []
            for i, j in itertools.pairwise([0, *(breaks(table) + 1).tolist(), len(part)]):
                if j - i > 1:
                    found += bucket(int(part[i]), int(cell[i]), fps[i:j], probe[i:j])
            yield from rows(found)

        for batch in batches:
            if not batch.num_rows:
                continue
            ends = breaks(batch)
            cut = int(ends[-1]) + 1 if len(ends) else 0  # the last bucket may go on
            if cut:
                yield from settle(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from settle(pa.Table.from_batches(held))

    ship(spark)
    looked = _roomy(distinct.mapInArrow(spread, "part int, value long, probe boolean, fp long"), n, [[left(k, -1)[j :: radius + 1] for j in range(radius + 1)] for k in range(len(parts))])
    return looked.repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(verify, "a long, b long").distinct()


def _roomy(looked: DataFrame, n: int, cells: list[list[tuple[int, ...]]]) -> DataFrame:
    """looked with cell and sub: rows of a bucket of over ROOM go, once for each of cells[part], by those bits' values.

    What is within the radius and shares a bucket differs in `radius` of the bits left at most, so it meets in some cell.
    """
    if n <= ROOM:  # a fingerprint is in a bucket once, by its own value or as a probe
        return looked.withColumn("cell", F.lit(-1)).withColumn("sub", F.lit(0).cast("long"))
    full = save(looked.groupBy("part", "value").count().filter(F.col("count") > ROOM).select("part", "value", F.lit(True).alias("full")), "full")
    masks = F.array(*[F.array(*[F.lit(np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64).item()) for bits in part]) for part in cells])
    split = F.transform(F.element_at(masks, F.col("part") + 1), lambda mask, j: F.struct(j.alias("cell"), F.col("fp").bitwiseAND(mask).alias("sub")))
    whole = F.array(F.struct(F.lit(-1).alias("cell"), F.lit(0).cast("long").alias("sub")))
    return looked.join(full, ["part", "value"], "left").withColumn("c", F.explode(F.when(F.col("full"), split).otherwise(whole))).select("part", "value", "probe", "fp", "c.*")


def components(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id, n_same (rows of that fingerprint).

    component_id is the smallest doc_id that links reach, itself included. Null or empty text: fingerprint zero,
    linked like any other. A null doc_id is never the smallest; a component that has no other keeps null. Equal
    texts meet in one fingerprint, which is all that the search sees, so copies are never paired.
    """
    fps = save(fingerprints(docs, width), "fingerprints")
    return fps.join(_named(fps, radius), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"), "component_id", "n_same")


def _roots(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; nothing for no edges."""
    return connected_components(edges) if not edges.isEmpty() else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _named(fps: DataFrame, radius: int) -> DataFrame:
    """fp, root (a fingerprint of its component), component_id and n_same of every distinct fingerprint."""
    distinct = save(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_same")), "distinct")
    roots = _roots(save(links(distinct.select("fp"), radius), "links"))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(ids, "root").select("fp", "root", "component_id", "n_same")


#: Minima in a band and bands: texts of Jaccard similarity 0.8 share a band with probability 0.9998.
BAND, N_BANDS = 4, 16
#: Shingles of a bucket that one task compares; larger buckets are compared block by block.
BLOCK = 1 << 20


def minima(h: np.ndarray) -> list[int]:
    """Of a set of shingle hashes: a key for each band, made of the smallest hashes under the band's multipliers."""
    if not len(h):
        return [0] * N_BANDS
    factors = np.array([xxhash.xxh64_intdigest(b"%d" % k, seed=1) | 1 for k in range(BAND * N_BANDS)], np.uint64)
    least = np.array([(h * f).min() for f in factors], np.uint64).reshape(N_BANDS, BAND)
    return [xxhash.xxh64_intdigest(b"%d:" % k + least[k].tobytes()) - (1 << 63) for k in range(N_BANDS)]


def shingle_set(raw: bytes, width: int) -> np.ndarray:
    return np.unique(np.concatenate([*shingle_hashes(raw, width), np.zeros(0, np.uint64)]))


def joined(label: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Edges between labels that join all sets alike by `similarity` or more, as far as the labels don't yet.

    Every set is compared with all those of other labels, by counts of what they share; a set just reached is next,
    so that copies of one original are found from it at once. When one label is left, nothing more is compared.
    """
    order = np.argsort([len(x) for x in sets], kind="stable")
    label, size = label[order].copy(), np.array([len(sets[k]) for k in order])
    groups = len(np.unique(label))
    _, ids, many = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True, return_counts=True)
    shared = many[ids] > 1  # what one set alone has is in no intersection
    ids, cuts = ids[shared], np.concatenate([[0], np.cumsum(shared)])[np.concatenate([[0], np.cumsum(size)])]
    flag, done, edges = np.zeros(len(many), bool), np.zeros(len(size), bool), []
    turn = list(range(len(size)))
    while turn and groups > 1:
        r = turn.pop()
        if done[r]:
            continue
        done[r] = True
        lo, hi = np.searchsorted(size, similarity * size[r] - 1e-9), np.searchsorted(size, size[r] / similarity + 1e-9, "right")
        other = lo + np.flatnonzero(label[lo:hi] != label[r])
        if not len(other):
            continue
        flag[ids[cuts[r] : cuts[r + 1]]] = True
        held = np.concatenate([[0], np.cumsum(flag[ids[cuts[lo] : cuts[hi]]])])
        flag[ids[cuts[r] : cuts[r + 1]]] = False
        both = held[cuts[other + 1] - cuts[lo]] - held[cuts[other] - cuts[lo]]
        near = other[both >= similarity * (size[r] + size[other] - both) - 1e-9]
        for x in np.unique(label[near]).tolist():
            edges.append((int(label[r]), x))
            label[label == x] = label[r]
            groups -= 1
        turn += near.tolist()
    return edges


def _split(live: DataFrame) -> DataFrame:
    """bucket, node, root, cell: rows of live (bucket, node, root, n), dealt out so that a cell holds two blocks at most.

    A bucket's largest group isn't compared with itself. The others, in blocks, meet each other and each of its blocks.
    """
    sums = live.groupBy("bucket", "root").agg(F.sum("n").alias("n"))
    most = sums.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("all"))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK).cast("int"))
    most = most.select(F.col("bucket"), F.col("m.root").alias("main"), (F.col("all") <= BLOCK).alias("whole"), blocks(F.col("m.n")).alias("nm"), blocks(F.col("all") - F.col("m.n")).alias("nu"))
    at = live.join(most, "bucket").withColumn("h", F.xxhash64("node"))
    mine = F.pmod("h", F.when(F.col("root") == F.col("main"), F.col("nm")).otherwise(F.col("nu"))).cast("int")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    first = F.col("nu") * F.col("nu")
    with_main = F.transform(upto(F.col("nm")), lambda j: first + F.col("b") * F.col("nm") + j)
    others = F.transform(upto(F.col("nu")), lambda j: F.least("b", j) * F.col("nu") + F.greatest("b", j))
    from_main = F.transform(upto(F.col("nu")), lambda i: first + i * F.col("nm") + F.col("b"))
    cells = F.when(F.col("whole"), F.array(F.lit(0))).when(F.col("root") == F.col("main"), from_main).otherwise(F.concat(others, with_main))
    return at.withColumn("b", mine).select("bucket", "node", "root", F.explode(cells).alias("cell"))


def _search(live: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) between roots of live (bucket, node, root, n) whose sets (node, hashes) are alike within a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, label, held = None, [], []

        def out() -> Iterator[pa.RecordBatch]:
            edges = joined(np.array(label, np.int64), held, similarity) if len(held) > 1 else []
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges, strict=True)], names=["a", "b"])
            label.clear()
            held.clear()

        for batch in batches:
            for bucket, cell, root, hashes in zip(*(batch[c].to_pylist() for c in ("bucket", "cell", "root", "hashes")), strict=True):
                if now != (bucket, cell):
                    yield from out()
                    now = bucket, cell
                label.append(root)
                held.append(np.frombuffer(hashes, np.uint64))
        yield from out()

    dealt = _split(live).join(sets, "node").select("bucket", "cell", "root", "hashes").repartition("bucket", "cell").sortWithinPartitions("bucket", "cell")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _hubs(live: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) of nodes alike to one of four hubs of their bucket, for buckets of more than a block.

    A hub is the node of its quarter with most company in all its buckets: an original rather than one of its copies.
    """
    large = live.groupBy("bucket").agg(F.sum("n").alias("all"), F.count("*").alias("crowd")).filter(F.col("all") > BLOCK).select("bucket", "crowd")
    crowded = live.join(small(large), "bucket")
    company = crowded.groupBy("node").agg(F.sum("crowd").alias("company"))
    ranked = crowded.join(company, "node").groupBy("bucket", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(4)).alias("quarter")).agg(F.max(F.struct("company", "node")).alias("h"))
    pairs = crowded.join(small(ranked.select("bucket", F.col("h.node").alias("hub"))), "bucket").filter("node <> hub").select("node", "hub").distinct()
    both = pairs.join(sets, "node").join(sets.select(F.col("node").alias("hub"), F.col("hashes").alias("hub_hashes")), "hub")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch["hashes"].to_pylist(), batch["hub_hashes"].to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(shared >= similarity * (len(x) + len(y) - shared) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch["node"], batch["hub"]], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.select("node", "hub", "hashes", "hub_hashes").mapInArrow(verify, "a long, b long")


def similar(keys: DataFrame, rows: DataFrame, width: int, radius: int, similarity: float) -> DataFrame:
    """(node, root) of the shingle sets that similarity joins, as far as there are any; roots are nodes too.

    Candidates are sets whose fingerprints hang together within the radius, and, as 64 bits cannot tell a pair at
    similarity 0.8 from others (about ten of them differ), sets that share a band of minima of the same hashes. Each
    is a bucket, and within a bucket all pairs of different groups are compared exactly, on whole texts: small buckets
    in one task, large ones block by block once hubs have joined what they can. Buckets of the same members are one.
    keys: doc_id, row_hash, node (of a shingle set), fp, n, bands. rows: doc_id, row_hash, raw.
    """
    ship(keys.sparkSession)
    named = save(_named(keys.select("doc_id", "fp"), radius).select("fp", "root"), "named")
    reps = save(keys.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash", "n", "bands")).alias("p")).select("node", "p.*"), "near-texts")
    by_print = keys.select("node", "fp", "n").distinct().join(named, "fp").select("node", "n", F.xxhash64(F.lit("fp"), F.col("root")).alias("bucket")).distinct()
    at = reps.select("node", "n", F.explode("bands").alias("bucket")).unionByName(by_print)
    h = F.xxhash64("node")
    same = at.groupBy("bucket").agg(F.count("*").alias("crowd"), F.bit_xor(h).alias("x"), F.sum(F.pmod(h, F.lit(1 << 31))).alias("s")).filter("crowd > 1")
    live = save(at.join(same.groupBy("crowd", "x", "s").agg(F.min("bucket").alias("bucket")).select("bucket"), "bucket").withColumn("root", F.col("node")), "near-live")
    if live.isEmpty():
        return live.select("node", "root")
    texts_ = reps.select("node", F.col("doc_id").alias("d"), F.col("row_hash").alias("r")).join(live.select("node").distinct(), "node")
    got = rows.join(small(texts_, 100_000), F.col("row_hash").eqNullSafe(F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d"))).select("node", "raw")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array([shingle_set(x.as_py(), width).tobytes() for x in batch["raw"]], pa.binary())], names=["node", "hashes"])

    sets = save(got.mapInArrow(hashes, "node long, hashes binary").dropDuplicates(["node"]), "near-sets")
    merges = None
    if not live.groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") > BLOCK).isEmpty():
        merges = save(_hubs(live, sets, similarity), "near-hubs")
        roots = _roots(merges).withColumnRenamed("root", "to")
        live = live.join(roots, "node", "left").withColumn("root", F.coalesce("to", "root")).drop("to")
        several = live.groupBy("bucket").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 <> r2").select("bucket")
        live = save(live.join(several, "bucket"), "near-live")
    found = save(_search(live, sets, similarity), "near-merges")
    return _roots(found if merges is None else found.union(merges))


def one_of_each(docs: DataFrame, width: int, radius: int, similarity: float) -> DataFrame:
    """The rows of docs, columns as they are, with one row of each component: that of the smallest doc_id.

    Texts are linked by shingle similarity; candidates come from fingerprints within the radius and from bands of
    minima. Null, empty and blank texts have no shingle and are alike. Ties are broken by a hash of the whole row; of
    rows that are alike in every column one stays. A null doc_id comes last. No group is paired out.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("struct<node:long,fp:long,n:long,bands:array<long>>")
    def keys_of(raws: pd.Series) -> pd.DataFrame:
        out = []
        for raw in raws:
            parts = list(shingle_hashes(raw, width))
            h = np.unique(np.concatenate([*parts, np.zeros(0, np.uint64)]))
            out.append((xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63), int(np.uint64(majority(parts)).astype(np.int64)), len(h), minima(h)))
        return pd.DataFrame(out, columns=["node", "fp", "n", "bands"])

    hashed = F.xxhash64(*[docs[c] for c in docs.columns])
    rows = docs.select(column(docs, "doc_id", "bigint"), hashed.alias("row_hash"), F.coalesce(column(docs, "text", "string"), F.lit("")).cast("binary").alias("raw"))
    keys = save(rows.withColumn("k", keys_of("raw")).select("doc_id", "row_hash", "k.*"), "row-keys")
    groups = similar(keys, rows, width, radius, similarity)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_hash")
    first = keys.select("doc_id", "row_hash", "node").join(groups, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(place).alias("first")).select("first.doc_id", "first.row_hash")
    copies = keys.groupBy("doc_id", "row_hash").agg(F.count("*").alias("copies"))
    stays = first.alias("f").join(copies.alias("a"), F.col("f.row_hash").eqNullSafe(F.col("a.row_hash")) & F.col("f.doc_id").eqNullSafe(F.col("a.doc_id")))
    stays = save(stays.select(F.col("f.doc_id").alias("keep_id"), F.col("f.row_hash").alias("keep_hash"), "copies"), "stays")
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), column(docs, "doc_id", "bigint"), hashed.alias("row_hash"))
    out = whole.join(stays, F.col("row_hash").eqNullSafe(F.col("keep_hash")) & F.col("doc_id").eqNullSafe(F.col("keep_id")))
    once = out.filter("copies = 1").select("doc.*")
    return once.unionByName(out.filter("copies > 1").dropDuplicates(["keep_hash", "keep_id"]).select("doc.*"))
