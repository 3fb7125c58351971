"""Suffix-array dedup: bytes of strings that a document of smaller doc_id also has are removed.

Whole copies are settled by SHA-256. In the rest, each string of WIDTH bytes holds an anchor: the GRAM-byte piece of
smallest hash in it, so equal strings have equal anchors at equal places (no repeat is lost). Only anchors that
occur twice matter; they travel, with the bytes around them, to a shard of the hash space. There a difference
cover puts the suffixes of these contexts in order: triples at the sampled places (not divisible by 3) are sorted and
named, the text of names is sorted again until names are unique, the other suffixes are merged in, and neighbours with
equal prefixes give the smallest document of every string. Equal hashes are never trusted: contexts that share one are
compared byte by byte, in their block and in their shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.llm.common import save, ship, small, texts

WIDTH, GRAM = 50, 24
SPAN = WIDTH - GRAM  # an anchor lies up to so many bytes after its string's start
REACH = SPAN + WIDTH  # bytes of an anchor's context
#: Bytes of text in a block, about; bytes that are hashed together.
BLOCK, TOGETHER = 8_000_000, 200_000
#: An anchor in more task outputs than this goes by its strings, one by one, so that no shard gets all of it.
CROWD = 20_000
#: Contexts whose suffixes are sorted together, unless one group has more.
CONTEXTS = 8_192
LAST = (1 << 63) - 1  # stands for a null doc_id, which is smaller than none

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _A
    return x ^ x >> np.uint64(29)


def _slide(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum or maximum of every `width` neighbours."""
    pick, size = np.minimum if least else np.maximum, 1
    while 2 * size <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def _grams(a: np.ndarray, width: int) -> np.ndarray:
    """Hash of every `width` bytes."""
    h, size = _mix(a.astype(np.uint64) + np.uint64(1)), 1
    while 2 * size <= width:
        h = _mix(h[:-size] * _B + h[size:])
        size *= 2
    rest = width - size
    return _mix(h[: len(h) - rest] * _B + h[rest:]) if rest else h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _B)
    up[0] = 1
    down = np.full(n, np.uint64(pow(int(_B), -1, 1 << 64)))
    down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def anchors(raws: list[bytes], contexts: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """For lists of texts: text number, place, hash of every anchor; with contexts also their hash."""
    k = 0
    while k < len(raws):
        first, held = k, 0
        while k < len(raws) and (k == first or held + len(raws[k]) <= TOGETHER):
            held += len(raws[k])
            k += 1
        part = raws[first:k]
        size = np.array([len(x) for x in part], np.int64)
        end = np.cumsum(size)
        a = np.frombuffer(b"".join(part), np.uint8)
        if len(a) < WIDTH:
            continue
        of = np.repeat(np.arange(len(part)), size)
        room = end[of] - np.arange(len(a))  # bytes from here to the text's end
        h = _grams(a, GRAM)
        h[room[: len(h)] < GRAM] = np.iinfo(np.uint64).max
        low = _slide(h, SPAN + 1, True)
        low[room[: len(low)] < WIDTH] = 0
        edge = np.zeros(SPAN, np.uint64)
        high = _slide(np.concatenate([edge, low, edge]), SPAN + 1, False)
        at = np.flatnonzero(high[: len(h)] == h)
        at = at[high[at] > 0]
        doc = of[at]
        begin = end[doc] - size[doc]
        if not contexts:
            yield first + doc, at - begin, h[at]
            continue
        lo, hi = np.maximum(at - SPAN, begin), np.minimum(at + WIDTH, end[doc])
        up, down = _powers(len(a) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * down[: len(a)])])
        # as a whole the sum depends on where the context lies; the power of the base undoes that
        value = (sums[hi] - sums[lo]) * up[lo]
        yield first + doc, at - begin, h[at], _mix(_mix(value) + (at - lo).astype(np.uint64) * _A + (hi - at).astype(np.uint64))


def _pack(x: np.ndarray) -> bytes:
    return x.tobytes()


def _stretches(*columns: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches of equal tuples."""
    n = len(columns[0])
    if not n:
        return [], []
    new = np.ones(n, bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(new).tolist()
    return starts, [*starts[1:], n]


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (h % np.uint64(shards)).astype(np.int64)


def short(h: np.ndarray) -> np.ndarray:
    """32 bits of a hash, unlike those that choose the shard."""
    return (_mix(h) >> np.uint64(32)).astype(np.uint32)


# ---------------------------------------------------------------- the shards' work


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of keys by their order, from 1 on, and that order."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.ones(len(k), np.int64)
    new[1:] = k[1:] != k[:-1]
    out = np.empty(len(k), np.int64)
    out[order] = np.cumsum(new)
    return out, order


def _dense(*columns: np.ndarray) -> np.ndarray:
    """One number for every tuple, in the order of tuples; made dense where the product of their ranges is too large."""
    out, room = columns[0], int(columns[0].max(initial=0)) + 1
    for c in columns[1:]:
        top = int(c.max(initial=0)) + 1
        if room * top >= 1 << 62:
            out = _names(out)[0]
            room = int(out.max(initial=0)) + 1
        out, room = out * top + c, room * top
    return out


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Places of all suffixes of t (whole numbers from 1 on) in order, by the difference cover of period 3.

    Triples at the places not divisible by 3 are sorted and named; while names are not unique, the same is done with the
    text of names, whose suffix order is theirs. The other suffixes follow from a letter and the rank after it, and both are
    merged by two kinds of comparison.
    """
    n = len(t)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: t[i:].tolist()), np.int64)
    s = np.concatenate([t, np.zeros(3, np.int64)])
    i = np.arange(n + (n % 3 == 1))  # one sampled suffix beyond the end keeps the two kinds apart in the text of names
    sampled = np.concatenate([i[i % 3 == 1], i[i % 3 == 2]])
    name, order = _names(_dense(s[sampled], s[sampled + 1], s[sampled + 2]))
    if name.max() < len(name):
        order = suffix_array(name)
        name = np.empty(len(order), np.int64)
        name[order] = np.arange(1, len(order) + 1)
    rank = np.zeros(n + 4, np.int64)
    rank[sampled] = name
    order = sampled[order]
    order = order[order < n]
    rest = i[(i % 3 == 0) & (i < n)]
    rest = rest[np.argsort(_dense(s[rest], rank[rest + 1]), kind="stable")]
    place = np.arange(len(rest))
    for k, ahead in ((1, 1), (2, 2)):  # against suffixes at places 1 and 2 modulo 3, as many letters ahead of a rank
        other = order[order % 3 == k]
        both = np.concatenate([rest, other])
        keys = _dense(*(s[both + j] for j in range(ahead)), rank[both + ahead])
        place = place + np.searchsorted(keys[len(rest) :], keys[: len(rest)])
    out, free = np.empty(n, np.int64), np.ones(n, bool)
    out[place], free[place] = rest, False
    out[free] = order
    return out


def smallest_by_string(rows: np.ndarray, left: np.ndarray, size: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For contexts (rows of REACH bytes, the anchor at column SPAN): bit c of the result says whether the string from
    column c also starts, in another of these contexts, in a smaller document.

    The suffixes of all contexts, one after the other, are put in order; strings whose first WIDTH bytes are equal are
    neighbours then, so comparing each with the one before is enough.
    """
    m = len(rows)
    column, lo = np.arange(REACH + 1), SPAN - left
    inside = (column >= lo[:, None]) & (column < (lo + size)[:, None])
    text = np.ones((m, REACH + 1), np.int64)  # 1 stands between contexts
    text[:, :REACH] = np.where(inside[:, :REACH], rows.astype(np.int64) + 2, 1)
    order = suffix_array(text.ravel())
    which, c = order // (REACH + 1), order % (REACH + 1)
    whole = (c <= SPAN) & (c >= lo[which]) & (c + WIDTH <= (lo + size)[which])
    which, c = which[whole], c[whole]
    new = np.ones(len(which), bool)
    step = np.arange(WIDTH)
    for a in range(1, len(which), 100_000):
        z = min(len(which), a + 100_000)
        w = rows[which[a - 1 : z, None], c[a - 1 : z, None] + step]
        new[a:z] = (w[1:] != w[:-1]).any(axis=1)
    if not len(which):
        return np.zeros(m, np.int64)
    starts = np.flatnonzero(new)
    least = np.minimum.reduceat(doc[which], starts)[np.cumsum(new) - 1]
    out = np.zeros(m, np.int64)
    later = doc[which] > least
    np.bitwise_or.at(out, which[later], np.int64(1) << c[later])
    return out


# ---------------------------------------------------------------- the operator


SCANNED = "shard int, blocks binary, hashes binary, often binary"
FOUND = "block int, shard int, hashes binary, crowd binary"


def _scan(docs: DataFrame, shards: int) -> DataFrame:
    """(shard, block, hashes): the short hashes of anchors, by block, of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def out() -> Iterator[pa.RecordBatch]:
            block, h = np.concatenate([b for b, _ in held]), np.concatenate([x for _, x in held])
            held.clear()
            shard, brief = shard_of(h, shards), short(h)
            order = np.lexsort((brief, block, shard))
            shard, block, brief = shard[order], block[order], brief[order]
            starts, ends = _stretches(shard, block, brief)
            often = np.subtract(ends, starts) > 1  # twice in a block already
            shard, block, brief = shard[starts], block[starts], brief[starts]
            rows = [(int(shard[i]), _pack(block[i:j].astype(np.int32)), _pack(brief[i:j]), _pack(often[i:j])) for i, j in zip(*_stretches(shard), strict=True)]
            yield from _table(rows, SCANNED).to_batches()

        for batch in batches:
            block = batch["block"].to_numpy()
            for doc, _, h in anchors(batch["raw"].to_pylist(), False):
                held.append((block[doc], h))
                count += len(h)
            if count > 500_000:
                yield from out()
                count = 0
        if held:
            yield from out()

    return docs.select("block", "raw").mapInArrow(run, SCANNED)


PACKED = "block int, ranks binary, sizes binary, data binary"


def _packed(docs: DataFrame) -> DataFrame:
    """The texts of each task by block, compressed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = {}
        total = 0
        squeeze = zstandard.ZstdCompressor(level=3).compress

        def out() -> Iterator[pa.RecordBatch]:
            for block, rows in held.items():
                ranks, sizes = np.array([r for r, _ in rows], np.int64), np.array([len(x) for _, x in rows], np.int64)
                yield from _table([(block, _pack(ranks), _pack(sizes), squeeze(b"".join(x for _, x in rows)))], PACKED).to_batches()
            held.clear()

        for batch in batches:
            for block, rank, raw in zip(batch["block"].to_pylist(), batch["rank"].to_pylist(), batch["raw"].to_pylist(), strict=True):
                held.setdefault(block, []).append((rank, raw))
                total += len(raw)
            if total > BLOCK:
                yield from out()
                total = 0
        yield from out()

    return docs.select("block", "rank", "raw").mapInArrow(run, PACKED)


def _texts(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Ranks and texts of packed rows."""
    ranks, raws = [np.zeros(0, np.int64)], []
    for r, s, data in zip(table["ranks"].to_pylist(), table["sizes"].to_pylist(), table["data"].to_pylist(), strict=True):
        flat = zstandard.ZstdDecompressor().decompress(data)
        ranks.append(np.frombuffer(r, np.int64))
        at = 0
        for n in np.frombuffer(s, np.int64).tolist():
            raws.append(flat[at : at + n])
            at += n
    return np.concatenate(ranks), raws


def _repeated(table: pa.Table) -> pa.Table:
    """Of one shard: for every block, the hashes that occur twice or more, and which of them crowd."""
    block = np.concatenate([np.frombuffer(x, np.int32) for x in table["blocks"].to_pylist()])
    h = np.concatenate([np.frombuffer(x, np.uint32) for x in table["hashes"].to_pylist()])
    often = np.concatenate([np.frombuffer(x, bool) for x in table["often"].to_pylist()])
    _, which, n = np.unique(h, return_inverse=True, return_counts=True)
    again = n + np.bincount(which, often, len(n)).astype(np.int64)
    keep = again[which] > 1
    block, h, crowd = block[keep], h[keep], (n > CROWD)[which[keep]]
    order = np.lexsort((h, block))
    block, h, crowd = block[order], h[order], crowd[order]
    shard = table["shard"][0].as_py()
    return _table([(int(block[i]), shard, _pack(h[i:j]), _pack(crowd[i:j])) for i, j in zip(*_stretches(block), strict=True)], FOUND)


TOUCHED = "block int, doc_id long, n_bytes long, kept_sha256 string, ranks binary, sizes binary, data binary, counts binary, places binary, hashes binary, contexts binary"


def _match(shards: int):
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        """Of one block: its documents with those anchors that repeat somewhere."""
        keys = [np.frombuffer(x, np.uint32).astype(np.uint64) | np.uint64(s) << np.uint64(32) for s, x in zip(found["shard"].to_pylist(), found["hashes"].to_pylist(), strict=True)]
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        crowd = np.concatenate([np.frombuffer(x, bool) for x in found["crowd"].to_pylist()]) if keys else np.zeros(0, bool)
        order = np.argsort(key)
        key, crowd = np.append(key[order], np.iinfo(np.uint64).max), np.append(crowd[order], False)
        ranks, raws = _texts(docs)
        mine: dict[int, list[np.ndarray]] = {}
        for doc, at, h, context in anchors(raws, True):
            k = short(h).astype(np.uint64) | shard_of(h, shards).astype(np.uint64) << np.uint64(32)
            i = np.searchsorted(key[:-1], k)
            good = np.flatnonzero(key[i] == k)
            doc, at, h, context, dense = doc[good], at[good], h[good], context[good], crowd[i[good]]
            for a, b in zip(*_stretches(doc), strict=True):
                places, hashes, contexts, full = at[a:b], h[a:b], context[a:b], dense[a:b]
                if full.any():  # each string by itself, marked by a place below zero
                    raw = np.frombuffer(raws[doc[a]], np.uint8)
                    s = np.unique((places[full][:, None] - np.arange(SPAN + 1)).ravel())
                    s = s[(s >= 0) & (s + WIDTH <= len(raw))]
                    value = _grams(raw, WIDTH)[s]
                    places, hashes, contexts = np.append(places[~full], -1 - s), np.append(hashes[~full], _mix(value + _B)), np.append(contexts[~full], _mix(value + _A))
                mine[int(doc[a])] = [places.astype(np.int32), hashes, contexts]
        block = docs["block"][0].as_py() if docs.num_rows else None  # texts of a block that no shard knows are untouched
        rows = [(block, None if r == LAST else int(r), len(x), hashlib.sha256(x).hexdigest(), *[None] * 7) for k, (r, x) in enumerate(zip(ranks.tolist(), raws, strict=True)) if k not in mine]
        if mine:
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(raws[k] for k in mine))
            sizes, counts = np.array([len(raws[k]) for k in mine], np.int64), np.array([len(v[0]) for v in mine.values()], np.int64)
            rows.append((block, None, None, None, _pack(ranks[list(mine)]), _pack(sizes), data, _pack(counts), *[b"".join(_pack(v[j]) for v in mine.values()) for j in range(3)]))
        return _table(rows, TOUCHED)

    return run


class _Block:
    """A block's touched texts and their anchors, in the order of (shard, hash, context, rank)."""

    def __init__(self, table: pa.Table, shards: int):
        self.ranks, self.raws = _texts(table)
        read = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in table[name].to_pylist()])
        row = np.repeat(np.arange(len(self.raws)), read("counts", np.int64))
        at, h, context = read("places", np.int32).astype(np.int64), read("hashes", np.uint64), read("contexts", np.uint64)
        self.size = np.array([len(x) for x in self.raws], np.int64)
        self.flat, self.begin = np.frombuffer(b"".join(self.raws), np.uint8), np.cumsum(self.size) - self.size
        while True:
            shard = shard_of(h, shards)
            order = np.lexsort((self.ranks[row], context, h, shard))
            row, h, context, at, self.shard = row[order], h[order], context[order], at[order], shard[order]
            starts, ends = _stretches(h, context)
            self.first, self.which = np.array(starts, np.int64), np.repeat(np.arange(len(starts)), np.subtract(ends, starts))
            alone = at < 0  # a string by itself
            self.row, self.place = row, np.where(alone, -1 - at, at)
            self.lo, self.hi = np.where(alone, self.place, np.maximum(self.place - SPAN, 0)), np.minimum(self.place + WIDTH, self.size[row])
            other = self._unlike()
            if not len(other):
                break
            context = context.copy()
            context[other] = _mix(context[other] + _B)  # equal hashes of unlike bytes: another context, which its shard compares
        self.rank, self.h, self.context = self.ranks[row], h, context

    def bytes_of(self, some: np.ndarray) -> np.ndarray:
        """Contexts as rows of REACH bytes, the anchor at column SPAN, zeros outside."""
        p, lo, hi = self.place[some], self.lo[some], self.hi[some]
        col = (p - SPAN)[:, None] + np.arange(REACH)
        inside = (col >= lo[:, None]) & (col < hi[:, None])
        rows = self.flat[np.where(inside, self.begin[self.row[some]][:, None] + col, 0)]
        rows[~inside] = 0
        return rows

    def _unlike(self) -> np.ndarray:
        """Contexts that have another's hash and not its bytes."""
        again = np.flatnonzero(np.arange(len(self.which)) != self.first[self.which]) if len(self.which) else np.zeros(0, np.int64)
        out = [np.zeros(0, np.int64)]
        for k in range(0, len(again), 50_000):
            some = again[k : k + 50_000]
            rep = self.first[self.which[some]]
            apart = (self.hi[some] - self.place[some] != self.hi[rep] - self.place[rep]) | (self.place[some] - self.lo[some] != self.place[rep] - self.lo[rep])
            differs = (self.bytes_of(some) != self.bytes_of(rep)).any(axis=1) | apart
            out.append(some[differs])
        return np.concatenate(out)


SENT = "shard int, block int, first long, hashes binary, contexts binary, ranks binary, lefts binary, sizes binary, bytes binary"
TOLD = "block int, numbers binary, ranks binary, masks binary"


def _send(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of every block: for each shard the distinct (hash, context) with the smallest rank and the context's bytes."""
        for batch in batches:
            for k in range(batch.num_rows):
                yield from block(pa.Table.from_batches([batch.slice(k, 1)])).to_batches()

    def block(table: pa.Table) -> pa.Table:
        b = _Block(table, shards)
        out = []
        for i, j in zip(*_stretches(b.shard[b.first]), strict=True):
            f = b.first[i:j]
            p, lo, hi, rows = b.place[f], b.lo[f], b.hi[f], b.bytes_of(f)
            out.append((int(b.shard[f[0]]), table["block"][0].as_py(), i, _pack(b.h[f]), _pack(b.context[f]), _pack(b.rank[f]), _pack((p - lo).astype(np.uint8)), _pack((hi - lo).astype(np.uint8)), zstandard.ZstdCompressor(level=3).compress(_pack(rows))))
        return _table(out, SENT)

    return run


def _resolve(table: pa.Table) -> pa.Table:
    """Of one shard: for every block, which of its (hash, context) have a smaller rank elsewhere, and which strings."""
    read = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in table[name].to_pylist()])
    h, context, rank = read("hashes", np.uint64), read("contexts", np.uint64), read("ranks", np.int64)
    left, size, rows = read("lefts", np.uint8).astype(np.int64), read("sizes", np.uint8).astype(np.int64), np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(x) for x in table["bytes"].to_pylist()), np.uint8).reshape(-1, REACH)
    lengths = [len(x) // 8 for x in table["hashes"].to_pylist()]
    block = np.repeat(table["block"].to_numpy(), lengths)
    number = np.concatenate([f + np.arange(n) for f, n in zip(table["first"].to_pylist(), lengths, strict=True)])
    order = np.lexsort((rank, context, h))
    h, context, rank, left, size, block, number = (x[order] for x in (h, context, rank, left, size, block, number))
    new_h = np.concatenate([[True], h[1:] != h[:-1]])
    new = new_h | np.concatenate([[True], context[1:] != context[:-1]])
    whole = np.concatenate([rows[order], left[:, None].astype(np.uint8), size[:, None].astype(np.uint8)], axis=1)
    if ((whole[1:] != whole[:-1]).any(axis=1) & ~new[1:]).any():  # equal hashes of unlike bytes: the bytes decide
        _, by_bytes = np.unique(whole, axis=0, return_inverse=True)
        again = np.lexsort((rank, by_bytes.ravel(), h))
        h, context, rank, left, size, block, number, order = (x[again] for x in (h, by_bytes.ravel().astype(np.uint64), rank, left, size, block, number, order))
        new_h = np.concatenate([[True], h[1:] != h[:-1]])
        new = new_h | np.concatenate([[True], context[1:] != context[:-1]])
    del whole
    which = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    group = np.cumsum(new_h) - 1
    several = np.bincount(group[first])[group[first]] > 1
    bits = np.zeros(len(first), np.int64)
    some, at = first[several], np.flatnonzero(several)
    starts, ends = _stretches(group[some])
    i = 0
    while i < len(starts):  # groups do not see each other, so a few at a time are enough
        j = i + 1
        while j < len(starts) and ends[j] - starts[i] <= CONTEXTS:
            j += 1
        c = slice(starts[i], ends[j - 1])
        f = some[c]
        bits[at[c]] = smallest_by_string(rows[order[f]], left[f], size[f], rank[f])
        i = j
    least, mask = rank[first][which], bits[which]
    tell = (least < rank) | (mask > 0)
    block, number, least, mask = block[tell], number[tell], least[tell], mask[tell]
    order = np.argsort(block, kind="stable")
    block, number, least, mask = block[order], number[order], least[order], mask[order]
    return _table([(int(block[i]), _pack(number[i:j]), _pack(least[i:j]), _pack(mask[i:j].astype(np.int32))) for i, j in zip(*_stretches(block), strict=True)], TOLD)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(shards: int, keep_bytes: bool):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        """Of one block: its touched documents without what smaller documents have."""
        if not table.num_rows:
            return _table([], RESULT)
        b = _Block(table, shards)
        least, mask = b.rank[b.first].copy(), np.zeros(len(b.first), np.int64)
        for n, r, m in zip(told["numbers"].to_pylist(), told["ranks"].to_pylist(), told["masks"].to_pylist(), strict=True):
            n = np.frombuffer(n, np.int64)
            least[n], mask[n] = np.frombuffer(r, np.int64), np.frombuffer(m, np.int32)
        begin = np.cumsum(b.size + 1) - b.size - 1
        change = np.zeros(int((b.size + 1).sum()) + 1, np.int32)
        gone = b.rank > least[b.which]
        np.add.at(change, (begin[b.row] + b.lo)[gone], 1)
        np.add.at(change, (begin[b.row] + b.hi)[gone], -1)
        part = np.flatnonzero(~gone & (mask[b.which] > 0))
        for c in range(SPAN + 1):
            here = part[mask[b.which[part]] >> c & 1 > 0]
            s = begin[b.row[here]] + b.place[here] - SPAN + c
            np.add.at(change, s, 1)
            np.add.at(change, s + WIDTH, -1)
        covered = np.cumsum(change, dtype=np.int32) > 0
        out = []
        for k, raw in enumerate(b.raws):
            c = covered[begin[k] : begin[k] + b.size[k]]
            kept = np.frombuffer(raw, np.uint8)[~c].tobytes()
            rank = int(b.ranks[k])
            out.append((None if rank == LAST else rank, len(raw), int(c.sum()), int(c[:1].sum() + (c[1:] & ~c[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
        return _table(out, RESULT)

    return run


def dedup(docs: DataFrame, keep_bytes: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and `kept`, the bytes, if asked).

    Every byte that a string of WIDTH bytes covers goes, if the string also starts in a document of smaller doc_id.
    Null or empty text: nothing to remove. Rows that share a doc_id, and null doc_ids among each other, do not
    remove from each other; a null doc_id is smaller than none. Only doc_id and text are read.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = texts(docs).select("doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("rank"), "raw", F.octet_length("raw").alias("size"), F.sha2("raw", 256).alias("digest"))
    copies = save(rows.groupBy("digest", "size").agg(F.min("rank").alias("least"), F.count("*").alias("n"), F.sum(F.col("size").cast("bigint")).alias("bytes")).filter("n > 1").select("digest", "least"), "copies")
    total = rows.agg(F.sum(F.col("size").cast("bigint"))).first()[0] or 0
    shards = max(4, -(-total // BLOCK))
    rows = rows.join(small(copies), "digest", "left").withColumn("copy", F.coalesce(F.col("rank") > F.col("least"), F.lit(False)))
    alone = rows.filter(~F.col("copy")).withColumn("block", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(shards)).cast("int")).select("block", "doc_id", "rank", "raw")
    found = _scan(alone, shards).groupBy("shard").applyInArrow(_repeated, FOUND)
    matched = save(_packed(alone).groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_match(shards), TOUCHED), "matched")
    touched = matched.filter("data IS NOT NULL").drop("doc_id", "n_bytes", "kept_sha256")
    told = touched.mapInArrow(_send(shards), SENT).groupBy("shard").applyInArrow(_resolve, TOLD)
    names_ = [x.split()[0] for x in RESULT.split(", ")]
    changed = touched.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_remove(shards, keep_bytes), RESULT)
    same = matched.filter("data IS NULL").select("doc_id", "n_bytes", F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"), "kept_sha256", F.lit(None).cast("binary").alias("kept"))
    if keep_bytes:
        whole = alone.select("doc_id", "raw", F.sha2("raw", 256).alias("sha")).alias("w")
        same = same.drop("kept").join(whole.select(F.col("doc_id").alias("d"), F.col("raw").alias("kept"), "sha").dropDuplicates(["d", "sha"]), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("kept_sha256") == F.col("sha"))).select(names_)
    all_gone = F.col("size") >= WIDTH
    left = F.when(all_gone, F.lit(b"")).otherwise(F.col("raw"))
    copied = rows.filter("copy").select("doc_id", F.col("size").cast("bigint").alias("n_bytes"), F.when(all_gone, F.col("size")).otherwise(0).cast("bigint").alias("n_removed"), F.when(all_gone, 1).otherwise(0).cast("bigint").alias("n_spans"), F.sha2(left, 256).alias("kept_sha256"), (left if keep_bytes else F.lit(None).cast("binary")).alias("kept"))
    out = changed.select(names_).unionByName(same.select(names_)).unionByName(copied)
    return out if keep_bytes else out.drop("kept")
