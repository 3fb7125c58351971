import hashlib
import random

import numpy as np
import zstandard

from samples import cases, frame, prose
from pagelake.llm import suffix_dedup


def plain(rows):
    """Of (doc_id, text): what each loses, string by string."""
    last = 1 << 63
    order = sorted(range(len(rows)), key=lambda k: last if rows[k][0] is None else rows[k][0])
    least, out = {}, []
    data = [(t or "").encode() for _, t in rows]
    for k in order:
        rank = last if rows[k][0] is None else rows[k][0]
        for s in range(len(data[k]) - 49):
            least.setdefault(data[k][s : s + 50], rank)
    for (i, _), x in zip(rows, data, strict=True):
        rank, gone = last if i is None else i, bytearray(len(x))
        for s in range(len(x) - 49):
            if least[x[s : s + 50]] < rank:
                gone[s : s + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(x, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()], key=str)


def test_cases_equal_brute_force(docs, empty):
    assert got(suffix_dedup.dedup(docs)) == plain(cases())
    assert suffix_dedup.dedup(empty).count() == 0


def test_crowded_anchors_and_kept_bytes(spark, monkeypatch):
    rng = random.Random(4)
    passage = prose(1, 20)
    rows = [(k, prose(100 + k, rng.randint(5, 40)) + " " + passage[: rng.randint(55, len(passage))] + " " + prose(300 + k, 10)) for k in range(25)]
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1_000)
    monkeypatch.setattr(suffix_dedup, "CROWD", 3)
    out = suffix_dedup.dedup(frame(spark, rows), keep_bytes=True)
    assert got(out) == plain(rows)
    for r in out.collect():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]


def test_equal_strings_have_equal_anchors():
    a, b = b"x" * 13 + prose(3, 12).encode()[:60], prose(9, 4).encode() + prose(3, 12).encode()[:60] + b"yy"
    found = [{h for *_, hs in suffix_dedup.anchors([t], False) for h in hs.tolist()} for t in (a, b)]
    assert found[0] & found[1]


def test_difference_cover_names_equal_strings():
    rng = np.random.default_rng(0)
    rows = rng.integers(97, 99, (40, suffix_dedup.REACH)).astype(np.uint8)
    rows[1] = rows[0]
    rows[2, 5:60] = rows[0, 5:60]
    rows[3, 3:60] = rows[0, 3:60]
    doc = np.arange(40)[::-1].copy()
    bits = suffix_dedup.smallest_by_string(rows, np.full(40, suffix_dedup.SPAN), np.full(40, suffix_dedup.REACH), doc)
    for r in range(40):
        for c in range(suffix_dedup.SPAN + 1):
            want = any((rows[q, c : c + 50] == rows[r, c : c + 50]).all() and doc[q] < doc[r] for q in range(40))
            assert bool(bits[r] >> c & 1) == want


def test_suffixes_are_in_order():
    rng = np.random.default_rng(0)
    for letters in (1, 2, 3, 200, 1 << 40):
        for n in (1, 2, 3, 4, 5, 17, 60, 200):
            for _ in range(8):
                t = rng.integers(1, letters + 1, n).astype(np.int64)
                text = t.tolist()
                assert suffix_dedup.suffix_array(t).tolist() == sorted(range(n), key=lambda i: text[i:])
    t = np.tile(np.array([5, 3, 5], np.int64), 700)  # names stay equal for many rounds
    text = t.tolist()
    assert suffix_dedup.suffix_array(t).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_equal_hashes_are_not_trusted():
    """Contexts that share both hashes and differ in bytes stay apart in a block, and in a shard the bytes decide."""
    rng = np.random.default_rng(3)
    raws = [rng.integers(97, 123, 120).astype(np.uint8).tobytes() for _ in range(3)]
    raws.append(raws[0])
    pack = lambda *x: b"".join(np.asarray(y).tobytes() for y in x)
    n = len(raws)
    table = suffix_dedup._table([(0, None, None, None, pack(np.arange(n)), pack(np.full(n, 120)), zstandard.ZstdCompressor().compress(b"".join(raws)), pack(np.ones(n, np.int64)), pack(np.full(n, 40, np.int32)), pack(np.full(n, 7, np.uint64)), pack(np.full(n, 9, np.uint64)))], suffix_dedup.TOUCHED)
    b = suffix_dedup._Block(table, 1)
    assert len(b.first) == 3 and len(set(b.which[np.isin(b.row, (0, 3))].tolist())) == 1
    reach, zip_ = suffix_dedup.REACH, zstandard.ZstdCompressor()
    sent = lambda block, rank, raw: (0, block, 0, pack(np.uint64([7])), pack(np.uint64([9])), pack(np.int64([rank])), pack(np.uint8([26])), pack(np.uint8([reach])), zip_.compress(raw[:reach]))
    told = suffix_dedup._resolve(suffix_dedup._table([sent(0, 5, raws[0]), sent(1, 6, raws[1]), sent(2, 8, raws[0])], suffix_dedup.SENT))
    assert told["block"].to_pylist() == [2] and np.frombuffer(told["ranks"][0].as_py(), np.int64).tolist() == [5]
