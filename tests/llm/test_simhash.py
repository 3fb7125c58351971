import random

import numpy as np
import pytest
import xxhash

from samples import cases, frame, prose
from pagelake.llm import simhash
from pagelake.llm.components import connected_components


def plain_fp(text, width=3):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    fps = sorted({plain_fp(t) for _, t in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for k, a in enumerate(fps):
        for b in fps[k + 1 :]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, t in rows:
        f = find(plain_fp(t))
        least[f] = min((x for x in (least.get(f), i) if x is not None), default=None)
    return sorted([(i, f"{plain_fp(t):016x}", least[find(plain_fp(t))]) for i, t in rows], key=str)


def test_cases_equal_brute_force(docs, empty):
    got = simhash.components(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain_components(cases())
    assert simhash.components(empty).count() == 0


@pytest.mark.parametrize("room", [simhash.ROOM, 0])
def test_links_lose_none(spark, monkeypatch, room):
    monkeypatch.setattr(simhash, "ROOM", room)
    rng = random.Random(2)
    fps = [rng.getrandbits(64) for _ in range(150)]
    fps += [f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for f in fps for _ in range(3)]
    fps = sorted(set(fps))
    for radius in (1, 2, 3):
        _links_equal_all_pairs(spark, fps, radius)


def test_probed_and_split_buckets_lose_none(spark, monkeypatch):
    """Thresholds over 0, and fingerprints that all share the values of many parts."""
    monkeypatch.setattr(simhash, "ROOM", 20)
    rng = random.Random(3)
    fps = sorted({1 << rng.randrange(64) | 1 << rng.randrange(64) | rng.getrandbits(3) << 61 for _ in range(150)})
    _links_equal_all_pairs(spark, fps, 2)
    halves = [tuple(range(0, 64, 2)), tuple(range(1, 64, 2))]
    for thresholds in ((0, 1), (1, 0)):
        monkeypatch.setattr(simhash, "plan", lambda *_, t=thresholds: list(zip(halves, t, strict=True)))
        _links_equal_all_pairs(spark, fps, 2)


def _links_equal_all_pairs(spark, fps, radius):
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df, radius).collect()]
    assert _classes(fps, edges) == _classes(fps, [(a, b) for k, a in enumerate(fps) for b in fps[k + 1 :] if (a ^ b).bit_count() <= radius])


def _classes(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_thresholds_sum_to_the_principle():
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 1 << 63, 600).astype(np.uint64)
    for radius in (1, 2, 3):
        for n in (1_000, 10**7, 10**11):
            parts = simhash.plan(sample, n, radius)
            assert all(t >= 0 for _, t in parts)
            # what is within the radius is within the threshold in some part
            for _ in range(200):
                x = 0
                for b in rng.choice(64, radius, replace=False).tolist():
                    x |= 1 << b
                assert any(sum(x >> b & 1 for b in bits) <= t for bits, t in parts)
    assert simhash.allocate([{-1: 0, 0: 5, 1: 50}, {-1: 0, 0: 9, 1: 10}], 0) == [-1, 1]


def test_large_buckets_are_split(monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 8)
    rng = random.Random(5)
    fps = sorted({1 << rng.randrange(40) | 1 << rng.randrange(40) for _ in range(120)} | {rng.getrandbits(40) for _ in range(60)})
    edges = [(int(m), int(r)) for ms, r in simhash.link(np.array(fps, np.uint64), 2, tuple(range(40))) for m in ms]
    assert _classes(fps, edges) == _classes(fps, [(a, b) for k, a in enumerate(fps) for b in fps[k + 1 :] if (a ^ b).bit_count() <= 2])


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


@pytest.mark.parametrize("block", [simhash.BLOCK, 400])
def test_one_of_each_is_exact_similarity(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    base = [prose(k, 150, 5000) for k in range(6)]
    rows = [(k, t) for k, t in enumerate(base)]
    for k, t in enumerate(base):
        w = t.split(" ")
        for j, n in enumerate((1, 2, 4, 9)):
            rng = random.Random(10 * k + j)
            v = list(w)
            for p in rng.sample(range(150), n):
                v[p] = f"edit{p}"
            rows.append((100 + 10 * k + j, " ".join(v)))
    rows += [(0, base[0]), (None, base[1]), (900, "short"), (901, "short"), (902, None), (903, "")]
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    nodes = list(range(len(rows)))
    edges = [(a, b) for a in nodes for b in nodes[a + 1 :] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = _classes(nodes, edges)
    want = sorted(min((rows[k][0] for k in nodes if root[k] == r and rows[k][0] is not None), default=None) for r in set(root.values()))
    out = simhash.one_of_each(frame(spark, rows), 5, 2, 0.8)
    assert sorted(r["doc_id"] for r in out.collect()) == want
    assert out.columns == frame(spark, rows).columns


def test_equal_fingerprints_alone_do_not_join(spark):
    """A line that is repeated very often rules the fingerprint; the texts around it are unlike."""
    line = "one line that comes again and again " * 400
    rows = [(k, prose(k, 100, 5000) + " " + line) for k in range(4)]
    assert len({plain_fp(t, 5) for _, t in rows}) == 1
    out = simhash.one_of_each(frame(spark, [*rows, (9, rows[2][1])]), 5, 2, 0.8)
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 1, 2, 3]


def test_joined_equals_all_pairs():
    rng = random.Random(4)
    for _ in range(30):
        base = [rng.sample(range(300), 30) for _ in range(3)]
        sets = []
        for _ in range(rng.randrange(2, 30)):
            x = set(rng.choice(base))
            for _ in range(rng.randrange(0, 5)):
                x.discard(rng.choice(sorted(x)))
                x.add(rng.randrange(1000))
            sets.append(x)
        label = np.array([rng.randrange(len(sets)) for _ in sets])
        want = [(a, b) for a in range(len(sets)) for b in range(a) if label[a] == label[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
        got = simhash.joined(label, [np.array(sorted(x), np.uint64) for x in sets], 0.8)
        of = _classes(sorted(set(label.tolist())), got)
        whole = _classes(range(len(sets)), want)
        assert all((of[int(label[a])] == of[int(label[b])]) == (whole[a] == whole[b]) for a in range(len(sets)) for b in range(a))


@pytest.mark.parametrize("block", [simhash.BLOCK, 3_000])
def test_one_original_with_hundreds_of_copies(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    base = prose(1, 200, 5000).split(" ")
    rows = [(500, " ".join(base))]
    for k in range(300):  # 0.81 to 0.88 like the original, mostly under 0.8 like each other
        rng = random.Random(k)
        v = list(base)
        for p in rng.sample(range(200), rng.choice((3, 4))):
            v[p] = f"edit{k}x{p}"
        rows.append((k, " ".join(v)))
    sets = [simhash.shingle_set(t.encode(), 5) for _, t in rows]
    like = lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert min(like(sets[0], x) for x in sets) >= 0.8
    assert np.mean([like(sets[1], x) < 0.8 for x in sets[2:]]) > 0.8
    other = prose(2, 200, 5000)
    out = simhash.one_of_each(frame(spark, [*rows, (900, other), (901, other + " more")]), 5, 2, 0.8)
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 900]
