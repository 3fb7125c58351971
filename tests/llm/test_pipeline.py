"""Each stage of the pipeline on its own input, and all of them in a row."""

import collections

import corpus_pipeline
import duckdb
from samples import cases, frame, prose
from pagelake.llm import mixing, packing, pii, quality
from pagelake.llm.tokens import word_ids


def plain_survivors(rows):
    """One row of each component of texts whose five-word shingles are alike by 0.8, all pairs compared."""
    sets = []
    for r in rows:
        w = (r["text"] or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = collections.defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(rows[k]["doc_id"])
    return sorted((min((i for i in g if i is not None), default=None) for g in groups.values()), key=str)


def plain_mix(rows):
    """doc_id, and how often the mix takes a row, by the operator's SQL."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r["doc_id"], r["text"], r["source"]) for r in rows])
    return collections.Counter({i: n for i, n in con.execute(f"SELECT doc_id, sum(CASE WHEN size > 0 THEN taken // size END) FROM ({mixing.ORACLE}) GROUP BY 1").fetchall() if n})


def test_stages(spark, docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near-duplicates", "personal data", "mixing", "packing"]
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        was = now.collect()
        now = stage(spark, now, None)
        if k < 4:
            assert now.columns == docs.columns
        got = now.collect()
        if name == "quality":
            want = [r for r in was if quality.measure((r["text"] or "").encode())[-1]]
            assert sorted(map(str, got)) == sorted(map(str, want))
        if name == "near-duplicates":
            assert sorted((r["doc_id"] for r in got), key=str) == plain_survivors(was) and len(got) < len(was)
        if name == "personal data":
            assert len(got) == len(was)
            assert not any(pii.base_spans(r["text"]) for r in got) and all(r["n_chars"] == len(r["text"]) for r in got)
        if name == "mixing":
            assert {r["text"] for r in got} <= {r["text"] for r in was}
            assert collections.Counter(r["doc_id"] for r in got) == plain_mix(was)
        if name == "packing":
            full = collections.Counter()
            for r in got:
                full[r["sequence_id"]] += r["length"]
            assert max(full.values()) <= packing.CAPACITY
            tokens = sum(len(word_ids().ids(r["text"] or "")) // 4 + 1 for r in was)
            assert sum(full.values()) == tokens and len(full) <= 1.05 * tokens / packing.CAPACITY + 1


def test_run(spark, tmp_path):
    frame(spark, cases()).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    frame(spark, []).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_planted_near_copies_are_caught(spark):
    """Copies with a few words changed, dropped or moved: of those that are alike by 0.8 none stays beside its original."""
    import random

    rows, n = [], 0
    for k in range(60):
        base = prose(k, 160, 6000).split(" ")
        rows.append((n, " ".join(base)))
        n += 1
        for j in range(4):
            rng, w = random.Random(10 * k + j), list(base)
            for _ in range(j):
                w[rng.randrange(len(w))] = f"new{j}"
            if j % 2:
                del w[rng.randrange(len(w))]
            rows.append((n, " ".join(w)))
            n += 1
    docs = frame(spark, rows)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, None).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == plain_survivors([r.asDict() for r in docs.collect()])
