import os
import threading
from collections import Counter
from contextlib import contextmanager

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from civicstat.llm import common, rules, topk

SF = "/root/testdata/sf0.001"


def test_top_k_with_ties_copies_and_nulls(spark):
    vectors = [(i, [1.0 if (i * 7 >> b) & 1 else -1.0 for b in range(6)]) for i in range(40)]
    vectors += [(100 + i, [1.0] * 6) for i in range(30)] + [(5, vectors[5][1]), (None, [1.0] * 6), (300, None), (400, []),
                                                            (500, [None, float("nan"), 1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").selectExpr("*", "1 AS code", "2 AS distance")
    got = {}
    for r in topk.top_k(df, df.where("vec_id % 20 = 0"), 7).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.distance, r.vec_id))
    codes = {i: tuple(bool(x and x > 0) for x in (list(e) + [None] * 6)[:6]) for i, e in vectors if i is not None and e is not None}
    for q in [i for i in codes if i % 20 == 0]:
        near = sorted((sum(a != b for a, b in zip(codes[q], c)), i) for i, c in codes.items() if i != q)[:7]
        assert sorted(got[q]) == [(n + 1, d, i) for n, (d, i) in enumerate(near)]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 20"), df.where("vec_id = 20")).count() == 0


def test_segments_grow_with_the_index():
    assert [topk.segment_bits(n) for n in (0, 1000, 10 ** 6, 10 ** 12)] == [8, 10, 20, 30]


def vectors_at(path, x, ids):
    offsets = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
    pq.write_table(pa.table({"vec_id": ids, "embedding": pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))}), path)
    return str(path)


def nearest(x, ids, q, k):
    off = ((x > 0) != (x[q] > 0)).sum(axis=1)
    return sorted((int(d), int(i)) for d, i in zip(off, ids) if i != ids[q])[:k]


@contextmanager
def disk_peak(spark):
    """Most bytes of shuffle and spill files at a time, beyond those there before."""
    dirs = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    peak, over = {"bytes": 0}, threading.Event()

    def used():
        total = 0
        for d in dirs:
            for base, _, files in os.walk(d):
                for f in files:
                    try:
                        total += os.path.getsize(os.path.join(base, f))
                    except OSError:
                        pass
        return total

    before = used()

    def watch():
        while not over.wait(0.05):
            peak["bytes"] = max(peak["bytes"], used() - before)

    t = threading.Thread(target=watch)
    t.start()
    try:
        yield peak
    finally:
        over.set()
        t.join()


def test_top_k_disk_stays_below_the_input(spark, tmp_path):
    # full segments of 14 bits leave one of a single bit, which half of all codes share
    n, dims = 1 << 14, 43
    x, ids = np.random.default_rng(5).standard_normal((n, dims)).astype(np.float32), np.arange(n)
    path = vectors_at(tmp_path / "v.parquet", x, ids)
    df = spark.read.parquet(path)
    with disk_peak(spark) as peak:
        got = {}
        for r in topk.top_k(df, df.where("vec_id % 100 = 0"), 10).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.distance, r.vec_id))
    assert set(got) == set(range(0, n, 100))
    for q in range(0, n, 100):
        assert sorted(got[q]) == [(i + 1, *p) for i, p in enumerate(nearest(x, ids, q, 10))]
    assert peak["bytes"] < 4 * os.path.getsize(path)


def test_top_k_in_many_cells(spark, tmp_path, monkeypatch):
    """Small cells, crowded tiles, codes of two words with a segment across
    them, small packs, and copies."""
    for name, size in (("CELL", 64), ("QUERIES", 16), ("ENTRIES", 200)):
        monkeypatch.setattr(topk, name, size)
    r = np.random.default_rng(6)
    x = r.standard_normal((3000, 70)).astype(np.float32)
    x[:, :4] = 1  # a segment whose high bits are the same everywhere
    x[1000:1400] = x[1000]
    x[1400:1800] = np.where(r.random((400, 70)) < 0.03, -1, 1) * x[1000]
    ids = r.permutation(3000) - 1500
    df = spark.read.parquet(vectors_at(tmp_path / "v.parquet", x, ids))
    for kind in ("long", "string"):
        some = df.selectExpr(f"CAST(vec_id AS {kind}) AS vec_id", "embedding")
        got = {}
        for row in topk.top_k(some, some.where("vec_id % 50 = 0"), 5).collect():
            got.setdefault(int(row.query_id), []).append((row["rank"], row.distance, row.vec_id))
        names = ids if kind == "long" else np.array([str(i) for i in ids])
        for q in np.flatnonzero(ids % 50 == 0):
            off = ((x > 0) != (x[q] > 0)).sum(axis=1)
            near = sorted((int(d), i) for d, i in zip(off, names.tolist()) if i != names[q])[:5]
            assert sorted(got[ids[q]]) == [(i + 1, *p) for i, p in enumerate(near)]


def test_a_task_holds_few_codes_at_once(monkeypatch):
    r = np.random.default_rng(7)
    words = r.integers(0, 1 << 12, (4000, 1)).astype(np.uint64)
    plan = topk.layout(12, 4000)
    plan.tiles = [(np.arange(1 << b), np.arange(1 << b) + (s << 9), np.ones(1 << b, int)) for s, b in enumerate(plan.bits)]
    assert (plan.m, plan.ends) == (1, [0, 12])
    own = words[plan.values(words, 0) >> plan.low(0) == 5]
    cell = topk.Cell(plan, 5, topk.pack(own[np.argsort(own[:, 0])], np.arange(len(own)), np.ones(len(own), np.int32)))
    asked, bound = words[:50], np.full(50, 12, np.int32)
    got = []
    for held in (1, 100, 1 << 20):
        monkeypatch.setattr(topk, "HELD", held)
        got.append(sorted(tuple(x.values()) for b in cell.search(asked, bound, 3, 4) for x in b.to_pylist()))
    assert got[0] == got[1] == got[2]
    for q in asked:
        met = [int(d) for d in np.bitwise_count(own[:, 0] ^ q[0]) if d == 3]
        found = [x for x in got[0] if x[0] == int(q[0]).to_bytes(8, "big")]
        assert len(found) >= min(4, len(met)) and all(x[2] == 3 for x in found)


def test_pipeline_stage_by_stage(spark):
    docs = common.table(spark, SF, "documents")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.cut(stage(spark, docs, SF))
        rows = docs.collect()
        if name == "quality_rules":
            assert {r.doc_id for r in rows} == {i for i, r in before.items() if rules.first_rejection(rules.Measures(r.text), rules.RULES) is None}
        elif name == "near_duplicates":
            kept = {c for _, c in brute.components([(i, brute.fingerprint(r.text)) for i, r in before.items()])}
            assert sorted(r.doc_id for r in rows) == sorted(kept)
        elif name == "substring_dedup":
            want = {x[0]: x[2:] for x in brute.substrings([(i, r.text) for i, r in before.items()])}
            assert {r.doc_id for r in rows} == set(before)
            for r in rows:
                assert r.n_chars == len(r.text)
                assert brute.sha(r.text.encode()) == want[r.doc_id][1] if want[r.doc_id][0] else r.text == before[r.doc_id].text
        elif name == "source_mixing":
            copies = Counter(r.doc_id for r in rows)
            assert set(copies) <= set(before) and max(copies.values()) <= 2
            words = sum(len(before[i].text.split()) * n for i, n in copies.items())
            every = sum(len(r.text.split()) for r in before.values())
            assert abs(words - 1.5 * every) <= 20 * max(len(r.text.split()) for r in before.values())
        else:
            assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == Counter(
                {(i, *brute.tokens(before[i].text)): n for i, n in copies.items()})
        if name != "byte_bpe":
            assert docs.columns == columns
            before = {r.doc_id: r for r in rows}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "substring_dedup", "source_mixing", "byte_bpe"]


def test_run_takes_empty_and_null_documents(spark, odd, scratch):
    odd.select("doc_id", "text", "lang", "source").write.parquet(f"{scratch}/odd/documents.parquet")
    odd.select("doc_id", "text", "lang", "source").limit(0).write.parquet(f"{scratch}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{scratch}/odd").count() > 0
    assert corpus_pipeline.run(spark, f"{scratch}/none").count() == 0
