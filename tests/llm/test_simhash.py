"""SimHash against brute force."""

import hashlib
import random

from pyspark.sql import functions as F

from tidemark.llm import simhash

M = (1 << 64) - 1


def test_neighbours_equal_brute_force(spark):
    rnd = random.Random(3)
    fps = [rnd.getrandbits(64) for _ in range(300)]
    for f in list(fps[:100]):
        for k in range(6):
            x = f
            for b in rnd.sample(range(64), k):
                x ^= 1 << b
            fps.append(x)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(f,) for f in signed] * 2, "fp long")
    queries = table.limit(250)
    for radius in (0, 2, 3):
        got = {(r.query & M, r.fp & M) for r in simhash.neighbours(queries, table, radius).collect()}
        want = {(q & M, f & M) for q in {r.fp for r in queries.collect()} for f in signed if ((q ^ f) & M).bit_count() <= radius}
        assert got == want and simhash.neighbours(queries, table, radius).count() == len(want)


def brute_fp(spark, text):
    """Votes added up in Python, from Spark's hashes of the terms."""
    row = spark.createDataFrame([(text,)], "t string").select(simhash.terms_of(F.col("t")).alias("w")).select(
        "w", F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1))).alias("h")).first()
    ones, total = [0] * 64, 0
    for i, h in enumerate(row.h):
        w = max(1, len(row.w[i]) + (len(row.w[i + 1]) if i + 1 < len(row.w) else 0))
        total += w
        for b in range(64):
            ones[b] += w * ((h & M) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > total)


def check(spark, docs, got):
    order = sorted(docs, key=lambda d: (d[0], (d[1] or "").encode()))
    texts = [t or "" for _, t in order]
    assert len(got) == len(order)
    by = sorted(got, key=lambda r: r.doc_id)
    for i, (r, (d, _)) in enumerate(zip(by, order)):
        t, nxt = texts[i], texts[(i + 1) % len(texts)]
        if sum(x[0] == d for x in order) > 1:
            continue
        half = len(t) // 2
        e = t[:len(t) - half] + nxt[:half]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (d, len(t), hashlib.sha256(e.encode()).hexdigest())
        a, b = int(r.fingerprint, 16), int(r.edited_fingerprint, 16)
        assert r.near_edited == 1 - (a ^ b).bit_count() / 64
        if i % 97 == 0:
            assert a == brute_fp(spark, t) and b == brute_fp(spark, e)
            assert r.near_next == 1 - (a ^ brute_fp(spark, nxt)).bit_count() / 64
    seen = {}
    for r, (_, t) in zip(by, order):
        if sum(x[0] == r.doc_id for x in order) == 1:
            assert seen.setdefault(t or "", r.fingerprint) == r.fingerprint
    fps = [int(r.fingerprint, 16) for r in by]
    for r, f in zip(by, fps):
        assert r.n_near == (sum((f ^ g).bit_count() <= 3 for g in fps) if r.doc_id % 100 == 0 else None)


def test_whole_table(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 100)
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = simhash.op4_simhash(spark, sf_dir).collect()
    check(spark, docs, got)
    assert sum(r.near_edited for r in got) / len(got) > sum(r.near_next for r in got) / len(got) + 0.08


def test_next_in_small_ranges(spark):
    docs = [(i * i * (-1) ** i, f"é text {i} " * (i % 5)) for i in range(50)] + [(10_000, None), (10_001, ""), (7, "same"), (7, "same"), (7, "other")]
    rows = simhash.with_next(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, next_text string"), bucket_rows=4).filter("not ghost").collect()
    order = sorted(((d, t or "") for d, t in docs), key=lambda x: (x[0], x[1].encode()))
    got = sorted(((r.doc_id, r.text, r.next_text) for r in rows), key=lambda x: (x[0], x[1].encode(), x[2].encode()))
    want = sorted(((*x, order[(i + 1) % len(order)][1]) for i, x in enumerate(order)), key=lambda x: (x[0], x[1].encode(), x[2].encode()))
    assert got == want


def test_empty_and_long(spark, tmp_path):
    for rows in ([], [(1, "word " * 50_000)], [(100, None), (200, "")]):
        spark.createDataFrame(rows, "doc_id long, text string").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        check(spark, rows, simhash.op4_simhash(spark, str(tmp_path)).collect())
