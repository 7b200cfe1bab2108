"""Mixing against plain Python."""

import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import mixing


def weights(tokens, a):
    z = sum(t**a for t in tokens)
    return [t**a / z for t in tokens]


def entropy(w):
    return -sum(x * math.log(x) for x in w)


def test_exponent_meets_entropy_and_limit(spark):
    tokens = [1000, 400, 90, 10]
    totals = spark.createDataFrame([(t,) for t in tokens], "tokens long")
    a = mixing.find_exponent(totals, 0.8, None)
    assert abs(entropy(weights(tokens, a)) - 0.8 * math.log(4)) < 1e-5
    b = mixing.find_exponent(totals, None, 3.0)
    assert abs((1000 / 10) ** (1 - b) - 3) < 1e-4
    assert mixing.find_exponent(totals, 0.8, 3.0) == max(a, b)
    assert mixing.find_exponent(totals, 0.1, None) == 1.0
    assert mixing.find_exponent(totals.limit(0), 0.8, 3.0) == 1.0


def brute(rows, a, limit):
    """{(doc_id, key): copies} for rows of (doc_id, source, tokens, key)."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    total = {s: sum(r[2] for r in rs) for s, rs in by.items()}
    top, out = max(total.values(), default=0), Counter()
    for s, rs in by.items():
        repeats = min((top / total[s]) ** (1 - a), limit) if total[s] else 1.0
        rest = math.floor(repeats * total[s]) - math.floor(repeats) * total[s]
        at, last = 0, set()
        for k in sorted({r[3] for r in rs}):
            at += sum(r[2] for r in rs if r[3] == k)
            if at > rest or not total[s] or rest == 0:
                break
            last.add(k)
        for r in rs:
            out[r[0], r[3]] += math.floor(repeats) + (r[3] in last)
    return out


def keys(docs):
    return [tuple(r) for r in docs.select("doc_id", mixing._source("source"), mixing.token_count("text"), F.xxhash64(F.lit(7), "doc_id", F.coalesce("text", F.lit("")))).collect()]


def totals(spark, rows):
    c = Counter()
    for r in rows:
        c[r[1]] += r[2]
    return spark.createDataFrame([(v,) for v in c.values() if v], "tokens long")


def check(spark, docs, out):
    rows = keys(docs)
    a = mixing.find_exponent(totals(spark, rows), 0.98, 2.0)
    want = brute(rows, a, 2.0)
    got = Counter((r[0], r[3]) for r in keys(out))
    assert got == want
    return rows


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit("src0")).otherwise(F.col("source")))
    out = mixing.mix_sources(docs)
    assert set(docs.columns) <= set(out.columns)
    check(spark, docs, out.cache())
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_query_and_blocks(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = mixing.mix_sources(docs, block_tokens=20_000).cache()
    n = out.agg(F.max("mix_block")).first()[0] + 1
    tokens = out.agg(F.sum("n_tokens")).first()[0]
    assert abs(n - tokens / 20_000) <= 2
    sizes = [r.t for r in out.groupBy("mix_block").agg(F.sum("n_tokens").alias("t")).collect()]
    assert len(sizes) == n and max(sizes) < 3 * 20_000
    assert mixing.op7_mixing(spark, sf_dir).columns == ["doc_id", "source", "n_tokens", "epoch", "mix_block", "mix_place"]


def test_budget_and_own_tokens(spark):
    """A budget below the table's tokens takes part of each source by weight; one above repeats up to the limit."""
    rows = [(i, "x", "big" if i % 10 else "small", 100 + i % 7) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, source string, tok int")
    total = Counter()
    for r in rows:
        total[r[2]] += r[3]
    for budget in (50_000, 300_000):
        out = mixing.mix_sources(docs, target_entropy=0.8, max_repeat=3.0, budget=budget, tokens="tok", block_tokens=10_000)
        got = Counter({r.source: r.n for r in out.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()})
        a = mixing.find_exponent(spark.createDataFrame([(v,) for v in total.values()], "tokens long"), 0.8, 3.0, budget)
        w = dict(zip(total, weights(list(total.values()), a)))
        assert all(budget * w[s] - 107 < got[s] <= budget * w[s] + 1e-6 for s in total), (got, w)
        assert max(got[s] / total[s] for s in total) <= 3.0 + 1e-6
        assert out.columns == [*docs.columns, "n_tokens", "epoch", "mix_block", "mix_place"]


def test_odd_tables(spark):
    schema = "doc_id long, text string, source string, epoch string"
    rows = [(i, "w " * (i % 7 + 1), "big", "x") for i in range(200)] + [(i, f"a{i} b c", None, None) for i in range(200, 260)]
    rows += [(300, None, "big", "x"), (301, "", "none", "x"), (302, None, "none", "x"), (5, "w " * 6, "big", "x"), (400, "same text", "s", "x"), (400, "same text", "s", "x"), (401, "q r", "s", "x")]
    docs = spark.createDataFrame(rows, schema)
    check(spark, docs, mixing.mix_sources(docs).cache())
    clash = mixing.mix_sources(docs.withColumnRenamed("epoch", "key").withColumn("src", F.lit("mine"))).select("key", "src").distinct().collect()
    assert {r.src for r in clash} == {"mine"} and {r.key for r in clash} == {"x", None}
    assert mixing.mix_sources(docs.limit(0)).count() == 0
