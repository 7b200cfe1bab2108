"""Near duplicates against brute force."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import minhash


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(x, y):
    """Probability Jaccard by its definition; where no shingle is repeated, that of sets."""
    if max([*x.values(), *y.values()]) == 1:
        shared = len(x.keys() & y.keys())
        return shared / (len(x) + len(y) - shared)
    ratios = sorted((y[j] / x[j], x[j], y[j]) for j in x.keys() & y.keys())
    only_x, only_y = sum(x[j] for j in x.keys() - y.keys()), sum(y[j] for j in y.keys() - x.keys())
    return sum(x[i] / (only_x + only_y / (y[i] / x[i]) + sum(max(b, c / (y[i] / x[i])) for _, b, c in ratios)) for i in x.keys() & y.keys())


def classes(rows, threshold=0.8):
    """{doc_id: smallest connected doc_id} by comparing all pairs that share a shingle."""
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets, index = [(d, shingles(t)) for d, t in rows], {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(i)
    pairs = {p for v in index.values() if len(v) > 1 for p in combinations(v, 2)}
    for i, j in pairs:
        (a, s), (b, t) = sets[i], sets[j]
        if find(a) != find(b) and similarity(s, t) >= threshold - 1e-12:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: find(d) for d, _ in rows}


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in minhash.op9_minhash(spark, sf_dir).collect()]
    assert len(got) == len(rows)
    want = classes(rows)
    wrong = [d for d, c in got if want[d] != c]
    assert not wrong
    assert len(set(want.values())) < len(want)


def test_chains_copies_and_odd_rows(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    rows, base = [], [word() for _ in range(120)]
    for i in range(60):  # each differs a little more from the first
        base = list(base)
        base[rnd.randrange(120)] = word()
        rows.append((1000 - i, " ".join(base)))
    rows += [(i, rows[0][1].upper()) for i in range(5)]
    for i in range(40):
        rows.append((2000 + i, " ".join(word() for _ in range(50))))
    rows += [(3000, None), (3001, ""), (3002, "  "), (3003, "a b"), (3004, "A, b!"), (3005, "a"), (3006, "x " * 4000), (2000, rows[-1][1])]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, class_id long")
    got = {tuple(r) for r in minhash.near_duplicates(docs).collect()}
    want = classes(rows)
    assert got == set(want.items())
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_recall_in_each_bin_with_repeated_passages(spark):
    """Of pairs of similarity 0.8 or more, with one passage repeated up to twelve times, nine of ten are found in each bin."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    rows = []
    for i in range(400):
        body, passage = [word() for _ in range(rnd.randrange(80, 400))], [word() for _ in range(15)]
        other = list(body)
        for _ in range(rnd.randrange(0, len(body) // 40 + 2)):
            other[rnd.randrange(len(body))] = word()
        n = rnd.randrange(0, 13)
        rows += [(2 * i, " ".join(body + passage * n)), (2 * i + 1, " ".join(passage * (n + rnd.randrange(0, 2)) + other))]
    got = dict(map(tuple, minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    bins = {}
    for i in range(400):
        s = similarity(shingles(rows[2 * i][1]), shingles(rows[2 * i + 1][1]))
        found = got[2 * i] == got[2 * i + 1]
        assert not found or s >= 0.8 - 1e-12
        if s >= 0.8:
            bins.setdefault(min(int(s * 20), 19), []).append(found)
    assert len(bins) == 4 and all(len(v) > 20 and sum(v) >= 0.9 * len(v) for v in bins.values())


def test_repeated_whole_text_is_a_copy(spark):
    rnd = random.Random(7)
    text = " ".join(str(rnd.random()) for _ in range(600))
    docs = spark.createDataFrame([(1, text), (2, f"{text} {text} {text}"), (3, f"{text} " + " ".join(str(rnd.random()) for _ in range(300)))], "doc_id long, text string")
    assert {tuple(r) for r in minhash.near_duplicates(docs).collect()} == {(1, 1), (2, 1), (3, 3)}


def test_large_bucket_and_family_in_blocks(spark, monkeypatch):
    """One bucket of all rows, cut into many blocks: nothing is lost beside leaders that resemble few."""
    rnd = random.Random(6)
    text = lambda: " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(60))
    rows, base = [], text().split()
    for i in range(0, 400, 10):
        near = text()
        rows += [(i, near), (i + 1, near + " end"), (i + 9, text())]
    for i in range(120):  # members of one family, most of them too far from each other to be links
        other = list(base)
        for _ in range(rnd.randrange(0, 3)):
            other[rnd.randrange(60)] = text().split()[0]
        rows.append((1000 + i, " ".join(other)))
    monkeypatch.setattr(minhash, "BUCKET_ROWS", 16)
    monkeypatch.setattr(minhash, "FAMILY_ROWS", 8)
    signed = minhash.signatures
    monkeypatch.setattr(minhash, "signatures", lambda docs, text: signed(docs, text).withColumn("bands", F.expr("array(1L)")))
    got = {tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = classes(rows)
    assert got == set(want.items()) and 30 < len({c for d, c in want.items() if d >= 1000})


def loose(n, seed, odd=0):
    """Members of one template with an end of their own: each pair just below 0.8, but every tenth is close to the one before."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(8))
    base, rows = [word() for _ in range(160)], []
    for i in range(n):
        own = base + [word() for _ in range(20)]
        if i % 10 == 9:
            own = [*rows[-1][1].split()[:179], word()]
        if i < odd:
            own += own[:30]
        rows.append((i, " ".join(own)))
    return rows


def test_rows_of_a_loose_family_grow_with_it(spark, monkeypatch):
    """Rows that are sent to be compared at most 2.2 times for twice the members, and no link is lost."""
    monkeypatch.setattr(minhash, "FAMILY_ROWS", 16)
    monkeypatch.setattr(minhash, "BUCKET_ROWS", 4096)
    compared, sent = minhash._compared, []

    def counted(rows, compare):
        if "elements" in rows.columns:
            sent[-1] += rows.count()
        return compared(rows, compare)

    monkeypatch.setattr(minhash, "_compared", counted)
    for n, odd in ((160, 0), (320, 0), (120, 20)):
        rows = loose(n, 3, odd)
        sent.append(0)
        got = {tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got == set(classes(rows).items()) and len({c for _, c in got}) > n / 2
    assert sent[1] <= 2.2 * sent[0], sent


def test_prob_jaccard_and_connected():
    rnd = np.random.default_rng(3)
    for _ in range(50):
        x, y = Counter(rnd.integers(0, 30, 40).tolist()), Counter(rnd.integers(0, 30, 60).tolist())
        e, f = np.array(sorted(x), np.uint64), np.array(sorted(y), np.uint64)
        got = minhash.prob_jaccard(e, np.array([x[k] for k in sorted(x)]), f, np.array([y[k] for k in sorted(y)]))
        want = sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in x.keys() | y.keys()) for i in x.keys() & y.keys())
        assert abs(got - want) < 1e-12
    near = rnd.random((40, 50)) < 0.02
    want = classes_of([(int(r), 100 + int(c)) for r, c in zip(*np.nonzero(near))])
    groups = minhash.connected(near)
    assert {frozenset([*r, *(100 + c for c in cs)]) for r, cs in groups} == want
    pairs = minhash.stars(groups, np.arange(40), 100 + np.arange(50))
    assert len(pairs) < 90 and classes_of(map(tuple, pairs.tolist())) == want


def classes_of(links):
    groups = []
    for a, b in links:
        hit = [g for g in groups if a in g or b in g]
        groups = [g for g in groups if g not in hit] + [set().union({a, b}, *hit)]
    return {frozenset(g) for g in groups}


def test_signatures_estimate_probability_jaccard():
    rnd = np.random.default_rng(0)
    elements = rnd.integers(0, 2**63, 60).astype(np.uint64)
    a, b = rnd.integers(1, 6, 60).astype(float), rnd.integers(1, 6, 60).astype(float)
    a[:10], b[50:] = 0, 0
    both = [i for i in range(60) if a[i] and b[i]]
    want = sum(1 / np.maximum(a / a[i], b / b[i]).sum() for i in both)
    agree = []
    for k in range(300):  # other hashes each time
        e = minhash._mix(elements + np.uint64(k * 7919))
        x, y = a > 0, b > 0
        s = minhash.prob_minhash(np.r_[np.zeros(x.sum(), int), np.ones(y.sum(), int)], np.r_[e[x], e[y]], np.r_[a[x], b[y]], 2)
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - want) < 0.02


def test_components(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(300)] + [(500, 500 + i) for i in range(1, 200)] + [(rnd.randrange(1000, 1400), rnd.randrange(1000, 1400)) for _ in range(250)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = dict(map(tuple, minhash.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {n: find(n) for a, b in links if a != b for n in (a, b)}


def test_only_copies_in_a_task(spark):
    """Chunks of a task in which every row is a copy, or has no words or no doc_id."""
    rows = [(i, "one two three four five six") for i in range(300)] + [(None, "one two three four five six"), (301, None), (302, "")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    got = {tuple(r) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {(i, 0) for i in range(300)} | {(None, None), (301, 301), (302, 302)}
