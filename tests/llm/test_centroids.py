"""Clusters against Python's integers."""

import hashlib
import math
import random

from tidemark.llm import centroids


def brute(rows, k=8, rounds=10, size=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(-centroids.LARGEST, min(centroids.LARGEST, math.floor(1024 * x) if abs(x) < 1e300 else math.copysign(centroids.LARGEST, x))) for x in v]))
    name = lambda i: hashlib.sha256(f"3:{'null' if i is None else i}".encode()).hexdigest()
    c = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def near(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, m)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            if mine:
                c[j] = [sum(col) // len(mine) for col in zip(*mine)]
    found = [(i, *near(v)) for i, v in kept]
    each = [sum(d for _, d, j in found if j == n) for n in range(len(c))]
    return sorted(((i, j, d, each[j], sum(each), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, d, j in found), key=repr)


def check(spark, rows, kind="array<double>"):
    table = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, cluster string").repartition(3)
    found = centroids.centroid_clusters(table)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert got == brute([r[:2] for r in rows])
    return got


def test_same_as_brute_force_with_odd_rows(spark):
    rnd = random.Random(13)
    blob = lambda k: [math.sin(k * (j + 1)) + rnd.gauss(0, 0.2) for j in range(64)]
    rows = [(i, blob(i % 9), "c") for i in range(300)]
    rows += [(1000, None, None), (1001, [0.0] * 63, None), (1002, [0.0] * 65, None), (1003, [], None), (1004, [None] + [0.0] * 63, None)]
    rows += [(1005, [math.nan] + [0.0] * 63, None), (1006, [math.inf] + [0.0] * 63, None), (None, blob(1), None), (None, blob(2), None), (5, blob(3), None), (5, rows[5][1], None)]
    rows += [(1007, [1e300, -1e300] + [1e6] * 62, None), (1008, [-0.0001] * 64, None)]
    assert len(check(spark, rows)) == 306


def test_ties_few_vectors_and_empty_clusters(spark):
    check(spark, [(i, [float(i % 2)] * 64, None) for i in range(40)], "array<float>")  # eight starts at two places: six stay empty
    check(spark, [(i, [0.5 * i] * 64, None) for i in range(3)])
    assert check(spark, [(1, [0.0], None)]) == []
    assert check(spark, [(9, [0.25] * 64, None)])[0][2] == 0


def test_floor_of_negative_sums(spark):
    rows = [(i, [-(i % 7) / 1024] * 64, None) for i in range(50)]
    check(spark, rows)
