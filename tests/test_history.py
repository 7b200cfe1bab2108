"""Snapshots in every order of arrival, rebuilt and spliced histories, probes in time."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scd2

DAY = [dt.datetime(2031, 3, d) for d in range(1, 10)]
ABSENT = object()
ORDERS = list(itertools.permutations(range(5)))


def column_of(spark, values):
    """A column that gives each order (its number is the key ``o``) its own value."""
    return F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(v).cast("timestamp_ntz")) for k, v in enumerate(values)))[F.col("o")]


def neighbours(step, order):
    done, k = sorted(order[:step]), order[step]
    return max([x for x in done if x < k], default=None), min([x for x in done if x > k], default=None)


def day(k):
    return None if k is None else DAY[k]


def in_order(snapshots):
    """Versions from one snapshot after the other, in plain Python; an absent key has no value."""
    out, open_ = [], {}
    for at, snap in snapshots:
        for k in set(open_) | set(snap):
            if k in open_ and snap.get(k, ABSENT) != open_[k][0]:
                out.append((k, open_[k][0], open_[k][1], at))
                del open_[k]
            if k in snap and k not in open_:
                open_[k] = (snap[k], at)
    return sorted([*out, *[(k, v, f, None) for k, (v, f) in open_.items()]], key=repr)


def presence_in_order(snapshots):
    out, open_ = [], {}
    for at, snap in snapshots:
        for k in set(open_) | set(snap):
            new = None if not snap else k in snap
            if k in open_ and open_[k][0] != new:
                out.append((k, *open_.pop(k), at))
            if k not in open_ and new is not None:
                open_[k] = (new, at)
    return sorted([*out, *[(k, v, f, None) for k, (v, f) in open_.items()]], key=repr)


def random_snapshots(seed):
    rnd = random.Random(seed)
    return [(DAY[t], {k: rnd.choice([1, 2, None]) for k in "abcdefgh" if rnd.random() < 0.6}) for t in range(5)]


@pytest.mark.parametrize("seed", [2])
def test_every_order_of_five_snapshots(spark, seed):
    """All 120 orders at once: the number of the order is part of the key."""
    snapshots = random_snapshots(seed)
    rows = spark.createDataFrame([(o, k, v, t) for o in range(len(ORDERS)) for t, (_, s) in enumerate(snapshots) for k, v in s.items()], "o int, k string, v int, t int")
    history = spark.createDataFrame([], "o int, k string, v int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    for step in range(5):
        now = F.create_map(*itertools.chain.from_iterable((F.lit(i), F.lit(o[step])) for i, o in enumerate(ORDERS)))[F.col("o")]
        near = [neighbours(step, o) for o in ORDERS]
        at, before, after = (column_of(spark, x) for x in ([DAY[o[step]] for o in ORDERS], [day(b) for b, _ in near], [day(a) for _, a in near]))
        history = scd2.scd2_splice(history, rows.filter(F.col("t") == now), ["o", "k"], ["v"], at, before, after)
        history = spark.createDataFrame(history.collect(), history.schema)
    assert scd2.scd2_check(history, ["o", "k"]).isEmpty()
    want, got = in_order(snapshots), {}
    for r in history.collect():
        got.setdefault(r.o, []).append((r.k, r.v, r.valid_from, r.valid_to))
    assert len(got) == 120 and all(sorted(x, key=repr) == want for x in got.values())
    times = spark.createDataFrame([(DAY[t], day(t + 1) if t < 4 else None) for t in range(5)], "observed_at timestamp_ntz, next_at timestamp_ntz")
    flat = spark.createDataFrame([(k, v, at) for at, s in snapshots for k, v in s.items()], "k string, v int, observed_at timestamp_ntz")
    assert sorted((tuple(r) for r in scd2.scd2_rebuild(flat, ["k"], ["v"], times).select("k", "v", "valid_from", "valid_to").collect()), key=repr) == want


@pytest.mark.parametrize("empties", [(), (0, 3), (1, 2)])
def test_every_order_of_presence(spark, empties):
    keys = [f"k{n}" for n in range(32)]
    snapshots = [(DAY[t], {k: True for n, k in enumerate(keys) if n >> t & 1 and t not in empties}) for t in range(5)]
    assert all(s or t in empties for t, (_, s) in enumerate(snapshots))
    rows = spark.createDataFrame([(o, k, t) for o in range(len(ORDERS)) for t, (_, s) in enumerate(snapshots) for k in s], "o int, k string, t int")
    history = spark.createDataFrame([], "o int, k string, available boolean, valid_from timestamp_ntz, valid_to timestamp_ntz")
    for step in range(5):
        now = F.create_map(*itertools.chain.from_iterable((F.lit(i), F.lit(o[step])) for i, o in enumerate(ORDERS)))[F.col("o")]
        near = [neighbours(step, o) for o in ORDERS]
        next_empty = [day(min([x for x in o[:step] if x > o[step] and x in empties], default=None)) for o in ORDERS]
        at, before, after, end = (column_of(spark, x) for x in ([DAY[o[step]] for o in ORDERS], [day(b) for b, _ in near], [day(a) for _, a in near], next_empty))
        empty = now.isin(list(empties)) if empties else F.lit(False)
        history = scd2.presence_splice(history, rows.filter(F.col("t") == now), ["o", "k"], at, before, after, empty, end)
        history = spark.createDataFrame(history.collect(), history.schema)
    assert scd2.scd2_check(history, ["o", "k"]).isEmpty()
    want, got = presence_in_order(snapshots), {}
    for r in history.collect():
        got.setdefault(r.o, []).append((r.k, r.available, r.valid_from, r.valid_to))
    assert len(got) == 120
    for o, x in got.items():
        assert sorted(x, key=repr) == want, ORDERS[o]
    times = scd2.snapshot_times(spark.createDataFrame([(DAY[t], t in empties) for t in range(5)], "observed_at timestamp_ntz, empty boolean"))
    flat = spark.createDataFrame([(k, at) for at, s in snapshots for k in s], "k string, observed_at timestamp_ntz")
    assert sorted((tuple(r) for r in scd2.presence_rebuild(flat, ["k"], times).collect()), key=repr) == want
    # One by one, as the write path does it.
    one = spark.createDataFrame([], "k string, available boolean, valid_from timestamp_ntz, valid_to timestamp_ntz")
    for at, s in snapshots:
        present = spark.createDataFrame([(k,) for k in s], "k string")
        plan = scd2.presence_plan(scd2.scd2_current(one), present, ["k"], empty=not s)
        one = one.filter("valid_to is not null").unionByName(scd2.presence_versions(plan, ["k"], F.lit(at).cast("timestamp_ntz")))
        one = spark.createDataFrame(one.collect(), one.schema)
    assert sorted((tuple(r) for r in one.collect()), key=repr) == want


def test_probes_find_the_version_that_holds(spark):
    rnd = random.Random(5)
    versions, probes = [], []
    for k in ["a", "b", "c", None]:
        t = dt.datetime(2031, 1, 1)
        for n in range(12):
            end = t + dt.timedelta(days=rnd.choice([1, 20, 70]))
            if n % 4 != 3:  # a gap
                versions.append((k, n, t, None if n == 10 else end))
            t = end
        probes += [(k, v[2] + dt.timedelta(microseconds=d)) for v in versions if v[0] == k for d in (-1, 0, 1)]
    probes += [("a", None), ("nobody", DAY[0]), ("a", dt.datetime(2030, 1, 1)), ("a", dt.datetime(2050, 1, 1))] + [("b", DAY[3])] * 50
    rows = [(i, k, t) for i, (k, t) in enumerate(probes)]
    got = scd2.scd2_asof_join(spark.createDataFrame(rows, "id int, k string, t timestamp_ntz"), spark.createDataFrame(versions, "k string, n int, valid_from timestamp_ntz, valid_to timestamp_ntz"), ["k"], "t", ["n"])
    assert got.columns == ["id", "k", "t", "n", "valid_from", "valid_to"]

    def held(k, t):
        return next(((n, f, e) for key, n, f, e in versions if k is not None and key == k and t is not None and f <= t and (e is None or t < e)), (None, None, None))

    assert {r.id: (r.n, r.valid_from, r.valid_to) for r in got.collect()} == {i: held(k, t) for i, k, t in rows} and got.count() == len(rows)
