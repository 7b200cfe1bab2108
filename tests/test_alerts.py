"""Alerts and rates over streams, against the same windows as a batch."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics
from tidemark.streaming import alerts, sync

T0 = datetime(2031, 5, 1)
SCHEMA = "ts timestamp, line string, bad boolean"
HOLD, WIDTH = 3, 10


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def held(rows):
    windows = alerts.closed_windows(rows, "ts", WIDTH, ["line"], {"share": F.count_if("bad") / F.count("*")})
    return alerts.hold_stream(windows, ["line"], F.col("share") > 0.5, HOLD, WIDTH)


def drain(df, sink, checkpoint):
    with alerts.timers(df.sparkSession):
        query = df.writeStream.format("parquet").option("path", str(sink)).option("checkpointLocation", str(checkpoint)).outputMode("append").trigger(availableNow=True).start()
    assert query.awaitTermination(300) and query.exception() is None
    return query


def wanted(spark, rows):
    """Firing and resolved rows by the batch operator over the windows that the last watermark has closed."""
    mark = max(r[0] for r in rows if r[0]) - timedelta(minutes=10)
    one = metrics.window_ratio(spark.createDataFrame(rows, SCHEMA), "ts", WIDTH, F.col("bad"), ["line"])
    one = one.filter((F.col("window_start") + F.make_dt_interval(mins=F.lit(WIDTH))) <= F.lit(mark))
    step, out = timedelta(minutes=WIDTH), []
    for r in metrics.alert_hold(one, ["line"], F.col("ratio") > 0.5, HOLD, WIDTH).collect():
        out.append((r.line, "firing", r.since, r.since + (HOLD - 1) * step, HOLD))
        if r.until + 2 * step <= mark:
            out.append((r.line, "resolved", r.since, r.until, r.windows))
    return sorted(out, key=repr)


def got(spark, sink):
    return sorted(map(tuple, spark.read.parquet(str(sink)).select("line", "state", "since", "until", "windows").collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_alerts_over_restarts_are_those_of_a_batch(spark, tmp_path, seed):
    """Gaps, a null series, rows out of order inside the watermark, and a query that stops and starts between files."""
    rnd, rows = random.Random(seed), []
    for line in ("a", "b", None):
        bad = False
        for m in range(0, 1440, 4):
            bad = bad if rnd.random() < 0.93 else not bad
            if (m // 60) % 7 != 3 or line == "b":
                rows.append((T0 + timedelta(minutes=m), line, bad))
    rows.sort(key=lambda r: (r[0], str(r[1])))
    parts = [rows[k:k + 200] for k in range(0, len(rows), 200)]
    for k, part in enumerate(parts):
        rnd.shuffle(part)
        write(spark, tmp_path / "in", part)
        if k % 2:
            drain(held(stream(spark, tmp_path / "in")), tmp_path / "out", tmp_path / "cp")
    drain(held(stream(spark, tmp_path / "in")), tmp_path / "out", tmp_path / "cp")
    want = wanted(spark, rows)
    assert got(spark, tmp_path / "out") == want and {r[1] for r in want} == {"firing", "resolved"} and None in {r[0] for r in want}


def test_a_run_ends_when_time_passes_without_rows(spark, tmp_path):
    fire = [(T0 + timedelta(minutes=10 * k), "a", True) for k in range(4)]
    write(spark, tmp_path / "in", fire)
    drain(held(stream(spark, tmp_path / "in")), tmp_path / "out", tmp_path / "cp")
    assert got(spark, tmp_path / "out") == [], "only two windows are closed"
    write(spark, tmp_path / "in", [(T0 + timedelta(hours=9), "b", False), (None, "a", True)])
    drain(held(stream(spark, tmp_path / "in")), tmp_path / "out", tmp_path / "cp")
    m = lambda k: T0 + timedelta(minutes=k)
    assert got(spark, tmp_path / "out") == [("a", "firing", m(0), m(20), 3), ("a", "resolved", m(0), m(30), 4)]


def test_short_runs_and_empty_streams_give_nothing(spark, tmp_path):
    write(spark, tmp_path / "in", [(T0, "a", True), (T0 + timedelta(minutes=10), "a", True), (T0 + timedelta(minutes=20), "a", None), (T0 + timedelta(days=1), "a", False)])
    drain(held(stream(spark, tmp_path / "in")), tmp_path / "out", tmp_path / "cp")
    assert got(spark, tmp_path / "out") == []
    write(spark, tmp_path / "none", [])
    drain(held(stream(spark, tmp_path / "none")), tmp_path / "out2", tmp_path / "cp2")


@pytest.mark.parametrize("mode", ["append", "update"])
def test_rates_with_late_rows(spark, tmp_path, mode):
    """A row within the watermark counts, one whose window is closed is dropped and counted as late; append waits for closed windows, update does not."""
    batches = [[(T0 + timedelta(minutes=k), "a", True) for k in (1, 2, 31)], [(T0 + timedelta(minutes=25), "a", True), (T0 + timedelta(minutes=45), "a", True)],
               [(T0 + timedelta(minutes=3), "a", True), (T0 + timedelta(minutes=62), "a", True)]]
    name, seen = f"late_{mode}", []
    for rows in batches:
        write(spark, tmp_path / "in", rows)
        rate = sync.windowed_stream(stream(spark, tmp_path / "in"), "ts", WIDTH, ["line"])
        query = rate.writeStream.foreachBatch(lambda df, _: seen.extend(map(tuple, df.select("window_start", F.round(F.col("rate") * 600).cast("int")).collect()))) \
            .queryName(name).option("checkpointLocation", f"{tmp_path}/cp").outputMode(mode).trigger(availableNow=True).start()
        assert query.awaitTermination(300) and query.exception() is None
    late = alerts.late_groups(query)
    m = lambda k: T0 + timedelta(minutes=k)
    last = dict(seen)
    assert late == 1 and last[m(0)] == 2 and last[m(20)] == 1, "25 is as late as allowed, 3 is later"
    assert (m(60) in last) == (mode == "update")
    assert len(seen) == len(last), "no window of these rows changes after it came"
