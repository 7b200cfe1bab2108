"""Workers on one stored error log, retention and orphans over what syncs store; windows over a stream with late rows."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from tidemark.sources.store import StateStore
from tidemark.streaming import sync, upkeep

NOW = dt.datetime(2031, 5, 1, 12)
HOUR = dt.timedelta(hours=1)


def error(k, at=NOW - HOUR, **more):
    return dict(id=k, occurred_at=at, provider="lake", stage="parse", severity="error", message=f"m{k}", resolved=False, notification_state="pending", notification_attempts=0) | more


def states(store):
    return {r.id: (r.notification_state, r.notification_attempts, r.worker) for r in upkeep.stored_errors(store, "lake").collect()}


def test_two_workers_never_claim_one_error(spark, tmp_path):
    store = StateStore(spark, f"file://{tmp_path}/s")
    store.append("lake", {"errors": sync._rows(spark, sync.ERRORS, [error(k) for k in range(12)] + [error(90, resolved=True), error(91, NOW - 48 * HOUR)])})
    with ThreadPoolExecutor(3) as pool:
        got = list(pool.map(lambda w: {r.id for r in upkeep.claim_stored(store, "lake", w, NOW, limit=4).collect()}, ["a", "b", "c"]))
    assert sorted(len(g) for g in got) == [4, 4, 4] and set.union(*got) == set(range(12))
    assert upkeep.claim_stored(store, "lake", "d", NOW + dt.timedelta(seconds=600)).isEmpty(), "leases hold"
    ids = lambda s: spark.createDataFrame([(k,) for k in s], "id long")
    upkeep.settle_stored(store, "lake", "a", ids(got[0] | got[1]), NOW, sent=True)
    upkeep.settle_stored(store, "lake", "b", ids(got[1]), NOW, sent=False)
    now = states(store)
    assert all(now[k] == ("sent", 1, "a") for k in got[0]) and all(now[k][0] == "pending" for k in got[1]) and all(now[k] == ("claimed", 1, "c") for k in got[2])
    # Expired leases return, and an old holder settles nothing any more.
    later = NOW + dt.timedelta(seconds=601)
    assert {r.id for r in upkeep.claim_stored(store, "lake", "d", later).collect()} == got[1] | got[2]
    upkeep.settle_stored(store, "lake", "c", ids(got[2]), later, sent=True)
    assert all(states(store)[k] == ("claimed", 2, "d") for k in got[2])
    upkeep.sweep_stored(store, "lake", later + HOUR, max_attempts=2)
    assert all(states(store)[k][0] == "dead" for k in got[1] | got[2]) and states(store)[90][0] == "pending"


def test_retention_and_orphans(spark, tmp_path):
    store, day = StateStore(spark, f"file://{tmp_path}/s"), dt.timedelta(days=1)
    ages = [1, 40, 100]
    store.append("lake", {
        "errors": sync._rows(spark, sync.ERRORS, [error(a, NOW - a * day, resolved=a != 40) for a in ages] + [error(101, NOW - 100 * day)]),
        "health": sync._rows(spark, sync.HEALTH, [dict(checked_at=NOW - a * day, component=f"c{a}") for a in ages]),
        "payloads": sync._rows(spark, sync.PAYLOADS, [dict(provider="lake", sha256=f"s{a}", observed_at=NOW - a * day, content=b"x") for a in [91, 100, 1]]),
        "ledger": sync._rows(spark, sync.LEDGER, [dict(provider="lake", sha256=f"s{a}", observed_at=NOW - a * day, at=NOW - a * day) for a in [91, 100, 1]]),
        "runs": sync._rows(spark, sync.RUNS, [dict(run_id=r, provider="lake", event="start", status="running", at=NOW - h * HOUR) for r, h in (("old", 3), ("young", 1), ("ended", 3))]
                           + [dict(run_id="ended", provider="lake", event="finish", status="success", at=NOW)])})
    upkeep.retain_stored(store, "lake", NOW)
    read = lambda n, c: store.read(n, sync._schema(spark, c)).collect()
    assert {r.id for r in read("errors", sync.ERRORS)} == {1, 40, 101} and {r.component for r in read("health", sync.HEALTH)} == {"c1"}
    assert {r.sha256 for r in read("payloads", sync.PAYLOADS)} == {"s1"} and len(read("ledger", sync.LEDGER)) == 3
    assert upkeep.fail_stored_orphans(store, "lake", NOW) == 1 and upkeep.fail_stored_orphans(store, "lake", NOW) == 0
    assert {(r.run_id, r.status, r.error_message) for r in read("runs", sync.RUNS) if r.event == "finish"} == {("old", "failed", "orphaned run"), ("ended", "success", None)}


def test_stream_windows_drop_late_rows_in_append_and_update_mode(spark, tmp_path):
    """A row behind the watermark counts in neither mode; a restart from the checkpoint goes on where the query stood."""
    at = lambda m: dt.datetime(2031, 5, 1, 0, 0) + dt.timedelta(minutes=m)
    batches = [[0, 1, 2, 11], [5, 30], [3, 31], [70]]  # 5 is late but inside the watermark of 10 minutes after 11; 3 is behind that after 30
    for mode in ("append", "update"):
        inbox, found = tmp_path / f"in-{mode}", []
        inbox.mkdir()
        for batch in batches:
            spark.createDataFrame([(at(m), "x") for m in batch], "ts timestamp, phase string").coalesce(1).write.mode("append").parquet(str(inbox))
            rows = spark.readStream.schema("ts timestamp, phase string").parquet(str(inbox))
            query = sync.windowed_stream(rows, "ts", 10, ["phase"]).writeStream.outputMode(mode).option("checkpointLocation", f"{tmp_path}/cp-{mode}").trigger(availableNow=True).foreachBatch(
                lambda df, _: found.extend(df.collect())).start()
            query.awaitTermination(120)
            assert query.exception() is None
        counts = {int((r.window_start - at(0)).total_seconds() // 60): round(r.rate * 600) for r in found}
        assert counts == {0: 4, 10: 1, 30: 2} | ({70: 1} if mode == "update" else {}), mode
