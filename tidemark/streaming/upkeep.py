"""Upkeep of what syncs have stored: claims of errors for the digest, retention, runs that never ended."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import logs
from tidemark.sources.store import StateStore
from tidemark.streaming.sync import ERRORS, HEALTH, LEDGER, PAYLOADS, RUNS

#: What happened to an error after it was stored; ``seq`` is the version it was decided on, so the latest has the largest.
EVENTS = "id bigint, provider string, seq bigint, worker string, notification_state string, notified_at timestamp_ntz, notification_claimed_at timestamp_ntz, notification_attempts int"
_STATE = ("notification_state", "notified_at", "notification_claimed_at", "notification_attempts")


def _schema(spark: SparkSession, columns: str):
    return spark.createDataFrame([], columns).schema


def _ts(at: datetime):
    return F.lit(at).cast("timestamp_ntz")


def stored_errors(store: StateStore, provider: str, at: dict | None = None) -> DataFrame:
    """A provider's errors in their latest state, with the ``worker`` that put them there: the error log folded with its events.

    Events combine on the map side; an error without any is as it was stored.
    """
    at = at or store.pointer(provider)
    errors = store.read("errors", _schema(store.spark, ERRORS), at=at)
    last = store.read("error_events", _schema(store.spark, EVENTS), at=at).groupBy("id").agg(F.max_by(F.struct(*_STATE, "worker"), "seq").alias("e"))
    j = errors.join(last, "id", "left")
    state = {c: F.when(F.col("e").isNull(), F.col(c)).otherwise(F.col(f"e.{c}")) for c in _STATE}
    return j.withColumns(state).withColumn("worker", F.col("e.worker")).drop("e").select(*errors.columns, "worker")


def _decided(store: StateStore, provider: str, worker: str | None, decide) -> DataFrame:
    """Store as events what ``decide`` makes of the errors' state; if another worker commits first, decide again on what it left."""
    schema = _schema(store.spark, EVENTS)

    def attempt() -> dict:
        base = store.pointer(provider)
        rows = decide(stored_errors(store, provider, base)).select(
            "id", F.lit(provider).alias("provider"), F.lit(base["version"]).cast("long").alias("seq"), F.lit(worker).cast("string").alias("worker"), *_STATE)
        folder = store.write("error_events", rows)
        store.commit(base, added={"error_events": folder})
        return {"folder": folder}

    return store.spark.read.schema(schema).parquet(store.retried(attempt)["folder"])


def claim_stored(store: StateStore, provider: str, worker: str, now: datetime, **limits) -> DataFrame:
    """Claim a provider's errors that are due (``logs.claim``, its ``limits``), for ``worker`` alone; they, as they are once claimed."""
    events = _decided(store, provider, worker, lambda errors: logs.claim(errors, _ts(now), **limits))
    errors = store.read("errors", _schema(store.spark, ERRORS), provider=provider)
    return errors.drop(*_STATE).join(events.select("id", *_STATE), "id")


def settle_stored(store: StateStore, provider: str, worker: str, ids: DataFrame, now: datetime, sent: bool, max_attempts: int = 5) -> DataFrame:
    """The errors of ``ids`` that ``worker`` still holds become sent, or wait again (dead after ``max_attempts``); a claim that passed to another stays its own."""

    def decide(errors: DataFrame) -> DataFrame:
        held = errors.filter((F.col("notification_state") == "claimed") & (F.col("worker") == worker)).join(ids.select("id").distinct(), "id", "left_semi")
        return logs.mark_sent(held, held.select("id"), _ts(now)) if sent else logs.mark_failed(held, held.select("id"), max_attempts)

    return _decided(store, provider, worker, decide)


def sweep_stored(store: StateStore, provider: str, now: datetime, max_attempts: int = 5, lease: int = 600) -> DataFrame:
    """Claims whose lease ran out after the last attempt are dead."""
    return _decided(store, provider, None, lambda errors: logs.sweep_dead(errors.filter("notification_state = 'claimed'"), _ts(now), max_attempts, lease).filter("notification_state = 'dead'"))


def fail_stored_orphans(store: StateStore, provider: str, now: datetime, stale: int = 7200) -> int:
    """Runs that began more than ``stale`` seconds ago and never ended get a failed end; how many. Run once at start."""
    schema = _schema(store.spark, RUNS)

    def attempt() -> dict:
        base = store.pointer(provider)
        runs = store.read("runs", schema, at=base)
        ended = runs.filter("event = 'finish'").select("run_id").distinct()
        gone = runs.filter((F.col("event") == "start") & (F.col("at") < _ts(now) - F.make_dt_interval(secs=F.lit(stale)))).join(ended, "run_id", "left_anti")
        gone = gone.withColumns({"event": F.lit("finish"), "status": F.lit("failed"), "error_message": F.lit("orphaned run")}).select(*schema.names).persist()
        n = gone.count()
        if n:
            store.commit(base, added={"runs": store.write("runs", gone)})
        gone.unpersist()
        return {"n": n}

    return store.retried(attempt)["n"]


def retain_stored(store: StateStore, provider: str, now: datetime, payload_days: int = 90, health_days: int = 30, error_days: int = 90) -> None:
    """Delete old payloads, old health rows, and old errors that are resolved or sent, with their events, from what a provider's syncs stored.

    The newest payload stays whatever its age, and the ledger stays whole, so no payload counts as new again. Rows are
    rewritten folder by table and committed one table at a time.
    """
    spark, at = store.spark, _ts(now)
    newest = store.read("ledger", _schema(spark, LEDGER), provider=provider).agg(F.max_by("sha256", "at")).first()[0]
    store.rewrite("payloads", _schema(spark, PAYLOADS), provider, lambda df: logs.retain(df, "observed_at", at, payload_days, ~F.col("sha256").eqNullSafe(F.lit(newest))))
    store.rewrite("health", _schema(spark, HEALTH), provider, lambda df: logs.retain(df, "checked_at", at, health_days))
    done = stored_errors(store, provider).filter(F.col("resolved") | F.col("notification_state").isin("sent", "dead")).select("id", F.lit(True).alias("_done"))
    old = lambda df: logs.retain(df.join(done, "id", "left"), "occurred_at", at, error_days, F.coalesce("_done", F.lit(False)))
    store.rewrite("errors", _schema(spark, ERRORS), provider, lambda df: old(df).select(*df.columns))
    left = store.read("errors", _schema(spark, ERRORS), provider=provider).select("id")
    store.rewrite("error_events", _schema(spark, EVENTS), provider, lambda df: df.join(left, "id", "left_semi"))
