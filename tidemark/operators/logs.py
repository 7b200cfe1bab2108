"""Run, error and health logs: digest states, retention, freshness, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import utf8_prefix


def _seconds(n: int) -> Column:
    return F.make_dt_interval(secs=F.lit(n))


def _days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def claim(errors: DataFrame, now: Column, window: int = 86_400, max_attempts: int = 5, lease: int = 600, limit: int = 5000) -> DataFrame:
    """Errors due for the digest, the oldest ``limit`` of them, as they are once claimed."""
    free = (F.col("notification_state") == "pending") | ((F.col("notification_state") == "claimed") & (F.col("notification_claimed_at") < now - _seconds(lease)))
    due = errors.filter(
        ~F.col("resolved") & F.col("notified_at").isNull() & (F.col("notification_attempts") < max_attempts) & (F.col("occurred_at") > now - _seconds(window)) & free)
    return due.orderBy("occurred_at", "id").limit(limit).withColumns({
        "notification_state": F.lit("claimed"), "notification_claimed_at": now, "notification_attempts": F.col("notification_attempts") + 1})


def with_claims(errors: DataFrame, claimed: DataFrame) -> DataFrame:
    """The error table with ``claimed`` rows in place of their old state; at most ``limit`` ids are joined."""
    return errors.join(claimed.select("id"), "id", "left_anti").unionByName(claimed)


def mark_sent(errors: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    """Claimed errors of ``ids`` become sent; repeating it changes nothing."""
    hit = errors.join(ids.select("id").distinct().withColumn("_hit", F.lit(True)), "id", "left")
    yes = F.col("_hit").isNotNull() & (F.col("notification_state") == "claimed")
    return hit.withColumn("notified_at", F.when(yes, now).otherwise(F.col("notified_at"))).withColumn(
        "notification_state", F.when(yes, "sent").otherwise(F.col("notification_state"))).drop("_hit")


def mark_failed(errors: DataFrame, ids: DataFrame, max_attempts: int = 5) -> DataFrame:
    """Claimed errors of ``ids`` wait again, or are dead after ``max_attempts``."""
    hit = errors.join(ids.select("id").distinct().withColumn("_hit", F.lit(True)), "id", "left")
    yes = F.col("_hit").isNotNull() & (F.col("notification_state") == "claimed")
    next_ = F.when(F.col("notification_attempts") >= max_attempts, "dead").otherwise("pending")
    return hit.withColumn("notification_state", F.when(yes, next_).otherwise(F.col("notification_state"))).drop("_hit")


def sweep_dead(errors: DataFrame, now: Column, max_attempts: int = 5, lease: int = 600) -> DataFrame:
    """Claims whose lease has run out after the last attempt are dead."""
    over = (F.col("notification_state") == "claimed") & (F.col("notification_attempts") >= max_attempts) & (F.col("notification_claimed_at") < now - _seconds(lease))
    return errors.withColumn("notification_state", F.when(over, "dead").otherwise(F.col("notification_state")))


def backfill_state(errors: DataFrame) -> DataFrame:
    """Errors that were notified before states existed are sent."""
    return errors.withColumn("notification_state", F.when(F.col("notified_at").isNotNull(), "sent").otherwise(F.col("notification_state")))


def error_digest(claimed: DataFrame, prefix_bytes: int = 80) -> DataFrame:
    """Groups by stage, severity and message prefix: count, first and last time, latest message (of a tie the smallest id)."""
    return claimed.groupBy("stage", "severity", utf8_prefix(F.col("message"), prefix_bytes).alias("prefix")).agg(
        F.count("*").alias("n"), F.min("occurred_at").alias("first_seen"), F.max("occurred_at").alias("last_seen"),
        F.max_by("message", F.struct("occurred_at", -F.col("id"))).alias("message"))


def digest_text(digest: DataFrame, window_minutes: int = 1440) -> DataFrame:
    """One row: totals, then each group by count downwards with its times and latest message.

    A digest has at most as many groups as the claim's limit, so it fits one row.
    """
    when = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss 'UTC'")
    entry = F.concat(
        F.lit("["), F.upper("severity"), F.lit("] "), F.col("stage"), F.lit(" - "), F.col("n").cast("string"), F.lit("\n    first: "), when("first_seen"),
        F.lit("\n    last: "), when("last_seen"), F.lit("\n    example: "), F.col("message"))
    entries = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), entry.alias("line"))))
    return digest.agg(F.concat(
        F.lit(f"Errors of the last {window_minutes} min\nevents: "), F.coalesce(F.sum("n"), F.lit(0)).cast("string"), F.lit("\ngroups: "), F.count("*").cast("string"), F.lit("\n\n"),
        F.array_join(F.transform(entries, lambda x: x["line"]), "\n\n")).alias("body"))


def retain(rows: DataFrame, ts: str, now: Column, days: int, deletable: Column | None = None) -> DataFrame:
    """Rows that stay: those not older than ``days``, and those that may not be deleted."""
    old = F.col(ts) < now - _days(days)
    return rows.filter(~F.coalesce(old if deletable is None else old & deletable, F.lit(False)))


def retain_snapshots(snapshots: DataFrame, runs: DataFrame, now: Column, days: int = 90) -> DataFrame:
    """Snapshots that stay: young ones and those that a run refers to."""
    used = runs.select(F.col("raw_snapshot_id").alias("id")).filter("id is not null").distinct().withColumn("_used", F.lit(True))
    j = snapshots.join(used, "id", "left")
    return j.filter(~(F.col("fetched_at") < now - _days(days)) | F.col("_used").isNotNull()).drop("_used")


def fail_orphans(runs: DataFrame, now: Column, stale: int = 7200, message: str = "orphaned run") -> DataFrame:
    """Runs that have been running for longer than ``stale`` seconds have failed; a message that is there stays."""
    gone = (F.col("status") == "running") & (F.col("started_at") < now - _seconds(stale))
    return runs.withColumns({
        "finished_at": F.when(gone, now).otherwise(F.col("finished_at")),
        "error_message": F.when(gone, F.coalesce("error_message", F.lit(message))).otherwise(F.col("error_message")),
        "status": F.when(gone, "failed").otherwise(F.col("status"))})


def freshness(runs: DataFrame, now: Column, max_age: int, statuses: list[str], allow_down: bool) -> DataFrame:
    """Each provider's age in seconds of its last run with one of ``statuses``, and a state: ok, degraded, down."""
    last = F.max(F.when(F.col("status").isin(*statuses), F.col("finished_at")))
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("last").cast("timestamp"))
    state = F.when(F.col("age").isNull(), "degraded").when(F.col("age") > 2 * max_age, "down" if allow_down else "degraded").when(F.col("age") > max_age, "degraded").otherwise("ok")
    return runs.groupBy("provider").agg(last.alias("last")).withColumn("age", age).withColumn("state", state).select("provider", "age", "state")


def run_view(starts: DataFrame, finishes: DataFrame) -> DataFrame:
    """The run log: each started run with its latest finish, or running."""
    last = finishes.groupBy("run_id").agg(F.max_by(F.struct("status", "finished_at"), "finished_at").alias("f"))
    return starts.join(last, "run_id", "left").select(*starts.columns, F.coalesce("f.status", F.lit("running")).alias("status"), F.col("f.finished_at").alias("finished_at"))


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    return child.join(parent.select(*keys), keys, "left_anti")
