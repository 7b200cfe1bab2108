"""Queries of logs, digests, retention, freshness and windowed metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import ts
from tidemark.operators import logs, metrics
from tidemark.plans.registry import query
from tidemark.plans.roles import role, role_of, table, with_roles
from tidemark.sources.scratch import new_folder
from tidemark.streaming import alerts

NOW = "2024-01-31 00:00:00"
#: The log spans January 2024, so the digest's window is a month here.
WINDOW = 31 * 86_400
T = f"timestamp '{NOW}'"
DUE = f"not resolved and notified_at is null and notification_attempts < 5 and occurred_at > {T} - interval 31 days and (notification_state = 'pending' or (notification_state = 'claimed' and notification_claimed_at < {T} - interval 600 seconds))"
CLAIMED = f"select id, occurred_at, stage, severity, message, notification_attempts + 1 as notification_attempts from errors where {DUE} order by occurred_at, id limit 5000"


def _errors(spark, sf_dir):
    return role(spark, sf_dir, "errors")


def _claimed(spark, sf_dir):
    return logs.claim(_errors(spark, sf_dir), ts(NOW), window=WINDOW)


@query("claim_batch", with_roles("errors", CLAIMED))
def claim_batch(spark, sf_dir):
    """The claim's limit is the feature: the oldest 5000 that are due."""
    return _claimed(spark, sf_dir).select("id", "occurred_at", "stage", "severity", "message", "notification_attempts")


#: The message's first 80 bytes: one byte, then letters of two bytes, then others of one; a letter that would be cut is left out.
TWO = "(length(message) - length(replace(message, 'é', '')))"
PREFIX = f"left(message, cast(case when {TWO} >= 40 then 40 else 80 - {TWO} end as int))"
GROUPS = f"select stage, severity, {PREFIX} as prefix, count(*) as n, min(occurred_at) as first_seen, max(occurred_at) as last_seen, arg_max(message, (occurred_at, -id)) as message from ({CLAIMED}) group by stage, severity, {PREFIX}"


@query("error_digest", with_roles("errors", GROUPS))
def error_digest(spark, sf_dir):
    return logs.error_digest(_claimed(spark, sf_dir))


@query("digest_totals", with_roles("errors", f"select cast(sum(n) as bigint) as events, count(*) as groups from ({GROUPS})"))
def digest_totals(spark, sf_dir):
    return logs.error_digest(_claimed(spark, sf_dir)).agg(F.sum("n").alias("events"), F.count("*").alias("groups"))


LINE = "'[' || upper(severity) || '] ' || stage || ' - ' || n || chr(10) || '    first: ' || strftime(first_seen, '%Y-%m-%d %H:%M:%S UTC') || chr(10) || '    last: ' || strftime(last_seen, '%Y-%m-%d %H:%M:%S UTC') || chr(10) || '    example: ' || message"


@query("digest_text", with_roles("errors", f"select 'Errors of the last 44640 min' || chr(10) || 'events: ' || cast(sum(n) as bigint) || chr(10) || 'groups: ' || count(*) || chr(10) || chr(10) || string_agg({LINE}, chr(10) || chr(10) order by -n, {LINE}) as body from ({GROUPS})"))
def digest_text(spark, sf_dir):
    return logs.digest_text(logs.error_digest(_claimed(spark, sf_dir)), WINDOW // 60)


@query("digest_states", with_roles("errors", "select notification_state, count(*) as n from errors where not resolved group by notification_state"))
def digest_states(spark, sf_dir):
    return _errors(spark, sf_dir).filter(~F.col("resolved")).groupBy("notification_state").agg(F.count("*").alias("n"))


@query("dead_window", with_roles("errors", f"select min(occurred_at) as first_at, max(occurred_at) as last_at, count(*) as n from errors where notification_state = 'dead' and occurred_at > {T} - interval 7 days"))
def dead_window(spark, sf_dir):
    dead = _errors(spark, sf_dir).filter((F.col("notification_state") == "dead") & (F.col("occurred_at") > ts(NOW) - F.make_dt_interval(days=F.lit(7))))
    return dead.agg(F.min("occurred_at").alias("first_at"), F.max("occurred_at").alias("last_at"), F.count("*").alias("n"))


@query("errors_by_stage", with_roles("errors", "select stage, severity, count(*) as n from errors group by stage, severity"))
def errors_by_stage(spark, sf_dir):
    return _errors(spark, sf_dir).groupBy("stage", "severity").agg(F.count("*").alias("n"))


# Acknowledgements name the critical errors.
@query("mark_sent", with_roles("errors", f"select id, case when severity = 'critical' and notification_state = 'claimed' then 'sent' else notification_state end as notification_state, case when severity = 'critical' and notification_state = 'claimed' then {T} else notified_at end as notified_at from errors"))
def mark_sent(spark, sf_dir):
    e = _errors(spark, sf_dir)
    return logs.mark_sent(e, e.filter("severity = 'critical'").select("id"), ts(NOW)).select("id", "notification_state", "notified_at")


@query("mark_failed", with_roles("errors", "select id, case when severity = 'critical' and notification_state = 'claimed' then case when notification_attempts >= 5 then 'dead' else 'pending' end else notification_state end as notification_state from errors"))
def mark_failed(spark, sf_dir):
    e = _errors(spark, sf_dir)
    return logs.mark_failed(e, e.filter("severity = 'critical'").select("id")).select("id", "notification_state")


@query("sweep_dead", with_roles("errors", f"select id, case when notification_state = 'claimed' and notification_attempts >= 5 and notification_claimed_at < {T} - interval 600 seconds then 'dead' else notification_state end as notification_state from errors"))
def sweep_dead(spark, sf_dir):
    return logs.sweep_dead(_errors(spark, sf_dir), ts(NOW)).select("id", "notification_state")


@query("backfill_state", with_roles("errors", "select id, case when notified_at is not null then 'sent' else notification_state end as notification_state from errors"))
def backfill_state(spark, sf_dir):
    return logs.backfill_state(_errors(spark, sf_dir).withColumn("notification_state", F.when(F.col("notification_state") == "sent", "pending").otherwise(F.col("notification_state")))).select("id", "notification_state")


@query("retention_snapshots", f"""select doc_id from documents where not (date '2023-06-01' + cast(n_chars % 365 as int) < {T} - interval 90 days) or doc_id in (select event_id from events where event_type = 'purchase')""")
def retention_snapshots(spark, sf_dir):
    """Documents as payloads; their length dates them."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.date_add(F.lit("2023-06-01").cast("date"), (F.col("n_chars") % 365).cast("int")).cast("timestamp_ntz").alias("fetched_at"))
    return logs.retain_snapshots(docs, role(spark, sf_dir, "runs"), ts(NOW)).select(F.col("id").alias("doc_id"))


@query("retention_health", f"select event_id from events where not (ts < {T} - interval 14 days)")
def retention_health(spark, sf_dir):
    return logs.retain(table(spark, sf_dir, "events"), "ts", ts(NOW), 14).select("event_id")


@query("retention_errors", with_roles("errors", f"select id from errors where not (occurred_at < {T} - interval 14 days and resolved)"))
def retention_errors(spark, sf_dir):
    return logs.retain(_errors(spark, sf_dir), "occurred_at", ts(NOW), 14, F.col("resolved")).select("id")


@query("orphan_runs", with_roles("runs", f"""select id, case when {{o}} then 'failed' else status end as status, case when {{o}} then {T} else finished_at end as finished_at,
    case when {{o}} then coalesce(error_message, 'orphaned run') else error_message end as error_message from runs""".replace("{o}", f"(status = 'running' and started_at < {T} - interval 7200 seconds)")))
def orphan_runs(spark, sf_dir):
    return logs.fail_orphans(role(spark, sf_dir, "runs"), ts(NOW)).select("id", "status", "finished_at", "error_message")


@query("run_log", with_roles("runs", "select id, provider, started_at, status, finished_at from runs"))
def run_log(spark, sf_dir):
    runs = role(spark, sf_dir, "runs")
    finishes = runs.filter("status <> 'running'").select(F.col("id").alias("run_id"), "status", "finished_at")
    return logs.run_view(runs.select(F.col("id").alias("run_id"), "provider", "started_at"), finishes).withColumnRenamed("run_id", "id")


@query("latest_runs", with_roles("runs", "select id, provider, status, started_at from runs order by started_at desc, id desc limit 20"))
def latest_runs(spark, sf_dir):
    """A top-k report."""
    return role(spark, sf_dir, "runs").orderBy(F.desc("started_at"), F.desc("id")).limit(20).select("id", "provider", "status", "started_at")


def _fresh(name, statuses, max_age, allow_down):
    worst = "down" if allow_down else "degraded"
    listed = ", ".join(f"'{s}'" for s in statuses)
    sql = f"""select provider, age, case when age is null then 'degraded' when age > {2 * max_age} then '{worst}' when age > {max_age} then 'degraded' else 'ok' end as state
        from (select provider, cast(floor(epoch({T})) - floor(epoch(max(case when status in ({listed}) then finished_at end))) as bigint) as age from runs group by provider)"""

    @query(name, with_roles("runs", sql))
    def fresh(spark, sf_dir):
        return logs.freshness(role(spark, sf_dir, "runs"), ts(NOW), max_age, statuses, allow_down)


_fresh("freshness_pipeline", ["success", "skipped"], 3600, True)
_fresh("freshness_content", ["success"], 3600, False)


@query("snapshot_stats", "select count(*) as snapshots, cast(sum(strlen(text)) as bigint) as bytes from documents")
def snapshot_stats(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("snapshots"), F.sum(F.octet_length("text")).alias("bytes"))


# Windowed metrics.
BIN5 = "time_bucket(interval 5 minutes, ts)"


def _metrics(spark, sf_dir):
    return role(spark, sf_dir, "metrics")


@query("rate_by_table", with_roles("metrics", f"select {BIN5} as window_start, phase, sum(duration) / 300 as rate from metrics group by 1, 2"))
def rate_by_table(spark, sf_dir):
    return metrics.window_rate(_metrics(spark, sf_dir), "ts", 5, ["phase"], F.col("duration"))


GRID5 = f"""select unnest(generate_series(a, b, interval 5 minutes)) as window_start, provider from (select min({BIN5}) as a, max({BIN5}) as b from metrics where status = 'failed'), (select distinct provider from metrics)"""


@query("error_rate", with_roles("metrics", f"""select g.window_start, g.provider, coalesce(s.rate, 0) as rate, coalesce(s.rate, 0) > 0.003 as firing from ({GRID5}) g
    left join (select {BIN5} as window_start, provider, count(*) / 300 as rate from metrics where status = 'failed' group by 1, 2) s on s.window_start = g.window_start and s.provider = g.provider"""))
def error_rate(spark, sf_dir):
    """Errors a second, zero in silent windows, and whether they pass the alert's threshold (here 0.003, for a thin log)."""
    m = _metrics(spark, sf_dir)
    rates = metrics.window_rate(m.filter("status = 'failed'"), "ts", 5, ["provider"])
    return metrics.zero_fill(rates, m, "provider", "rate", 5).withColumn("firing", F.col("rate") > 0.003)


@query("request_increase", with_roles("metrics", "select time_bucket(interval 1 hour, ts) as window_start, status, count(*) as n from metrics group by 1, 2"))
def request_increase(spark, sf_dir):
    """Requests of an hour by status."""
    return _metrics(spark, sf_dir).groupBy(F.window("ts", "1 hour").alias("w"), "status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "status", "n")


@query("request_rate", with_roles("metrics", f"select {BIN5} as window_start, phase, status, count(*) / 300 as rate from metrics group by 1, 2, 3"))
def request_rate(spark, sf_dir):
    return metrics.window_rate(_metrics(spark, sf_dir), "ts", 5, ["phase", "status"])


LE = metrics.DURATION_BUCKETS


def _quantile_sql(q, c="c"):
    """Interpolation inside the bucket that holds the rank; ``c0`` to ``c15`` are cumulative counts."""
    rank, n = f"({c}{len(LE)} * {q})", len(LE)
    part = lambda k: f"{LE[k - 1] if k else 0.0}::double + {LE[k] - (LE[k - 1] if k else 0.0)!r}::double * ({rank} - {f'{c}{k - 1}' if k else 0}) / ({c}{k} - {f'{c}{k - 1}' if k else 0})"
    return "round(case " + f"when {c}{n} = 0 then null " + " ".join(f"when {c}{k} >= {rank} then {part(k)}" for k in range(n)) + f" else {LE[-1]} end, 6)"


COUNTS = ", ".join([f"count(*) filter (duration <= {b}) as c{k}" for k, b in enumerate(LE)] + [f"count(duration) as c{len(LE)}"])


@query("phase_p95", with_roles("metrics", f"""select window_start, phase, {_quantile_sql(0.95)} as quantile from (
    select time_bucket(interval 1 minute, ts) - to_minutes(k) as window_start, phase, {COUNTS} from metrics, (select unnest(range(10)) as k) group by 1, 2)"""))
def phase_p95(spark, sf_dir):
    return metrics.window_quantiles(_metrics(spark, sf_dir), "ts", "duration", 10, ["phase"], 0.95).withColumn("quantile", F.round("quantile", 6))


@query("phase_avg", with_roles("metrics", "select time_bucket(interval 1 hour, ts) as window_start, phase, avg(duration) as mean from metrics group by 1, 2"))
def phase_avg(spark, sf_dir):
    return _metrics(spark, sf_dir).groupBy(F.window("ts", "1 hour").alias("w"), "phase").agg(F.avg("duration").alias("mean")).select(F.col("w.start").alias("window_start"), "phase", "mean")


@query("success_age", with_roles("metrics", f"select provider, cast(floor(epoch({T})) - floor(epoch(max(ts))) as bigint) as age, floor(epoch({T})) - floor(epoch(max(ts))) > 7200 as firing from metrics where status = 'success' group by provider"))
def success_age(spark, sf_dir):
    age = F.unix_seconds(ts(NOW).cast("timestamp")) - F.unix_seconds(F.max("ts").cast("timestamp"))
    return _metrics(spark, sf_dir).filter("status = 'success'").groupBy("provider").agg(age.alias("age")).withColumn("firing", F.col("age") > 7200)


@query("cycles_by_status", with_roles("metrics", """select provider, count(*) filter (status = 'success') as success, count(*) filter (status = 'skipped') as skipped, count(*) filter (status = 'failed') as failed,
    cast(count(*) filter (phase = 'signup') as bigint) as deactivated, cast(coalesce(sum(cast(floor(100 * duration) as bigint)) filter (phase = 'view'), 0) as bigint) as fetched_bytes from metrics group by provider"""))
def cycles_by_status(spark, sf_dir):
    """Cycles by status with the totals of two counters, here made of the log's phases."""
    totals = [F.count_if(F.col("phase") == "signup").alias("deactivated"), F.coalesce(F.sum(F.when(F.col("phase") == "view", F.floor(100 * F.col("duration")))), F.lit(0)).cast("long").alias("fetched_bytes")]
    return _metrics(spark, sf_dir).groupBy("provider").agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("success", "skipped", "failed")], *totals)


@query("latency_quantiles", with_roles("metrics", f"select phase, {', '.join(f'{_quantile_sql(q)} as {n}' for q, n in ((0.5, 'p50'), (0.95, 'p95'), (0.99, 'p99')))} from (select phase, {COUNTS} from metrics group by phase)"))
def latency_quantiles(spark, sf_dir):
    counts = metrics.bucket_counts(_metrics(spark, sf_dir), "duration", ["phase"])
    return counts.select("phase", *[F.round(metrics.histogram_quantile(F.col("counts"), q), 6).alias(n) for q, n in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))])


@query("error_ratio", with_roles("metrics", f"select *, ratio > 0.01 as firing from (select {BIN5} as window_start, count(*) filter (status = 'failed') / count(*) as ratio from metrics group by 1)"))
def error_ratio(spark, sf_dir):
    return metrics.window_ratio(_metrics(spark, sf_dir), "ts", 5, F.col("status") == "failed").withColumn("firing", F.col("ratio") > 0.01)


HOURLY = "select time_bucket(interval 1 hour, ts) as window_start, provider, count(*) filter (status = 'failed') / count(*) as ratio from metrics group by 1, 2"


@query("alert_hold", with_roles("metrics", f"""select provider, min(window_start) as since, max(window_start) as until, count(*) as windows from
    (select *, window_start - to_hours(cast(row_number() over (partition by provider order by window_start) as int)) as run from ({HOURLY}) where ratio > 0.1) group by provider, run having count(*) >= 3"""))
def alert_hold(spark, sf_dir):
    hourly = metrics.window_ratio(_metrics(spark, sf_dir), "ts", 60, F.col("status") == "failed", ["provider"])
    return metrics.alert_hold(hourly, ["provider"], F.col("ratio") > 0.1, 3, 60)


CLOSED = f"{HOURLY} having time_bucket(interval 1 hour, ts) + interval 1 hour <= (select max(ts) - interval 10 minutes from metrics)"
HELD = f"select provider, min(window_start) as since, max(window_start) as until, count(*) as windows from (select *, window_start - to_hours(cast(row_number() over (partition by provider order by window_start) as int)) as run from ({CLOSED}) where ratio > 0.1) group by provider, run having count(*) >= 3"


@query("alert_stream", with_roles("metrics", f""", held as ({HELD}) select provider, 'firing' as state, since, since + interval 2 hours as until, cast(3 as bigint) as windows from held
    union all select provider, 'resolved', since, until, windows from held where until + interval 2 hours <= (select max(ts) - interval 10 minutes from metrics)"""))
def alert_stream(spark, sf_dir):
    """The whole log as a stream: alerts as they fire and as they end, in windows that the watermark has closed."""
    # A pattern, since a stream's plain path must be a folder and the table may be one file.
    log = role_of(spark, "metrics", "events", spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parque[t]"))
    windows = alerts.closed_windows(log, "ts", 60, ["provider"], {"ratio": F.count_if(F.col("status") == "failed") / F.count("*")})
    held, folder = alerts.hold_stream(windows, ["provider"], F.col("ratio") > 0.1, 3, 60), new_folder(spark, "alerts")
    with alerts.timers(spark):
        run = held.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(held.schema).parquet(f"{folder}/rows").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("since", "until")})


@query("duration_histogram", with_roles("metrics", f"select phase, le, count(*) filter (le is null or duration <= le) as n from metrics, (select unnest([{', '.join(map(str, metrics.DURATION_BUCKETS))}, null]::double[]) as le) group by phase, le"))
def duration_histogram(spark, sf_dir):
    return metrics.duration_histogram(_metrics(spark, sf_dir), "duration", ["phase"])


@query("zero_fill", with_roles("metrics", f"""select g.window_start, g.provider, coalesce(s.n, 0) as n from ({GRID5}) g
    left join (select {BIN5} as window_start, provider, count(*) as n from metrics where status = 'failed' group by 1, 2) s on s.window_start = g.window_start and s.provider = g.provider"""))
def zero_fill(spark, sf_dir):
    m = _metrics(spark, sf_dir)
    series = m.filter("status = 'failed'").groupBy(F.window("ts", "5 minutes").alias("w"), "provider").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "provider", "n")
    return metrics.zero_fill(series, m, "provider", "n", 5)
