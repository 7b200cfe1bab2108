"""Snapshots from landed files into versioned tables, batch by batch."""

from __future__ import annotations

import contextlib
import functools
import hashlib
import json
import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import canonical, scd1, scd2
from tidemark.operators import enrich as rules_
from tidemark.sources import feed
from tidemark.sources.store import Conflict, StateStore

#: Payloads from so many bytes on are read by many tasks, if ``landed`` names their files.
LARGE_BYTES = 16 << 20
LIFE = "is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz"
VERSION = "valid_from timestamp_ntz, valid_to timestamp_ntz"
#: table -> (key columns, other columns) of dimensions.
DIMENSIONS = {
    "objects": ("external_id string", "name string"),
    "stages": ("external_id string", "name string"),
    "classes": ("external_class_id string", "external_object_id string, name string, description string, base_seats int, tiers int, partial_buyout boolean"),
    "rooms": ("external_room_id string", "external_object_id string, external_stage_id string, external_class_id string, number string"),
    "tours": ("external_cruise_id string", "external_object_id string, cruise_type_id bigint, begin_date date, begin_time string, end_date date, end_time string, name string"),
}
#: Columns that rules may fill in tours.
ENRICHED = "site_name string, site_cruise_object_id string, route string, city_from string, city_to string, departure_city string, days int, is_return boolean, is_weekend boolean"
HISTORIES = {
    "prices": ("external_cruise_id string, external_class_id string, partial_buyout boolean", "base_price decimal(12,2), child_price decimal(12,2), extra_seat decimal(12,2), currency string"),
    "sales": ("external_cruise_id string, external_class_id string, external_room_id string, partial_buyout boolean", "base_price decimal(12,2), currency string"),
    "availability": ("external_cruise_id string, external_room_id string", "available boolean"),
}
#: A payload's instant counts in histories as ``at``, and ``empty`` tells that it listed no free room.
LEDGER = "provider string, sha256 string, observed_at timestamp_ntz, at timestamp_ntz, empty boolean"
#: Tables that are only added to: payloads as they came, what happened to runs, errors as the digest takes them, health checks.
PAYLOADS = "provider string, sha256 string, observed_at timestamp_ntz, content binary"
RUNS = "run_id string, provider string, event string, status string, at timestamp_ntz, sha256 string, rows_read bigint, rows_written bigint, duration_ms bigint, error_message string"
ERRORS = """id bigint, occurred_at timestamp_ntz, provider string, stage string, severity string, message string, context string, resolved boolean, notified_at timestamp_ntz,
    notification_state string, notification_claimed_at timestamp_ntz, notification_attempts int""".replace("\n   ", "")
HEALTH = "checked_at timestamp_ntz, component string, status string, latency_ms bigint, details string"
METRICS = "run_id string, provider string, label string, n bigint"
#: What the list shows of each cruise's open versions: kept up by each sync for the cruises that it touches.
VIEW = "provider string, external_cruise_id string, minimal_price decimal(12,2), room_counts int"
REJECTS = "run_id string, provider string, section string, ordinal string, value string, reason string"


def _names(columns: str) -> list[str]:
    return [c.split()[0] for c in columns.split(", ")]


def _schema(spark: SparkSession, columns: str):
    return spark.createDataFrame([], columns).schema


class SyncError(RuntimeError):
    """A failed snapshot: provider, the stage that failed, and the cause."""

    def __init__(self, provider: str, stage: str, cause: Exception):
        super().__init__(f"{provider}: {stage}: {cause}")
        self.provider, self.stage = provider, stage


@contextlib.contextmanager
def _stage(provider: str, name: str):
    try:
        yield
    except Exception as e:
        raise SyncError(provider, name, e) from e


def accounted(upserts: dict[str, int], deactivated: int, histories: dict[str, dict[str, int]]) -> tuple[dict[str, int], int, int]:
    """The labels of a sync's write metrics, rows read and rows written.

    Upserts are the rows that came, repeated keys too. Created counts new and reopened
    versions, updated the changed or switched, closed those that went (of availability: that
    switched off, which are among the updated). Rows written are upserts, created
    and updated; rows read are those, closed prices and sales, and what was deactivated.
    """
    labels = {f"{k}_upserted": n for k, n in upserts.items()}
    for name, actions in histories.items():
        n = lambda *which: sum(actions.get(w, 0) for w in which)  # noqa: B023, E731
        if name == "availability":
            counts = n("opened"), n("switched_on", "switched_off"), n("switched_off")
        else:
            counts = n("created", "updated"), n("updated"), n("closed")
        labels |= {f"{name}_{k}": v for k, v in zip(("created", "updated", "closed"), counts)}
    written = sum(n for k, n in labels.items() if not k.endswith("_closed"))
    read = written + labels.get("prices_closed", 0) + labels.get("sales_closed", 0) + deactivated
    return labels | {"deactivated": deactivated}, read, written


def _rows(spark: SparkSession, columns: str, rows: list[dict]) -> DataFrame:
    """Rows with the given values, others null."""
    schema = _schema(spark, columns)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


@dataclass
class Run:
    """One payload on its way: ``at`` is its instant in histories; ``late`` if a newer one of its provider is in; ``before`` and ``after`` are the instants next to it."""

    provider: str
    observed_at: datetime
    sha256: str
    base: dict
    at: datetime
    late: bool = False
    before: datetime | None = None
    after: datetime | None = None
    next_empty: datetime | None = None
    path: str | None = None
    id: str = field(default_factory=lambda: uuid.uuid4().hex)
    began: float = field(default_factory=time.monotonic)

    def end(self, spark: SparkSession, status: str, read: int = 0, written: int = 0, message: str | None = None) -> dict[str, DataFrame]:
        took = int(1000 * (time.monotonic() - self.began))
        return {
            "runs": _rows(spark, RUNS, [dict(run_id=self.id, provider=self.provider, event="finish", status=status, at=self.observed_at, sha256=self.sha256, rows_read=read, rows_written=written, duration_ms=took, error_message=message)]),
            "health": _rows(spark, HEALTH, [dict(checked_at=self.observed_at, component=f"sync:{self.provider}", status="down" if status == "failed" else "ok", latency_ms=took, details=json.dumps({"run": self.id, "status": status}))])}


def _placed(store: StateStore, provider: str, observed_at: datetime, sha: str) -> Run | None:
    """Where a payload stands among those of its provider, from one aggregation of the ledger; None if it was seen before."""
    base = store.pointer(provider)
    ledger, at = store.read("ledger", _schema(store.spark, LEDGER), at=base), F.lit(observed_at).cast("timestamp_ntz")
    near = (F.col("at") >= at) & (F.col("at") < at + F.expr("interval 1 second"))
    r = ledger.agg(F.count_if(F.col("sha256") == sha).alias("seen"), F.max("at").alias("newest"), F.sort_array(F.collect_set(F.when(near, F.col("at")))).alias("near")).first()
    if r["seen"]:
        return None
    run = Run(provider, observed_at, sha, base, observed_at)
    for taken in r["near"]:  # a second payload of one instant counts as a microsecond later
        if taken == run.at:
            run.at += timedelta(microseconds=1)
    if r["newest"] is not None and run.at < r["newest"]:
        at = F.lit(run.at).cast("timestamp_ntz")
        x = ledger.agg(
            F.max(F.when(F.col("at") < at, F.col("at"))).alias("before"), F.min(F.when(F.col("at") > at, F.col("at"))).alias("after"),
            F.min(F.when((F.col("at") > at) & F.col("empty"), F.col("at"))).alias("next_empty")).first()
        run.late, run.before, run.after, run.next_empty = True, x["before"], x["after"], x["next_empty"]
    return run


def sync_snapshot(store: StateStore, landed: DataFrame, provider: str, rules: list[rules_.Rule] = ()) -> dict | None:
    """Apply one payload (one row of ``landed``); returns its write metrics, or None if it was seen before.

    All changes of a snapshot are one commit: tables, the payload itself, the ledger, rejected rows, the run's end, metrics and a health row.
    A failure is a commit of its own: the run's end, an error row with the stage, a health row. If another publisher commits this provider
    meanwhile, the snapshot is applied again to what that left.
    """
    first = landed.filter(F.col("provider") == provider).agg(F.min(F.struct("observed_at", "sha256")).alias("x")).first()["x"]
    if first is None:
        return None
    done, failed = _round(store, landed, [(provider, first["observed_at"], first["sha256"])], {provider: list(rules)})
    if failed:
        raise failed[0]
    return done[0][1]


def _round(store: StateStore, batch: DataFrame, payloads: list[tuple[str, datetime, str]], rules: dict[str, list]) -> tuple[list, list]:
    """Apply one payload of each provider: those that are the newest of their provider in one go, late ones each for itself.

    The work is the same few jobs however many providers there are. If it fails, each provider's payload is tried alone, so one bad payload
    stops no other; so is one whose provider another publisher has changed meanwhile.
    """
    spark, done, failed, joint, single = store.spark, [], [], [], []
    runs = [Run(p, at, sha, {}, at) for p, at, sha in payloads]
    starts = store.write_each("runs", _rows(spark, RUNS, [dict(run_id=r.id, provider=r.provider, event="start", status="running", at=r.observed_at, sha256=r.sha256) for r in runs]), [r.provider for r in runs])
    large = {}
    if {"path", "length"} <= set(batch.columns):
        named = batch.filter(F.col("sha256").isin([r.sha256 for r in runs]) & (F.col("length") >= LARGE_BYTES))
        large = {r["sha256"]: r["path"] for r in named.groupBy("sha256").agg(F.min("path").alias("path")).collect()}
    for run in runs:
        sha = run.sha256
        store.retried(lambda run=run: store.commit(store.pointer(run.provider), added={"runs": starts[run.provider]}))
        now = _placed(store, run.provider, run.observed_at, run.sha256)
        if now is None:
            store.append(run.provider, run.end(spark, "skipped"))
            done.append((run.provider, None))
        else:
            now.id, now.began = run.id, run.began
            now.path = large.get(sha)
            (single if now.late or now.path else joint).append(now)
    if len(joint) > 1:
        try:
            metrics, again = _apply(store, batch, joint, rules)
            done += list(metrics.items())
            joint = again
        except SyncError:
            pass  # one of them is bad: each alone tells which
    for run in [*joint, *single]:
        try:
            done.append((run.provider, store.retried(lambda run=run: _alone(store, batch, run, rules))))
        except SyncError as e:
            number = int(hashlib.sha256(run.id.encode()).hexdigest()[:15], 16)
            store.append(run.provider, run.end(spark, "failed", message=str(e)) | {"errors": _rows(spark, ERRORS, [dict(
                id=number, occurred_at=run.observed_at, provider=run.provider, stage=e.stage, severity="error", message=str(e), context=json.dumps({"run": run.id, "sha256": run.sha256}),
                resolved=False, notification_state="pending", notification_attempts=0)])})
            failed.append(e)
    return done, failed


def _alone(store: StateStore, batch: DataFrame, run: Run, rules: dict[str, list]) -> dict | None:
    """One payload, placed anew; a ``Conflict`` if its provider has changed by the time of the commit."""
    now = _placed(store, run.provider, run.observed_at, run.sha256)
    if now is None:
        return None
    now.id, now.began, now.path = run.id, run.began, run.path
    metrics, again = _apply(store, batch, [now], rules)
    if again:
        raise Conflict(run.provider)
    return metrics[run.provider]


def _by_provider(values: dict[str, object], kind: str) -> Column:
    """A column with each provider's value."""
    pairs = [x for p, v in values.items() for x in (F.lit(p), F.lit(v).cast(kind))]
    return F.create_map(*pairs)[F.col("provider")]


def cruise_figures(prices: DataFrame, sales: DataFrame, availability: DataFrame) -> DataFrame:
    """``VIEW`` from open versions: the lowest price over prices and sales, and the rooms that are available; cruises with neither have no row."""
    priced = lambda df: df.select("provider", "external_cruise_id", "base_price", F.lit(0).alias("room"))
    rooms = availability.filter("available").select("provider", "external_cruise_id", F.lit(None).cast("decimal(12,2)").alias("base_price"), F.lit(1).alias("room"))
    return priced(prices).unionAll(priced(sales)).unionAll(rooms).groupBy("provider", "external_cruise_id").agg(F.min("base_price").alias("minimal_price"), F.sum("room").cast("int").alias("room_counts"))


def _apply(store: StateStore, batch: DataFrame, runs: list[Run], rules: dict[str, list]) -> tuple[dict[str, dict], list[Run]]:
    """Write and commit the payloads of ``runs``, of different providers; write metrics by provider, and the runs that met a conflict.

    Every table is read, diffed by one join and written once for all of them; each provider's rows go to a folder of its own, and each
    provider is one commit. Late payloads are spliced into the whole history, which then is rewritten.
    """
    spark, names, late = store.spark, [r.provider for r in runs], runs[0].late
    label = names[0] if len(names) == 1 else ", ".join(names)
    with contextlib.ExitStack() as spent:

        def held(df: DataFrame) -> DataFrame:
            spent.callback(df.persist().unpersist)
            return df

        def known(name: str, schema, part: str | None) -> DataFrame:
            frames = [store.read(name, schema, part, at=r.base) for r in runs if r.base["tables"].get(name)]
            return functools.reduce(DataFrame.unionAll, frames) if frames else spark.createDataFrame([], schema)

        with _stage(label, "dedup"):
            wanted = F.broadcast(_rows(spark, "provider string, observed_at timestamp_ntz, sha256 string", [dict(provider=r.provider, observed_at=r.observed_at, sha256=r.sha256) for r in runs]))
            fresh = held(batch.join(wanted, ["provider", "observed_at", "sha256"]).dropDuplicates(["provider"]) if len(runs) > 1 else batch.join(wanted, ["provider", "observed_at", "sha256"]).limit(1))
        at = _by_provider({r.provider: r.at for r in runs}, "timestamp_ntz")
        before, after, next_empty = (_by_provider({r.provider: getattr(r, c) for r in runs}, "timestamp_ntz") for c in ("before", "after", "next_empty"))
        with _stage(label, "parse"):
            raw = None
            if runs[0].path:
                with contextlib.suppress(feed.Malformed):  # or such that only a parse as a whole can tell
                    raw = feed.typed_records(feed.records_of_file(spark, runs[0].path, names[0], F.lit(runs[0].observed_at).cast("timestamp_ntz"), held))
            raw = raw or feed.shred(held(feed.parse(fresh)))
            canon = {k: v.drop("observed_at") for k, v in canonical.canonicalise(raw).items()}
            counted = functools.reduce(DataFrame.unionAll, [df.groupBy("provider").agg(F.count("*").alias("n")).select("provider", F.lit(k).alias("name"), "n") for k, df in canon.items() if k != "tours"])
            # Tours are counted by their records: a date that is none is a failure of writing, not of reading.
            counted = counted.unionAll(raw["cruises"].groupBy("provider").agg(F.count("*").alias("n")).select("provider", F.lit("tours").alias("name"), "n"))
            counts = {(r["provider"], r["name"]): r["n"] for r in counted.collect()}
            for p in names:
                if not counts.get((p, "objects")) and not counts.get((p, "tours")):
                    raise canonical.EmptySnapshot("no objects and no tours")
        with _stage(label, "enrich"):
            own = rules_.rules_frame(spark, [(k, p, r.field, r.kind, {"value": r.value, "template": r.template, "plus": r.plus}, k, True) for p in names for k, r in enumerate(rules.get(p, ()))])
            fields = _names(ENRICHED)
            enriched = rules_.typed(rules_.enrich_by_table(canon["tours"], rules_.rules_by_provider(own, spark.createDataFrame([(p,) for p in names], "provider string")), fields, cruise_id="external_cruise_id"))
            canon["tours"] = enriched
        with _stage(label, "persist"):
            empty = _by_provider({p: not counts.get((p, "availability")) for p in names}, "boolean")
            replaced, added, closed, actions, deactivated, current_, touched = {}, {}, {}, {}, {}, {}, []
            for name, (key, rest) in DIMENSIONS.items():
                attrs = _names(rest) + (_names(ENRICHED) if name == "tours" else [])
                keys = ["provider", *_names(key)]
                columns = f"provider string, {key}, {rest}, " + (f"{ENRICHED}, " if name == "tours" else "") + LIFE
                incoming = scd1.last_wins(canon[name].select(*keys, *attrs, "ordinal"), keys, ["ordinal"]).drop("ordinal")
                current = known(name, _schema(spark, columns), "open")
                if late:
                    kept = scd1.splice_scd1(current, incoming, keys, attrs, at, after).withColumn("deactivated", F.lit(False))
                else:
                    merged = scd1.merge_scd1(current, incoming, keys, attrs, at)
                    kept = held(scd1.deactivate_missing(merged.drop("action"), incoming.select(*keys), keys, None, at))
                    for r in kept.groupBy("provider").agg(F.count_if("deactivated").alias("n")).collect():
                        deactivated[r["provider"]] = deactivated.get(r["provider"], 0) + r["n"]
                replaced[name] = store.write_each(name, kept.select(*_names(columns)), names)
            for name, (key, rest) in HISTORIES.items():
                keys, values = ["provider", *_names(key)], _names(rest)
                schema = _schema(spark, f"provider string, {key}, {rest}, {VERSION}")
                presence = name == "availability"
                rows = canon[name] if presence else scd2.stage(
                    canon[name].select(*keys, *values, "ordinal"), keys, ["ordinal"], [c for c in values if c != "currency"], ["partial_buyout"])
                if late:
                    whole = known(name, schema, None)
                    versions = held((
                        scd2.presence_splice(whole, rows, keys, at, before, after, empty, next_empty) if presence
                        else scd2.scd2_splice(whole, rows, keys, values, at, before, after)).select(*schema.names))
                    closed[name] = store.write_each(name, versions.filter("valid_to is not null"), names)
                else:
                    open_ = known(name, schema, "open")
                    plan = held(scd2.presence_plan(open_, rows, keys, empty) if presence else scd2.scd2_plan(open_, rows, keys, values))
                    versions = (scd2.presence_versions(plan, keys, at) if presence else scd2.scd2_versions(plan, keys, values, at)).select(*schema.names)
                    for r in plan.groupBy("provider", "action").count().collect():
                        actions.setdefault((r["provider"], name), {})[r["action"]] = r["count"]
                    added[name] = store.write_each(name, versions.filter("valid_to is not null"), names)
                current_[name] = scd2.scd2_current(versions)
                if not late:
                    touched.append(plan.filter("action <> 'same'").select("provider", "external_cruise_id"))
                replaced[name] = store.write_each(name, current_[name], names)
            # The figures of a cruise whose versions changed are made anew, also if its lowest price went; all others stay.
            if late:
                view = cruise_figures(*[current_[n] for n in HISTORIES])
            else:
                cruise = ["provider", "external_cruise_id"]
                hit = held(functools.reduce(DataFrame.unionAll, touched).distinct())
                view = known("cruise_figures", _schema(spark, VIEW), "open").join(hit, cruise, "left_anti").unionByName(
                    cruise_figures(*[current_[n].join(hit, cruise, "left_semi") for n in HISTORIES]))
            replaced["cruise_figures"] = store.write_each("cruise_figures", view.select(*_names(VIEW)), names)
            ids = _by_provider({r.provider: r.id for r in runs}, "string")
            rejects = raw["rejects"].select("provider", "section", F.col("ordinal").cast("string"), "value", F.lit("no number").alias("reason")).unionAll(
                raw["classes"].filter(F.length("id") < 3).select("provider", F.lit("classes"), F.col("ordinal").cast("string"), "id", F.lit("short id")))
            rejects = held(rejects.withColumn("run_id", ids).select(*_names(REJECTS)))
            bad = {r["provider"]: r["count"] for r in rejects.groupBy("provider").count().collect()}
            added["rejects"] = store.write_each("rejects", rejects, names)
            added["payloads"] = store.write_each("payloads", fresh.select(*_names(PAYLOADS)), names)
            added["ledger"] = store.write_each("ledger", fresh.select("provider", "sha256", "observed_at", at.alias("at"), empty.alias("empty")), names)
            metrics, ends = {}, {"runs": [], "health": []}
            for run in runs:
                p = run.provider
                labels, read, written = accounted({k: counts.get((p, k), 0) for k in DIMENSIONS}, deactivated.get(p, 0), {k: actions.get((p, k), {}) for k in HISTORIES})
                # Rows that came once more with a key that was there: the first counts.
                seen = {k: sum(v for a, v in actions.get((p, k), {}).items() if a in ("created", "updated", "same")) for k in ("prices", "sales")}
                repeated = {} if late else {f"{k}_repeated": counts.get((p, k), 0) - n for k, n in seen.items()}
                metrics[p] = labels | repeated | {"rejected": bad.get(p, 0)}
                for k, df in run.end(spark, "success", read, written).items():
                    ends[k].append(df)
            added["metrics"] = store.write_each("metrics", spark.createDataFrame([(r.id, r.provider, k, n) for r in runs for k, n in metrics[r.provider].items()], METRICS), names)
            union = lambda frames: functools.reduce(DataFrame.unionAll, frames)
            added["runs"] = store.write_each("runs", union(ends["runs"]), names)
            health = union(ends["health"]).withColumn("provider", F.expr("substring(component, 6)"))
            added["health"] = store.write_each("health", health, names)
            again = []
            for run in runs:
                p = run.provider
                pick = lambda tables, p=p: {name: folder[p] for name, folder in tables.items()}
                try:
                    store.commit(run.base, pick(replaced), pick(added), {name: [folder] for name, folder in pick(closed).items()})
                except Conflict:
                    again.append(run)
    return {p: m for p, m in metrics.items() if p not in {r.provider for r in again}}, again


def sync_batch(store: StateStore, batch: DataFrame, rules: dict[str, list] | None = None) -> dict[str, list]:
    """Apply a micro-batch in rounds of one payload of each provider, a provider's in order of time; a failed payload stops no other, later ones of its provider
    neither, since each is a whole snapshot.

    The driver sees the payloads' names only. A batch has as many rounds as its busiest provider has payloads.
    """
    done, failed, queues = [], [], {}
    batch = batch.persist()
    try:
        for r in batch.select("provider", "observed_at", "sha256").distinct().orderBy("observed_at", "sha256").collect():
            queue = queues.setdefault(r["provider"], [])
            if r["sha256"] not in {sha for _, _, sha in queue}:
                queue.append((r["provider"], r["observed_at"], r["sha256"]))
        while any(queues.values()):
            ok, bad = _round(store, batch, [q.pop(0) for q in queues.values() if q], rules or {})
            done, failed = done + ok, failed + bad
    finally:
        batch.unpersist()
    for p in queues:
        for name, (key, rest) in HISTORIES.items():
            store.compact(name, _schema(store.spark, f"provider string, {key}, {rest}, {VERSION}"), p)
        for name, columns in (("ledger", LEDGER), ("runs", RUNS), ("errors", ERRORS), ("health", HEALTH), ("metrics", METRICS), ("rejects", REJECTS)):
            store.compact(name, _schema(store.spark, columns), p)
    return {"done": done, "failed": failed}


def sync_stream(store: StateStore, path: str, provider: str, checkpoint: str, rules: dict[str, list] | None = None):
    """A query that applies files as they land; a batch that runs again finds its payloads in the ledger, and a bad one leaves an error row and goes by."""
    landed = feed.land(store.spark, path, provider, streaming=True)
    return landed.writeStream.foreachBatch(lambda batch, _: sync_batch(store, batch, rules) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_stream(rows: DataFrame, ts: str, minutes: int, by: list[str], late: str = "10 minutes") -> DataFrame:
    """Rates in tumbling windows over a log stream, with a watermark."""
    from tidemark.operators.metrics import window_rate

    return window_rate(rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late), ts, minutes, by)
