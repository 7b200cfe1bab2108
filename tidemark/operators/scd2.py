"""Versioned history: rows with [valid_from, valid_to); a null valid_to is open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.scd1 import first_wins


def stage(incoming: DataFrame, keys: list[str], order: list[str], decimals: list[str] = (), flags: list[str] = ()) -> DataFrame:
    """Incoming rows as the diff wants them: null flags false, amounts DECIMAL(12,2), the first row of each key."""
    incoming = with_flags(incoming, list(flags)) if flags else incoming
    for c in decimals:
        incoming = incoming.withColumn(c, F.col(c).cast("decimal(12,2)"))
    return first_wins(incoming, keys, order).drop(*[c for c in order if c not in keys])


def from_scd1(rows: DataFrame, updated_at: Column, now: Column) -> DataFrame:
    """Rows of a table without history as open versions from their last update, or from ``now``."""
    return rows.withColumns({"valid_from": F.coalesce(updated_at, now), "valid_to": F.lit(None).cast("timestamp_ntz")})


def with_flags(rows: DataFrame, flags: list[str]) -> DataFrame:
    """Null key flags of older rows become false, so that they meet staged rows."""
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in flags})


def scd2_plan(open_rows: DataFrame, incoming: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """Keys, ``old`` and ``new`` structs of ``compare``, valid_from of the old, and ``action``.

    created: no open version; updated: some value differs, nulls counted as
    values; closed: key absent; same. One full outer join of open and staged
    rows; closed versions take no part.
    """
    a = open_rows.select(*keys, F.struct(*compare).alias("old"), "valid_from")
    b = incoming.select(*keys, F.struct(*compare).alias("new"))
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    action = F.when(F.col("old").isNull(), "created").when(F.col("new").isNull(), "closed").when(differs, "updated").otherwise("same")
    return a.join(b, keys, "full_outer").withColumn("action", action)


def scd2_versions(plan: DataFrame, keys: list[str], compare: list[str], observed_at: Column) -> DataFrame:
    """Versions that follow from ``plan``: old ones, closed where the plan says so, and new ones."""
    never = F.lit(None).cast("timestamp_ntz")
    old = F.struct(*[F.col(f"old.{c}").alias(c) for c in compare], F.col("valid_from").alias("valid_from"), F.when(F.col("action") != "same", observed_at).otherwise(never).alias("valid_to"))
    new = F.struct(*[F.col(f"new.{c}").alias(c) for c in compare], observed_at.alias("valid_from"), never.alias("valid_to"))
    rows = F.when(F.col("action") == "created", F.array(new)).when(F.col("action") == "updated", F.array(old, new)).otherwise(F.array(old))
    return plan.select(*keys, F.explode(rows).alias("v")).select(*keys, "v.*")


def scd2_apply(history: DataFrame, incoming: DataFrame, keys: list[str], compare: list[str], observed_at: Column) -> DataFrame:
    """History after a snapshot. An empty snapshot closes every open version."""
    plan = scd2_plan(scd2_current(history), incoming, keys, compare)
    closed = history.filter("valid_to is not null").select(*keys, *compare, "valid_from", "valid_to")
    return closed.unionByName(scd2_versions(plan, keys, compare, observed_at))


def presence_plan(open_rows: DataFrame, present: DataFrame, keys: list[str], empty: bool | Column = False) -> DataFrame:
    """Availability: ``present`` lists the keys that are available now.

    opened: unknown key; switched_on: it was false; switched_off: true and absent, so a false
    version opens; same. With ``empty`` (nothing present at all) every open version is
    closed and none opens; it may be a column of the keys.
    """
    seen = present.select(*keys).distinct().withColumn("_now", F.lit(True))
    j = open_rows.select(*keys, "available", "valid_from").join(seen, keys, "full_outer")
    here = F.col("_now").isNotNull()
    action = (
        F.when(F.col("available").isNull(), "opened").when(here & ~F.col("available"), "switched_on")
        .when(~here & F.col("available"), "switched_off").otherwise("same"))
    return j.withColumn("action", F.when(F.lit(empty) if isinstance(empty, bool) else empty, "closed").otherwise(action)).drop("_now")


def presence_versions(plan: DataFrame, keys: list[str], observed_at: Column) -> DataFrame:
    never = F.lit(None).cast("timestamp_ntz")
    flips = F.col("action").isin("switched_on", "switched_off")
    old = F.struct(F.col("available"), F.col("valid_from"), F.when(F.col("action") == "same", never).otherwise(observed_at).alias("valid_to"))
    new = F.struct((F.col("action") != "switched_off").alias("available"), observed_at.alias("valid_from"), never.alias("valid_to"))
    rows = F.when(F.col("action") == "opened", F.array(new)).when(flips, F.array(old, new)).otherwise(F.array(old))
    return plan.select(*keys, F.explode(rows).alias("v")).select(*keys, "v.*")


def scd2_current(history: DataFrame) -> DataFrame:
    return history.filter("valid_to is null")


def scd2_as_of(history: DataFrame, at: Column) -> DataFrame:
    return history.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def scd2_changes(history: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each version with the one before: previous value and difference."""
    w = Window.partitionBy(*keys).orderBy("valid_from")
    return history.withColumn("previous", F.lag(value).over(w)).filter("previous is not null").withColumn("change", F.col(value) - F.col("previous"))


def scd2_rebuild(snapshots: DataFrame, keys: list[str], compare: list[str], times: DataFrame) -> DataFrame:
    """History from many snapshots at once, equal to applying them one by one.

    ``snapshots`` has keys, compare and ``observed_at``, one row for each key and time; ``times``
    lists all snapshot times (``observed_at``, ``next_at``). Equal neighbours are one version; a time without the
    key closes it.
    """
    w = Window.partitionBy(*keys).orderBy("observed_at")
    rows = snapshots.join(F.broadcast(times) if times.count() < 100_000 else times, "observed_at")
    value = F.struct(*compare)
    held = (
        rows.withColumn("_prev", F.lag(value).over(w)).withColumn("_due", F.lag("next_at").over(w))
        .withColumn("_new", F.coalesce(~value.eqNullSafe(F.col("_prev")), F.lit(True)) | ~F.col("_due").eqNullSafe(F.col("observed_at")))
        .withColumn("_run", F.sum(F.col("_new").cast("int")).over(w)))
    return held.groupBy(*keys, "_run").agg(
        *[F.first(c).alias(c) for c in compare], F.min("observed_at").alias("valid_from"), F.max_by("next_at", "observed_at").alias("valid_to")).drop("_run")


def _covers(t: Column) -> Column:
    return F.coalesce((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)), F.lit(False))


def _starts(t: Column) -> Column:
    return F.coalesce(F.col("valid_from") == t, F.lit(False))


def _gathered(history: DataFrame, keys: list[str], values: list[str], before: Column, after: Column, incoming: DataFrame) -> DataFrame:
    """One row for each key: ``_o``, its version at ``before``; ``_x``, the one that starts at ``after``; ``_later``, the next start beyond; ``_n`` of ``incoming``.

    One shuffle; rows combine on the map side.
    """
    version = F.struct(F.struct(*values).alias("v"), "valid_from", "valid_to")
    known = history.select(
        *keys, F.when(_covers(before), version).alias("_o"), F.when(_starts(after), version).alias("_x"), F.when(F.col("valid_from") > after, F.col("valid_from")).alias("_later"))
    both = known.unionByName(incoming.select(*keys, "_n"), allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("_o", "_x", "_n")], F.min("_later").alias("_later"))


def _spliced(values: Column, valid_from: Column, valid_to: Column) -> Column:
    return F.struct(values.alias("v"), valid_from.alias("valid_from"), valid_to.cast("timestamp_ntz").alias("valid_to"))


def _versions_of(rows: DataFrame, keys: list[str], values: list[str], versions: list[Column]) -> DataFrame:
    """The versions that are not null, one row each."""
    return rows.select(*keys, F.explode(F.filter(F.array(*versions), lambda v: v.isNotNull())).alias("_v")).select(
        *keys, *[F.col(f"_v.v.{c}").alias(c) for c in values], "_v.valid_from", "_v.valid_to")


def scd2_splice(history: DataFrame, incoming: DataFrame, keys: list[str], compare: list[str], at: Column, before: Column, after: Column) -> DataFrame:
    """History after a snapshot of any time: ``before`` and ``after`` are the snapshot times next to ``at``, null where there is none.

    The result is that of applying all snapshots in the order of their times. Between two snapshots nothing changes, so what
    the new one says holds from ``at`` to ``after``: the version that covers ``before`` is cut there and goes on at ``after`` if
    it lasts beyond, and a version that starts at ``after`` with the new values starts at ``at`` instead. Other versions stay as they are.
    ``incoming`` has one row for each key; the times may be columns of keys.
    """
    rows = _gathered(history, keys, compare, before, after, incoming.select(*keys, F.struct(*compare).alias("_n")))
    o, x, n = F.col("_o"), F.col("_x"), F.col("_n")
    same = n.eqNullSafe(o["v"])
    joined = ~same & n.isNotNull() & x.isNotNull() & n.eqNullSafe(x["v"])
    lasts = o.isNotNull() & after.isNotNull() & (o["valid_to"].isNull() | (o["valid_to"] > after))
    versions = [
        F.when(same, o).when(o.isNotNull(), _spliced(o["v"], o["valid_from"], at)),
        F.when(joined, _spliced(n, at, x["valid_to"])).when(~same & n.isNotNull(), _spliced(n, at, after)),
        F.when(~joined, x), F.when(~same & lasts, _spliced(o["v"], after, o["valid_to"]))]
    rest = history.filter(~_covers(before) & ~_starts(after)).select(*keys, *compare, "valid_from", "valid_to")
    return rest.unionByName(_versions_of(rows, keys, compare, versions))


def presence_splice(history: DataFrame, present: DataFrame, keys: list[str], at: Column, before: Column, after: Column, empty: Column, next_empty: Column) -> DataFrame:
    """Availability after a snapshot of any time, as if all had been applied in order; ``next_empty`` is the first empty snapshot after ``at``.

    Besides the cuts of ``scd2_splice``: a key that the snapshot shows first is absent, so false, from ``after`` until it is shown or an
    empty snapshot comes; and after an ``empty`` snapshot no absence is known, until the key is shown.
    """
    rows = _gathered(history, keys, ["available"], before, after, present.select(*keys).distinct().withColumn("_n", F.lit(True)))
    o, x = F.col("_o"), F.col("_x")
    was, next_ = o["v"]["available"], x["v"]["available"]
    rows = rows.withColumn("_n", F.when(empty, F.lit(None).cast("boolean")).otherwise(F.coalesce("_n", F.when(o.isNotNull(), False))))
    n = F.col("_n")
    same, value = n.eqNullSafe(was), lambda b: F.struct(b.alias("available"))
    joined = ~same & n.isNotNull() & n.eqNullSafe(next_)
    lasts = o.isNotNull() & after.isNotNull() & (o["valid_to"].isNull() | (o["valid_to"] > after))
    unknown = empty & (next_ == F.lit(False))
    first = o.isNull() & n.isNotNull() & x.isNull() & after.isNotNull() & ~after.eqNullSafe(next_empty)
    versions = [
        F.when(same, o).when(o.isNotNull(), _spliced(o["v"], o["valid_from"], at)),
        F.when(joined, _spliced(value(n), at, x["valid_to"])).when(~same & n.isNotNull(), _spliced(value(n), at, after)),
        F.when(~joined & ~F.coalesce(unknown, F.lit(False)), x),
        F.when(~same & lasts & (~empty | was), _spliced(o["v"], after, o["valid_to"])),
        F.when(first, _spliced(value(F.lit(False)), after, F.least("_later", next_empty)))]
    rest = history.filter(~_covers(before) & ~_starts(after)).select(*keys, "available", "valid_from", "valid_to")
    return rest.unionByName(_versions_of(rows, keys, ["available"], versions))


def presence_rebuild(snapshots: DataFrame, keys: list[str], times: DataFrame) -> DataFrame:
    """Availability from many snapshots at once, equal to applying them one by one.

    ``snapshots`` has the keys present at each ``observed_at``; ``times`` lists all snapshot times, with those of empty ones,
    as ``observed_at``, ``next_at`` and ``next_empty`` (the first empty one after it). Consecutive presences are one true version. At
    the next snapshot without the key a false one opens, if that is not empty; it ends when the key or an empty snapshot comes.
    """
    w = Window.partitionBy(*keys).orderBy("observed_at")
    rows = snapshots.select(*keys, "observed_at").distinct().join(F.broadcast(times) if times.count() < 100_000 else times, "observed_at")
    held = (
        rows.withColumn("_again", F.lead("observed_at").over(w)).withColumn("_due", F.lag("next_at").over(w))
        .withColumn("_run", F.sum((~F.col("_due").eqNullSafe(F.col("observed_at"))).cast("int")).over(w)))
    runs = held.groupBy(*keys, "_run").agg(F.min("observed_at").alias("valid_from"), F.max_by(F.struct("next_at", "next_empty", "_again"), "observed_at").alias("e"))
    absent = F.col("e.next_at").isNotNull() & ~F.col("e.next_at").eqNullSafe(F.col("e.next_empty"))
    version = lambda b, start, end: F.struct(F.lit(b).alias("available"), start.alias("valid_from"), end.alias("valid_to"))
    versions = F.array(
        version(True, F.col("valid_from"), F.col("e.next_at")), F.when(absent, version(False, F.col("e.next_at"), F.least("e._again", "e.next_empty"))))
    return runs.select(*keys, F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("v")).select(*keys, "v.*")


def snapshot_times(times: DataFrame) -> DataFrame:
    """observed_at, next_at and next_empty from ``times`` (observed_at, empty): one row for each snapshot, so one window serves."""
    w = Window.orderBy("observed_at")
    return times.select(
        "observed_at", F.lead("observed_at").over(w).alias("next_at"),
        F.min(F.when(F.col("empty"), F.col("observed_at"))).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("next_empty"))


def scd2_asof_join(probes: DataFrame, history: DataFrame, keys: list[str], time: str, values: list[str], unit: str = "month") -> DataFrame:
    """``probes`` with ``values``, valid_from and valid_to of the version that holds at ``time``; nulls where none does.

    Probes and starts of versions are sorted together and each probe takes the last start before it: no join by range. A key's time
    is cut by ``unit``, and each piece begins with the version that holds then, so a key with a large share of the probes
    is many groups. Probes without a key or a time find nothing; a version holds from its first instant until before its last.
    """
    names, at = probes.columns, F.col(time).cast("timestamp_ntz")
    version = F.struct(*values, "valid_from", "valid_to")
    starts = history.select(*keys, F.col("valid_from").cast("timestamp_ntz").alias("_t"), version.alias("_v"))
    rows = probes.select(*[F.col(k).alias(k) for k in keys], at.alias("_t"), F.struct(*names).alias("_p"))
    piece = F.date_trunc(unit, "_t").cast("timestamp_ntz")
    pieces = rows.select(*keys, piece.alias("_t")).distinct()
    over = lambda *by: Window.partitionBy(*keys, *by).orderBy("_t", F.col("_k")).rowsBetween(Window.unboundedPreceding, 0)
    begun = (
        starts.withColumn("_k", F.lit(0)).unionByName(pieces.withColumn("_k", F.lit(1)), allowMissingColumns=True)
        .withColumn("_v", F.last("_v", ignorenulls=True).over(over())).filter("_k = 1").drop("_k"))
    every = (
        begun.withColumns({"_k": F.lit(0), "_s": F.col("_t")}).unionByName(starts.withColumns({"_k": F.lit(1), "_s": piece}))
        .unionByName(rows.withColumns({"_k": F.lit(2), "_s": piece}), allowMissingColumns=True))
    found = every.withColumn("_v", F.last("_v", ignorenulls=True).over(over("_s"))).filter("_k = 2")
    whole = F.col("_t").isNotNull() & (F.col("_v.valid_to").isNull() | (F.col("_v.valid_to") > F.col("_t")))
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return found.select(*[F.col(f"_p.`{c}`").alias(c) for c in names], *[F.when(whole, F.col(f"_v.{c}")).alias(c) for c in (*values, "valid_from", "valid_to")])


def scd2_check(history: DataFrame, keys: list[str]) -> DataFrame:
    """Violations: keys with two open versions, versions that overlap or have no length."""
    w = Window.partitionBy(*keys).orderBy("valid_from", F.col("valid_to").asc_nulls_last())
    ends = F.lag("valid_to").over(w)
    j = history.withColumn("_ends", ends).withColumn("_n", F.row_number().over(w))
    bad = F.when((F.col("_n") > 1) & F.col("_ends").isNull(), "open before").when(F.col("_ends") > F.col("valid_from"), "overlap").when(F.col("valid_to") <= F.col("valid_from"), "empty")
    return j.withColumn("problem", bad).filter("problem is not null").drop("_ends", "_n")


def outcome(plan: DataFrame, table: str) -> DataFrame:
    """One row: created (changed keys are reopened, so they count), updated, closed."""
    n = lambda *a: F.count(F.when(F.col("action").isin(*a), 1)).alias
    return plan.agg(n("created", "updated")("created"), n("updated")("updated"), n("closed")("closed")).select(F.lit(table).alias("table_name"), "created", "updated", "closed")
