"""Key-based merges with soft deletes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key: the last by ``order``; combined on the map side."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def merge_scd1(current: DataFrame, incoming: DataFrame, keys: list[str], attrs: list[str], now: Column) -> DataFrame:
    """``current`` after an upsert of ``incoming``, with ``action``: inserted, updated, reactivated or kept.

    ``current`` has keys, attrs, is_active, created_at and updated_at; ``incoming`` keys
    and attrs, one row for each key. Matched rows take all attributes, nulls too, and become active. One
    shuffle of both sides on the keys.
    """
    a = current.select(*keys, F.struct(*attrs, "is_active", "created_at", "updated_at").alias("_old"))
    b = incoming.select(*keys, F.struct(*attrs).alias("_new"))
    j = a.join(b, keys, "full_outer")
    fresh, matched = F.col("_old").isNull(), F.col("_new").isNotNull()
    return j.select(
        *keys,
        *[F.when(matched, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in attrs],
        F.when(matched, True).otherwise(F.col("_old.is_active")).alias("is_active"),
        F.when(fresh, now).otherwise(F.col("_old.created_at")).alias("created_at"),
        F.when(matched, now).otherwise(F.col("_old.updated_at")).alias("updated_at"),
        F.when(fresh, "inserted").when(matched & ~F.col("_old.is_active"), "reactivated").when(matched, "updated").otherwise("kept").alias("action"))


def deactivate_missing(current: DataFrame, incoming: DataFrame, keys: list[str], provider: str | None, now: Column) -> DataFrame:
    """``current`` with active rows of ``provider`` switched off whose key is absent; ``deactivated`` marks them.

    ``incoming`` holds that provider's keys, with or without repeats; without ``provider`` all rows count and keys name it. Other providers' rows and
    inactive rows stay as they are; an empty ``incoming`` switches all off.
    """
    seen = incoming.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct().withColumn("_seen", F.lit(True))
    on = [current[k].eqNullSafe(seen[f"_{k}"]) for k in keys]
    mine = F.lit(True) if provider is None else F.col("provider") == provider
    off = F.col("is_active") & mine & F.col("_seen").isNull()
    j = current.join(seen, on, "left").withColumn("deactivated", F.coalesce(off, F.lit(False)))
    return j.select(
        *[c for c in current.columns if c not in ("is_active", "updated_at")],
        F.when(F.col("deactivated"), False).otherwise(F.col("is_active")).alias("is_active"),
        F.when(F.col("deactivated"), now).otherwise(F.col("updated_at")).alias("updated_at"), "deactivated")


def splice_scd1(current: DataFrame, incoming: DataFrame, keys: list[str], attrs: list[str], at: Column, after: Column) -> DataFrame:
    """``current`` after a snapshot older than the newest, as if all had been merged and deactivated in order; ``after`` is the next one's time.

    An active row is in the newest snapshot and keeps its attributes. An inactive one left at ``updated_at``: if that is ``after`` or
    before, the late snapshot is the last that may show it, so it gives the attributes, and the row leaves at ``after``; if it does not show
    a row that left at ``after``, that one left at ``at`` already. A row that nothing else shows is new and inactive.
    """
    a = current.select(*keys, F.struct(*attrs, "is_active", "created_at", "updated_at").alias("_old"))
    j = a.join(incoming.select(*keys, F.struct(*attrs).alias("_new")), keys, "full_outer")
    shown, fresh = F.col("_new").isNotNull(), F.col("_old").isNull()
    gone = F.coalesce(~F.col("_old.is_active"), F.lit(True))
    takes = shown & gone & F.coalesce(F.col("_old.updated_at") <= after, F.lit(True))
    left = F.when(takes, after).when(~shown & gone & (F.col("_old.updated_at") == after), at).otherwise(F.col("_old.updated_at"))
    return j.select(
        *keys, *[F.when(takes, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in attrs], F.when(fresh, False).otherwise(F.col("_old.is_active")).alias("is_active"),
        F.when(shown, F.least(F.col("_old.created_at"), at)).otherwise(F.col("_old.created_at")).alias("created_at"), left.alias("updated_at"))
