"""Provider-neutral rows from the feed's record sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import class_object, lenient_time
from tidemark.operators.scd1 import last_wins

BATCH = ("provider", "observed_at", "ordinal")


def objects(ships: DataFrame) -> DataFrame:
    """Also stages, from decks."""
    return ships.select(*BATCH, F.col("id").alias("external_id"), "name")


def classes(raw: DataFrame) -> DataFrame:
    """Ids shorter than three characters name no object and are dropped."""
    return raw.filter(F.length("id") >= 3).select(
        *BATCH, class_object(F.col("id")).alias("external_object_id"), F.col("id").alias("external_class_id"), "name", F.col("comment").alias("description"),
        F.col("m_count").alias("base_seats"), F.col("r_count").alias("tiers"), F.col("no_full").alias("partial_buyout"))


def rooms(cabins: DataFrame) -> DataFrame:
    return cabins.select(
        *BATCH, F.col("ship").alias("external_object_id"), F.col("deck").alias("external_stage_id"), F.col("class_id").alias("external_class_id"), F.col("id").alias("external_room_id"), "number")


def tours(cruises: DataFrame, cruise_type_id: int = 1) -> DataFrame:
    """Dates are strict: a bad one fails the batch. Times that are none become null."""
    return cruises.select(
        *BATCH, F.col("ship_id").alias("external_object_id"), F.col("id").alias("external_cruise_id"), F.lit(cruise_type_id).cast("long").alias("cruise_type_id"),
        F.to_date("begin_date", "d.M.yyyy").alias("begin_date"), lenient_time(F.col("begin_time")).alias("begin_time"),
        F.to_date("end_date", "d.M.yyyy").alias("end_date"), lenient_time(F.col("end_time")).alias("end_time"), F.col("route").alias("name"))


def prices(raw: DataFrame, cruises: DataFrame, currency: str = "RUB") -> DataFrame:
    """Prices with their cruise's child and extra-seat prices; of repeated cruises the last counts."""
    extra = last_wins(cruises.select("provider", "observed_at", F.col("id").alias("cruise_id"), "child_price", F.col("dop_price").alias("extra_seat"), "ordinal"),
                      ["provider", "observed_at", "cruise_id"], ["ordinal"]).drop("ordinal")
    return raw.join(extra, ["provider", "observed_at", "cruise_id"], "left").select(
        *BATCH, F.col("cruise_id").alias("external_cruise_id"), F.col("class_id").alias("external_class_id"), F.col("price").alias("base_price"),
        F.col("nofull").alias("partial_buyout"), "child_price", "extra_seat", F.lit(currency).alias("currency"))


def sales(spos: DataFrame, currency: str = "RUB") -> DataFrame:
    return spos.select(
        *BATCH, F.col("cruise_id").alias("external_cruise_id"), F.col("class_id").alias("external_class_id"), F.col("cabin_id").alias("external_room_id"),
        F.col("spo").alias("base_price"), F.col("nofull").alias("partial_buyout"), F.lit(currency).alias("currency"))


def availability(free: DataFrame) -> DataFrame:
    return free.select(*BATCH, F.col("cruise_id").alias("external_cruise_id"), F.col("cabin_id").alias("external_room_id"), F.lit(True).alias("available"))


def canonicalise(raw: dict[str, DataFrame], cruise_type_id: int = 1) -> dict[str, DataFrame]:
    return {
        "objects": objects(raw["ships"]), "stages": objects(raw["decks"]), "classes": classes(raw["classes"]), "rooms": rooms(raw["cabins"]),
        "tours": tours(raw["cruises"], cruise_type_id), "prices": prices(raw["prices"], raw["cruises"]), "sales": sales(raw["spos"]), "availability": availability(raw["free"])}


class EmptySnapshot(ValueError):
    """A batch without objects and tours; taking it would switch everything off."""


def guard_not_empty(canon: dict[str, DataFrame]) -> None:
    if canon["objects"].isEmpty() and canon["tours"].isEmpty():
        raise EmptySnapshot("no objects and no tours")
