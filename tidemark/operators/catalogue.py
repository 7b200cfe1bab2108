"""The read side: list, detail, paging, JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import encode_cursor


#: Rows of rooms, and of classes or ships, up to which they are sent whole to every task; no setting of Spark's size check changes how lines are sent.
BROADCAST_ROWS = 500_000
HASHED_ROWS = 100_000


def hashed(classes: DataFrame) -> bool:
    """Whether ``classes`` (or ships) are too many to be sent whole: rows that are joined by them should then be dealt by their key at first."""
    return classes.count() > HASHED_ROWS


def hashed_rooms(rooms: DataFrame) -> bool:
    """The same of ``rooms``."""
    return rooms.count() > BROADCAST_ROWS


def _dimension(df: DataFrame, large: bool) -> DataFrame:
    """``df`` as the right side of a join by its key: a large one is hashed in parts, so that the other side, which has more rows, is not sorted."""
    return df.hint("shuffle_hash") if large else F.broadcast(df)


def min_prices(prices: DataFrame, sales: DataFrame) -> DataFrame:
    """Lowest open price of each (provider, cruise_id) over prices and sales."""
    both = prices.select("provider", "cruise_id", "base_price").unionAll(sales.select("provider", "cruise_id", "base_price"))
    return both.groupBy("provider", "cruise_id").agg(F.min("base_price").alias("minimal_price"))


def room_counts(availability: DataFrame) -> DataFrame:
    """Rooms of each cruise with an open version that is available."""
    return availability.filter("available").groupBy("provider", "cruise_id").agg(F.count("*").cast("int").alias("room_counts"))


def filtered(tours: DataFrame, date_from: str | None = None, date_to: str | None = None, city: str | None = None) -> DataFrame:
    """Dates are inclusive; an argument that is not given filters nothing."""
    if date_from is not None:
        tours = tours.filter(F.col("begin_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        tours = tours.filter(F.col("begin_date") <= F.lit(date_to).cast("date"))
    return tours if city is None else tours.filter(F.col("city") == city)


def catalogue(tours: DataFrame, objects: DataFrame, prices: DataFrame, sales: DataFrame, availability: DataFrame, **filters) -> DataFrame:
    """List items of active tours: ship name (of inactive ships too), lowest price, free rooms.

    Tours are filtered first. Prices and availability are aggregated before
    they are joined, so no join multiplies rows.
    """
    return tours_view(filtered(tours.filter("active"), **filters), prices, sales, availability).join(
        objects.select("provider", "object_id", F.col("name").alias("ship_name")), ["provider", "object_id"], "left")


def tours_view(tours: DataFrame, prices: DataFrame, sales: DataFrame, availability: DataFrame) -> DataFrame:
    """Every tour with room_counts (0 if none) and minimal_price."""
    keys = ["provider", "cruise_id"]
    return (
        tours.join(min_prices(prices, sales), keys, "left").join(room_counts(availability), keys, "left")
        .withColumn("room_counts", F.coalesce("room_counts", F.lit(0)).cast("int")))


def keyset_page(df: DataFrame, cursor: tuple[str, str] | None, limit: int, date: str = "begin_date", key: str = "cruise_id") -> DataFrame:
    """``limit`` + 1 rows after ``cursor`` in the order of (date, key), by bytes.

    The row comparison is spelled out, so its first part reaches the scan.
    """
    if cursor is not None:
        d = F.lit(cursor[0]).cast("date")
        df = df.filter((F.col(date) >= d) & ((F.col(date) > d) | (F.col(key) > cursor[1])))
    return df.orderBy(date, key).limit(max(1, min(limit, 100)) + 1)


def with_pages(df: DataFrame, page_size: int, provider: str = "provider", date: str = "begin_date", key: str = "cruise_id") -> DataFrame:
    """``df`` with each row's ``page`` of its provider, in the order of date and key.

    Page numbers come from two steps: rows per (provider, date) are
    summed first, so a window runs over dates, not over all tours; ranks
    inside a date run by (provider, date).
    """
    days = df.groupBy(provider, date).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(provider).orderBy(date).rowsBetween(Window.unboundedPreceding, -1))
    days = days.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    rank = F.row_number().over(Window.partitionBy(provider, date).orderBy(key))
    placed = df.withColumn("_rank", rank).join(days, [provider, date])
    return placed.withColumn("page", F.floor((F.col("_before") + F.col("_rank") - 1) / page_size).cast("long")).drop("_rank", "_before")


def page_index(df: DataFrame, page_size: int, provider: str = "provider", date: str = "begin_date", key: str = "cruise_id") -> DataFrame:
    """Pages of each provider: number, rows, and the cursor that leads to the next page (null on the last)."""
    pages = with_pages(df.select(provider, date, key), page_size, provider, date, key).groupBy(provider, "page").agg(F.count("*").alias("rows"), F.max(F.struct(date, key)).alias("_last"))
    total = pages.groupBy(provider).agg(F.max("page").alias("_top"))
    return pages.join(total, provider).select(
        provider, "page", "rows", F.when(F.col("page") < F.col("_top"), encode_cursor(F.col(f"_last.{date}"), F.col(f"_last.{key}"))).alias("next_cursor"))


def page_documents(items: DataFrame, item: Column, page_size: int, provider: str = "provider", date: str = "begin_date", key: str = "cruise_id") -> DataFrame:
    """provider, page and body: each page as a JSON document, its items in order; ``next_cursor`` is left out on the last page, other nulls are kept."""
    rows = with_pages(items.withColumn("_item", page_json(item)), page_size, provider, date, key)
    pages = rows.groupBy(provider, "page").agg(F.sort_array(F.collect_list(F.struct(date, key, "_item"))).alias("_items"))
    top = pages.groupBy(provider).agg(F.max("page").alias("_top"))
    last = F.element_at("_items", -1)
    more = F.when(F.col("page") < F.col("_top"), F.concat(F.lit(',"next_cursor":"'), encode_cursor(last[date], last[key]), F.lit('"'))).otherwise("")
    body = F.concat(F.lit('{"items":['), F.array_join(F.transform("_items", lambda x: x["_item"]), ","), F.lit("]"), more, F.lit("}"))
    return pages.join(top, provider).select(provider, "page", body.alias("body"))


def class_prices(prices: DataFrame, classes: DataFrame, parts: int | None = None) -> DataFrame:
    """Open prices with their class's attributes; a missing name is ''.

    If classes are ``hashed``, prices meet them where their class is (prices that are dealt by class stay there), and are then dealt by cruise, if ``parts`` is given.
    """
    large = hashed(classes)
    rows = prices.join(_dimension(classes.select("provider", "class_id", F.col("name").alias("class_name"), "base_seats"), large), ["provider", "class_id"], "left").withColumn(
        "class_name", F.coalesce("class_name", F.lit("")))
    return rows.repartition(parts, "cruise_id") if large and parts else rows


def detail_rooms(rooms: DataFrame, availability: DataFrame, classes: DataFrame, stages: DataFrame, parts: int | None = None) -> DataFrame:
    """Rooms of each cruise: those with an open availability version, free or not, with class and stage names.

    Rooms get their names first, so availability, which has most rows, is joined once; while rooms are few enough to be sent whole, its rows
    stay where they are, and else (``hashed_rooms``) they meet rooms where those are, and are then dealt by cruise, if ``parts`` is given.
    """
    named = (
        rooms.join(classes.select("provider", "class_id", F.col("name").alias("class_name")), ["provider", "class_id"], "left")
        .join(stages.select("provider", "stage_id", F.col("name").alias("stage_name")), ["provider", "stage_id"], "left"))
    large = hashed_rooms(rooms)
    found = availability.select("provider", "cruise_id", "room_id", "available").join(_dimension(named, large), ["provider", "room_id"])
    return found.repartition(parts, "cruise_id") if large and parts else found


def detail(tours: DataFrame, objects: DataFrame, priced: DataFrame, roomed: DataFrame) -> DataFrame:
    """One nested row for each tour: prices[], and rooms[] with the prices of their class.

    Prices are sorted by (base_price, partial_buyout); rooms by number as text, their prices by
    (partial_buyout, base_price). Offers are never room prices.
    """
    price = F.struct("base_price", "partial_buyout", "class_id", "class_name", "child_price", "extra_seat", "currency")
    keys, empty = ["provider", "cruise_id"], "array<struct<base_price:decimal(12,2),partial_buyout:boolean,class_id:string,class_name:string,child_price:decimal(12,2),extra_seat:decimal(12,2),currency:string>>"
    # A cruise's prices are gathered once; its rooms pick theirs from that list.
    prices = priced.groupBy(*keys).agg(F.sort_array(F.collect_list(price)).alias("prices"))
    rooms = roomed.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("number", "room_id", "class_id", "class_name", "stage_name", "available"))).alias("rooms"))
    ships = _dimension(objects.select("provider", "object_id", F.col("name").alias("ship_name")), hashed(objects))
    both = (
        tours.join(ships, ["provider", "object_id"], "left")
        .join(prices, keys, "left").join(rooms, keys, "left").withColumn("prices", F.coalesce("prices", F.array().cast(empty))))
    own = lambda r: F.sort_array(F.transform(F.filter("prices", lambda p: p["class_id"] == r["class_id"]), lambda p: F.struct(
        *[p[c].alias(c) for c in ("partial_buyout", "base_price", "child_price", "extra_seat", "currency")])))
    listed = F.transform("rooms", lambda r: F.struct(*[r[c].alias(c) for c in ("number", "room_id", "class_id", "class_name", "stage_name", "available")], own(r).alias("prices")))
    return both.withColumn("rooms", F.coalesce(listed, F.array().cast("array<struct<number:string,room_id:string,class_id:string,class_name:string,stage_name:string,available:boolean,prices:array<struct<partial_buyout:boolean,base_price:decimal(12,2),child_price:decimal(12,2),extra_seat:decimal(12,2),currency:string>>>>")))


def page_json(items: Column) -> Column:
    """JSON of a list item: dates and decimals as strings, nulls kept."""
    return F.to_json(items, {"ignoreNullFields": "false"})


def detail_document(prices: str = "prices", rooms: str = "rooms") -> Column:
    """A row of ``detail`` as a JSON document: dates and decimals as strings, nulls kept."""
    text = lambda x, *names: [x[n].cast("string").alias(n) for n in names]
    price = lambda p: F.struct(p["class_id"].alias("class_id"), p["class_name"].alias("class_name"), p["partial_buyout"].alias("partial_buyout"), *text(p, "base_price", "child_price", "extra_seat", "currency"))
    own = lambda p: F.struct(p["partial_buyout"].alias("partial_buyout"), *text(p, "base_price", "child_price", "extra_seat", "currency"))
    room = lambda r: F.struct(*[r[n].alias(n) for n in ("room_id", "number", "class_name", "stage_name", "available")], F.transform(r["prices"], own).alias("prices"))
    return page_json(F.struct(
        "cruise_id", F.date_format("begin_date", "yyyy-MM-dd").alias("begin_date"), F.date_format("end_date", "yyyy-MM-dd").alias("end_date"), "ship_name",
        F.transform(prices, price).alias("prices"), F.transform(rooms, room).alias("rooms")))
