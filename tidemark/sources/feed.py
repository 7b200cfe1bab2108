"""Landed XML feeds: payloads, fingerprints, and eight record sets from one parse."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import lenient_bool, lenient_decimal

PAYLOAD = "path string, modificationTime timestamp, length bigint, content binary"
#: Attributes of each record set, as the feed names them.
SHIP = ("id", "name")
CLASS = ("id", "name", "comment", "m_count", "r_count", "no_full")
CABIN = ("id", "ship", "number", "class_id", "deck")
CRUISE = ("id", "ship_id", "begin_date", "begin_time", "end_date", "end_time", "route", "child_price", "dop_price")
PRICE = ("cruise_id", "class_id", "price", "nofull")
SPO = ("cruise_id", "class_id", "cabin_id", "spo", "nofull")


def _rows(section: str, tag: str, attributes: tuple[str, ...], more: list[T.StructField] = ()) -> T.StructField:
    row = T.StructType([*[T.StructField(f"_{a}", T.StringType()) for a in attributes], *more])
    return T.StructField(section, T.StructType([T.StructField(tag, T.ArrayType(row))]))


def feed_schema() -> T.StructType:
    """All attributes are strings: ids keep their zeros and times are no timestamps."""
    inner = T.StructField("cabin", T.ArrayType(T.StructType([T.StructField("_id", T.StringType())])))
    return T.StructType([
        _rows("ships", "ship", SHIP), _rows("decks", "deck", SHIP), _rows("classes", "class", CLASS), _rows("cabins", "cabin", CABIN),
        _rows("cruises", "cruise", CRUISE), _rows("prices", "price", PRICE), _rows("spos", "spo", SPO), _rows("free", "cruise", ("id",), [inner])])


def land(spark: SparkSession, path: str, provider: str, streaming: bool = False) -> DataFrame:
    """provider, observed_at, content, path, length and sha256 of each landed file."""
    reader = spark.readStream.schema(PAYLOAD) if streaming else spark.read
    return fingerprint(reader.format("binaryFile").load(path).select(
        F.lit(provider).alias("provider"), F.col("modificationTime").cast("timestamp_ntz").alias("observed_at"), "content", "path", "length"))


def fingerprint(payloads: DataFrame, content: str = "content") -> DataFrame:
    return payloads.withColumn("sha256", F.sha2(F.col(content), 256))


def drop_seen(landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Payloads whose (provider, sha256) the ledger lacks, the first of each.

    Which they are is found without contents; contents are moved only where one payload landed twice at a time.
    """
    key = ["provider", "sha256", "observed_at"]
    times = landed.groupBy(*key).agg(F.count("*").alias("_n"))
    first = times.groupBy("provider", "sha256").agg(F.min_by(F.struct("observed_at", "_n"), "observed_at").alias("p")).select("provider", "sha256", "p.*")
    fresh = landed.join(first.join(ledger.select("provider", "sha256"), ["provider", "sha256"], "left_anti"), key)
    names = ["provider", "observed_at", "content", "sha256"]
    return fresh.filter("_n = 1").select(names).unionAll(fresh.filter("_n > 1").dropDuplicates(key).select(names))


def parse(landed: DataFrame, text: Column | None = None) -> DataFrame:
    """provider, observed_at and the parsed tree ``r``; a malformed document fails the batch."""
    text = F.decode(F.col("content"), "UTF-8") if text is None else text
    options = {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false"}
    return landed.select("provider", "observed_at", F.from_xml(text, feed_schema().simpleString(), options).alias("r"))


def _each(tree: DataFrame, section: str, tag: str, attributes: tuple[str, ...]) -> DataFrame:
    return tree.select("provider", "observed_at", F.posexplode(f"r.{section}.{tag}").alias("ordinal", "x")).select(
        "provider", "observed_at", "ordinal", *[F.col(f"x._{a}").alias(a) for a in attributes])


#: section -> (tag, attributes) of its records.
SECTIONS = {
    "ships": ("ship", SHIP), "decks": ("deck", SHIP), "classes": ("class", CLASS), "cabins": ("cabin", CABIN), "cruises": ("cruise", CRUISE), "prices": ("price", PRICE), "spos": ("spo", SPO)}


def records(tree: DataFrame) -> dict[str, DataFrame]:
    """Record sets of parsed documents as they came: provider, observed_at, ordinal and attributes; of free, each cruise's cabins."""
    found = {s: _each(tree, s, tag, attributes) for s, (tag, attributes) in SECTIONS.items()}
    found["free"] = tree.select("provider", "observed_at", F.posexplode("r.free.cruise").alias("o", "x")).select("provider", "observed_at", "o", F.col("x._id").alias("cruise_id"), F.col("x.cabin").alias("cabins"))
    return found


#: A tag up to its end, whatever its attributes hold; and what may stand after ``<!`` in one piece.
_TAG = r"""^((?:[^>"']|"[^"]*"|'[^']*')*)>"""
_ASIDE = r"(?s)^!(--.*--|\[CDATA\[.*\]\]|DOCTYPE[^\[]*)>"


class Malformed(ValueError):
    """A document that is not well-formed."""


def _tags(spark: SparkSession, path: str) -> DataFrame:
    """One row for each ``<`` of a file, in the order of (block, id): the text up to the next one, its tag, name and change of depth."""
    value = F.col("value")
    rows = spark.read.option("lineSep", "<").text(path).select(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    rows = rows.filter((value != "") & (value != "\ufeff")).select(
        "block", "id", "value", F.regexp_extract(value, _TAG, 1).alias("tag"), F.regexp_extract(value, r"^/?([^\s/>]+)", 1).alias("name"), value.startswith("/").alias("closing"),
        (value.startswith("?") | value.startswith("!")).alias("aside"))
    odd = F.when(F.col("aside"), value.startswith("!") & ~value.rlike(_ASIDE)).otherwise(~value.rlike(_TAG) | (F.col("name") == ""))
    delta = F.when(F.col("aside"), 0).when(F.col("closing"), -1).when(F.col("tag").endswith("/"), 0).otherwise(1)
    return rows.withColumns({"odd": odd, "delta": delta})


def records_of_file(spark: SparkSession, path: str, provider: str, observed_at: Column, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, DataFrame]:
    """``records`` of one large document, read by many tasks; ordinals are (block, id), in the order of the document.

    The file is split at ``<``, which well-formed XML has nowhere but before tags, so each row is a tag, and each block of the file is read
    by a task of its own. Sums of +1 and -1 over blocks, then inside them, give each tag's depth; tags at depth two begin records, and Spark's
    parser reads each record strictly. Tags that do not match, or a document that does not end, raise ``Malformed``;
    comments and character data with a ``<`` do too: such a document must be parsed as a whole. One row for each block reaches the driver. ``keep`` may
    hold the parsed records, from which all sets are taken.
    """
    tags = _tags(spark, path)
    held = ("root", "section", "record", "kind")
    sums = {r["block"]: r for r in tags.groupBy("block").agg(F.sum("delta").alias("delta"), F.count_if("odd").alias("odd")).collect()}
    blocks, base, depth = sorted(sums), {}, 0
    for k in blocks:
        base[k], depth = depth, depth + sums[k]["delta"]
    if depth or not blocks or any(r["odd"] for r in sums.values()):
        raise Malformed(f"{path}: not well-formed, or a tag in a comment or in character data")
    by_block = lambda values, kind: F.create_map(*[x for k in blocks for x in (F.lit(k), F.lit(values.get(k)).cast(kind))])[F.col("block")]
    inside = Window.partitionBy("block").orderBy("id")
    before, upto = inside.rowsBetween(Window.unboundedPreceding, -1), inside.rowsBetween(Window.unboundedPreceding, 0)
    opens = ~F.col("closing") & ~F.col("aside")
    at = lambda n, what: F.when((F.col("depth") == n) & opens, what)
    placed = tags.withColumn("depth", by_block(base, "bigint") + F.coalesce(F.sum("delta").over(before), F.lit(0))).withColumns({
        "root": at(0, F.col("name")), "section": at(1, F.col("name")), "record": at(2, F.col("id")), "kind": at(2, F.col("name"))})
    placed = placed.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in held})
    lasts = {r["block"]: r for r in placed.groupBy("block").agg(*[F.max_by(c, "id").alias(c) for c in held], F.count_if((F.col("depth") == 0) & opens).alias("roots")).collect()}
    carried, now = {c: {} for c in held}, dict.fromkeys(held)
    for k in blocks:
        for c in held:
            carried[c][k] = now[c]
            now[c] = now[c] if lasts[k][c] is None else lasts[k][c]
    whole = placed.withColumns({c: F.coalesce(c, by_block(carried[c], "bigint" if c == "record" else "string")) for c in held})
    wrong = F.col("closing") & ((F.col("depth") < 1) | ((F.col("depth") == 1) & (F.col("name") != F.col("root"))) | ((F.col("depth") == 2) & (F.col("name") != F.col("section"))))
    if sum(r["roots"] for r in lasts.values()) != 1 or not whole.filter(wrong).isEmpty():
        raise Malformed(f"{path}: tags do not match")
    own = whole.filter((F.col("depth") > 2) | ((F.col("depth") == 2) & opens))
    single = (F.col("depth") == 2) & (F.col("delta") == 0)
    parts = F.sort_array(F.collect_list(F.struct("block", "id", "value")))
    one = own.filter(single).select("section", "kind", F.struct("block", "id").alias("ordinal"), F.concat(F.lit("<"), "tag", F.lit(">")).alias("xml"))
    many = own.filter(~single).groupBy("section", "kind", "record").agg(
        F.min(F.struct("block", "id")).alias("ordinal"), F.concat(F.lit("<"), F.array_join(F.transform(parts, lambda p: p["value"]), "<")).alias("xml")).drop("record")
    # Records of any section are read, so that a malformed one fails wherever it is.
    rows = keep(one.unionAll(many).select(F.lit(provider).alias("provider"), observed_at.alias("observed_at"), "section", "kind", "ordinal", F.from_xml("xml", _ANY, {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false"}).alias("x")))
    known = (F.col("section") == "free") & (F.col("kind") == "cruise")
    for s, (tag, _) in SECTIONS.items():
        known = known | ((F.col("section") == s) & (F.col("kind") == tag))
    rows.filter(~known & F.col("x").isNull()).isEmpty()  # reads the others
    found = {
        s: rows.filter((F.col("section") == s) & (F.col("kind") == tag)).select("provider", "observed_at", "ordinal", *[F.col(f"x._{a}").alias(a) for a in attributes]) for s, (tag, attributes) in SECTIONS.items()}
    found["free"] = rows.filter("section = 'free' and kind = 'cruise'").select("provider", "observed_at", F.col("ordinal").alias("o"), F.col("x._id").alias("cruise_id"), F.col("x.cabin").alias("cabins"))
    return found


#: A record of any section.
_ANY = ", ".join([*[f"_{a} string" for a in dict.fromkeys(x for _, attributes in SECTIONS.values() for x in attributes)], "cabin array<struct<_id: string>>"])


def _or_empty(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.coalesce(F.col(n), F.lit("")) for n in names})


def shred(tree: DataFrame) -> dict[str, DataFrame]:
    """``typed_records`` of parsed documents."""
    return typed_records(records(tree))


#: Attributes without which a record is skipped; and the one of a price that must be a number.
NEEDED = {
    **{s: ("id",) for s in ("ships", "decks", "classes", "cabins", "cruises")}, "prices": ("cruise_id", "class_id", "price"), "spos": ("cruise_id", "class_id", "cabin_id", "spo"), "free": ("cruise_id", "cabin_id")}
AMOUNT = {"prices": "price", "spos": "spo"}


def _whole(section: str, attribute: Callable[[str], Column]) -> Column:
    """Whether a record of ``section`` has all that it needs."""
    return reduce(Column.__and__, [attribute(a).isNotNull() for a in NEEDED[section]])


def typed_records(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """ships, decks, classes, cabins, cruises, prices, spos, free, and the rows that prices and spos reject.

    Records without their ids are skipped. Every row has provider, observed_at and the ordinal in its section.
    """
    kept = lambda s: raw[s].filter(_whole(s, F.col))
    ships = _or_empty(kept("ships"), "name")
    decks = _or_empty(kept("decks"), "name")
    classes = _or_empty(kept("classes"), "name").withColumns({
        "m_count": F.trim("m_count").try_cast("int"), "r_count": F.trim("r_count").try_cast("int"), "no_full": lenient_bool(F.col("no_full"))})
    cabins = _or_empty(kept("cabins"), "ship", "number", "class_id", "deck")
    cruises = _or_empty(kept("cruises"), "ship_id", "begin_date", "end_date", "route").withColumns({
        "child_price": lenient_decimal(F.col("child_price")), "dop_price": lenient_decimal(F.col("dop_price"))})

    def priced(section: str) -> tuple[DataFrame, DataFrame]:
        amount = AMOUNT[section]
        rows = kept(section).withColumn("nofull", lenient_bool(F.col("nofull"))).withColumn("_n", _strict_decimal(F.col(amount)))
        good = rows.filter("_n is not null").withColumn(amount, F.col("_n")).drop("_n")
        bad = rows.filter("_n is null").select("provider", "observed_at", F.lit(section).alias("section"), F.col("ordinal"), F.col(amount).alias("value"))
        return good, bad

    prices, bad_prices = priced("prices")
    spos, bad_spos = priced("spos")
    free = raw["free"].select("provider", "observed_at", "o", "cruise_id", F.posexplode("cabins").alias("i", "y")).select(
        "provider", "observed_at", F.struct("o", "i").alias("ordinal"), "cruise_id", F.col("y._id").alias("cabin_id")).filter(_whole("free", F.col))
    return {"ships": ships, "decks": decks, "classes": classes, "cabins": cabins, "cruises": cruises, "prices": prices, "spos": spos, "free": free, "rejects": bad_prices.unionByName(bad_spos)}


def record_counts(tree: DataFrame) -> DataFrame:
    """section, n and rejected: how many rows ``shred`` finds and rejects in each section, from one parse of each document for all of them.

    The k-th records of all sections stand side by side in one row, so they are counted in one pass.
    """
    tags = {s: tag for s, (tag, _) in SECTIONS.items()} | {"free": "cruise"}
    kinds = {s: feed_schema()[s].dataType[tag].dataType for s, tag in tags.items()}
    side = F.arrays_zip(*[F.coalesce(F.col(f"r.{s}.{tag}"), F.array().cast(kinds[s])).alias(s) for s, tag in tags.items()])
    seen = {}
    for s in SECTIONS:
        whole = _whole(s, lambda a, s=s: F.col(f"x.{s}._{a}"))
        seen[s] = whole & _strict_decimal(F.col(f"x.{s}._{AMOUNT[s]}")).isNotNull() if s in AMOUNT else whole
        seen[f"{s} whole"] = whole
    cabins = F.array_size(F.filter("x.free.cabin", lambda y: _whole("free", lambda a: F.col("x.free._id") if a == "cruise_id" else y["_id"])))
    seen["free"] = seen["free whole"] = F.when(F.col("x.free._id").isNotNull(), cabins)
    rows = tree.select(F.explode(side).alias("x")).select(*[n.cast("long").alias(c) for c, n in seen.items()])
    sums = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in seen])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(s).alias("section"), F.col(s).alias("n"), (F.col(f"{s} whole") - F.col(s)).alias("rejected")) for s in tags])).alias("x")).select("x.*")


def _strict_decimal(c: Column) -> Column:
    """Without surrounding space; malformed numbers are null, those too large for the column an error."""
    shaped = F.when(c.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"), c)
    return shaped.try_cast("decimal(38,10)").cast("decimal(12,2)")
