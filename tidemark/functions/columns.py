"""Column functions: lenient and strict casts, cursors, tags, prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts(text: str) -> Column:
    return F.expr(f"timestamp_ntz'{text}'")


def lenient_bool(c: Column) -> Column:
    """1, true, yes and 0, false, no; any other spelling, capitals too, is null."""
    return F.when(c.isin("1", "true", "yes"), True).when(c.isin("0", "false", "no"), False)


def strict_bool(c: Column) -> Column:
    return F.when(c == "true", True).when(c == "false", False)


def lenient_decimal(c: Column) -> Column:
    """Null for an empty or malformed number; one too large for DECIMAL(12,2) is an error, as in a strict table."""
    plain = F.trim(c)
    shaped = F.when(plain.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"), plain)
    return shaped.try_cast("decimal(38,10)").cast("decimal(12,2)")


def strict_int(c: Column) -> Column:
    """A whole number without surrounding space, or null."""
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c).try_cast("int")


def lenient_time(c: Column) -> Column:
    """HH:mm or HH:mm:ss as HH:mm:ss; anything else is null."""
    ok = c.rlike(r"^([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$")
    return F.when(ok, F.when(F.length(c) == 5, F.concat(c, F.lit(":00"))).otherwise(c))


def class_object(c: Column) -> Column:
    """Object id: the class id without its last two characters."""
    return F.substring(c, F.lit(1), F.length(c) - 2)


def encode_cursor(date: Column, key: Column) -> Column:
    return F.lower(F.hex(F.encode(F.concat_ws("|", F.date_format(date, "yyyy-MM-dd"), key), "UTF-8")))


def decode_cursor(c: Column) -> Column:
    """struct(begin_date, cruise_id, error); error is one of hex, utf8, shape, empty_id, date, or null."""
    raw = F.when(c.rlike("^([0-9a-fA-F]{2})*$"), F.unhex(c))
    text = F.when(F.expr("true") & F.is_valid_utf8(raw.cast("string")), raw.cast("string"))
    at = F.instr(text, "|")
    key = F.substring(text, at + 1, F.length(text))
    head = F.substring(text, F.lit(1), at - 1)
    date = F.when(head.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(head, "yyyy-MM-dd") if hasattr(F, "try_to_date") else head.try_cast("date"))
    error = (
        F.when(raw.isNull(), "hex").when(text.isNull(), "utf8").when(at == 0, "shape")
        .when(key == "", "empty_id").when(date.isNull(), "date"))
    good = error.isNull()
    return F.struct(F.when(good, date).alias("begin_date"), F.when(good, key).alias("cruise_id"), error.alias("error"))


def content_tag(json: Column) -> Column:
    """First eight bytes of the SHA-256 as hex, in quotes."""
    return F.concat(F.lit('"'), F.substring(F.sha2(json, 256), 1, 16), F.lit('"'))


def utf8_prefix(c: Column, size: int) -> Column:
    """The longest prefix of whole characters that takes at most ``size`` bytes."""
    head = F.substring(c, 1, size)
    fits = F.filter(F.sequence(F.lit(size), F.lit(0), F.lit(-1)), lambda n: F.octet_length(F.substring(head, F.lit(1), n)) <= size)
    return F.when(F.octet_length(head) <= size, head).otherwise(F.substring(head, F.lit(1), F.get(fits, 0)))
