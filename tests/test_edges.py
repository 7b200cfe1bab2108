"""Edge cases of the operators, each against a value worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import decode_cursor, encode_cursor, lenient_bool, lenient_decimal, ts, utf8_prefix
from tidemark.operators import canonical, enrich, logs, metrics, scd1, scd2

NOW = "2031-05-01 12:00:00"
ERRORS = "id long, occurred_at string, resolved boolean, notified_at string, notification_state string, notification_claimed_at string, notification_attempts int"


def errors(spark, *rows):
    df = spark.createDataFrame(rows, ERRORS)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("occurred_at", "notified_at", "notification_claimed_at")})


def states(df):
    return {r.id: r.notification_state for r in df.collect()}


def test_claims_leases_and_attempts(spark):
    fresh = "2031-05-01 11:00:00"
    table = errors(
        spark, (1, fresh, False, None, "pending", None, 0), (2, fresh, True, None, "pending", None, 0), (3, fresh, False, fresh, "sent", fresh, 1),
        (4, fresh, False, None, "claimed", "2031-05-01 11:49:59", 2), (5, fresh, False, None, "claimed", "2031-05-01 11:50:00", 2), (6, fresh, False, None, "pending", None, 5),
        (7, "2031-04-30 12:00:00", False, None, "pending", None, 0), (8, "2031-04-30 12:00:01", False, None, "pending", None, 4), (9, fresh, False, None, "dead", None, 5))
    claimed = logs.claim(table, ts(NOW))
    assert [(r.id, r.notification_attempts) for r in claimed.collect()] == [(8, 5), (1, 1), (4, 3)], "oldest first; a lease of ten minutes, a window of a day, five attempts"
    assert [r.id for r in logs.claim(table, ts(NOW), limit=1).collect()] == [8]
    held = logs.with_claims(table, claimed)
    assert held.count() == 9 and logs.claim(held, ts(NOW)).count() == 0, "claimed rows are not claimed again"
    ids = claimed.select("id")
    sent = logs.mark_sent(held, ids.unionAll(ids), ts(NOW))
    assert states(logs.mark_sent(sent, ids, ts(NOW))) == states(sent) and states(sent)[1] == "sent" and states(sent)[5] == "claimed"
    failed = states(logs.mark_failed(held, ids))
    assert (failed[8], failed[1], failed[4], failed[5]) == ("dead", "pending", "pending", "claimed")
    spent = errors(spark, (1, fresh, False, None, "claimed", "2031-05-01 11:00:00", 5), (2, fresh, False, None, "claimed", "2031-05-01 11:59:00", 5), (3, fresh, False, None, "claimed", "2031-05-01 11:00:00", 4))
    assert states(logs.sweep_dead(spent, ts(NOW))) == {1: "dead", 2: "claimed", 3: "claimed"}


def test_digest_prefix_ends_with_a_whole_letter(spark):
    messages = ["я" * 39 + "!" + "я" * 5, "x" + "я" * 60, "short", "𝒳" * 30, None]
    got = spark.createDataFrame([(m,) for m in messages], "m string").select(utf8_prefix(F.col("m"), 80).alias("p")).collect()
    want = [None if m is None else m.encode()[:80].decode(errors="ignore") for m in messages]
    assert [r.p for r in got] == want
    rows = spark.createDataFrame(
        [(1, "parse", "error", "я" * 40 + "a", "2031-01-01"), (2, "parse", "error", "я" * 40 + "b", "2031-01-02"), (3, "parse", "error", "я" * 40 + "c", "2031-01-02"), (4, "fetch", "error", "я" * 40, "2031-01-01")],
        "id long, stage string, severity string, message string, occurred_at string")
    assert {(r.stage, r.n, r.message[-1]) for r in logs.error_digest(rows).collect()} == {("parse", 3, "b"), ("fetch", 1, "я")}, "of a tie the first met"


def test_cursors(spark):
    text = lambda s: s.encode().hex()
    cases = {
        text("2031-02-03|a|b"): (dt.date(2031, 2, 3), "a|b", None), text("2031-02-03|é").upper(): (dt.date(2031, 2, 3), "é", None), "0": (None, None, "hex"), "zz": (None, None, "hex"), "c328": (None, None, "utf8"),
        text("2031-02-03"): (None, None, "shape"), "": (None, None, "shape"), text("|"): (None, None, "empty_id"), text("no|"): (None, None, "empty_id"), text("2031-02-30|a"): (None, None, "date"), text("3.2.2031|a"): (None, None, "date")}
    got = spark.createDataFrame([(c,) for c in cases], "c string").select("c", decode_cursor(F.col("c")).alias("d")).collect()
    assert {r.c: tuple(r.d) for r in got} == cases
    one = spark.createDataFrame([(dt.date(2031, 2, 3), "a|b")], "d date, k string").select(encode_cursor(F.col("d"), F.col("k"))).first()[0]
    assert one == text("2031-02-03|a|b")


def test_lenient_casts(spark):
    texts = ["1", "true", "yes", "0", "false", "no", "TRUE", " 1", "", None, " 5000 ", "12.345", "1,5", "1e3", "."]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(lenient_bool(F.col("t")).alias("b"), lenient_decimal(F.col("t")).alias("d")).collect()
    assert [r.b for r in got][:10] == [True, True, True, False, False, False, None, None, None, None]
    assert [None if r.d is None else str(r.d) for r in got][8:13] == [None, None, "5000.00", "12.35", None]


def test_tours_are_strict_about_dates_only(spark):
    columns = "provider string, observed_at timestamp_ntz, ordinal int, id string, ship_id string, begin_date string, begin_time string, end_date string, end_time string, route string"
    row = lambda begin, time: ("p", None, 0, "c", "s", begin, time, "2.1.2031", None, "r")
    good = canonical.tours(spark.createDataFrame([row("1.1.2031", "25:00"), row("01.01.2031", "7:05")], columns)).collect()
    assert {str(r.begin_date) for r in good} == {"2031-01-01"} and {r.begin_time for r in good} <= {None, "07:05:00", "7:05:00"}
    with pytest.raises(Exception, match="2031|DATE|date"):
        canonical.tours(spark.createDataFrame([row("31.02.2031", None)], columns)).collect()


def test_upserts_overwrite_with_nulls_and_reactivate(spark):
    life = "is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz"
    old = dt.datetime(2031, 1, 1)
    current = spark.createDataFrame([("p", "a", "x", True, old, old), ("p", "b", "y", False, old, old), ("q", "a", "z", True, old, old)], f"provider string, k string, v string, {life}")
    incoming = spark.createDataFrame([("p", "a", None), ("p", "b", "y"), ("p", "c", "n")], "provider string, k string, v string")
    merged = scd1.merge_scd1(current, incoming, ["provider", "k"], ["v"], ts(NOW))
    assert {(r.provider, r.k): (r.v, r.is_active, r.action, r.created_at == old) for r in merged.collect()} == {
        ("p", "a"): (None, True, "updated", True), ("p", "b"): ("y", True, "reactivated", True), ("p", "c"): ("n", True, "inserted", False), ("q", "a"): ("z", True, "kept", True)}
    off = scd1.deactivate_missing(merged.drop("action"), incoming.limit(0).select("k"), ["k"], "p", ts(NOW))
    assert {(r.provider, r.k): r.is_active for r in off.collect()} == {("p", "a"): False, ("p", "b"): False, ("p", "c"): False, ("q", "a"): True}, "no rows at all switch all off, of this provider"


def test_staging_first_wins_and_null_is_false(spark):
    rows = spark.createDataFrame([("c", None, "10.005", 0), ("c", False, "99", 1), ("c", True, "5", 2)], "k string, partial_buyout boolean, base_price string, ordinal int").withColumn("base_price", F.col("base_price").cast("decimal(20,6)"))
    got = {(r.k, r.partial_buyout): str(r.base_price) for r in scd2.stage(rows, ["k", "partial_buyout"], ["ordinal"], ["base_price"], ["partial_buyout"]).collect()}
    assert got == {("c", False): "10.01", ("c", True): "5.00"}


def test_templates(spark):
    fill = lambda t: spark.range(1).select(enrich.template_column(t, {"name": F.lit("{cruise_id}"), "cruise_id": F.lit("7")}).alias("x")).first().x
    assert [fill(t) for t in ("", "{name}", "a{b}c", "{open", "{}", "{name}{cruise_id}}")] == ["", "{cruise_id}", "a{b}c", "{open}", "{}", "{cruise_id}7}"]


def test_bucket_quantiles_and_zero_fill(spark):
    rows = spark.createDataFrame([(f"2031-01-01 00:0{k % 10}:30", "a", float(k)) for k in range(20)], "ts string, phase string, v double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    counts = metrics.bucket_counts(rows, "v", ["phase"])
    assert counts.first().counts == [1, 1, 1, 1, 1, 1, 1, 2, 3, 6, 11, 20, 20, 20, 20, 20]
    got = counts.select(metrics.histogram_quantile(F.col("counts"), 0.5).alias("p50"), metrics.histogram_quantile(F.col("counts"), 0.95).alias("p95")).first()
    assert abs(got.p50 - (5 + 5 * 4 / 5)) < 1e-9 and abs(got.p95 - (10 + 20 * 8 / 9)) < 1e-9
    windows = metrics.window_quantiles(rows, "ts", "v", 10, ["phase"], 0.5).count()
    assert windows == 19, "each of ten minutes is in ten windows, which overlap"
    series = rows.filter("v in (3.0, 5.0)").select(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("window_start"), "phase", F.lit(1).alias("n"))
    filled = metrics.zero_fill(series, spark.createDataFrame([("a",), ("b",)], "phase string"), "phase", "n", 1).collect()
    assert sorted((r.phase, r.window_start.minute, r.n) for r in filled) == [("a", 3, 1), ("a", 4, 0), ("a", 5, 1), ("b", 3, 0), ("b", 4, 0), ("b", 5, 0)]
    assert metrics.zero_fill(series.limit(0), rows.select("phase"), "phase", "n", 1).count() == 0
