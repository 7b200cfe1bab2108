"""Snapshots of a lake ferry line through the whole write path, as batches and as a stream."""

from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest

from tidemark.operators import scd2
from tidemark.operators.enrich import Rule
from tidemark.sources import feed
from tidemark.sources.store import Conflict, StateStore
from tidemark.streaming import sync

#: Day 1: a key priced twice (the first counts), null and false buyout that collide, one bad price, ids of every length.
DAY1 = """<root>
<ships><ship id="40" name="Heron"/><ship id="41" name="Tern"/><ship id="42" name="Otter"/><ship id="41" name="Tern II"/></ships>
<decks><deck id="upper" name="Upper"/><deck id="lower" name="Lower"/></decks>
<classes><class id="4011" name="Window" m_count="3" no_full="yes"/><class id="4122" name="Bunk" m_count="x"/><class id="кит-α07" name="Suite"/><class id="77" name="too short"/><class id="" name="none"/></classes>
<cabins><cabin id="H-1" ship="40" number="12" class_id="4011" deck="upper"/><cabin id="H-2" ship="40" number="3" class_id="4011" deck="lower"/><cabin id="T-9" ship="41" number="9" class_id="4122" deck="lower"/></cabins>
<cruises><cruise id="spring" ship_id="40" begin_date="02.04.2031" begin_time="08:15" end_date="04.04.2031" route="{name} &amp; {cruise_id}" child_price=" 12.5 "/>
<cruise id="summer" ship_id="41" begin_date="1.7.2031" begin_time="noon" end_date="09.07.2031" route="Isles"/><cruise id="autumn" ship_id="42" begin_date="05.10.2031" end_date="06.10.2031" route="Fog"/></cruises>
<prices><price cruise_id="spring" class_id="4011" price="210.40"/><price cruise_id="spring" class_id="4011" nofull="0" price="999"/><price cruise_id="spring" class_id="4011" nofull="1" price="150"/>
<price cruise_id="summer" class_id="4122" price="80"/><price cruise_id="autumn" class_id="4122" price="65.5"/><price cruise_id="autumn" class_id="4011" price="12,5"/></prices>
<spos><spo cruise_id="summer" class_id="4122" cabin_id="T-9" spo="71.25"/></spos><weather><sky/></weather>
<free><cruise id="summer"><cabin id="T-9" free="0"/></cruise><cruise id="spring"><cabin id="H-1"/><cabin id="H-2"/></cruise></free></root>"""
#: Day 2: the child price alone changes, a price and a cabin go, offers change; Otter and autumn are gone.
DAY2 = """<root><ships><ship id="40" name="Heron"></ship><ship id="41" name="Tern II"/></ships><decks><deck id="upper" name="Upper"/><deck id="lower" name="Lower"/></decks>
<classes><class id="4011" name="Window"/><class id="4122" name="Bunk"/></classes>
<cabins><cabin id="H-1" ship="40" number="12" class_id="4011" deck="upper"/><cabin id="T-9" ship="41" number="9" class_id="4122" deck="lower"/></cabins>
<cruises><cruise id="spring" ship_id="40" begin_date="02.04.2031" end_date="04.04.2031" route="Bay" child_price="13"/><cruise id="summer" ship_id="41" begin_date="01.07.2031" end_date="09.07.2031" route="Isles"/></cruises>
<prices><price cruise_id="spring" class_id="4011" price="210.40"/><price cruise_id="summer" class_id="4122" price="84"/></prices>
<spos><spo cruise_id="summer" class_id="4122" cabin_id="T-9" spo="70"/></spos><free><cruise id="spring"><cabin id="H-1"/></cruise></free></root>"""
#: Day 3: autumn and its price return, the cabin is free again, no offers.
DAY3 = DAY2.replace("</cruises>", '<cruise id="autumn" ship_id="41" begin_date="05.10.2031" end_date="06.10.2031" route="Fog"/></cruises>').replace(
    "</prices>", '<price cruise_id="autumn" class_id="4122" price="65.50"/></prices>').replace(
    '<spo cruise_id="summer" class_id="4122" cabin_id="T-9" spo="70"/>', "").replace('<cabin id="H-1"/></cruise></free>', '<cabin id="H-1"/><cabin id="H-2"/></cruise></free>')
RULES = {"lake": [Rule("route", "template", template="{name}/{cruise_id}"), Rule("days", "days_between", plus=1), Rule("is_return", "constant", value="true")]}
TIMES = [f"2031-01-0{k} 06:00:00" for k in (1, 2, 3)]


def landed(spark, *payloads):
    rows = [(p, t, x.encode()) for p, t, x in payloads]
    df = spark.createDataFrame(rows, "provider string, at string, content binary").selectExpr("provider", "cast(at as timestamp_ntz) as observed_at", "content")
    return feed.fingerprint(df)


def table(store, name, provider="lake"):
    key, rest = sync.HISTORIES[name]
    return store.read(name, sync._schema(store.spark, f"provider string, {key}, {rest}, {sync.VERSION}")).filter(f"provider = '{provider}'")


def dimension(store, name, provider="lake"):
    key, rest = sync.DIMENSIONS[name]
    columns = f"provider string, {key}, {rest}, " + (f"{sync.ENRICHED}, " if name == "tours" else "") + sync.LIFE
    return store.read(name, sync._schema(store.spark, columns), "open", provider)


def rows(store, name, columns):
    return store.read(name, sync._schema(store.spark, columns)).collect()


def check_three_days(store):
    tours = {r.external_cruise_id: r for r in dimension(store, "tours").collect()}
    assert {k: r.is_active for k, r in tours.items()} == {"spring": True, "summer": True, "autumn": True}
    assert (tours["spring"].route, tours["spring"].days, tours["spring"].is_return, tours["spring"].begin_time) == ("Bay/spring", 3, True, None)
    ships = {r.external_id: (r.name, r.is_active, str(r.updated_at)) for r in dimension(store, "objects").collect()}
    assert ships == {"40": ("Heron", True, TIMES[2]), "41": ("Tern II", True, TIMES[2]), "42": ("Otter", False, TIMES[1])}
    assert {r.external_class_id: (r.external_object_id, r.is_active) for r in dimension(store, "classes").collect()} == {"4011": ("40", True), "4122": ("41", True), "кит-α07": ("кит-α", False)}
    assert {r.external_room_id for r in dimension(store, "rooms").filter("not is_active").collect()} == {"H-2"}
    versions = sorted(
        (r.external_cruise_id, r.external_class_id, r.partial_buyout, str(r.valid_from), r.base_price, r.child_price, str(r.valid_to)) for r in table(store, "prices").collect())
    D = Decimal  # noqa: N806
    assert versions == [
        ("autumn", "4122", False, TIMES[0], D("65.50"), None, TIMES[1]), ("autumn", "4122", False, TIMES[2], D("65.50"), None, "None"),
        ("spring", "4011", False, TIMES[0], D("210.40"), D("12.50"), TIMES[1]), ("spring", "4011", False, TIMES[1], D("210.40"), D("13.00"), "None"),
        ("spring", "4011", True, TIMES[0], D("150.00"), D("12.50"), TIMES[1]),
        ("summer", "4122", False, TIMES[0], D("80.00"), None, TIMES[1]), ("summer", "4122", False, TIMES[1], D("84.00"), None, "None")]
    assert [(str(r.valid_from), str(r.base_price), str(r.valid_to)) for r in table(store, "sales").orderBy("valid_from").collect()] == [
        (TIMES[0], "71.25", TIMES[1]), (TIMES[1], "70.00", TIMES[2])]
    rooms = sorted((r.external_room_id, str(r.valid_from), r.available, str(r.valid_to)) for r in table(store, "availability").collect())
    assert rooms == [
        ("H-1", TIMES[0], True, "None"), ("H-2", TIMES[0], True, TIMES[1]), ("H-2", TIMES[1], False, TIMES[2]), ("H-2", TIMES[2], True, "None"),
        ("T-9", TIMES[0], True, TIMES[1]), ("T-9", TIMES[1], False, "None")]
    for name in sync.HISTORIES:
        assert scd2.scd2_check(table(store, name), ["provider", *sync._names(sync.HISTORIES[name][0])]).count() == 0
    check_figures(store, "lake", {"spring": ("210.40", 2), "summer": ("84.00", 0), "autumn": ("65.50", 0)})


def check_figures(store, provider, want=None):
    """Figures that syncs kept up are those of all open versions."""
    kept = {r.external_cruise_id: (str(r.minimal_price), r.room_counts) for r in store.read("cruise_figures", sync._schema(store.spark, sync.VIEW), "open", provider).collect()}
    whole = sync.cruise_figures(*[table(store, n, provider).filter("valid_to is null") for n in sync.HISTORIES])
    assert kept == {r.external_cruise_id: (str(r.minimal_price), r.room_counts) for r in whole.collect()} and (want is None or kept == want)


def test_batches_in_order_with_bad_payloads_and_other_providers(spark, tmp_path):
    store = StateStore(spark, f"file://{tmp_path}/s")
    batch = landed(
        spark, ("lake", TIMES[1], DAY2), ("lake", TIMES[0], DAY1), ("sea", TIMES[0], DAY1), ("torn", TIMES[0], "<root><ships></root>"), ("void", TIMES[0], "<root><ships/></root>"),
        ("dated", TIMES[0], DAY1.replace("05.10.2031", "31.02.2031")), ("dated", TIMES[1], DAY2))
    result = sync.sync_batch(store, batch, RULES)
    assert sorted(p for p, _ in result["done"]) == ["dated", "lake", "lake", "sea"]
    assert {(e.provider, e.stage) for e in result["failed"]} == {("torn", "parse"), ("void", "parse"), ("dated", "persist")}
    sync.sync_batch(store, landed(spark, ("lake", TIMES[2], DAY3)), RULES)
    check_three_days(store)
    assert dimension(store, "tours", "sea").filter("is_active").count() == 3 and table(store, "prices", "sea").filter("valid_to is null").count() == 4
    assert dimension(store, "tours", "dated").count() == 2, "a good payload follows a bad one"

    # Payloads, runs, errors, health and metrics tell the same story.
    assert {(r.provider, bytes(r.content).decode()) for r in rows(store, "payloads", sync.PAYLOADS)} == {("lake", DAY1), ("lake", DAY2), ("lake", DAY3), ("sea", DAY1), ("dated", DAY2)}
    errors = {r.provider: r for r in rows(store, "errors", sync.ERRORS)}
    assert set(errors) == {"torn", "void", "dated"} and all((r.notification_state, r.notification_attempts, r.resolved) == ("pending", 0, False) for r in errors.values())
    runs = rows(store, "runs", sync.RUNS)
    ends = {r.run_id: r for r in runs if r.event == "finish"}
    assert len(runs) == 2 * len(ends) == 16 and sorted(r.status for r in ends.values()) == ["failed"] * 3 + ["success"] * 5
    assert sum(r.status == "down" for r in rows(store, "health", sync.HEALTH)) == 3
    first = next(r for r in ends.values() if r.provider == "lake" and str(r.at) == TIMES[0])
    labels = {r.label: r.n for r in rows(store, "metrics", sync.METRICS) if r.run_id == first.run_id}
    assert labels == {
        "objects_upserted": 4, "stages_upserted": 2, "classes_upserted": 3, "rooms_upserted": 3, "tours_upserted": 3, "prices_created": 4, "prices_updated": 0, "prices_closed": 0,
        "sales_created": 1, "sales_updated": 0, "sales_closed": 0, "availability_created": 3, "availability_updated": 0, "availability_closed": 0, "deactivated": 0,
        "prices_repeated": 1, "sales_repeated": 0, "rejected": 3}
    assert (first.rows_written, first.rows_read) == (23, 23)
    second = next(r for r in ends.values() if r.provider == "lake" and str(r.at) == TIMES[1])
    labels = {r.label: r.n for r in rows(store, "metrics", sync.METRICS) if r.run_id == second.run_id}
    assert (labels["prices_created"], labels["prices_updated"], labels["prices_closed"], labels["availability_updated"], labels["availability_closed"], labels["deactivated"]) == (2, 2, 2, 2, 2, 4)
    assert second.rows_read - second.rows_written == 2 + 0 + 4

    # What was left out, and why.
    assert sorted((r.section, r.value, r.reason) for r in rows(store, "rejects", sync.REJECTS) if r.run_id == first.run_id) == [("classes", "", "short id"), ("classes", "77", "short id"), ("prices", "12,5", "no number")]

    # Seen before: skipped, and no table changes.
    before = store.pointer("lake")["tables"]
    again = sync.sync_batch(store, batch.filter("provider = 'lake'"), RULES)
    assert [o for _, o in again["done"]] == [None, None]
    after = store.pointer("lake")["tables"]
    assert all(before[n] == after[n] for n in before if n not in ("runs", "health"))
    assert sum(r.status == "skipped" for r in rows(store, "runs", sync.RUNS)) == 2
    with pytest.raises(Conflict):
        store.commit(store.pointer("lake", back=1))


def state(store, provider):
    """All tables of a provider as sets of rows."""
    return {
        **{n: sorted(map(repr, table(store, n, provider).collect())) for n in sync.HISTORIES}, **{n: sorted(map(repr, dimension(store, n, provider).filter(f"provider = '{provider}'").collect())) for n in sync.DIMENSIONS}}


def test_snapshots_in_any_order(spark, tmp_path):
    """Late payloads give the tables of the right order, and providers' payloads of a round go together."""
    days = {1: DAY1, 2: DAY2.replace('<cruise id="spring"><cabin id="H-1"/></cruise>', ""), 3: DAY3}  # day 2 lists no room
    orders = {"right": (1, 2, 3), "mixed": (3, 1, 2)}
    store = StateStore(spark, f"file://{tmp_path}/s")
    for step in range(3):
        result = sync.sync_batch(store, landed(spark, *[(p, TIMES[o[step] - 1], days[o[step]]) for p, o in orders.items()]), {p: RULES["lake"] for p in orders})
        assert len(result["done"]) == len(orders) and not result["failed"]
    want = {n: [r.replace("'right'", "'x'") for r in v] for n, v in state(store, "right").items()}
    assert all(want.values())
    for p in orders:
        check_figures(store, p)
        assert {n: [r.replace(f"'{p}'", "'x'") for r in v] for n, v in state(store, p).items()} == want, p
        for name in sync.HISTORIES:
            assert scd2.scd2_check(table(store, name, p), ["provider", *sync._names(sync.HISTORIES[name][0])]).isEmpty()


def test_streams_of_two_providers_at_once(spark, tmp_path):
    """Neither waits for the other nor loses a snapshot; two publishers of one provider try again until both are in."""
    store = StateStore(spark, f"file://{tmp_path}/s")
    work = [("lake", TIMES[0], DAY1), ("sea", TIMES[0], DAY1), ("lake", TIMES[1], DAY2), ("sea", TIMES[1], DAY2)]
    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(lambda w: sync.sync_batch(store, landed(spark, w), RULES), work))
    assert all(len(r["done"]) == 1 and not r["failed"] for r in results)
    assert rows(store, "errors", sync.ERRORS) == []
    for p in ("lake", "sea"):
        assert {str(r.observed_at) for r in rows(store, "ledger", sync.LEDGER) if r.provider == p} == set(TIMES[:2])
    lake, sea = ({n: [r.replace(f"'{p}'", "'x'") for r in v] for n, v in state(store, p).items() if n != "tours"} for p in ("lake", "sea"))
    assert lake == sea and len(lake["prices"]) == 6 and sum("valid_to=None" in r for r in lake["prices"]) == 2


def test_payloads_of_one_instant(spark, tmp_path):
    store = StateStore(spark, f"file://{tmp_path}/s")
    for day in (DAY1, DAY2):
        sync.sync_batch(store, landed(spark, ("lake", TIMES[0], day)))
    assert sorted(str(r.at) for r in rows(store, "ledger", sync.LEDGER)) == [TIMES[0], TIMES[0] + ".000001"]
    for name in sync.HISTORIES:
        assert scd2.scd2_check(table(store, name), ["provider", *sync._names(sync.HISTORIES[name][0])]).isEmpty()


def test_closed_parts_are_compacted(spark, tmp_path):
    store = StateStore(spark, f"file://{tmp_path}/s")
    schema = spark.createDataFrame([], "n int").schema
    for k in range(5):
        store.append("a/b", {"log": spark.createDataFrame([(k,)], schema)})
    assert not store.compact("log", schema, "a/b", fan_in=9) and store.compact("log", schema, "a/b", fan_in=5)
    assert store.providers() == ["a/b"] and len(store.pointer("a/b")["tables"]["log"]["closed"]) == 1 and sorted(r.n for r in store.read("log", schema).collect()) == list(range(5))


def test_one_payload_landed_twice_is_one(spark):
    batch = landed(spark, ("lake", TIMES[1], DAY1), ("lake", TIMES[0], DAY1), ("lake", TIMES[0], DAY1), ("sea", TIMES[0], DAY1))
    fresh = feed.drop_seen(batch, spark.createDataFrame([], sync.LEDGER)).collect()
    assert sorted((r.provider, str(r.observed_at), bytes(r.content).decode() == DAY1) for r in fresh) == [("lake", TIMES[0], True), ("sea", TIMES[0], True)]


def test_stream_goes_on_after_a_bad_file(spark, tmp_path):
    store, inbox = StateStore(spark, f"file://{tmp_path}/s"), tmp_path / "in"
    inbox.mkdir()
    for name, text in (("a.xml", DAY1), ("b.xml", "<root><ships>"), ("c.xml", DAY2)):
        (inbox / name).write_text(text)
        query = sync.sync_stream(store, str(inbox), "lake", f"{tmp_path}/cp", RULES)
        query.awaitTermination(120)
        assert query.exception() is None
    assert {r.external_cruise_id: r.is_active for r in dimension(store, "tours").collect()} == {"spring": True, "summer": True, "autumn": False}
    assert [(r.stage, r.severity) for r in rows(store, "errors", sync.ERRORS)] == [("parse", "error")]


def test_rates_over_a_stream(spark, sf_dir, tmp_path):
    source = spark.read.parquet(f"{sf_dir}/events.parquet")
    source.write.parquet(f"{tmp_path}/in")
    rows = spark.readStream.schema(source.schema).parquet(f"{tmp_path}/in")
    query = sync.windowed_stream(rows, "ts", 60, ["event_type"]).writeStream.format("memory").queryName("rates").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert abs(spark.table("rates").selectExpr("sum(rate) * 3600 as n").first().n - source.count()) < 1e-6
