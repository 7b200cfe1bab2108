"""A document read by many tasks gives the rows of one parsed as a whole."""

import pytest
from pyspark.sql import functions as F

from test_sync import DAY1, DAY2, DAY3, RULES, TIMES, check_three_days
from tidemark.functions.columns import ts
from tidemark.sources import feed
from tidemark.sources.store import StateStore
from tidemark.streaming import sync


@pytest.fixture
def small_blocks(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    spark.conf.set(keys[0], "700b")
    spark.conf.set(keys[1], "1b")
    yield
    for k in keys:
        spark.conf.unset(k)


def both(spark, path, text):
    path.write_text(text)
    whole = feed.shred(feed.parse(spark.createDataFrame([("p", text.encode())], "provider string, content binary").select("provider", ts("2031-01-01 00:00:00").alias("observed_at"), "content")))
    return whole, feed.typed_records(feed.records_of_file(spark, str(path), "p", ts("2031-01-01 00:00:00")))


MORE = """<?xml version="1.0" encoding="UTF-8"?>
<!-- a note --><!DOCTYPE root>
<root note="a > b"><ships><ship id="1" name="x &lt; y &gt; z"/><ship id='2' name='"quoted" > /'></ship>
<ship name="no id"/><other id="9"/></ships>
 text between <prices/><cruises>
<cruise id="in cruises"><cabin id="no room"/></cruise></cruises><free><cruise id="a"><cabin id="1"/><!-- here --><cabin id="2"></cabin></cruise><cruise id="b"/><cruise id="c"></cruise></free>
<junk><deep><deeper><ships><ship id="no ship"/></ships></deeper></deep></junk><classes><class id="ключ-1" name="Люкс" m_count=" 3 "/></classes></root>
"""


@pytest.mark.parametrize("text", [DAY1, DAY2, DAY3, MORE, "<root/>"])
def test_same_records(spark, tmp_path, small_blocks, text):
    whole, split = both(spark, tmp_path / "a.xml", text)
    for name in whole:
        a, b = ([tuple(r) for r in x[name].orderBy("ordinal").drop("ordinal").collect()] for x in (whole, split))
        assert a == b, name


def test_every_block_is_a_task_and_order_holds(spark, tmp_path, small_blocks):
    rows = "".join(f'<price cruise_id="c{k}" class_id="k" price="{k}"/>' for k in range(600))
    text = f"<root><ships><ship id='1'/></ships><prices>{rows}</prices><free>" + "".join(f'<cruise id="c{k}"><cabin id="x{k}"/><cabin id="y{k}"/></cruise>' for k in range(100)) + "</free></root>"
    whole, split = both(spark, tmp_path / "a.xml", text)
    assert [r.cruise_id for r in split["prices"].orderBy("ordinal").collect()] == [f"c{k}" for k in range(600)]
    assert [(r.cruise_id, r.cabin_id) for r in split["free"].orderBy("ordinal").collect()] == [(f"c{k}", f"{x}{k}") for k in range(100) for x in "xy"]
    assert split["prices"].select(F.col("ordinal.block")).distinct().count() > 20


@pytest.mark.parametrize("text", [
    "<root><ships><ship id='1'/></ships>", "<root><ships><ship id='1'></ships></ship></root>", "<root><ships></decks></root>", "<root></root></root>", "<root/><root/>", "<root><ships><ship id=1/></ships></root>",
    "<root><ships><ship id='1' id='2'/></ships></root>", "<root><x><a></b></x></root>", "<root><!-- <ship/> --></root>", "<root><ships><ship id='1'/></ships></rood>", "", "no tags at all", "<root><ships><ship id='1</ships></root>"])
def test_malformed_documents_fail(spark, tmp_path, small_blocks, text):
    (tmp_path / "a.xml").write_text(text)
    with pytest.raises(Exception):  # noqa: B017
        found = feed.records_of_file(spark, str(tmp_path / "a.xml"), "p", ts("2031-01-01 00:00:00"))
        [df.collect() for df in found.values()]


def test_write_path_splits_large_payloads(spark, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr(sync, "LARGE_BYTES", 1)
    store, inbox = StateStore(spark, f"file://{tmp_path}/s"), tmp_path / "in"
    inbox.mkdir()
    for k, day in enumerate((DAY1, DAY2, DAY3)):
        (inbox / f"{k}.xml").write_text(day if k != 1 else day.replace("<decks>", "<!-- <decks/> --><decks>"))  # day 2 can be parsed as a whole only
    landed = feed.land(spark, str(inbox), "lake")
    for k, at in enumerate(TIMES):
        result = sync.sync_batch(store, landed.filter(F.col("path").endswith(f"/{k}.xml")).withColumn("observed_at", ts(at)), RULES)
        assert len(result["done"]) == 1 and not result["failed"]
    check_three_days(store)


def tree_of(spark, *texts):
    payloads = spark.createDataFrame([("p", t.encode()) for t in texts], "provider string, content binary")
    return feed.parse(payloads.select("provider", ts("2031-01-01 00:00:00").alias("observed_at"), "content"))


ODD = """<root><prices><price cruise_id="a" class_id="k" price="1"/><price cruise_id="a" class_id="k" price="n/a"/><price class_id="k" price="x"/><price cruise_id="a" class_id="k"/></prices>
<spos><spo cruise_id="a" class_id="k" cabin_id="1" spo="2"/><spo cruise_id="a" class_id="k" cabin_id="1" spo=""/></spos><free><cruise><cabin id="1"/></cruise><cruise id="a"/><cruise id="a"><cabin/><cabin id="2"/></cruise></free></root>"""


@pytest.mark.parametrize("texts", [(DAY1, DAY2, DAY3), (MORE, ODD), ("<root/>",), ()])
def test_counts_are_those_of_the_records(spark, texts):
    tree = tree_of(spark, *texts)
    sets = feed.shred(tree)
    rejects = {r["section"]: r["n"] for r in sets.pop("rejects").groupBy("section").agg(F.count("*").alias("n")).collect()}
    assert {r["section"]: (r["n"], r["rejected"]) for r in feed.record_counts(tree).collect()} == {s: (df.count(), rejects.get(s, 0)) for s, df in sets.items()}


def test_documents_are_parsed_once_for_all_counts(spark, sf_dir, capsys):
    from tidemark.plans.feed_queries import xml_shred

    xml_shred(spark, sf_dir).explain()
    plan = capsys.readouterr().out
    assert plan.count("/lineitem.parquet") == 2, "one read for prices, offers and rejects, one for free cabins"
