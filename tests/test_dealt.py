"""Lines are sent once, to more tasks for more rows, and every way to join gives the same rows."""

import re

import pytest

from tidemark.operators import catalogue
from tidemark.plans import catalogue_queries, roles


def exchanges(df, capsys):
    df.explain()
    return re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, (\d+)\), (\w+)", capsys.readouterr().out)


def test_minimal_prices_need_no_second_exchange(spark, sf_dir, capsys, monkeypatch):
    monkeypatch.setattr(roles, "PART_ROWS", 1000)
    n = str(roles.table(spark, sf_dir, "lineitem").count() // 1000)
    assert exchanges(catalogue_queries.min_price(spark, sf_dir), capsys) == [("l_orderkey", n, "REPARTITION_BY_NUM")] * 2


@pytest.mark.parametrize("name", ["detail", "detail_json"])
def test_details_send_lines_once_for_prices_and_once_for_rooms(spark, sf_dir, capsys, name):
    sent = exchanges(getattr(catalogue_queries, name)(spark, sf_dir), capsys)
    assert sorted((key, why) for key, _, why in sent) == [("cruise_id", "ENSURE_REQUIREMENTS"), *[("l_orderkey", "REPARTITION_BY_NUM")] * 2]
    assert len({n for _, n, _ in sent}) == 1


@pytest.mark.parametrize("name", ["detail", "detail_json", "class_prices", "detail_rooms"])
def test_large_dimensions_give_the_same_rows(spark, sf_dir, capsys, monkeypatch, name):
    query = getattr(catalogue_queries, name)
    small = query(spark, sf_dir)
    monkeypatch.setattr(catalogue, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(catalogue, "HASHED_ROWS", 0)
    large = query(spark, sf_dir)
    large.explain()
    assert "ShuffledHashJoin" in capsys.readouterr().out
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))


SENT = {
    "class_prices": ([("l_orderkey", "REPARTITION_BY_NUM")], [("l_partkey", "REPARTITION_BY_NUM"), ("class_id", "ENSURE_REQUIREMENTS")]),
    "detail_rooms": ([("l_orderkey", "REPARTITION_BY_NUM")], [("l_suppkey", "REPARTITION_BY_NUM"), ("room_id", "ENSURE_REQUIREMENTS")]),
    "detail_json": (
        [*[("l_orderkey", "REPARTITION_BY_NUM")] * 2, ("cruise_id", "ENSURE_REQUIREMENTS")],
        [*[(k, "REPARTITION_BY_NUM") for k in ("l_partkey", "l_suppkey", "cruise_id", "cruise_id")], *[(k, "ENSURE_REQUIREMENTS") for k in ("class_id", "room_id", "object_id", "object_id", "cruise_id")]]),
}
SENT["detail"] = SENT["detail_json"]


@pytest.mark.parametrize("name", sorted(SENT))
def test_lines_are_sent_alike_whatever_the_size_check_says(spark, sf_dir, capsys, monkeypatch, name):
    """Lines are sent once for each role, or once by class or room and once by cruise, but not by order first; no gathered list is sent."""
    query, key = getattr(catalogue_queries, name), "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(key)
    try:
        for threshold in (kept, "-1"):
            spark.conf.set(key, threshold)
            few, many = SENT[name]
            for want, most in ((few, 500_000), (many, 0)):
                monkeypatch.setattr(catalogue, "BROADCAST_ROWS", most)
                monkeypatch.setattr(catalogue, "HASHED_ROWS", most)
                # What names rooms is as small as rooms and left to the size check.
                sent = [(k, why) for k, _, why in exchanges(query(spark, sf_dir), capsys) if k != "stage_id"]
                named = [("class_id", "ENSURE_REQUIREMENTS")] * 2 if threshold == "-1" and name != "class_prices" else []
                assert sorted(sent) == sorted([*want, *named]), (threshold, most)
    finally:
        spark.conf.set(key, kept)
