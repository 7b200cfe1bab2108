"""Pages of a published list are those of the whole list."""

from tidemark.operators import catalogue
from tidemark.plans.roles import role
from tidemark.sources.pages import Pages, publish


def test_pages_follow_each_other(spark, sf_dir, tmp_path):
    items = role(spark, sf_dir, "tours").filter("active").select("begin_date", "cruise_id", "object_id")
    publish(items, f"{tmp_path}/list", 16)
    pages, want = Pages(spark, f"{tmp_path}/list"), sorted((r.begin_date.isoformat(), r.cruise_id.encode()) for r in items.collect())
    assert 8 <= len(pages.files) <= 16
    cursor, got = None, []
    for _ in range(12):
        rows, cursor = pages.page(cursor, 100)
        got += [(r.begin_date.isoformat(), r.cruise_id.encode()) for r in rows]
    assert got == want[:1200]
    # Pages that reach into further files, past the end, and of a cursor that is no row.
    for at in (len(want) - 150, len(want) - 5, *[want.index(x) - 3 for x in pages.lasts[:3]]):
        cursor = (want[at][0], want[at][1].decode())
        rows, after = pages.page(cursor, 100)
        assert [(r.begin_date.isoformat(), r.cruise_id.encode()) for r in rows] == want[at + 1:at + 101] and (after is None) == (at + 101 >= len(want))
        plain = catalogue.keyset_page(items, cursor, 100).collect()[:100]
        assert [tuple(r) for r in rows] == [tuple(r) for r in plain]
    assert pages.page(("2031-01-01", "0"), 20) == ([], None)
    assert len(pages.page(("1998-03-01", "no id"), 20)[0]) == 20


def test_empty_list(spark, tmp_path):
    publish(spark.createDataFrame([], "begin_date date, cruise_id string"), f"{tmp_path}/list", 4)
    assert Pages(spark, f"{tmp_path}/list").page(None, 10) == ([], None)
