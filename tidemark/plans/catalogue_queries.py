"""Queries of the read side."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import content_tag, decode_cursor, encode_cursor
from tidemark.operators import catalogue as c
from tidemark.plans.registry import query
from tidemark.plans.roles import parts, role, table, with_roles

MIN = "select provider, cruise_id, min(base_price) as minimal_price from (select provider, cruise_id, base_price from prices union all select provider, cruise_id, base_price from sales) group by provider, cruise_id"
COUNTS = "select provider, cruise_id, cast(count(*) as int) as room_counts from availability where available group by provider, cruise_id"
ITEMS = f"""select t.provider, t.cruise_id, t.object_id, t.begin_date, t.city, o.name as ship_name, m.minimal_price, cast(coalesce(r.room_counts, 0) as int) as room_counts
    from tours t left join objects o on o.provider = t.provider and o.object_id = t.object_id
    left join ({MIN}) m on m.provider = t.provider and m.cruise_id = t.cruise_id left join ({COUNTS}) r on r.provider = t.provider and r.cruise_id = t.cruise_id where t.active"""
LIST_ROLES = "tours objects prices sales availability"
LIST_COLUMNS = ["provider", "cruise_id", "object_id", "begin_date", "city", "ship_name", "minimal_price", "room_counts"]


def _items(spark, sf_dir, **filters):
    r = lambda n: role(spark, sf_dir, n)
    return c.catalogue(r("tours"), r("objects"), r("prices"), r("sales"), r("availability"), **filters).select(*LIST_COLUMNS)


@query("list_cruises", with_roles(LIST_ROLES, ITEMS + " and t.begin_date >= date '1998-01-01'"))
def list_cruises(spark, sf_dir):
    return _items(spark, sf_dir, date_from="1998-01-01")


@query("list_filters", with_roles(LIST_ROLES, ITEMS + " and t.begin_date >= date '1997-01-01' and t.begin_date <= date '1999-12-31' and t.city = 'F'"))
def list_filters(spark, sf_dir):
    return _items(spark, sf_dir, date_from="1997-01-01", date_to="1999-12-31", city="F")


@query("list_join", with_roles("tours objects", "select t.cruise_id, o.name as ship_name from tours t left join objects o on o.provider = t.provider and o.object_id = t.object_id"))
def list_join(spark, sf_dir):
    objects = role(spark, sf_dir, "objects").select("provider", "object_id", F.col("name").alias("ship_name"))
    return role(spark, sf_dir, "tours").join(objects, ["provider", "object_id"], "left").select("cruise_id", "ship_name")


@query("min_price", with_roles("prices sales", MIN))
def min_price(spark, sf_dir):
    return c.min_prices(role(spark, sf_dir, "prices"), role(spark, sf_dir, "sales"))


@query("room_counts", with_roles("availability", COUNTS))
def room_counts(spark, sf_dir):
    return c.room_counts(role(spark, sf_dir, "availability"))


@query("tours_view", with_roles("tours prices sales availability", f"""select t.provider, t.cruise_id, t.object_id, t.begin_date, t.active, m.minimal_price, cast(coalesce(r.room_counts, 0) as int) as room_counts from tours t
    left join ({MIN}) m on m.provider = t.provider and m.cruise_id = t.cruise_id left join ({COUNTS}) r on r.provider = t.provider and r.cruise_id = t.cruise_id"""))
def tours_view(spark, sf_dir):
    r = lambda n: role(spark, sf_dir, n)
    return c.tours_view(r("tours"), r("prices"), r("sales"), r("availability")).select("provider", "cruise_id", "object_id", "begin_date", "active", "minimal_price", "room_counts")


def _page(name, cursor, limit):
    after = f" and (t.begin_date, t.cruise_id) > (date '{cursor[0]}', '{cursor[1]}')" if cursor else ""
    sql = with_roles("tours", f"select t.begin_date, t.cruise_id, t.object_id from tours t where t.active{after} order by t.begin_date, t.cruise_id limit {limit + 1}")

    @query(name, sql)
    def page(spark, sf_dir):
        return c.keyset_page(role(spark, sf_dir, "tours").filter("active"), cursor, limit).select("begin_date", "cruise_id", "object_id")


# A page is a top-k report: its limit is the feature.
_page("keyset_first", None, 20)
_page("keyset_next", ("1998-03-01", "500"), 100)
_page("keyset_past_end", ("2031-01-01", "0"), 20)


@query("page_index", with_roles("tours", """, placed as (select provider, begin_date, cruise_id, cast((row_number() over (partition by provider order by begin_date, cruise_id) - 1) // 100 as bigint) as page from tours),
    last as (select provider, page, begin_date, cruise_id, count(*) over (partition by provider, page) as rows, row_number() over (partition by provider, page order by begin_date desc, cruise_id desc) as back, max(page) over (partition by provider) as top from placed)
    select provider, page, rows, case when page < top then lower(hex(encode(strftime(begin_date, '%Y-%m-%d') || '|' || cruise_id))) end as next_cursor from last where back = 1"""))
def page_index(spark, sf_dir):
    return c.page_index(role(spark, sf_dir, "tours"), 100)


@query("cursor_encode", with_roles("tours", "select cruise_id, lower(hex(encode(strftime(begin_date, '%Y-%m-%d') || '|' || cruise_id))) as page_cursor from tours"))
def cursor_encode(spark, sf_dir):
    return role(spark, sf_dir, "tours").select("cruise_id", encode_cursor(F.col("begin_date"), F.col("cruise_id")).alias("page_cursor"))


# Cursors that are whole or broken in one of five ways, in turn by ship; a broken date and no id at once is no id.
BROKEN = ("", "hex", "utf8", "shape", "empty_id", "date", "", "empty_id")
DECODED = " ".join(f"when {k} then {f'null' if not e else repr(e)}" for k, e in enumerate(BROKEN))


@query("cursor_decode", with_roles("tours", f"""select cruise_id, case when error is null then begin_date end as begin_date_out, case when error is null then cruise_id || '|x' end as id_out, error
    from (select *, case cast(object_id as bigint) % 8 {DECODED} end as error from tours)"""))
def cursor_decode(spark, sf_dir):
    date, kind = F.date_format("begin_date", "yyyy-MM-dd"), F.col("object_id").cast("long") % 8
    coded = lambda text: F.lower(F.hex(F.encode(text, "UTF-8")))
    whole = coded(F.concat(date, F.lit("|"), F.col("cruise_id"), F.lit("|x")))
    text = (
        F.when(kind == 1, F.concat(whole, F.lit("0g"))).when(kind == 2, F.concat(whole, F.lit("c328"))).when(kind == 3, coded(date)).when(kind == 4, coded(F.concat(date, F.lit("|"))))
        .when(kind == 5, coded(F.concat(F.lit("2031-02-30|"), F.col("cruise_id")))).when(kind == 7, coded(F.lit("no date|"))).otherwise(whole))
    d = role(spark, sf_dir, "tours").select("cruise_id", decode_cursor(text).alias("d"))
    return d.select("cruise_id", F.col("d.begin_date").alias("begin_date_out"), F.col("d.cruise_id").alias("id_out"), "d.error")


ITEM_JSON = """'{"cruise_id":"' || cruise_id || '","begin_date":"' || strftime(begin_date, '%Y-%m-%d') || '","ship_name":"' || ship_name || '","minimal_price":' || coalesce('"' || cast(minimal_price as string) || '"', 'null') || ',"room_counts":' || room_counts || '}'"""


def _json(spark, sf_dir):
    item = F.struct("cruise_id", F.date_format("begin_date", "yyyy-MM-dd").alias("begin_date"), "ship_name", F.col("minimal_price").cast("string").alias("minimal_price"), "room_counts")
    return _items(spark, sf_dir).select("cruise_id", c.page_json(item).alias("body"))


@query("list_json", with_roles(LIST_ROLES, f", items as ({ITEMS}) select cruise_id, {ITEM_JSON} as body from items"))
def list_json(spark, sf_dir):
    return _json(spark, sf_dir)


@query("content_tag", with_roles(LIST_ROLES, f""", items as ({ITEMS}) select cruise_id, '"' || substr(sha256({ITEM_JSON}), 1, 16) || '"' as tag from items"""))
def content_tags(spark, sf_dir):
    return _json(spark, sf_dir).select("cruise_id", content_tag(F.col("body")).alias("tag"))


def _priced(spark, sf_dir, n=None):
    classes = role(spark, sf_dir, "classes")
    return c.class_prices(role(spark, sf_dir, "prices", by_order=not c.hashed(classes)), classes, n)


@query("class_prices", with_roles("prices classes", """select p.cruise_id, p.class_id, p.partial_buyout, p.base_price, coalesce(k.name, '') as class_name, k.base_seats from prices p
    left join classes k on k.provider = p.provider and k.class_id = p.class_id"""))
def class_prices(spark, sf_dir):
    return _priced(spark, sf_dir).select("cruise_id", "class_id", "partial_buyout", "base_price", "class_name", "base_seats")


ROOMS = """select a.provider, a.cruise_id, a.room_id, a.available, r.number, r.class_id, k.name as class_name, s.name as stage_name from availability a join rooms r on r.provider = a.provider and r.room_id = a.room_id
    left join classes k on k.provider = a.provider and k.class_id = r.class_id left join stages s on s.provider = a.provider and s.stage_id = r.stage_id"""


def _rooms(spark, sf_dir, n=None):
    r = lambda n: role(spark, sf_dir, n)
    rooms = r("rooms")
    return c.detail_rooms(rooms, role(spark, sf_dir, "availability", by_order=not c.hashed_rooms(rooms)), r("classes"), r("stages"), n)


@query("detail_rooms", with_roles("availability rooms classes stages", ROOMS))
def detail_rooms(spark, sf_dir):
    return _rooms(spark, sf_dir).select("provider", "cruise_id", "room_id", "available", "number", "class_id", "class_name", "stage_name")


def _detail(spark, sf_dir):
    r = lambda n: role(spark, sf_dir, n)
    n = parts(table(spark, sf_dir, "lineitem"))
    return c.detail(r("tours"), r("objects"), _priced(spark, sf_dir, n), _rooms(spark, sf_dir, n))


DETAIL = f""", priced as (select p.cruise_id, string_agg(cast(p.base_price as string) || '/' || p.partial_buyout || '/' || p.class_id || '/' || coalesce(k.name, ''), ';' order by p.base_price, p.partial_buyout, p.class_id) as prices
        from prices p left join classes k on k.class_id = p.class_id group by p.cruise_id),
    roomed as (select a.cruise_id, string_agg(a.number || '/' || a.available || '/' || coalesce(a.stage_name, '') || '/' || coalesce(q.n, 0), ';' order by a.number, a.room_id) as rooms from ({ROOMS}) a
        left join (select cruise_id, class_id, count(*) as n from prices group by cruise_id, class_id) q on q.cruise_id = a.cruise_id and q.class_id = a.class_id group by a.cruise_id)
    select t.cruise_id, o.name as ship_name, coalesce(p.prices, '') as prices, coalesce(r.rooms, '') as rooms from tours t left join objects o on o.object_id = t.object_id left join priced p on p.cruise_id = t.cruise_id left join roomed r on r.cruise_id = t.cruise_id"""


@query("detail", with_roles("tours objects prices classes availability rooms stages", DETAIL))
def detail(spark, sf_dir):
    """Nested details of every tour, flattened to strings for comparison."""
    text = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    return _detail(spark, sf_dir).select(
        "cruise_id", "ship_name",
        F.array_join(F.transform("prices", lambda p: F.concat_ws("/", p["base_price"].cast("string"), p["partial_buyout"].cast("string"), p["class_id"], text(p["class_name"]))), ";").alias("prices"),
        F.array_join(F.transform("rooms", lambda r: F.concat_ws("/", r["number"], r["available"].cast("string"), text(r["stage_name"]), F.size(r["prices"]).cast("string"))), ";").alias("rooms"))


def _quoted(x):
    return f"coalesce('\"' || cast({x} as varchar) || '\"', 'null')"


AMOUNTS = f"""',"base_price":' || {_quoted('p.base_price')} || ',"child_price":' || {_quoted('p.child_price')} || ',"extra_seat":' || {_quoted('p.extra_seat')} || ',"currency":"' || p.currency || '"}}'"""
DOCUMENT = f""", priced as (select p.*, '{{"class_id":"' || p.class_id || '","class_name":"' || coalesce(k.name, '') || '","partial_buyout":' || p.partial_buyout || {AMOUNTS} as full_json, '{{"partial_buyout":' || p.partial_buyout || {AMOUNTS} as own_json
        from prices p left join classes k on k.class_id = p.class_id),
    listed as (select cruise_id, string_agg(full_json, ',' order by base_price, partial_buyout, class_id) as prices from priced group by cruise_id),
    of_class as (select cruise_id, class_id, string_agg(own_json, ',' order by partial_buyout, base_price) as prices from priced group by cruise_id, class_id),
    roomed as (select a.cruise_id, string_agg('{{"room_id":"' || a.room_id || '","number":"' || a.number || '","class_name":' || {_quoted('a.class_name')} || ',"stage_name":' || {_quoted('a.stage_name')} || ',"available":' || a.available
        || ',"prices":[' || coalesce(q.prices, '') || ']}}', ',' order by a.number, a.room_id) as rooms from ({ROOMS}) a left join of_class q on q.cruise_id = a.cruise_id and q.class_id = a.class_id group by a.cruise_id)
    select t.cruise_id, '{{"cruise_id":"' || t.cruise_id || '","begin_date":"' || strftime(t.begin_date, '%Y-%m-%d') || '","end_date":"' || strftime(t.end_date, '%Y-%m-%d') || '","ship_name":' || {_quoted('o.name')}
        || ',"prices":[' || coalesce(l.prices, '') || '],"rooms":[' || coalesce(r.rooms, '') || ']}}' as body
    from tours t left join objects o on o.object_id = t.object_id left join listed l on l.cruise_id = t.cruise_id left join roomed r on r.cruise_id = t.cruise_id"""


@query("detail_json", with_roles("tours objects prices classes availability rooms stages", DOCUMENT))
def detail_json(spark, sf_dir):
    """Each detail as a whole document."""
    return _detail(spark, sf_dir).select("cruise_id", c.detail_document().alias("body"))


@query("list_pages_json", with_roles(LIST_ROLES, f""", items as ({ITEMS}), placed as (select *, (row_number() over (order by begin_date, cruise_id) - 1) // 100 as page from items),
    pages as (select page, string_agg({ITEM_JSON}, ',' order by begin_date, cruise_id) as items, arg_max(strftime(begin_date, '%Y-%m-%d') || '|' || cruise_id, (begin_date, cruise_id)) as last from placed group by page)
    select cast(page as bigint) as page, '{{"items":[' || items || ']' || case when page < (select max(page) from pages) then ',"next_cursor":"' || lower(hex(encode(last))) || '"' else '' end || '}}' as body from pages"""))
def list_pages_json(spark, sf_dir):
    """Every page of the list as a document with its cursor."""
    items = _items(spark, sf_dir).withColumn("provider", F.lit("1"))
    item = F.struct("cruise_id", F.date_format("begin_date", "yyyy-MM-dd").alias("begin_date"), "ship_name", F.col("minimal_price").cast("string").alias("minimal_price"), "room_counts")
    return c.page_documents(items, item, 100).select("page", "body")


@query("orphan_classes", "select cast(s_suppkey as string) as class_id, s_name as name from supplier where s_suppkey not in (select c_custkey from customer where c_acctbal >= 0)")
def orphan_classes(spark, sf_dir):
    from tidemark.operators.logs import orphans

    child = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("object_id"), F.col("s_suppkey").cast("string").alias("class_id"), F.col("s_name").alias("name"))
    parent = table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("object_id"))
    return orphans(child, parent, ["object_id"]).select("class_id", "name")
