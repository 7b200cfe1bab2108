"""Queries of merges, soft deletes and versioned history."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import ts
from tidemark.operators import scd1, scd2
from tidemark.plans.registry import query
from tidemark.plans.roles import role, table, with_roles

OLD, NOW = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
ORDER = ["l_linenumber", "l_partkey", "l_suppkey"]
PRICE_KEYS, PRICE_VALUES = ["cruise_id", "class_id", "partial_buyout"], ["base_price", "child_price", "extra_seat", "currency"]
SALE_KEYS, SALE_VALUES = ["cruise_id", "class_id", "room_id", "partial_buyout"], ["base_price", "currency"]


# Dimensions: rows known before, and rows of a new snapshot in which some are missing, some new, some renamed.
DIMENSIONS = {
    "objects": ("customer", "c_custkey", ["name"], "c_name as name", "concat(c_name, '*')", "c_acctbal > 0", "c_acctbal < 8000", "c_mktsegment <> 'MACHINERY'"),
    "stages": ("nation", "n_nationkey", ["name"], "n_name as name", "concat(n_name, '*')", "n_regionkey > 0", "n_regionkey < 4", "n_regionkey <> 2"),
    "classes": ("part", "p_partkey", ["name", "base_seats", "brand"], "p_name as name, p_size as base_seats, p_brand as brand", "concat(p_name, '*')", "p_retailprice > 920", "p_size < 40", "p_type <> 'ECONOMY'"),
    "rooms": ("supplier", "s_suppkey", ["name", "nation"], "s_name as name, s_nationkey as nation", "concat(s_name, '*')", "s_acctbal > 1000", "s_acctbal < 8000", "s_nationkey > 2"),
    "tours": ("orders", "o_orderkey", ["name", "city", "days"], "o_orderpriority as name, o_orderstatus as city, case when o_totalprice > 100000 then 7 end as days", "concat(o_orderpriority, '*')", "o_totalprice > 50000", "o_totalprice < 400000", "o_orderstatus <> 'P'"),
}


def _sides(kind):
    base, key, attrs, columns, renamed, before, after, active = DIMENSIONS[kind]
    first = columns.partition(" as name")[0]
    now = columns.replace(f"{first} as name", f"case when {active} then {first} else {renamed} end as name", 1)
    if kind == "tours":  # enrichment that is gone leaves nulls
        now = now.replace("case when o_totalprice > 100000 then 7 end", "case when o_totalprice > 200000 then 7 end")
    if kind == "classes":
        now = now.replace("p_size as base_seats", "case when p_size > 5 then p_size end as base_seats")
    current = f"select '1' as provider, {key} as id, {columns}, {active} as is_active, cast('{OLD}' as timestamp_ntz) as created_at, cast('{OLD}' as timestamp_ntz) as updated_at from {base} where {before}"
    return base, attrs, current, f"select '1' as provider, {key} as id, {now} from {base} where {after}"


def _sql(text):
    return text.replace("timestamp_ntz", "timestamp")


def _frames(kind, spark, sf_dir):
    base, attrs, current, incoming = _sides(kind)
    df = table(spark, sf_dir, base)
    return attrs, *(spark.sql(x.replace(f" from {base}", " from " + "{t}"), t=df) for x in (current, incoming))


def _upsert(kind):
    _, attrs, current, incoming = _sides(kind)
    picked = ", ".join(f"case when i.id is not null then i.{a} else c.{a} end as {a}" for a in attrs)
    sql = f"""with c as ({_sql(current)}), i as ({_sql(incoming)}) select coalesce(c.id, i.id) as id, {picked}, case when i.id is not null then true else c.is_active end as is_active,
        coalesce(c.created_at, timestamp '{NOW}') as created_at, case when i.id is not null then timestamp '{NOW}' else c.updated_at end as updated_at,
        case when c.id is null then 'inserted' when i.id is null then 'kept' when not c.is_active then 'reactivated' else 'updated' end as action
        from c full outer join i on c.provider = i.provider and c.id = i.id"""

    @query(f"upsert_{kind}", sql)
    def upsert(spark, sf_dir):
        attrs, current, incoming = _frames(kind, spark, sf_dir)
        return scd1.merge_scd1(current, incoming, ["provider", "id"], attrs, ts(NOW)).drop("provider")

    off = "c.is_active and i.id is null"
    sql = f"""with c as ({_sql(current)}), i as ({_sql(incoming)}) select c.id, case when {off} then false else c.is_active end as is_active,
        case when {off} then timestamp '{NOW}' else c.updated_at end as updated_at, {off} as deactivated from c left join (select distinct id from i) i on c.id = i.id"""

    @query(f"deactivate_{kind}", sql)
    def deactivate(spark, sf_dir):
        _, current, incoming = _frames(kind, spark, sf_dir)
        return scd1.deactivate_missing(current, incoming, ["id"], "1", ts(NOW)).select("id", "is_active", "updated_at", "deactivated")


for _kind in DIMENSIONS:
    _upsert(_kind)

_, _, _cur, _inc = _sides("objects")


@query("reactivate", f"with c as ({_sql(_cur)}), i as ({_sql(_inc)}) select c.id from c join i on c.id = i.id where not c.is_active")
def reactivate(spark, sf_dir):
    attrs, current, incoming = _frames("objects", spark, sf_dir)
    return scd1.merge_scd1(current, incoming, ["provider", "id"], attrs, ts(NOW)).filter("action = 'reactivated'").select("id")


# Versioned prices and offers.
def _staged_sql(name, keys, values):
    return f"(select * from (select {', '.join(keys + values)}, row_number() over (partition by {', '.join(keys)} order by {', '.join(ORDER)}) as rn from {name}) where rn = 1)"


def _plan_sql(old, new, keys, values):
    on = " and ".join(f"h.{k} = i.{k}" for k in keys)
    differs = " or ".join(f"h.{v} is distinct from i.{v}" for v in values)
    return f"""p as (select {', '.join(f'coalesce(h.{k}, i.{k}) as {k}' for k in keys)}, {', '.join(f'h.{v} as old_{v}, i.{v} as new_{v}' for v in values)},
        case when h.rn is null then 'created' when i.rn is null then 'closed' when {differs} then 'updated' else 'same' end as action from {_staged_sql(old, keys, values)} h full outer join {_staged_sql(new, keys, values)} i on {on})"""


def _versions_sql(keys, values):
    k = ", ".join(keys)
    return f"""select {k}, {', '.join(f'old_{v} as {v}' for v in values)}, timestamp '{OLD}' as valid_from, case when action <> 'same' then timestamp '{NOW}' end as valid_to from p where action <> 'created'
        union all select {k}, {', '.join(f'new_{v} as {v}' for v in values)}, timestamp '{NOW}' as valid_from, cast(null as timestamp) as valid_to from p where action in ('created', 'updated')"""


PRICES = with_roles("snapshot_old snapshot_new", ", " + _plan_sql("snapshot_old", "snapshot_new", PRICE_KEYS, PRICE_VALUES))
SALES = with_roles("sales_old sales_new", ", " + _plan_sql("sales_old", "sales_new", SALE_KEYS, SALE_VALUES))


def _stage(spark, sf_dir, name, keys, values):
    return scd2.stage(role(spark, sf_dir, name).select(*keys, *values, *ORDER), keys, ORDER, [v for v in values if v != "currency"], ["partial_buyout"])


def _history(spark, sf_dir, name, keys, values):
    return _stage(spark, sf_dir, name, keys, values).withColumn("valid_from", ts(OLD)).withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))


def _prices(spark, sf_dir):
    return _history(spark, sf_dir, "snapshot_old", PRICE_KEYS, PRICE_VALUES), _stage(spark, sf_dir, "snapshot_new", PRICE_KEYS, PRICE_VALUES)


def _sales(spark, sf_dir):
    return _history(spark, sf_dir, "sales_old", SALE_KEYS, SALE_VALUES), _stage(spark, sf_dir, "sales_new", SALE_KEYS, SALE_VALUES)


def _price_plan(spark, sf_dir):
    return scd2.scd2_plan(*_prices(spark, sf_dir), PRICE_KEYS, PRICE_VALUES)


@query("scd2_stage_first_wins", with_roles("snapshot_new", f"select {', '.join(PRICE_KEYS + PRICE_VALUES)} from {_staged_sql('snapshot_new', PRICE_KEYS, PRICE_VALUES)} s"))
def stage_first_wins(spark, sf_dir):
    return _stage(spark, sf_dir, "snapshot_new", PRICE_KEYS, PRICE_VALUES)


def _part(name, action, sides):
    columns = PRICE_KEYS + [f"{s}_base_price" for s in sides]

    @query(name, f"{PRICES} select {', '.join(columns)} from p where action in ({action})")
    def part(spark, sf_dir):
        return _price_plan(spark, sf_dir).filter(f"action in ({action})").select(*PRICE_KEYS, *[F.col(f"{s}.base_price").alias(f"{s}_base_price") for s in sides])


_part("scd2_prices_changed", "'updated'", ["old", "new"])
_part("scd2_prices_closed", "'closed'", ["old"])
_part("scd2_prices_created", "'created', 'updated'", ["new"])


@query("scd2_prices", f"{PRICES} {_versions_sql(PRICE_KEYS, PRICE_VALUES)}")
def scd2_prices(spark, sf_dir):
    return scd2.scd2_apply(*_prices(spark, sf_dir), PRICE_KEYS, PRICE_VALUES, ts(NOW))


@query("scd2_sales", f"{SALES} {_versions_sql(SALE_KEYS, SALE_VALUES)}")
def scd2_sales(spark, sf_dir):
    return scd2.scd2_apply(*_sales(spark, sf_dir), SALE_KEYS, SALE_VALUES, ts(NOW))


@query("scd2_sales_empty", with_roles("sales_old", f"select {', '.join(SALE_KEYS + SALE_VALUES)}, timestamp '{OLD}' as valid_from, timestamp '{NOW}' as valid_to from {_staged_sql('sales_old', SALE_KEYS, SALE_VALUES)} s"))
def scd2_sales_empty(spark, sf_dir):
    old, new = _sales(spark, sf_dir)
    return scd2.scd2_apply(old, new.limit(0), SALE_KEYS, SALE_VALUES, ts(NOW))


ROOM_KEYS = ["cruise_id", "room_id"]
ROOMS = with_roles("rooms_old rooms_new", """, p as (select coalesce(h.cruise_id, i.cruise_id) as cruise_id, coalesce(h.room_id, i.room_id) as room_id, h.available,
    case when h.room_id is null then 'opened' when i.room_id is not null and not h.available then 'switched_on' when i.room_id is null and h.available then 'switched_off' else 'same' end as action
    from rooms_old h full outer join (select distinct cruise_id, room_id from rooms_new) i on h.cruise_id = i.cruise_id and h.room_id = i.room_id)""")
ROOM_VERSIONS = f"""select cruise_id, room_id, available, timestamp '{OLD}' as valid_from, case when action <> 'same' then timestamp '{NOW}' end as valid_to from p where action <> 'opened'
    union all select cruise_id, room_id, action <> 'switched_off' as available, timestamp '{NOW}' as valid_from, cast(null as timestamp) as valid_to from p where action <> 'same'"""


def _rooms(spark, sf_dir):
    return role(spark, sf_dir, "rooms_old").drop("provider").withColumn("valid_from", ts(OLD)), role(spark, sf_dir, "rooms_new").drop("provider")


def _room_versions(spark, sf_dir):
    return scd2.presence_versions(scd2.presence_plan(*_rooms(spark, sf_dir), ROOM_KEYS), ROOM_KEYS, ts(NOW))


@query("scd2_availability", f"{ROOMS} {ROOM_VERSIONS}")
def scd2_availability(spark, sf_dir):
    return _room_versions(spark, sf_dir)


@query("scd2_availability_empty", with_roles("rooms_old", f"select cruise_id, room_id, available, timestamp '{OLD}' as valid_from, timestamp '{NOW}' as valid_to from rooms_old"))
def scd2_availability_empty(spark, sf_dir):
    old, new = _rooms(spark, sf_dir)
    return scd2.presence_versions(scd2.presence_plan(old, new.limit(0), ROOM_KEYS, empty=True), ROOM_KEYS, ts(NOW))


@query("current_prices", f"{PRICES}, v as ({_versions_sql(PRICE_KEYS, PRICE_VALUES)}) select {', '.join(PRICE_KEYS)}, base_price from v where valid_to is null")
def current_prices(spark, sf_dir):
    return scd2.scd2_current(scd2_prices(spark, sf_dir)).select(*PRICE_KEYS, "base_price")


@query("current_sales", f"{SALES}, v as ({_versions_sql(SALE_KEYS, SALE_VALUES)}) select {', '.join(SALE_KEYS)}, base_price from v where valid_to is null")
def current_sales(spark, sf_dir):
    return scd2.scd2_current(scd2_sales(spark, sf_dir)).select(*SALE_KEYS, "base_price")


@query("current_availability", f"{ROOMS}, v as ({ROOM_VERSIONS}) select cruise_id, room_id, available from v where valid_to is null")
def current_availability(spark, sf_dir):
    return scd2.scd2_current(_room_versions(spark, sf_dir)).select(*ROOM_KEYS, "available")


@query("asof_prices", f"{PRICES}, v as ({_versions_sql(PRICE_KEYS, PRICE_VALUES)}) select {', '.join(PRICE_KEYS)}, base_price from v where valid_from <= timestamp '2024-01-15' and (valid_to is null or valid_to > timestamp '2024-01-15')")
def asof_prices(spark, sf_dir):
    return scd2.scd2_as_of(scd2_prices(spark, sf_dir), ts("2024-01-15 00:00:00")).select(*PRICE_KEYS, "base_price")


@query("price_changes", f"{PRICES} select {', '.join(PRICE_KEYS)}, old_base_price as previous, new_base_price as base_price, new_base_price - old_base_price as change from p where action = 'updated'")
def price_changes(spark, sf_dir):
    return scd2.scd2_changes(scd2_prices(spark, sf_dir), PRICE_KEYS, "base_price").select(*PRICE_KEYS, "previous", "base_price", "change")


@query("scd1_to_scd2", f"select l_orderkey, l_suppkey, l_linenumber, coalesce(case when l_linestatus = 'F' then l_shipdate end, timestamp '{NOW}') as valid_from, cast(null as timestamp) as valid_to from lineitem")
def scd1_to_scd2(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("updated_at", F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")))
    return scd2.from_scd1(rows, F.col("updated_at"), ts(NOW)).select("l_orderkey", "l_suppkey", "l_linenumber", "valid_from", "valid_to")


@query("backfill_null_key", "select l_orderkey, l_linenumber, l_partkey, coalesce(case when l_returnflag <> 'N' then l_returnflag = 'R' end, false) as partial_buyout from lineitem")
def backfill_null_key(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("partial_buyout", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "R"))
    return scd2.with_flags(rows, ["partial_buyout"]).select("l_orderkey", "l_linenumber", "l_partkey", "partial_buyout")


OUTCOME = with_roles(
    "snapshot_old snapshot_new sales_old sales_new rooms_old rooms_new",
    ", " + _plan_sql("snapshot_old", "snapshot_new", PRICE_KEYS, PRICE_VALUES) + ", " + _plan_sql("sales_old", "sales_new", SALE_KEYS, SALE_VALUES).replace("p as (", "s as (", 1)
    + ", r as (" + ROOMS.partition(", p as (")[2])
TOTALS = f"""select 'prices' as table_name, cast(c as bigint) as created, cast(u as bigint) as updated, cast(d as bigint) as closed from (select sum(case when action in ('created','updated') then 1 else 0 end) c, sum(case when action = 'updated' then 1 else 0 end) u, sum(case when action = 'closed' then 1 else 0 end) d from p)
    union all select 'sales', cast(c as bigint), cast(u as bigint), cast(d as bigint) from (select sum(case when action in ('created','updated') then 1 else 0 end) c, sum(case when action = 'updated' then 1 else 0 end) u, sum(case when action = 'closed' then 1 else 0 end) d from s)
    union all select 'availability', cast(c as bigint), cast(u as bigint), cast(d as bigint) from (select sum(case when action = 'opened' then 1 else 0 end) c, sum(case when action like 'switched%' then 1 else 0 end) u, sum(case when action = 'switched_off' then 1 else 0 end) d from r)"""


def _outcome(spark, sf_dir):
    n = lambda *a: F.count(F.when(F.col("action").isin(*a), 1)).alias
    rooms = scd2.presence_plan(*_rooms(spark, sf_dir), ROOM_KEYS).agg(
        n("opened")("created"), n("switched_on", "switched_off")("updated"), n("switched_off")("closed")).select(F.lit("availability").alias("table_name"), "created", "updated", "closed")
    return scd2.outcome(_price_plan(spark, sf_dir), "prices").unionAll(
        scd2.outcome(scd2.scd2_plan(*_sales(spark, sf_dir), SALE_KEYS, SALE_VALUES), "sales")).unionAll(rooms)


# The snapshot's dimensions: all but the customers of one segment, and classes, rooms, stages and tours as they come.
UPSERTS = {"objects": "customer where c_mktsegment <> 'MACHINERY'", "stages": "nation", "classes": "part", "rooms": "supplier", "tours": "orders where o_totalprice >= 50000"}
GONE = {"objects": "customer where c_mktsegment = 'MACHINERY'", "tours": "orders where o_totalprice < 50000"}
UPSERTED = " union all ".join(f"select '{k}_upserted' as label, count(*) as n from {v}" for k, v in UPSERTS.items())
DEACTIVATED = " + ".join(f"(select count(*) from {v})" for v in GONE.values())
LABELS = f"{UPSERTED} union all select table_name || '_created', created from o union all select table_name || '_updated', updated from o union all select table_name || '_closed', closed from o"


def _labels(spark, sf_dir):
    """label and n of all tables; objects and tours that the snapshot lacks are deactivated."""
    rows = lambda v: table(spark, sf_dir, v.split()[0]).filter(v.partition(" where ")[2] or "true")
    out = _outcome(spark, sf_dir).unpivot("table_name", ["created", "updated", "closed"], "action", "n").select(F.concat_ws("_", "table_name", "action").alias("label"), "n")
    for k, v in UPSERTS.items():
        out = out.unionAll(rows(v).agg(F.count("*").alias("n")).select(F.lit(f"{k}_upserted").alias("label"), "n"))
    gone = {"objects": ("customer", "c_custkey"), "tours": ("orders", "o_orderkey")}
    for k, (name, key) in gone.items():
        whole = table(spark, sf_dir, name).select(F.lit("1").alias("provider"), F.col(key).alias("key"), F.lit(True).alias("is_active"), ts(OLD).alias("updated_at"))
        off = scd1.deactivate_missing(whole, rows(UPSERTS[k]).select(F.col(key).alias("key")), ["key"], "1", ts(NOW))
        out = out.unionAll(off.agg(F.count_if("deactivated").alias("n")).select(F.lit("deactivated").alias("label"), "n"))
    return out


@query("sync_outcome", f"""{OUTCOME}, o as ({TOTALS}), l as ({LABELS}) select cast(sum(n) filter (label not like '%_closed') as bigint) as rows_written,
    cast(sum(n) filter (label <> 'availability_closed') as bigint) + {DEACTIVATED} as rows_read from l""")
def sync_outcome(spark, sf_dir):
    """Rows written are upserts, created and updated; rows read add closed prices and sales, and what was deactivated."""
    over = lambda keep: F.sum(F.when(keep, F.col("n")))
    closed = F.col("label").endswith("_closed")
    return _labels(spark, sf_dir).agg(over(~closed & (F.col("label") != "deactivated")).alias("rows_written"), over(F.col("label") != "availability_closed").alias("rows_read"))


@query("write_metrics", f"{OUTCOME}, o as ({TOTALS}) {LABELS} union all select 'deactivated', {DEACTIVATED}")
def write_metrics(spark, sf_dir):
    return _labels(spark, sf_dir).groupBy("label").agg(F.sum("n").alias("n"))


# Each provider keeps its own history; here a return flag is a provider.
MULTI = "select l_returnflag as provider, cast(l_orderkey as string) as cruise_id, l_linestatus as class_id, cast(%s as decimal(12,2)) as base_price, l_linenumber, l_partkey, l_suppkey from lineitem where %s"
MULTI_OLD, MULTI_NEW = MULTI % ("l_extendedprice", "l_shipdate < cast('2000-07-01' as timestamp)"), MULTI % ("case when l_tax >= 0.05 then l_extendedprice + 1 else l_extendedprice end", "l_shipdate >= cast('1996-07-01' as timestamp)")
MULTI_KEYS = ["provider", "cruise_id", "class_id"]


@query("multi_provider", f"with a as ({MULTI_OLD}), b as ({MULTI_NEW}), {_plan_sql('a', 'b', MULTI_KEYS, ['base_price'])} select provider, action, count(*) as n from p group by provider, action")
def multi_provider(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    old, new = (scd2.stage(spark.sql(x.replace("from lineitem", "from " + "{t}"), t=df), MULTI_KEYS, ORDER, ["base_price"]) for x in (MULTI_OLD, MULTI_NEW))
    return scd2.scd2_plan(old.withColumn("valid_from", ts(OLD)), new, MULTI_KEYS, ["base_price"]).groupBy("provider", "action").agg(F.count("*").alias("n"))


# Snapshots of a supplier's prices by ship year: many at once.
SNAP = """select cast(l_suppkey as string) as cruise_id, l_linestatus as class_id, date_trunc('year', l_shipdate) as observed_at, cast(floor(max(l_quantity) / 10) as bigint) as level
    from lineitem group by l_suppkey, l_linestatus, date_trunc('year', l_shipdate)"""


LEVELS = f"""s as ({SNAP}), t as (select observed_at, lead(observed_at) over (order by observed_at) as next_at from (select distinct observed_at from s)),
    h as (select s.*, t.next_at, lag(level) over w as prev, lag(t.next_at) over w as due from s join t on s.observed_at = t.observed_at window w as (partition by cruise_id, class_id order by s.observed_at)),
    r as (select *, sum(case when level is distinct from prev or due is distinct from observed_at then 1 else 0 end) over (partition by cruise_id, class_id order by observed_at) as run from h),
    v as (select cruise_id, class_id, min(level) as level, min(observed_at) as valid_from, arg_max(coalesce(next_at, timestamp '9999-01-01'), observed_at) as valid_to from r group by cruise_id, class_id, run)"""
LEVEL_KEYS = ["cruise_id", "class_id"]


def _levels(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("cruise_id"), F.col("l_linestatus").alias("class_id"), F.date_trunc("year", "l_shipdate").cast("timestamp_ntz").alias("observed_at"))
        .agg(F.floor(F.max("l_quantity") / 10).cast("long").alias("level")))


def _rebuilt(snapshots):
    times = scd2.snapshot_times(snapshots.select("observed_at").distinct().withColumn("empty", F.lit(False)))
    return scd2.scd2_rebuild(snapshots, LEVEL_KEYS, ["level"], times.drop("next_empty"))


def _endless(history):
    return history.withColumn("valid_to", F.coalesce("valid_to", ts("9999-01-01 00:00:00")))


@query("history_rebuild", f"with {LEVELS} select * from v")
def history_rebuild(spark, sf_dir):
    return _endless(_rebuilt(_levels(spark, sf_dir)))


@query("history_splice", f"with {LEVELS} select * from v")
def history_splice(spark, sf_dir):
    """The snapshot of 1998 comes last: the history is the same."""
    snapshots, late = _levels(spark, sf_dir), ts("1998-01-01 00:00:00")
    history = _rebuilt(snapshots.filter(F.col("observed_at") != late))
    return _endless(scd2.scd2_splice(history, snapshots.filter(F.col("observed_at") == late).drop("observed_at"), LEVEL_KEYS, ["level"], late, ts("1997-01-01 00:00:00"), ts("1999-01-01 00:00:00")))


@query("asof_join", f"""with {LEVELS}, q as (select l_orderkey, l_linenumber, cast(l_suppkey as string) as cruise_id, l_linestatus as class_id, l_shipdate - interval 200 day as t from lineitem)
    select q.l_orderkey, q.l_linenumber, q.cruise_id, q.class_id, q.t, v.level, v.valid_from from q left join v on v.cruise_id = q.cruise_id and v.class_id = q.class_id and v.valid_from <= q.t and q.t < v.valid_to""")
def asof_join(spark, sf_dir):
    """What held 200 days before each line was shipped; nothing before the first snapshot."""
    probes = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("cruise_id"), F.col("l_linestatus").alias("class_id"), (F.col("l_shipdate").cast("timestamp_ntz") - F.expr("interval 200 days")).alias("t"))
    return scd2.scd2_asof_join(probes, _rebuilt(_levels(spark, sf_dir)), LEVEL_KEYS, "t", ["level"]).drop("valid_to")


# Which parts of a supplier are shown in each quarter; the snapshots of 1998 came empty.
SHOWN = """with q as (select distinct cast(l_suppkey as string) as cruise_id, cast(l_partkey as string) as room_id, date_trunc('quarter', l_shipdate) as observed_at from lineitem),
    t as (select distinct observed_at, year(observed_at) = 1998 as empty from q), s as (select * from q where year(observed_at) <> 1998),
    d as (select k.cruise_id, k.room_id, t.observed_at, s.room_id is not null as here, max(s.observed_at) over w as shown, max(case when t.empty then t.observed_at end) over w as lost
        from (select distinct cruise_id, room_id from s) k cross join t left join s on s.cruise_id = k.cruise_id and s.room_id = k.room_id and s.observed_at = t.observed_at
        window w as (partition by k.cruise_id, k.room_id order by t.observed_at)),
    e as (select *, case when here then true when shown is not null and (lost is null or shown > lost) then false end as available from d),
    f as (select *, lag(available) over (partition by cruise_id, room_id order by observed_at) is distinct from available as turn from e),
    g as (select cruise_id, room_id, available, observed_at as valid_from, lead(observed_at) over (partition by cruise_id, room_id order by observed_at) as valid_to from f where turn)
    select * from g where available is not null"""


def _shown(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("cruise_id"), F.col("l_partkey").cast("string").alias("room_id"), F.date_trunc("quarter", "l_shipdate").cast("timestamp_ntz").alias("observed_at"))
    lost = F.year("observed_at") == 1998
    return rows.filter(~lost), rows.select("observed_at").distinct().withColumn("empty", lost)


@query("history_rebuild_availability", SHOWN)
def history_rebuild_availability(spark, sf_dir):
    present, times = _shown(spark, sf_dir)
    return scd2.presence_rebuild(present, ROOM_KEYS, scd2.snapshot_times(times))


@query("availability_splice", SHOWN)
def availability_splice(spark, sf_dir):
    """The second quarter of 1997 comes last, before the empty snapshots: the history is the same."""
    present, times = _shown(spark, sf_dir)
    late = ts("1997-04-01 00:00:00")
    history = scd2.presence_rebuild(present.filter(F.col("observed_at") != late), ROOM_KEYS, scd2.snapshot_times(times.filter(F.col("observed_at") != late)))
    return scd2.presence_splice(
        history, present.filter(F.col("observed_at") == late), ROOM_KEYS, late, ts("1997-01-01 00:00:00"), ts("1997-07-01 00:00:00"), F.lit(False), ts("1998-01-01 00:00:00"))
