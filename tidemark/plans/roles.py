"""The driver's tables in the roles of this library's tables.

Each role is one SELECT that Spark and DuckDB read alike, so a query and its
oracle start from the same rows. Roles span whole tables; where a history
and a snapshot must differ, dates and prices tell them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = "region nation customer supplier part orders lineitem events documents".split()

_LINE = """'1' as provider, cast(l_orderkey as string) as cruise_id, l_linestatus as class_id, l_returnflag = 'R' as partial_buyout,
    cast(%s as decimal(12,2)) as base_price, case when l_tax > 0 then cast(100 * l_tax as decimal(12,2)) end as child_price,
    case when l_discount > 0.02 then cast(100 * l_discount as decimal(12,2)) end as extra_seat, 'RUB' as currency"""
_ORDER = "l_linenumber, l_partkey, l_suppkey"

ROLES = {
    "tours": """select '1' as provider, cast(o_orderkey as string) as cruise_id, cast(o_custkey as string) as object_id, cast(o_orderdate as date) as begin_date,
        cast(o_orderdate as date) as end_date, o_orderstatus as city, o_totalprice >= 50000 as active, o_totalprice from orders""",
    "objects": "select '1' as provider, cast(c_custkey as string) as object_id, c_name as name, c_mktsegment <> 'MACHINERY' as is_active from customer",
    "classes": "select '1' as provider, cast(p_partkey as string) as class_id, p_name as name, p_size as base_seats from part",
    "stages": "select '1' as provider, cast(n_nationkey as string) as stage_id, n_name as name from nation",
    "rooms": "select '1' as provider, cast(s_suppkey as string) as room_id, s_name as number, cast(s_suppkey as string) as class_id, cast(s_nationkey as string) as stage_id from supplier",
    # Open versions of the read side: of each part of an order the first line.
    "prices": """select '1' as provider, cast(l_orderkey as string) as cruise_id, cast(l_partkey as string) as class_id, l_returnflag = 'R' as partial_buyout,
        min(cast(l_extendedprice as decimal(12,2))) as base_price, min(cast(100 * l_tax as decimal(12,2))) as child_price, min(cast(100 * l_discount as decimal(12,2))) as extra_seat, 'RUB' as currency
        from lineitem group by l_orderkey, l_partkey, l_returnflag = 'R'""",
    "sales": "select '1' as provider, cast(l_orderkey as string) as cruise_id, cast(l_suppkey as string) as room_id, cast(cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) as decimal(12,2)) as base_price from lineitem where l_discount >= 0.05",
    "availability": "select '1' as provider, cast(l_orderkey as string) as cruise_id, cast(l_suppkey as string) as room_id, max(l_linestatus) = 'O' as available from lineitem group by l_orderkey, l_suppkey",
    # Two snapshots that overlap: known before mid 2000, and seen since mid 1996 with dearer taxed lines.
    "snapshot_old": f"select {_LINE % 'l_extendedprice'}, {_ORDER} from lineitem where l_shipdate < cast('2000-07-01' as timestamp)",
    "snapshot_new": f"select {_LINE % 'case when l_tax >= 0.05 then l_extendedprice + 1 else l_extendedprice end'}, {_ORDER} from lineitem where l_shipdate >= cast('1996-07-01' as timestamp)",
    "sales_old": f"select {_LINE % 'l_extendedprice'}, cast(l_suppkey as string) as room_id, {_ORDER} from lineitem where l_discount >= 0.05 and l_shipdate < cast('2000-07-01' as timestamp)",
    "sales_new": f"select {_LINE % 'case when l_tax >= 0.05 then l_extendedprice + 1 else l_extendedprice end'}, cast(l_suppkey as string) as room_id, {_ORDER} from lineitem where l_discount >= 0.05 and l_shipdate >= cast('1996-07-01' as timestamp)",
    "rooms_old": "select '1' as provider, cast(l_orderkey as string) as cruise_id, cast(l_suppkey as string) as room_id, max(l_linestatus) = 'O' as available from lineitem where l_shipdate < cast('2000-07-01' as timestamp) group by l_orderkey, l_suppkey",
    "rooms_new": "select '1' as provider, cast(l_orderkey as string) as cruise_id, cast(l_suppkey as string) as room_id from lineitem where l_shipdate >= cast('1996-07-01' as timestamp)",
    "runs": """select event_id as id, cast(user_id % 5 as string) as provider, event_type as phase, case event_type when 'error' then 'failed' when 'view' then 'skipped' when 'signup' then 'running' else 'success' end as status,
        ts as started_at, case when event_type <> 'signup' then ts end as finished_at, case when event_type = 'purchase' then event_id end as raw_snapshot_id, value as duration, cast(case when value > 50 then props end as string) as error_message from events""",
    "errors": """select event_id as id, ts as occurred_at, cast(user_id % 5 as string) as provider, case user_id % 5 when 0 then 'fetch' when 1 then 'dedup' when 2 then 'parse' when 3 then 'enrich' else 'persist' end as stage,
        case when value > 80 then 'critical' else 'error' end as severity, 'x' || repeat('é', cast(user_id % 50 as int)) || props as message, value < 5 as resolved,
        case when event_id % 4 = 2 then ts end as notified_at, case event_id % 4 when 0 then 'pending' when 1 then 'claimed' when 2 then 'sent' else 'dead' end as notification_state,
        case when event_id % 4 = 1 then ts end as notification_claimed_at, cast(event_id % 7 as int) as notification_attempts from events""",
    "snapshots": "select doc_id as id, source as provider, text as payload, lang from documents",
    "metrics": "select ts, event_type as phase, cast(user_id % 5 as string) as provider, value as duration, case event_type when 'error' then 'failed' when 'view' then 'skipped' else 'success' end as status from events",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that one task groups.
PART_ROWS = 100_000


def parts(rows: DataFrame) -> int:
    """Tasks over which a table is dealt: more for more rows, so that no task's share grows with it."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // PART_ROWS)


#: Roles with many rows for an order, and the columns of their keys, the order first, then what they may be joined by.
DEALT = {"prices": ("l_orderkey", "l_partkey"), "sales": ("l_orderkey", "l_suppkey"), "availability": ("l_orderkey", "l_suppkey")}


def role(spark: SparkSession, sf_dir: str, name: str, by_order: bool = True) -> DataFrame:
    """The rows of a role; views are replaced by tables of ``sf_dir`` inside the text only.

    Lines are dealt by order, as the text that ids are, before a role groups them. Groups are then whole in a task, and what is grouped or joined by cruise
    next stays where it is. Without ``by_order`` the same holds of the other key: what is joined by class or room next stays.
    """
    base = next(t for t in TABLES if f" from {t}" in " ".join(ROLES[name].split()))
    rows = table(spark, sf_dir, base)
    if name in DEALT:
        keys = DEALT[name]
        rows = rows.withColumns({k: F.col(k).cast("string") for k in keys}).repartition(parts(rows), keys[0 if by_order else 1])
    return role_of(spark, name, base, rows)


def role_of(spark: SparkSession, name: str, base: str, rows: DataFrame) -> DataFrame:
    """The role with ``rows``, a stream too, in place of its table ``base``."""
    return spark.sql(ROLES[name].replace(f"from {base}", "from " + "{base}"), base=rows)


def with_roles(names: str, query: str) -> str:
    """Oracle text: the roles as common table expressions, then ``query``."""
    ctes = "with " + ", ".join(f"{n} as ({ROLES[n]})" for n in names.split())
    return ctes + ("" if query.startswith(",") else " ") + query
