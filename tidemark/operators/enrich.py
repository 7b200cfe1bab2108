"""Derived columns by data-driven rules."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import strict_bool, strict_int

CONFIG = "value string, template string, plus int"
KINDS = ("constant", "config_lookup", "template", "days_between")

#: Rows that a new installation starts with (fixed values of the data model): rules as id, provider, field, kind, config, priority, active; and cruise types.
DEFAULT_RULES = [
    (1, None, "site_name", "template", {"template": "{name} Название для сайта"}, 100, True),
    (2, None, "site_cruise_object_id", "constant", {"value": "1"}, 100, True),
    (3, None, "route", "template", {"template": "Маршрут круиза {cruise_id}"}, 100, True),
    (4, None, "city_from", "constant", {"value": "Пермь"}, 100, True),
    (5, None, "city_to", "constant", {"value": "Пермь"}, 100, True),
    (6, None, "departure_city", "constant", {"value": "Астрахань"}, 100, True),
    (7, None, "days", "days_between", {"plus": 1}, 100, True),
    (8, None, "is_return", "constant", {"value": "true"}, 100, True),
    (9, None, "is_weekend", "constant", {"value": "false"}, 100, True),
]
CRUISE_TYPES = [(1, "речной круиз")]


@dataclass(frozen=True)
class Rule:
    field: str
    kind: str
    value: str | None = None
    template: str | None = None
    plus: int | None = None


def load_rules(rules: DataFrame, provider: str) -> DataFrame:
    """Active rules of ``provider`` and global ones with their parsed config, in order of priority, then id.

    A provider's rules do not outrank global ones. Unknown kinds are left out.
    """
    return (
        rules.filter(F.col("is_active") & (F.col("provider").isNull() | (F.col("provider") == provider)) & F.col("rule_type").isin(*KINDS))
        .withColumn("config", F.from_json("rule_config", CONFIG, {"mode": "FAILFAST"})).orderBy("priority", "id")
        .select("id", "priority", "field_name", "rule_type", "config.value", "config.template", "config.plus"))


def compiled(rules: DataFrame) -> list[Rule]:
    """The ordered rules on the driver; a rules table is configuration of a few rows."""
    return [Rule(r["field_name"], r["rule_type"], r["value"], r["template"], r["plus"]) for r in rules.orderBy("priority", "id").collect()]


def template_column(template: str, values: dict[str, Column]) -> Column:
    """``{name}`` filled in one pass; unknown placeholders stay, an unclosed one is closed.

    The template is cut on the driver, so substituted text is never read again.
    """
    parts, rest = [], template
    while rest:
        before, brace, rest = rest.partition("{")
        if before:
            parts.append(F.lit(before))
        if brace:
            name, _, rest = rest.partition("}")
            parts.append(F.coalesce(values[name], F.lit("")) if name in values else F.lit("{" + name + "}"))
    return F.concat(*parts) if parts else F.lit("")


def rule_column(rule: Rule, columns: dict[str, Column], begin: Column, end: Column, config: dict[str, str]) -> Column:
    if rule.kind == "constant":
        return F.lit(rule.value).cast("string")
    if rule.kind == "config_lookup":
        return F.lit(config.get(rule.field, rule.value)).cast("string")
    if rule.kind == "template":
        return template_column(rule.template, columns) if rule.template is not None else F.lit(None).cast("string")
    return (F.datediff(end, begin) + F.lit(rule.plus or 0)).cast("string")


def enrich(tours: DataFrame, rules: list[Rule], config: dict[str, str] | None = None, name: str = "name", cruise_id: str = "cruise_id",
           begin: str = "begin_date", end: str = "end_date") -> DataFrame:
    """``tours`` with a text column for each field: the first rule in order that gives a value.

    A rule that gives null leaves the field to the next. No join: rules become expressions.
    """
    columns, fields = {"name": F.col(name), "cruise_id": F.col(cruise_id)}, {}
    for r in rules:
        fields.setdefault(r.field, []).append(rule_column(r, columns, F.col(begin), F.col(end), config or {}))
    return tours.withColumns({f: F.coalesce(*c) if len(c) > 1 else c[0] for f, c in fields.items()})


def rules_by_provider(rules: DataFrame, providers: DataFrame) -> DataFrame:
    """provider and ``rules``: each provider's active rules and the global ones, by priority, then id; a small table."""
    items = rules.filter(F.col("is_active") & F.col("rule_type").isin(*KINDS)).withColumn("c", F.from_json("rule_config", CONFIG, {"mode": "FAILFAST"})).select(
        "provider", F.struct("priority", "id", "field_name", "rule_type", "c.value", "c.template", "c.plus").alias("rule"))
    own = items.filter("provider is not null").groupBy("provider").agg(F.collect_list("rule").alias("own"))
    # One row of global rules; the constant key makes each provider meet it.
    shared = items.filter("provider is null").agg(F.collect_list("rule").alias("shared")).withColumn("_all", F.lit(True))
    names = providers.select("provider").distinct().withColumn("_all", F.lit(True))
    return names.join(F.broadcast(shared), "_all").join(own, "provider", "left").select(
        "provider", F.sort_array(F.concat(F.coalesce("own", F.slice("shared", 1, 0)), "shared")).alias("rules"))


def filled(template: Column, values: dict[str, Column]) -> Column:
    """``template_column`` for a template that is a column itself."""
    parts = F.regexp_extract_all(template, F.lit(r"\{[^}]*\}?|[^{]+"), F.lit(0))
    name = lambda p: F.regexp_replace(p, r"^\{|\}$", "")

    def part(p: Column) -> Column:
        found = F.concat(F.lit("{"), name(p), F.lit("}"))
        for k, v in values.items():
            found = F.when(name(p) == k, F.coalesce(v, F.lit(""))).otherwise(found)
        return F.when(p.startswith("{"), found).otherwise(p)

    return F.array_join(F.transform(parts, part), "")


def enrich_by_table(tours: DataFrame, rules: DataFrame, fields: list[str], config: DataFrame | None = None, name: str = "name", cruise_id: str = "cruise_id",
                    begin: str = "begin_date", end: str = "end_date") -> DataFrame:
    """``tours`` of many providers with a text column for each of ``fields``: the first value, not null, of their provider's ``rules_by_provider``.

    Rules stay rows: one join by provider, and each tour works off its provider's list, so neither plan nor jobs grow with
    rules or providers. ``config`` (provider, field, value) holds looked-up values. A provider without rules has nulls.
    """
    rules = F.broadcast(rules) if rules.count() <= 10_000 else rules
    both = tours.join(rules.withColumnRenamed("rules", "_rules"), "provider", "left")
    if config is not None:
        known = config.groupBy("provider", "field").agg(F.max("value").alias("value")).groupBy("provider").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("_config"))
        both = both.join(F.broadcast(known) if known.count() <= 10_000 else known, "provider", "left")
    else:
        both = both.withColumn("_config", F.lit(None).cast("map<string,string>"))
    value = lambda r: (
        F.when(r["rule_type"] == "constant", r["value"])
        .when(r["rule_type"] == "config_lookup", F.when(F.map_contains_key("_config", r["field_name"]), F.col("_config")[r["field_name"]]).otherwise(r["value"]))
        .when(r["rule_type"] == "template", filled(r["template"], {"name": F.col(name), "cruise_id": F.col(cruise_id)}))
        .otherwise((F.datediff(F.col(end), F.col(begin)) + F.coalesce(r["plus"], F.lit(0))).cast("string")))
    made = F.filter(F.transform("_rules", lambda r: F.struct(r["field_name"].alias("field"), value(r).alias("value"))), lambda x: x["value"].isNotNull())
    both = both.withColumn("_made", made)
    first = lambda f: F.get(F.filter("_made", lambda x: x["field"] == f), F.lit(0))["value"]
    return both.withColumns({f: first(f) for f in fields}).drop("_rules", "_config", "_made")


def typed(enriched: DataFrame) -> DataFrame:
    """days as int, is_return and is_weekend as booleans; any other spelling is null."""
    have = set(enriched.columns)
    casts = {"days": strict_int, "is_return": strict_bool, "is_weekend": strict_bool}
    return enriched.withColumns({c: f(F.col(c)) for c, f in casts.items() if c in have})


def attach(tours: DataFrame, enrichment: DataFrame, keys: list[str]) -> DataFrame:
    """Tours with their enrichment, nulls where there is none."""
    return typed(tours.join(enrichment, keys, "left"))


def rules_frame(spark, rows: list[tuple]) -> DataFrame:
    """Rules table from (id, provider, field_name, rule_type, config dict, priority, is_active)."""
    return spark.createDataFrame(
        [(i, p, f, t, json.dumps(c), pr, a) for i, p, f, t, c, pr, a in rows],
        "id long, provider string, field_name string, rule_type string, rule_config string, priority int, is_active boolean")
