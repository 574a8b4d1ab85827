"""Tests on built tables: each returns how many rows violate it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.plans.facts import GRAINS
from obsmart.plans.marts import (
    CORRELATIONS,
    INDEX_VERDICTS,
    PLAN_VERDICTS,
    RPO_STATUSES,
    SLO_STATUSES,
)

Tables = Callable[[str], DataFrame]


def not_null(column: str) -> Column:
    return F.col(column).isNull()


def accepted(column: str, values: list[str]) -> Column:
    """NULL is the business of ``not_null``."""
    return F.col(column).isNotNull() & ~F.col(column).isin(values)


def non_negative(column: str) -> Column:
    return F.col(column) < 0


def row_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """All row-level rules of a table in one pass: (rule, violations)."""
    counted = df.agg(*[F.count_if(violated).alias(rule) for rule, violated in rules.items()])
    pairs = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"`{rule}`").alias("violations")) for rule in rules])
    return counted.select(F.inline(pairs))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(f"unique({', '.join(keys)})").alias("rule"), "violations"
    )


def relationship(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent. Keys are reduced to distinct values first."""
    orphans = child.select(key).distinct().join(parent.select(key).distinct(), key, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(f"relationship({key})").alias("rule"), "violations"
    )


# Which columns of each table may not be NULL.
NOT_NULL = {
    "stg_query_snapshot": ["instance_id", "query_id", "dt", "captured_at", "calls"],
    "fct_query_daily": ["instance_id", "query_id", "dt", "delta_calls", "delta_total_time_ms"],
    "mart_query_regression": ["instance_id", "query_id", "latency_increase_ms"],
    "fct_query_hourly": ["instance_id", "query_id", "dt", "hour"],
    "fct_size_daily": ["instance_id", "object_name", "dt"],
    "mart_capacity_forecast": ["instance_id", "risk_flag"],
    "fct_wait_event_daily": ["instance_id", "event_name", "dt"],
    "fct_backup_daily": ["instance_id", "dt"],
    "fct_plan_change_daily": ["instance_id", "dt"],
    "mart_wait_top": ["instance_id", "event_name"],
    "mart_plan_regression": ["instance_id", "query_id", "verdict"],
    "mart_backup_rpo": ["instance_id", "as_of_dt", "rpo_status"],
    "mart_weekly_ops_report": ["week_start", "instance_id"],
    "fct_config_change_daily": ["instance_id", "dt"],
    "mart_config_change": ["instance_id", "change_kind"],
    "int_change_events": ["instance_id", "change_source"],
    "mart_config_impact": ["instance_id", "change_source", "correlation"],
    "fct_uptime_daily": ["instance_id", "dt"],
    "mart_uptime_slo": ["instance_id", "slo_status"],
    "dim_instance": ["instance_id", "engine"],
    "fct_index_daily": ["instance_id", "index_name", "dt", "delta_scans"],
    "mart_index_verdict": ["instance_id", "index_name", "verdict"],
}
ACCEPTED = {
    "mart_plan_regression": ("verdict", PLAN_VERDICTS),
    "mart_backup_rpo": ("rpo_status", RPO_STATUSES),
    "mart_config_impact": ("correlation", CORRELATIONS),
    "mart_uptime_slo": ("slo_status", SLO_STATUSES),
    "mart_index_verdict": ("verdict", INDEX_VERDICTS),
}
NON_NEGATIVE = {
    "fct_query_daily": ["delta_calls", "delta_total_time_ms"],
    "fct_query_hourly": ["delta_calls", "delta_total_time_ms"],
}
UNIQUE = {
    "dim_instance": ["instance_id"],
    "mart_uptime_slo": ["instance_id"],
    "stg_query_snapshot": ["instance_id", "query_id", "dt", "captured_at"],
    "fct_query_daily": GRAINS["fct_query_daily"],
}
PARENTS = {"fct_query_daily": ("stg_query_snapshot", "instance_id")}


def table_rules(name: str) -> dict[str, Column]:
    rules = {f"not_null({c})": not_null(c) for c in NOT_NULL.get(name, [])}
    if name in ACCEPTED:
        column, values = ACCEPTED[name]
        rules[f"accepted({column})"] = accepted(column, values)
    rules.update({f"non_negative({c})": non_negative(c) for c in NON_NEGATIVE.get(name, [])})
    return rules


def key_tests(tables: Tables, name: str) -> list[DataFrame]:
    """Uniqueness and relationships of a table: what no single row can tell."""
    parts = [unique(tables(name), UNIQUE[name])] if name in UNIQUE else []
    if name in PARENTS:
        parent, key = PARENTS[name]
        parts.append(relationship(tables(name), tables(parent), key))
    return parts


def named_tests(parts: dict[str, list[DataFrame]]) -> DataFrame | None:
    results = None
    for name, found in parts.items():
        for part in found:
            part = part.select(F.lit(name).alias("table_name"), "rule", "violations")
            results = part if results is None else results.unionByName(part)
    return results


def run_tests(tables: Tables, names: list[str]) -> DataFrame:
    """(table_name, rule, violations) for every declared test of the tables."""
    parts = {}
    for name in names:
        rows = [row_rules(tables(name), table_rules(name))] if table_rules(name) else []
        parts[name] = rows + key_tests(tables, name)
    return named_tests(parts)


class TestsFailed(RuntimeError):
    """A built table violates at least one of its tests."""

    __test__ = False  # not a test class


def _refuse(results: DataFrame | None) -> None:
    failed = [] if results is None else results.where("violations > 0").collect()  # at most one row per rule
    if failed:
        raise TestsFailed("; ".join(f"{r['table_name']} {r['rule']}: {r['violations']}" for r in failed))


def require_clean(tables: Tables, names: list[str]) -> None:
    """Fail closed: raise when any declared test finds a violating row."""
    _refuse(run_tests(tables, names))


def require_keys(tables: Tables, names: list[str]) -> None:
    """The same for uniqueness and relationships alone, where the rules on single
    rows were counted while the tables were written."""
    _refuse(named_tests({n: key_tests(tables, n) for n in names}))
