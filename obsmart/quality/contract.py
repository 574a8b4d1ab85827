"""Output contracts: names, types, NOT NULL and checks, enforced before publishing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsmart.quality.data_tests import not_null, row_rules


class ContractBroken(RuntimeError):
    """A table does not have the promised shape or values."""


# The promised columns of the contracted tables, and value checks.
CONTRACTS = {
    "fct_query_daily": "instance_id BIGINT NOT NULL, query_id STRING NOT NULL, dt DATE NOT NULL, query_text STRING, "
    "delta_calls BIGINT NOT NULL, delta_total_time_ms DOUBLE NOT NULL, avg_latency_ms DOUBLE",
    "mart_query_regression": "instance_id BIGINT NOT NULL, query_id STRING NOT NULL, query_text STRING, "
    "recent_from_dt DATE, recent_to_dt DATE, recent_days_seen BIGINT, prior_days_seen BIGINT, "
    "prior_latency_ms DOUBLE, recent_latency_ms DOUBLE, latency_increase_ms DOUBLE NOT NULL, "
    "latency_increase_pct DOUBLE, recent_delta_calls BIGINT",
    "mart_baseline_longterm": "instance_id BIGINT NOT NULL, query_id STRING NOT NULL, dow SMALLINT NOT NULL, "
    "hour SMALLINT NOT NULL, mean_delta_calls DOUBLE, stddev_delta_calls DOUBLE, observations BIGINT, "
    "computed_at TIMESTAMP",
    "mart_plan_regression": "instance_id BIGINT NOT NULL, query_id STRING NOT NULL, flip_dt DATE NOT NULL, "
    "prev_plan_hash STRING, new_plan_hash STRING, before_avg_ms DOUBLE, after_avg_ms DOUBLE, latency_ratio DOUBLE, "
    "before_days BIGINT, after_days BIGINT, after_calls BIGINT, verdict STRING NOT NULL, computed_at TIMESTAMP",
    "mart_backup_rpo": "instance_id BIGINT NOT NULL, as_of_dt DATE NOT NULL, last_success_dt DATE, "
    "last_verified_dt DATE, gap_days BIGINT, no_successful_backup BOOLEAN NOT NULL, max_gap_days BIGINT, "
    "rpo_status STRING NOT NULL, computed_at TIMESTAMP",
}
CHECKS = {"fct_query_daily": ["delta_calls >= 0", "delta_total_time_ms >= 0"]}


def shape_problems(df: DataFrame, name: str) -> list[str]:
    """Names and types that differ from the contract; decided from the schema alone."""
    promised = {f.name: f.dataType for f in StructType.fromDDL(CONTRACTS[name])}
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"{c}: missing" for c in promised if c not in have]
    wrong += [f"{c}: not promised" for c in have if c not in promised]
    wrong += [
        f"{c}: {have[c].simpleString()} instead of {t.simpleString()}"
        for c, t in promised.items()
        if c in have and have[c] != t
    ]
    return wrong


def value_rules(name: str) -> dict[str, Column]:
    """The NOT NULL and CHECK clauses, as conditions that a row breaks."""
    rules = {f"not_null({f.name})": not_null(f.name) for f in StructType.fromDDL(CONTRACTS[name]) if not f.nullable}
    return {**rules, **{f"check({c})": ~F.expr(c) for c in CHECKS.get(name, [])}}


def value_violations(df: DataFrame, name: str) -> DataFrame:
    """(rule, violations) of the NOT NULL and CHECK clauses, in one pass."""
    return row_rules(df, value_rules(name))


def require_shape(df: DataFrame, name: str) -> None:
    """Refuse other names or types than promised; no row is read."""
    wrong = shape_problems(df, name)
    if wrong:
        raise ContractBroken(f"{name}: {'; '.join(wrong)}")


def enforce(df: DataFrame, name: str) -> None:
    require_shape(df, name)
    broken = value_violations(df, name).where("violations > 0").collect()  # at most one row per rule
    if broken:
        raise ContractBroken(f"{name}: " + "; ".join(f"{r['rule']} violated {r['violations']} times" for r in broken))


def enforce_all(tables: Callable[[str], DataFrame]) -> None:
    for name in CONTRACTS:
        enforce(tables(name), name)
