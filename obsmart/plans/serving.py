"""Dashboard queries over the published tables.

Each takes tables by name and, where a dashboard offers it, one instance.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.functions import rounded

Tables = Callable[[str], DataFrame]

RECENT_RUNS = 30
QUERY_ID_CHARS = 20
QUERY_TEXT_CHARS = 60


def _for_instance(df: DataFrame, instance_id: int | None) -> DataFrame:
    return df if instance_id is None else df.where(F.col("instance_id") == instance_id)


def _short_id() -> Column:
    return F.substring("query_id", 1, QUERY_ID_CHARS).alias("query_id")


def regression_ranking(tables: Tables, instance_id: int | None = None) -> DataFrame:
    squeezed = F.regexp_replace("query_text", r"\s+", " ")
    return (
        _for_instance(tables("mart_query_regression"), instance_id)
        .orderBy(F.desc("latency_increase_ms"), "instance_id", "query_id")
        .select(
            "instance_id", _short_id(), "recent_from_dt", "recent_to_dt",
            rounded(F.col("prior_latency_ms"), 2).alias("prior_avg_latency_ms"),
            rounded(F.col("recent_latency_ms"), 2).alias("recent_avg_latency_ms"),
            rounded(F.col("latency_increase_ms"), 2).alias("increase_ms"),
            F.col("latency_increase_pct").alias("increase_pct"),
            "recent_delta_calls",
            F.substring(squeezed, 1, QUERY_TEXT_CHARS).alias("query"),
        )
    )


def daily_trend(tables: Tables, instance_id: int | None = None) -> DataFrame:
    return (
        _for_instance(tables("fct_query_daily"), instance_id)
        .groupBy("dt")
        .agg(F.sum("delta_calls").alias("calls"), rounded(F.sum("delta_total_time_ms"), 0).alias("total_time_ms"))
        .orderBy("dt")
    )


def regressed_count(tables: Tables, instance_id: int | None = None) -> DataFrame:
    return _for_instance(tables("mart_query_regression"), instance_id).agg(
        F.count(F.lit(1)).alias("regressed_queries")
    )


def last_successful_day(tables: Tables) -> DataFrame:
    return tables("pipeline_run_log").where("gate_status <> 'FAIL'").agg(F.max("dt").alias("last_success_dt"))


def latest_gate(tables: Tables) -> DataFrame:
    return (
        tables("pipeline_run_log")
        .orderBy(F.desc("run_at"))
        .limit(1)
        .select("dt", "gate_status", "gate_reconciliation", "gate_completeness", "gate_freshness",
                "gate_schema_drift", "run_at")
    )


def recent_runs(tables: Tables) -> DataFrame:
    return (
        tables("pipeline_run_log")
        .orderBy(F.desc("run_at"))
        .limit(RECENT_RUNS)
        .select("dt", "run_at", "gate_status", rounded(F.col("duration_sec"), 1).alias("duration_sec"),
                "offload_rows", "published_rows")
    )


def weekly_report(tables: Tables) -> DataFrame:
    return (
        tables("mart_weekly_ops_report")
        .select(
            "instance_id", "instance_name", "engine",
            F.col("capacity_worst_risk").alias("capacity_risk"),
            F.col("min_days_to_threshold").alias("d_day"),
            F.col("top_wait_event").alias("top_wait"),
            F.col("plan_flips_this_week").alias("plan_flips"),
            F.col("plan_regressed_this_week").alias("plan_regressed"),
            "backup_gap_days", "backup_status",
            F.col("this_week_uptime_pct").alias("uptime_pct"),
        )
        .orderBy("instance_id")
    )


def uptime_slo(tables: Tables) -> DataFrame:
    return (
        tables("mart_uptime_slo")
        .select(
            "instance_id", "instance_name", "engine", "days_observed", "window_uptime_pct",
            "worst_day_uptime_pct", rounded(F.col("avg_ping_ms"), 1).alias("avg_ping_ms"), "target_pct",
            "error_budget_remaining_pct", "slo_status",
        )
        .orderBy("window_uptime_pct", "instance_id")
    )


def backup_gaps(tables: Tables) -> DataFrame:
    return (
        tables("mart_backup_rpo")
        .where("rpo_status <> 'ok'")
        .orderBy(F.desc("no_successful_backup"), F.desc_nulls_last("gap_days"), "instance_id")
        .select("instance_id", "as_of_dt", "last_success_dt", "gap_days", "max_gap_days", "rpo_status")
    )


def plan_regressions(tables: Tables) -> DataFrame:
    return (
        tables("mart_plan_regression")
        .orderBy((F.col("verdict") == "REGRESSED").desc(), F.desc_nulls_last("latency_ratio"),
                 "instance_id", "query_id", "flip_dt")
        .select(
            "instance_id", _short_id(), "flip_dt", "prev_plan_hash", "new_plan_hash", "before_avg_ms",
            "after_avg_ms", "latency_ratio", "after_calls", "verdict",
        )
    )


def config_timeline(tables: Tables) -> DataFrame:
    return (
        tables("mart_config_change")
        .orderBy(F.desc("captured_at"), "instance_id", "param_name")
        .select("instance_id", F.col("dt").alias("change_dt"), "param_name", "old_value", "new_value", "change_kind")
    )


def config_impact(tables: Tables) -> DataFrame:
    return (
        tables("mart_config_impact")
        .orderBy(F.desc("regressed_after"), F.desc("plan_flips_after"), F.desc_nulls_last("latency_ratio"),
                 F.desc("change_dt"), "instance_id", "change_key")
        .select(
            "instance_id", "change_dt", "change_source", "change_key", "new_value", "plan_flips_after",
            "before_latency_ms", "after_latency_ms", "latency_ratio", "correlation",
        )
    )


def config_daily(tables: Tables) -> DataFrame:
    return (
        tables("fct_config_change_daily")
        .select("instance_id", "dt", "cycles_collected", "change_events", "params_changed")
        .orderBy(F.desc("change_events"), "instance_id", "dt")
    )


SERVING = {
    "serve_regression_ranking": regression_ranking,
    "serve_daily_trend": daily_trend,
    "serve_regressed_count": regressed_count,
    "serve_last_successful_day": last_successful_day,
    "serve_latest_gate": latest_gate,
    "serve_recent_runs": recent_runs,
    "serve_weekly_report": weekly_report,
    "serve_uptime_slo": uptime_slo,
    "serve_backup_gaps": backup_gaps,
    "serve_plan_regressions": plan_regressions,
    "serve_config_timeline": config_timeline,
    "serve_config_impact": config_impact,
    "serve_config_daily": config_daily,
}
