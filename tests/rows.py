"""Tiny input frames for the model tests."""

from __future__ import annotations

from datetime import date, datetime

from obsmart.sources.local import local_frame

STG = {
    "query": "instance_id BIGINT, query_id STRING, dt DATE, captured_at TIMESTAMP_NTZ, calls BIGINT, "
    "total_time_ms DOUBLE, rows_examined BIGINT, query_text STRING",
    "daily": "instance_id BIGINT, query_id STRING, dt DATE, query_text STRING, delta_calls BIGINT, "
    "delta_total_time_ms DOUBLE, avg_latency_ms DOUBLE",
    "size": "instance_id BIGINT, object_type STRING, object_name STRING, dt DATE, total_bytes BIGINT, "
    "volume_total_bytes BIGINT, max_bytes BIGINT",
    "plan": "id BIGINT, instance_id BIGINT, query_id STRING, plan_hash STRING, captured_at TIMESTAMP_NTZ, dt DATE",
    "backup": "instance_id BIGINT, dt DATE, success_runs BIGINT, verified_runs BIGINT",
    "index": "id BIGINT, instance_id BIGINT, captured_at TIMESTAMP_NTZ, dt DATE, table_name STRING, "
    "index_name STRING, scan_count BIGINT, size_bytes BIGINT, is_unique BOOLEAN",
    "index_daily": "instance_id BIGINT, table_name STRING, index_name STRING, dt DATE, delta_scans BIGINT, "
    "size_bytes BIGINT, is_unique BOOLEAN",
    "health": "id BIGINT, instance_id BIGINT, sampled_at TIMESTAMP_NTZ, dt DATE, up BOOLEAN, ping_millis BIGINT",
    "uptime": "instance_id BIGINT, dt DATE, samples BIGINT, up_samples BIGINT, down_samples BIGINT, "
    "uptime_pct DOUBLE, avg_ping_ms DOUBLE, p95_ping_ms DOUBLE",
    "wait": "id BIGINT, instance_id BIGINT, captured_at TIMESTAMP_NTZ, dt DATE, event_name STRING, category STRING, "
    "wait_count BIGINT, total_ms DOUBLE",
    "change": "instance_id BIGINT, change_dt DATE, change_source STRING, change_key STRING, change_kind STRING, "
    "old_value STRING, new_value STRING",
    "verdict": "instance_id BIGINT, query_id STRING, flip_dt DATE, verdict STRING",
    "dim": "instance_id BIGINT, instance_name STRING, engine STRING, team_label STRING",
    "capacity_thresholds": "instance_id BIGINT, threshold_bytes BIGINT, threshold_kind STRING",
    "plan_regression_thresholds": "instance_id BIGINT, regress_ratio DOUBLE, min_after_calls BIGINT",
    "uptime_slo_targets": "instance_id BIGINT, target_pct DOUBLE",
    "backup_rpo_thresholds": "instance_id BIGINT, max_gap_days BIGINT",
}


def d(text: str) -> date:
    return date.fromisoformat(f"2026-{text}")


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"2026-{text}")


def frame(spark, kind: str, *rows):
    return local_frame(spark, rows, STG[kind])


def poll(instance, query, when, calls, time_ms, text="t"):
    moment = at(when)
    return (instance, query, moment.date(), moment, calls, float(time_ms), 0, text)


def result(df, *columns, key=None):
    """Rows as dicts, by ``key`` when given."""
    rows = [r.asDict() for r in df.select(*columns).collect()] if columns else [r.asDict() for r in df.collect()]
    return {r[key]: r for r in rows} if key else rows


def daily_contract_rows():
    return [(1, "q", d("01-01"), "t", 5, 10.0, 2.0), (1, "q", d("01-02"), None, 0, 0.0, None)]
