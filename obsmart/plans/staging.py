"""Staging relations: typed, pruned views of the landed raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _project(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).cast("date").alias(c) if c == "dt" else F.col(c) for c in columns])


def stg_query_snapshot(raw: DataFrame) -> DataFrame:
    """One row per (instance, query, poll): a fingerprint that is reported as
    several interleaved series is summed into one.

    The poll time is part of the key, so however much of the table one query
    makes up, its polls spread over all tasks and repeated polls are combined
    before they are shuffled.
    """
    return (
        raw.withColumn("dt", F.col("dt").cast("date"))
        .groupBy("instance_id", "query_id", "dt", "captured_at")
        .agg(
            F.sum("calls").alias("calls"),
            F.sum("total_time_ms").alias("total_time_ms"),
            F.sum("rows_examined").alias("rows_examined"),
            F.max("query_text").alias("query_text"),
        )
    )


def stg_backup_run(raw: DataFrame) -> DataFrame:
    return _project(
        raw, "id", "instance_id", "started_at", "dt", "status", "backup_type", "duration_ms",
        "verify_status", "verified_at", "remote_location",
    )


def stg_plan_snapshot(raw: DataFrame) -> DataFrame:
    return _project(raw, "id", "instance_id", "query_id", "plan_hash", "captured_at", "dt")


def stg_wait_event(raw: DataFrame) -> DataFrame:
    return _project(raw, "id", "instance_id", "captured_at", "dt", "event_name", "category", "wait_count", "total_ms")


def stg_size_snapshot(raw: DataFrame) -> DataFrame:
    return _project(
        raw, "id", "instance_id", "captured_at", "dt", "object_type", "object_name", "row_estimate",
        "data_bytes", "index_bytes", "volume_total_bytes", "volume_available_bytes", "max_bytes",
    ).withColumn("total_bytes", F.col("data_bytes") + F.col("index_bytes"))


def stg_index_usage_snapshot(raw: DataFrame) -> DataFrame:
    return _project(
        raw, "id", "instance_id", "captured_at", "dt", "table_name", "index_name", "scan_count",
        "size_bytes", "is_unique",
    )


def stg_config_snapshot(raw: DataFrame) -> DataFrame:
    return _project(raw, "id", "instance_id", "captured_at", "dt", "param_hash", "change_count", "baseline")


def stg_config_param_change(raw: DataFrame) -> DataFrame:
    return _project(
        raw, "id", "snapshot_id", "instance_id", "captured_at", "dt", "param_name", "old_value",
        "new_value", "change_kind",
    )


def stg_dim_instance(raw: DataFrame) -> DataFrame:
    return _project(raw, "id", "name", "type", "team_label", "dt")


def stg_health_sample(raw: DataFrame) -> DataFrame:
    return _project(raw, "id", "instance_id", "sampled_at", "dt", "up", "ping_millis")


# staging relation -> (builder, raw table)
STAGING = {
    "stg_query_snapshot": (stg_query_snapshot, "query_snapshot"),
    "stg_backup_run": (stg_backup_run, "backup_run"),
    "stg_plan_snapshot": (stg_plan_snapshot, "plan_snapshot"),
    "stg_wait_event": (stg_wait_event, "wait_event_snapshot"),
    "stg_size_snapshot": (stg_size_snapshot, "size_snapshot"),
    "stg_index_usage_snapshot": (stg_index_usage_snapshot, "index_usage_snapshot"),
    "stg_config_snapshot": (stg_config_snapshot, "config_snapshot"),
    "stg_config_param_change": (stg_config_param_change, "config_param_change"),
    "stg_dim_instance": (stg_dim_instance, "dim_instance"),
    "stg_health_sample": (stg_health_sample, "health_sample"),
}
