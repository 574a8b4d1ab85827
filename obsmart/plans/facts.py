"""The instance dimension, the change stream and the daily/hourly facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsmart.functions import pct, ratio, tenths
from obsmart.operators.counters import (
    endpoints,
    label_per_key,
    merge_endpoints,
    per_poll,
    reset_safe_delta,
    with_hour,
)
from obsmart.operators.ranking import latest_per_key
from obsmart.operators.windows import interpolated_percentile, rank_ranges

QUERY_DAY = ["instance_id", "query_id", "dt"]
QUERY_HOUR = [*QUERY_DAY, "hour"]
QUERY_COUNTERS = ["calls", "total_time_ms"]


def dim_instance(registry: DataFrame) -> DataFrame:
    """Newest registry snapshot of every instance ever registered."""
    newest = latest_per_key(registry, ["id"], ["dt"], ["name", "type", "team_label"])
    return newest.select(
        F.col("id").alias("instance_id"), F.col("name").alias("instance_name"), F.col("type").alias("engine"),
        "team_label",
    )


def int_change_events(changes: DataFrame) -> DataFrame:
    """Every change in one shape; configuration is the only source so far."""
    return changes.select(
        "instance_id",
        F.col("dt").alias("change_dt"),
        F.lit("config").alias("change_source"),
        F.col("param_name").alias("change_key"),
        "change_kind",
        "old_value",
        "new_value",
    )


def _query_deltas(ends: DataFrame, *keys: str) -> DataFrame:
    calls, spent = reset_safe_delta("calls"), reset_safe_delta("total_time_ms")
    return ends.select(
        *keys,
        calls.alias("delta_calls"),
        spent.alias("delta_total_time_ms"),
        ratio(spent, calls).alias("avg_latency_ms"),
    )


def fct_query_hourly(snapshots: DataFrame) -> DataFrame:
    """Per query and hour; an hour with a single poll shows no calls."""
    return _query_deltas(endpoints(with_hour(snapshots), QUERY_HOUR, "captured_at", QUERY_COUNTERS), *QUERY_HOUR)


def fct_query_daily(snapshots: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Per query and day: calls, time and mean latency.

    ``texts`` may be the raw table: the statement text is looked up apart from
    the counters, so it is never shuffled once per poll.
    """
    ends = endpoints(snapshots, QUERY_DAY, "captured_at", QUERY_COUNTERS)
    text = label_per_key(snapshots if texts is None else texts, QUERY_DAY, "query_text")
    return _query_deltas(ends, *QUERY_DAY).join(text, QUERY_DAY, "left").select(
        *QUERY_DAY, "query_text", "delta_calls", "delta_total_time_ms", "avg_latency_ms"
    )


def fct_size_daily(sizes: DataFrame) -> DataFrame:
    """Last size observation of the day per object."""
    keys = ["instance_id", "object_type", "object_name", "dt"]
    return latest_per_key(
        sizes, keys, ["captured_at", "id"],
        ["row_estimate", "data_bytes", "index_bytes", "total_bytes", "volume_total_bytes",
         "volume_available_bytes", "max_bytes"],
    )


def fct_wait_event_daily(waits: DataFrame) -> DataFrame:
    """Per wait event and day: what accumulated, and the last state (some engines
    report totals, others the state of the moment)."""
    day = ["instance_id", "event_name", "dt"]
    counters = ["wait_count", "total_ms"]
    polls = per_poll(waits, day, "captured_at", counters)
    daily = merge_endpoints(polls, day, counters, F.count(F.lit(1)).alias("observations"))
    return daily.join(label_per_key(waits, day, "category"), day, "left").select(
        "instance_id", "event_name", "category", "dt", "observations",
        reset_safe_delta("wait_count").alias("delta_count"),
        reset_safe_delta("total_ms").alias("delta_ms"),
        F.col("last_wait_count").alias("last_count"),
        F.col("last_total_ms").alias("last_ms"),
    )


def fct_backup_daily(runs: DataFrame) -> DataFrame:
    return runs.groupBy("instance_id", "dt").agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(F.col("status") == "SUCCESS").alias("success_runs"),
        F.count_if(F.col("status") == "FAILED").alias("failed_runs"),
        F.count_if(F.col("backup_type") == "LOG").alias("log_runs"),
        F.count_if(F.col("verify_status") == "VERIFIED").alias("verified_runs"),
        F.count_if(F.col("remote_location").isNotNull()).alias("offsite_runs"),
        F.max("started_at").alias("last_started_at"),
    )


def fct_plan_change_daily(plans: DataFrame) -> DataFrame:
    """Plan rows and distinct queries per day, counted per query first so that a
    busy instance is combined before it is shuffled by (instance, day)."""
    per_query = plans.groupBy("instance_id", "dt", "query_id").agg(F.count(F.lit(1)).alias("n"))
    return per_query.groupBy("instance_id", "dt").agg(
        F.sum("n").alias("plan_changes"), F.count("query_id").alias("queries_flipped")
    )


def fct_index_daily(usage: DataFrame) -> DataFrame:
    """Scans per index and day; an index that reports no counter has zero scans."""
    keys = ["instance_id", "table_name", "index_name", "dt"]
    unique = F.bool_or("is_unique").alias("is_unique")
    ends = endpoints(usage, keys, "captured_at", ["scan_count", "size_bytes"], unique, tiebreak="id")
    return ends.select(
        *keys,
        reset_safe_delta("scan_count").alias("delta_scans"),
        F.col("last_size_bytes").alias("size_bytes"),
        "is_unique",
    )


def fct_config_change_daily(cycles: DataFrame, changes: DataFrame) -> DataFrame:
    """Days with collection cycles are the spine, so a quiet day shows zero
    changes while a day that was not collected shows no row."""
    day = ["instance_id", "dt"]
    spine = cycles.groupBy(*day).agg(F.count(F.lit(1)).alias("cycles_collected"))
    per_param = changes.groupBy(*day, "param_name").agg(F.count(F.lit(1)).alias("n"))
    events = per_param.groupBy(*day).agg(
        F.sum("n").alias("change_events"), F.count("param_name").alias("params_changed")
    )
    return spine.join(events, day, "left").select(
        *day,
        "cycles_collected",
        F.coalesce("change_events", F.lit(0)).alias("change_events"),
        F.coalesce("params_changed", F.lit(0)).alias("params_changed"),
    )


def fct_uptime_daily(samples: DataFrame) -> DataFrame:
    """Availability per day; ping figures come from successful polls only.

    Polls are first counted per distinct ping value. Everything else works on
    that histogram, so one chatty instance is reduced before it is gathered,
    and ranks and totals share one exchange.
    """
    day = ["instance_id", "dt"]
    counts = samples.groupBy(*day, "up", "ping_millis").agg(F.count(F.lit(1)).alias("n"))
    ranked = rank_ranges(counts.repartition(*day), [*day, "up"], "ping_millis", "n")
    up, n, zero = F.col("up"), F.col("n"), F.lit(0).cast("long")
    return (
        ranked.groupBy(*day)
        .agg(
            F.sum(n).alias("samples"),
            F.coalesce(F.sum(F.when(up, n)), zero).alias("up_samples"),
            F.coalesce(F.sum(F.when(~up, n)), zero).alias("down_samples"),
            F.sum(F.when(up, F.col("ping_millis") * n)).alias("ping_sum"),
            interpolated_percentile("ping_millis", 95, up).alias("p95"),
        )
        .select(
            *day, "samples", "up_samples", "down_samples",
            pct(F.col("up_samples"), F.col("samples"), 2).alias("uptime_pct"),
            tenths(F.col("ping_sum"), F.col("up_samples")).alias("avg_ping_ms"),
            tenths(F.col("p95"), F.lit(100).cast("long")).alias("p95_ping_ms"),
        )
    )


def fct_plan_daily(plans: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Plan of the day (the last one seen) of each query seen on a day, and the one
    of the last day before on which it was seen. ``carried`` has the last plan
    of each query before the first of these days, so that no older day is read."""
    key = ["instance_id", "query_id"]
    daily = latest_per_key(plans, [*key, "dt"], ["captured_at", "id"], ["plan_hash"])
    by_day = Window.partitionBy(*key).orderBy("dt")
    before = F.lag("plan_hash").over(by_day)
    if carried is None:
        return daily.withColumn("prev_hash", before)
    known = carried.select(*key, F.col("plan_hash").alias("_carried"))
    return daily.withColumn("_before", before).join(known, key, "left").select(
        *key, "dt", "plan_hash", F.coalesce("_before", "_carried").alias("prev_hash")
    )


# fact -> (builder, staging inputs); every fact but the dimension is per day.
FACTS = {
    "fct_query_daily": (fct_query_daily, ("stg_query_snapshot",)),
    "fct_query_hourly": (fct_query_hourly, ("stg_query_snapshot",)),
    "fct_size_daily": (fct_size_daily, ("stg_size_snapshot",)),
    "fct_wait_event_daily": (fct_wait_event_daily, ("stg_wait_event",)),
    "fct_backup_daily": (fct_backup_daily, ("stg_backup_run",)),
    "fct_plan_change_daily": (fct_plan_change_daily, ("stg_plan_snapshot",)),
    "fct_plan_daily": (fct_plan_daily, ("stg_plan_snapshot",)),
    "fct_index_daily": (fct_index_daily, ("stg_index_usage_snapshot",)),
    "fct_config_change_daily": (fct_config_change_daily, ("stg_config_snapshot", "stg_config_param_change")),
    "fct_uptime_daily": (fct_uptime_daily, ("stg_health_sample",)),
}

# Keys that identify one row of each fact.
GRAINS = {
    "fct_query_daily": QUERY_DAY,
    "fct_query_hourly": QUERY_HOUR,
    "fct_size_daily": ["instance_id", "object_type", "object_name", "dt"],
    "fct_wait_event_daily": ["instance_id", "event_name", "dt"],
    "fct_backup_daily": ["instance_id", "dt"],
    "fct_plan_change_daily": ["instance_id", "dt"],
    "fct_plan_daily": QUERY_DAY,
    "fct_index_daily": ["instance_id", "table_name", "index_name", "dt"],
    "fct_config_change_daily": ["instance_id", "dt"],
    "fct_uptime_daily": ["instance_id", "dt"],
}
