"""The ten raw tables of a monitored fleet, derived from the event tables.

Every group of 150 users is one site of six databases, so the fleet grows with
the data. Counters are built in two steps: events are summed per hour with
map-side partials, and only those hourly sums run through a window. No window
ever holds raw events, however skewed they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsmart.functions import daynum
from obsmart.sources.tables import raw_table

# How events are read as database activity (shared with the
# comparison SQL).
USERS_PER_SITE = 150
DATABASES_PER_SITE = 6
LATE_INDEX_DAY = "2024-01-20"
LAST_BACKUP_DAY = "2024-01-20"
ENGINES = ["MYSQL", "POSTGRESQL", "MSSQL", "MONGODB", "ORACLE"]


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the instance they belong to and the integers read from them."""
    user = F.col("user_id")
    day = F.to_date("ts")
    return spark.read.parquet(f"{folder}/events.parquet").select(
        "event_id",
        "ts",
        "event_type",
        "value",
        F.regexp_extract("props", "[0-9]+", 0).cast("long").alias("k"),
        day.alias("dt"),
        F.hour("ts").alias("hr"),
        daynum(day).alias("eday"),
        (F.floor(user / USERS_PER_SITE) * DATABASES_PER_SITE + user % DATABASES_PER_SITE + 1).alias("instance_id"),
        (user % DATABASES_PER_SITE + 1).alias("slot"),
    )


def _at(every_hours: int = 1) -> Column:
    """Start of the polling interval as a zone-less timestamp."""
    return F.expr(
        f"cast(dt as timestamp_ntz) + make_dt_interval(0, (hr div {every_hours}) * {every_hours})"
    ).alias("captured_at")


def _running(sums: Sequence[str], keys: Sequence[str]) -> dict[str, Column]:
    so_far = Window.partitionBy(*keys).orderBy("captured_at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return {c: F.sum(c).over(so_far) for c in sums}


def plan_number() -> Column:
    return F.expr(
        "case when event_type = 'error' then (eday div 2) % 3 else ((eday + 2 * instance_id) div 9) % 3 end"
    )


def query_snapshot(ev: DataFrame) -> DataFrame:
    """Cumulative statement counters, two interleaved series per fingerprint,
    restarting at half-day boundaries."""
    calls = F.expr("1 + event_id % 97")
    keys = ["instance_id", "query_id", "series", "epoch_no"]
    hourly = (
        ev.select(
            "event_id", "instance_id", "dt", "k",
            F.col("event_type").alias("query_id"),
            F.expr("event_id % 2").alias("series"),
            F.expr("(2 * eday + if(hr >= 12, 1, 0) + 7) div 14").alias("epoch_no"),
            _at(),
            calls.alias("c"),
            (calls * (2 + 2 * plan_number()) + F.col("k") % 5).alias("t"),
        )
        .groupBy(*keys, "dt", "captured_at")
        .agg(
            F.max("event_id").alias("id"),
            F.sum("c").alias("calls"),
            F.sum("t").alias("total_time_ms"),
            F.sum("k").alias("rows_examined"),
        )
    )
    return hourly.withColumns(_running(["calls", "total_time_ms", "rows_examined"], keys)).select(
        "id", "instance_id", "captured_at", "query_id",
        F.format_string(
            "select  *\n  from %s_log  -- series %d\n where tenant = ? and opened_at > ?  order by opened_at desc",
            "query_id", "series",
        ).alias("query_text"),
        "calls", F.col("total_time_ms").cast("double"), "rows_examined", "dt",
    )


def backup_run(ev: DataFrame) -> DataFrame:
    failed = (F.col("k") % 7 == 0) | (F.col("slot") == 6)
    verified = ~failed & (F.col("k") % 3 == 0)
    return (
        ev.where("event_type = 'purchase'")
        .where((F.col("slot") != 5) | (F.col("dt") <= F.lit(LAST_BACKUP_DAY).cast("date")))
        .select(
            F.col("event_id").alias("id"),
            "instance_id",
            F.col("ts").alias("started_at"),
            F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
            F.when(F.col("k") < 10, F.lit(None)).when(F.col("k") % 2 == 0, "LOG").otherwise("FULL").alias("backup_type"),
            (F.col("k") * 1000).alias("duration_ms"),
            F.when(failed, "disk quota").alias("detail"),
            F.format_string("/backup/%d", "event_id").alias("location"),
            F.when(verified, "VERIFIED").when(~failed, "PENDING").alias("verify_status"),
            F.when(verified, F.col("ts")).alias("verified_at"),
            F.when(F.col("k") % 5 == 0, F.format_string("vault/%d", "event_id")).alias("remote_location"),
            "dt",
        )
    )


def plan_snapshot(ev: DataFrame) -> DataFrame:
    plan = plan_number()
    return ev.select(
        F.col("event_id").alias("id"),
        "instance_id",
        F.col("event_type").alias("query_id"),
        F.concat(F.lit("p"), plan.cast("string")).alias("plan_hash"),
        F.concat(F.lit("shape "), plan.cast("string")).alias("plan_shape"),
        F.col("ts").alias("captured_at"),
        "dt",
    )


def wait_event_snapshot(ev: DataFrame) -> DataFrame:
    keys = ["instance_id", "event_name"]
    hourly = (
        ev.select("event_id", "instance_id", "dt", F.col("event_type").alias("event_name"), _at(),
                  F.round(F.col("value") * 100, 0).cast("long").alias("ms"))
        .groupBy(*keys, "dt", "captured_at")
        .agg(F.max("event_id").alias("id"), F.count(F.lit(1)).alias("wait_count"), F.sum("ms").alias("total_ms"))
    )
    category = (
        F.when(F.col("event_name").isin("view", "click"), "io").when(F.col("event_name") == "error", "lock")
    )
    return hourly.withColumns(_running(["wait_count", "total_ms"], keys)).select(
        "id", "instance_id", "captured_at", "event_name", category.alias("category"),
        "wait_count", F.col("total_ms").cast("double"), "dt",
    )


def size_snapshot(ev: DataFrame) -> DataFrame:
    keys = ["instance_id", "object_name"]
    six_hourly = (
        ev.select("event_id", "instance_id", "slot", "dt", F.col("event_type").alias("object_name"), _at(6),
                  ((F.col("k") + 1) * 10_000).alias("grown"))
        .groupBy(*keys, "slot", "dt", "captured_at")
        .agg(F.max("event_id").alias("id"), F.count(F.lit(1)).alias("row_estimate"), F.sum("grown").alias("grown"))
    )
    data = F.expr(
        "case slot when 5 then 900000000 - grown when 6 then 500000000 else 100000000 * slot + grown end"
    )
    return (
        six_hourly.withColumns(_running(["row_estimate", "grown"], keys))
        .withColumn("data_bytes", data)
        .select(
            "id", "instance_id", "captured_at", F.lit("table").alias("object_type"), "object_name", "row_estimate",
            "data_bytes",
            F.expr("data_bytes div 10").alias("index_bytes"),
            F.expr("if(slot = 5, 8000000000, null)").alias("volume_total_bytes"),
            F.expr("if(slot = 5, 8000000000 - data_bytes, null)").alias("volume_available_bytes"),
            F.expr("if(slot = 4, 2000000000, null)").alias("max_bytes"),
            "dt",
        )
    )


def index_usage_snapshot(ev: DataFrame) -> DataFrame:
    """Scan counters; slot 2 does not report one index, slot 3 never uses two of
    them, and one index of slot 4 appears late and stays unused."""
    keys = ["instance_id", "table_name", "index_name"]
    hourly = (
        ev.select("event_id", "instance_id", "slot", "dt", "k", F.col("event_type").alias("table_name"),
                  (F.col("k") % 4).alias("which"), _at())
        .where(
            (F.col("slot") != 4) | (F.col("which") != 1) | (F.col("dt") >= F.lit(LATE_INDEX_DAY).cast("date"))
        )
        .withColumn("index_name", F.concat(F.lit("idx_"), F.col("which").cast("string")))
        .groupBy(*keys, "slot", "which", "dt", "captured_at")
        .agg(F.max("event_id").alias("id"), F.count(F.lit(1)).alias("n"), F.sum("k").alias("scans"))
    )
    counter = F.expr(
        "case when slot = 2 and which = 3 then null when slot = 3 and which >= 2 then 0 "
        "when slot = 4 and which = 1 then 0 else scans end"
    )
    return hourly.withColumns(_running(["n", "scans"], keys)).select(
        "id", "instance_id", "captured_at", "table_name", "index_name",
        counter.cast("long").alias("scan_count"),
        (1_000_000 * (F.col("which") + 1) + 8192 * F.col("n")).alias("size_bytes"),
        (F.col("which") % 2 == 0).alias("is_unique"),
        "dt",
    )


def config_snapshot(ev: DataFrame) -> DataFrame:
    """One collection cycle per instance and hour in which anything happened."""
    return (
        ev.select("event_id", "instance_id", "dt", "eday", "k", _at())
        .groupBy("instance_id", "dt", "eday", "captured_at")
        .agg(F.max("event_id").alias("id"), F.count_if(F.col("k") < 2).alias("n"))
        .select(
            "id", "instance_id", "captured_at",
            F.concat(F.lit("h"), F.expr("eday div 10").cast("string")).alias("param_hash"),
            F.col("n").cast("int").alias("change_count"),
            (F.dayofmonth("dt") == 1).alias("baseline"),
            "dt",
        )
    )


def config_param_change(ev: DataFrame) -> DataFrame:
    kind = F.expr("case event_id % 3 when 0 then 'CHANGED' when 1 then 'ADDED' else 'REMOVED' end")
    text = F.floor("value").cast("string")
    return (
        ev.where("k < 2")
        .withColumn("change_kind", kind)
        .select(
            F.col("event_id").alias("id"),
            F.col("event_id").alias("snapshot_id"),
            "instance_id",
            F.col("ts").alias("captured_at"),
            F.concat(F.lit("param_"), F.col("event_type")).alias("param_name"),
            F.when(F.col("change_kind") != "ADDED", F.concat(F.lit("v"), text)).alias("old_value"),
            F.when(F.col("change_kind") != "REMOVED", F.concat(F.lit("w"), text)).alias("new_value"),
            "change_kind",
            "dt",
        )
    )


def health_sample(ev: DataFrame) -> DataFrame:
    error = F.col("event_type") == "error"
    down = (error & (F.col("slot") <= 2) & (F.col("k") % 3 == 0)) | (error & (F.col("slot") == 4) & (F.col("k") == 1))
    return ev.select(
        F.col("event_id").alias("id"), "instance_id", F.col("ts").alias("sampled_at"),
        (~down).alias("up"), F.floor("value").cast("long").alias("ping_millis"), "dt",
    )


def dim_instance(ev: DataFrame, nations: DataFrame) -> DataFrame:
    """One registry snapshot per day; a database is renamed at mid-month."""
    seen = ev.select("instance_id", "dt").distinct()
    engines = F.array(*[F.lit(e) for e in ENGINES])
    half = F.when(F.dayofmonth("dt") <= 15, 1).otherwise(2)
    return (
        seen.join(nations, F.col("instance_id") % 25 == F.col("n_nationkey"), "left")
        .select(
            F.col("instance_id").alias("id"),
            F.concat_ws("-", F.lit("db"), F.col("instance_id").cast("string"), half.cast("string")).alias("name"),
            F.element_at(engines, (F.col("instance_id") % 5 + 1).cast("int")).alias("type"),
            F.col("n_name").alias("team_label"),
            "dt",
        )
    )


def fleet_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A raw table by name, in its declared column order and types."""
    table = raw_table(name)
    ev = events(spark, folder)
    if name == "dim_instance":
        df = dim_instance(ev, spark.read.parquet(f"{folder}/nation.parquet"))
    else:
        df = _BUILDERS[name](ev)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in table.landed_schema])


_BUILDERS = {
    "query_snapshot": query_snapshot,
    "backup_run": backup_run,
    "plan_snapshot": plan_snapshot,
    "wait_event_snapshot": wait_event_snapshot,
    "size_snapshot": size_snapshot,
    "index_usage_snapshot": index_usage_snapshot,
    "config_snapshot": config_snapshot,
    "config_param_change": config_param_change,
    "health_sample": health_sample,
}
