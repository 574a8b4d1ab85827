"""Registered queries: every operator over the fleet derived from a table folder."""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart import scale
from obsmart.functions import rounded
from obsmart.lake.versions import Lake
from obsmart.params import DEFAULTS
from obsmart.plans import serving
from obsmart.plans.daily import row_rules
from obsmart.plans.facts import FACTS
from obsmart.plans.marts import MARTS
from obsmart.plans.staging import STAGING
from obsmart.plans.warehouse import FROM_STATE, PUBLISHED, SETTLED, Warehouse, load_start, refresh_fact, write_fact
from obsmart.quality import contract, data_tests, gate, runs
from obsmart.session import fresh_dir
from obsmart.sources import jdbc, landing, storage
from obsmart.sources.fleet import fleet_source
from obsmart.sources.local import local_frame
from obsmart.sources.tables import AUXILIARY, RAW_TABLES, raw_table

Query = Callable[[SparkSession, str], DataFrame]

# The events cover thirty days, fewer than some default windows ask for.
PARAMS = replace(DEFAULTS, baseline_min_observations=2, index_window_days=30, index_min_obs_days=20)
NOON = datetime(2024, 2, 1, 12, tzinfo=UTC)

_SPANS: dict[tuple[str, str], tuple[date, date]] = {}


def span(spark: SparkSession, folder: str) -> tuple[date, date]:
    """First and last day of the given events."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _SPANS:
        day = F.to_date("ts")
        _SPANS[key] = tuple(spark.read.parquet(f"{folder}/events.parquet").agg(F.min(day), F.max(day)).first())
    return _SPANS[key]


def days_of(spark: SparkSession, folder: str) -> list[date]:
    return landing.days_between(*span(spark, folder))


#: Raw tables of running counters. Their windows need all earlier days, so that a
#: load of a few days would derive the whole history again.
RUNNING = ("query_snapshot", "wait_event_snapshot", "size_snapshot", "index_usage_snapshot")

_SOURCES: dict[tuple[str, str, str], str] = {}
_SOURCE_LOCKS: dict[tuple[str, str, str], threading.Lock] = {}


def loaded_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A raw table that several loads read. One of running counters is derived
    once per session and folder and kept by day, so a load reads its days only."""
    whole = fleet_source(spark, folder, name)
    if name not in RUNNING:
        return whole
    key = (spark.sparkContext.applicationId, folder, name)
    with _SOURCE_LOCKS.setdefault(key, threading.Lock()):
        if key not in _SOURCES:
            path = fresh_dir(spark, f"source-{name}")
            write_fact(whole, path, whole=True)
            _SOURCES[key] = path
    return spark.read.schema(whole.schema).parquet(_SOURCES[key]).select(*whole.columns)


_WAREHOUSES: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """One warehouse per session and folder, so facts are written once."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse(
            spark, lambda name: fleet_source(spark, folder, name), fresh_dir(spark, "warehouse"), PARAMS
        )
    return _WAREHOUSES[key]


def _without_stamp(df: DataFrame) -> DataFrame:
    return df.drop("computed_at")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on their order in the last digits."""
    return df.withColumns({c: rounded(F.col(c), 6) for c in columns})




def _staging(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return warehouse(spark, folder).staging(name)

    return query


def _fact(name: str) -> Query:
    return lambda spark, folder: warehouse(spark, folder).build_fact(name)


ROUNDED = {
    "mart_query_regression": ["prior_latency_ms", "recent_latency_ms", "latency_increase_ms"],
    "mart_baseline_longterm": ["mean_delta_calls", "stddev_delta_calls"],
    "mart_config_impact": ["before_bytes", "after_bytes"],
}


def _mart(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _rounded(_without_stamp(warehouse(spark, folder).build_mart(name)), *ROUNDED.get(name, []))

    return query


def _serving(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        w = warehouse(spark, folder)

        def tables(table: str) -> DataFrame:
            if table == "pipeline_run_log":
                return stored_run_log(spark, folder)
            return w.stored(table) if table in MARTS else w.table(table)

        return serving.SERVING[name](tables)

    return query


# -- landing ---------------------------------------------------------------------
def registry_ids(spark: SparkSession, folder: str) -> DataFrame:
    return fleet_source(spark, folder, "dim_instance").select(F.col("id").alias("instance_id")).distinct()


def offload_extract_day(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each table that fall into each day, by high-water column."""
    result = None
    for name, table in RAW_TABLES.items():
        if table.watermark is None:
            continue
        rows = landing.extract_days(fleet_source(spark, folder, name), table, *span(spark, folder))
        per_day = rows.groupBy("dt").agg(
            F.count(F.lit(1)).alias("rows"), F.min(table.watermark).alias("first_at"),
            F.max(table.watermark).alias("last_at"), F.sum("id").alias("id_sum"),
        ).select(F.lit(name).alias("table_name"), "dt", "rows", "first_at", "last_at", "id_sum")
        result = per_day if result is None else result.unionByName(per_day)
    return result


def offload_primary(spark: SparkSession, folder: str) -> DataFrame:
    """Land the statement counters and read them back under the declared schema."""
    root = fresh_dir(spark, "raw")
    landing.offload(spark, fleet_source(spark, folder, "query_snapshot"), "query_snapshot", root, *span(spark, folder),
                    registry_ids(spark, folder))
    return landing.read_landed(spark, root, "query_snapshot", whole=True)


def offload_auxiliary(spark: SparkSession, folder: str) -> DataFrame:
    """Land the eight auxiliary tables; rows per table and partition."""
    sources = {name: fleet_source(spark, folder, name) for name in AUXILIARY}
    registry = fleet_source(spark, folder, "dim_instance").where(F.col("dt") == F.lit(span(spark, folder)[1])).drop("dt")
    return landing.offload_auxiliary(spark, sources, registry, fresh_dir(spark, "raw"), *span(spark, folder))


def offload_connections(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each instance and day as eight connections read them, each day
    balanced by the rows of the day before; the reader stands in for a database."""
    ids, table = registry_ids(spark, folder).withColumnRenamed("instance_id", "id"), raw_table("health_sample")
    whole = fleet_source(spark, folder, table.name)

    def read(_: str, predicates: list[str]) -> DataFrame:
        """Each row as often as a connection asks for it."""
        asked = F.array_compact(F.array(*[F.when(F.expr(p), n) for n, p in enumerate(predicates)]))
        return whole.withColumn("_connection", F.explode(asked))

    instances, result = jdbc.registry_ids(ids), None
    per_day = whole.groupBy("dt", "instance_id").count().collect()  # one number a database and day
    rows: dict[date, dict[int, int]] = {}
    for day, instance, n in per_day:
        rows.setdefault(day, {})[instance] = n
    for day in days_of(spark, folder):
        found = jdbc.read_day(read, table, instances, rows.get(day - timedelta(days=1), {}), day, connections=8)
        counted = found.groupBy("instance_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("id").alias("id_sum"))
        counted = counted.withColumn("dt", F.lit(day))
        result = counted if result is None else result.unionByName(counted)
    return result


def offload_registry(spark: SparkSession, folder: str) -> DataFrame:
    """The registry snapshot of every day, each landed by itself; an empty
    registry is skipped on a day without a snapshot and refused on one with."""
    root = fresh_dir(spark, "raw")
    snapshots = fleet_source(spark, folder, "dim_instance")
    first, last = span(spark, folder)
    none = snapshots.where("false").drop("dt")
    rows = [("empty before", landing.offload_registry(spark, none, root, first - timedelta(days=1)))]
    for day in landing.days_between(first, last):
        landing.offload_registry(spark, snapshots.where(F.col("dt") == F.lit(day)).drop("dt"), root, day)
    try:
        landing.offload_registry(spark, none, root, last)
    except landing.ArchiveGuardError:
        rows.append(("refused", 1))
    landed = landing.read_landed(spark, root, "dim_instance")
    marks = local_frame(spark, rows, "mark STRING, n BIGINT").groupBy().pivot("mark", ["empty before", "refused"]).agg(F.first("n"))
    marks = marks.toDF("landed_before", "refused")
    return landed.join(marks, F.lit(True))


def offload_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Loading a partition again replaces it; other partitions stay."""
    root = fresh_dir(spark, "raw")
    source = fleet_source(spark, folder, "plan_snapshot")
    first, last = span(spark, folder)
    landing.offload(spark, source, "plan_snapshot", root, first, last)
    once = landing.landed_counts(spark, root, "plan_snapshot", first, last).withColumnRenamed("landed_rows", "first_rows")
    once.write.parquet(f"{root}/once")  # the next load replaces the files behind `once`
    half = first + (last - first) // 2
    landing.offload(spark, source, "plan_snapshot", root, first, half)
    again = landing.landed_counts(spark, root, "plan_snapshot", first, last).withColumnRenamed("landed_rows", "second_rows")
    return spark.read.parquet(f"{root}/once").join(again, ["dt", "instance_id"], "full_outer")


def offload_guard(spark: SparkSession, folder: str) -> DataFrame:
    """What a reload would do after the source lost everything before the eighth
    day and the twentieth was never landed."""
    root = fresh_dir(spark, "raw")
    first = span(spark, folder)[0]
    table = raw_table("health_sample")
    source = fleet_source(spark, folder, table.name)
    landing.land(source.where(F.col("dt") != F.lit(first + timedelta(days=19))), root, table)
    kept = source.where(F.col("dt") >= F.lit(first + timedelta(days=7)))
    left = kept.groupBy("dt", "instance_id").agg(F.count(F.lit(1)).alias("source_rows"))
    return landing.partition_actions(
        left,
        landing.landed_partitions(spark, root, table, days_of(spark, folder)),
        landing.expected_partitions(spark, registry_ids(spark, folder), days_of(spark, folder)),
    )


def instance_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """Seed overrides and defaults as they apply to each instance."""
    w = warehouse(spark, folder)
    ids = w.table("dim_instance").select("instance_id")
    for seed in ("capacity_thresholds", "plan_regression_thresholds", "uptime_slo_targets", "backup_rpo_thresholds"):
        ids = ids.join(w.table(seed), "instance_id", "left")
    p = w.params
    return ids.select(
        "instance_id", "threshold_bytes", F.coalesce("threshold_kind", F.lit("none")).alias("threshold_kind"),
        F.coalesce("regress_ratio", F.lit(p.plan_regress_ratio)).alias("regress_ratio"),
        F.coalesce("min_after_calls", F.lit(p.plan_min_calls).cast("long")).alias("min_after_calls"),
        F.coalesce("target_pct", F.lit(p.uptime_target_pct)).alias("target_pct"),
        F.coalesce("max_gap_days", F.lit(p.backup_max_gap_days).cast("long")).alias("max_gap_days"),
    )


def thirds(spark: SparkSession, folder: str) -> list[date]:
    """Three days of the given span on which loads end: the last is the last day."""
    first, last = span(spark, folder)
    length = (last - first).days
    return [first + timedelta(days=length * 2 // 3), first + timedelta(days=length * 5 // 6), last]


def _incremental(name: str) -> Query:
    """The fact after a load of two thirds of the days and two later incremental loads."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        ends = thirds(spark, folder)
        seen = {"until": ends[0]}

        def raw(table: str) -> DataFrame:
            return loaded_source(spark, folder, table).where(F.col("dt") <= F.lit(seen["until"]))

        w = Warehouse(spark, raw, fresh_dir(spark, "incremental"), PARAMS)
        for until in ends:
            seen["until"] = until
            refresh_fact(w, name)
        return w.fact(name)

    return query


def _facts_below(mart: str) -> list[str]:
    inputs = MARTS[mart][1]
    own = [i for i in inputs if i in FACTS]
    return list(dict.fromkeys(own + [f for i in inputs if i in MARTS for f in _facts_below(i)]))


def _incremental_mart(name: str) -> Query:
    """The mart after a first load, incremental loads, and a correction that
    arrives late: until then one day lacks a third of its databases."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        ends = thirds(spark, folder)
        late = ends[1] - timedelta(days=2)
        seen = {"until": ends[0], "corrected": False}

        def raw(table: str) -> DataFrame:
            df = loaded_source(spark, folder, table).where(F.col("dt") <= F.lit(seen["until"]))
            if seen["corrected"] or "instance_id" not in df.columns:
                return df
            return df.where((F.col("dt") != F.lit(late)) | (F.col("instance_id") % 3 != 0))

        w = Warehouse(spark, raw, fresh_dir(spark, "incremental"), PARAMS)

        def load(first: date | None = None) -> None:
            with ThreadPoolExecutor(landing.SIDE_BY_SIDE) as pool:
                starts = list(pool.map(lambda fact: refresh_fact(w, fact, first), _facts_below(name)))
            changed = None if None in starts else min(starts)
            for mart in SETTLED:
                if mart == name or mart in MARTS[name][1]:
                    w.refresh_mart(mart, changed)

        for until in ends:
            seen["until"] = until
            load()
        seen["corrected"] = True
        load(late)
        return _rounded(_without_stamp(w.mart(name)), *ROUNDED.get(name, []))

    return query


# -- versions --------------------------------------------------------------------
def lake_publish(spark: SparkSession, folder: str) -> DataFrame:
    """All published tables as one version: rows per table."""
    w = warehouse(spark, folder)
    lake = Lake(spark, fresh_dir(spark, "lake"))
    lake.publish(w.tables(PUBLISHED), daily=dict.fromkeys(FACTS), rules=row_rules)
    return lake.measure().select("table_name", "row_count")


def lake_publish_after_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Published days of a fact, all days but the last six in one load, then day
    by day; the publishes of the second and third of these fail, and a
    correction of the first arrives after the fifth."""
    first, last = span(spark, folder)
    lake, root = Lake(spark, fresh_dir(spark, "lake")), fresh_dir(spark, "facts")
    days = landing.days_between(max(first, last - timedelta(days=6)), last)
    late, failing = days[1], days[2:4]
    state = {"until": first, "redone": False}

    def raw(name: str) -> DataFrame:
        df = fleet_source(spark, folder, name).where(F.col("dt") <= F.lit(state["until"]))
        return df if state["redone"] else df.where((F.col("dt") != F.lit(late)) | (F.col("instance_id") != 2))

    w = Warehouse(spark, raw, root, PARAMS)

    def refused(_) -> None:
        raise RuntimeError("refused on purpose")

    for day in (*days[:-1], late, days[-1]):
        state["redone"] = state["redone"] or day < state["until"]
        state["until"] = max(state["until"], day)
        start = load_start(w, "fct_uptime_daily", day)
        refresh_fact(w, "fct_uptime_daily", start, start is None)
        try:
            fails = refused if day in failing else None
            lake.publish({"fct_uptime_daily": w.fact("fct_uptime_daily")}, str(day), validate=fails, daily={"fct_uptime_daily": start})
        except RuntimeError:
            continue
    return lake.read("fct_uptime_daily").select("instance_id", "dt", "samples")


def _half_loads(spark: SparkSession, folder: str) -> tuple[Lake, DataFrame]:
    lake = Lake(spark, fresh_dir(spark, "lake"))
    raw = fleet_source(spark, folder, "query_snapshot")
    middle = F.lit(date(2024, 1, 15))
    for n, part in enumerate((raw.where(F.col("dt") > middle), raw.where(F.col("dt") <= middle))):
        lake.append("query_snapshot", part, committed_at=NOON + timedelta(days=n))
    return lake, raw


def lake_load_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows added by each of two loads, in commit order."""
    lake, _ = _half_loads(spark, folder)
    rows = [(v, lake.rows(v) - (lake.rows(v - 1) if v > 1 else 0)) for v in lake.versions()]
    return local_frame(spark, rows, "version BIGINT, rows_added BIGINT")


def lake_time_travel(spark: SparkSession, folder: str) -> DataFrame:
    """Daily rows and calls as seen by each version."""
    lake, _ = _half_loads(spark, folder)
    result = None
    for v in lake.versions():
        seen = lake.read("query_snapshot", v).groupBy("dt").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("calls").alias("calls")
        ).withColumn("version", F.lit(v).cast("long"))
        result = seen if result is None else result.unionByName(seen)
    return result


def lake_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return _half_loads(spark, folder)[0].snapshots().select("version", "changes", "table_count", "row_count")


def lake_correct_row(spark: SparkSession, folder: str) -> DataFrame:
    """Time per day before and after correcting the newest row of one day."""
    lake, raw = _half_loads(spark, folder)
    day = "2024-01-16"
    newest = raw.where(F.col("dt") == F.lit(day).cast("date")).agg(F.max("id")).first()[0]
    lake.correct("query_snapshot", day, F.col("id") == newest, "total_time_ms", F.col("total_time_ms") + 1000.0)

    def per_day(version: int, name: str) -> DataFrame:
        return lake.read("query_snapshot", version).groupBy("dt").agg(
            F.count(F.lit(1)).alias(f"rows_{name}"), F.sum("total_time_ms").alias(f"time_{name}")
        )

    return per_day(2, "before").join(per_day(3, "after"), "dt", "full_outer")


def lake_delete_rolled_back(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per day after a delete that was rolled back (version 2) and one that
    was committed (version 3)."""
    lake, _ = _half_loads(spark, folder)
    day = "2024-01-10"
    try:
        with lake.transaction("delete") as tx:
            tx.delete_day("query_snapshot", day)
            raise RuntimeError("rolled back on purpose")
    except RuntimeError:
        pass
    kept = lake.read("query_snapshot").groupBy("dt").agg(F.count(F.lit(1)).alias("rows_kept"))
    with lake.transaction(f"delete {day}") as tx:
        tx.delete_day("query_snapshot", day)
    after = lake.read("query_snapshot", 3).groupBy("dt").agg(F.count(F.lit(1)).alias("rows_deleted"))
    return kept.join(after, "dt", "left").withColumn("versions", F.lit(len(lake.versions())).cast("long"))


def lake_expire(spark: SparkSession, folder: str) -> DataFrame:
    """Versions left after expiring all but the last day, and the rows they show."""
    lake, _ = _half_loads(spark, folder)
    lake.compact(committed_at=NOON + timedelta(days=2))
    lake.expire(timedelta(hours=1), as_of=NOON + timedelta(days=3))
    seen = lake.read("query_snapshot").groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))
    return seen.withColumn("versions_left", F.lit(len(lake.versions())).cast("long"))


def lake_compact(spark: SparkSession, folder: str) -> DataFrame:
    """A commit per day, then compaction: parts, and an order-free content check."""
    lake = Lake(spark, fresh_dir(spark, "lake"))
    scale.daily_commits(lake, "plan_snapshot", fleet_source(spark, folder, "plan_snapshot"), days_of(spark, folder))
    (before, after), = lake.compact().values()
    content = lake.read("plan_snapshot").agg(F.count(F.lit(1)).alias("rows"), F.sum("id").alias("id_sum"))
    return content.withColumns(
        {"parts_before": F.lit(before).cast("long"), "parts_after": F.lit(after).cast("long"),
         "versions": F.lit(len(lake.versions())).cast("long")}
    )


def lake_measure(spark: SparkSession, folder: str) -> DataFrame:
    return _half_loads(spark, folder)[0].measure().select("table_name", "parts", "row_count")


def lake_maintenance(spark: SparkSession, folder: str) -> DataFrame:
    """Versions, parts and rows before and after maintenance."""
    lake, _ = _half_loads(spark, folder)
    return lake.maintain(timedelta(hours=1), as_of=NOON + timedelta(days=3)).where(
        F.col("metric").isin("versions", "tables", "parts", "rows")
    )


# -- quality ---------------------------------------------------------------------
def _landed_with_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Landed statement counters with planted faults: day 10 lost one hour, day 15
    lost one instance, day 20 stopped at 18:00, day 25 at 09:00, day 28 is absent."""
    dt, hour = F.col("dt"), F.hour("captured_at")

    def on(d: int):
        return dt == F.lit(date(2024, 1, d))

    lost = (
        (on(10) & (hour == 12)) | (on(15) & (F.col("instance_id") == 3)) | (on(20) & (hour >= 18))
        | (on(25) & (hour >= 9)) | on(28)
    )
    return fleet_source(spark, folder, "query_snapshot").where(~lost)


def _gate(spark: SparkSession, folder: str) -> DataFrame:
    return gate.evaluate(
        spark, fleet_source(spark, folder, "query_snapshot").drop("dt"), _landed_with_faults(spark, folder),
        registry_ids(spark, folder), raw_table("query_snapshot"), days_of(spark, folder), PARAMS,
    )


def quality_source_counts(spark: SparkSession, folder: str) -> DataFrame:
    return gate.source_counts(fleet_source(spark, folder, "query_snapshot").drop("dt"), raw_table("query_snapshot"), days_of(spark, folder))


def quality_landed_counts(spark: SparkSession, folder: str) -> DataFrame:
    return gate.counts(_landed_with_faults(spark, folder), "landed_rows")


def quality_newest_watermark(spark: SparkSession, folder: str) -> DataFrame:
    return gate.newest_watermark(_landed_with_faults(spark, folder), raw_table("query_snapshot"))


def quality_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    return gate.reconcile(quality_source_counts(spark, folder), quality_landed_counts(spark, folder))


def quality_completeness(spark: SparkSession, folder: str) -> DataFrame:
    expected = landing.expected_partitions(spark, registry_ids(spark, folder), days_of(spark, folder))
    return gate.missing_instances(quality_landed_counts(spark, folder), expected)


def quality_freshness(spark: SparkSession, folder: str) -> DataFrame:
    newest = quality_newest_watermark(spark, folder)
    return newest.select(
        "dt", rounded(gate.freshness_gap(F.col("newest_at")), 3).alias("gap_hours"),
        gate.freshness_status(F.col("newest_at"), PARAMS).alias("status"),
    )


def quality_schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Every raw table against its declaration, and three changed copies of one."""
    rows = []
    for name, table in RAW_TABLES.items():
        rows.append((name, gate.schema_drift(fleet_source(spark, folder, name).drop("dt").schema, table.schema)[0]))
    changed = fleet_source(spark, folder, "query_snapshot").drop("dt")
    declared = raw_table("query_snapshot").schema
    for label, df in {
        "query_snapshot lost a column": changed.drop("calls"),
        "query_snapshot retyped": changed.withColumn("calls", F.col("calls").cast("string")),
        "query_snapshot gained a column": changed.withColumn("extra", F.lit(1)),
    }.items():
        rows.append((label, gate.schema_drift(df.schema, declared)[0]))
    return local_frame(spark, rows, "table_name STRING, status STRING")


def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    return _gate(spark, folder).select("dt", "axis", "status")


def _lost(table) -> Column:
    """Planted losses of the auxiliary tables: instance 2 on day 12, the evening
    of day 18, all of day 22."""
    dt = F.col("dt")
    evening = (dt == F.lit(date(2024, 1, 18))) & (F.hour(table.watermark) >= 15)
    return ((dt == F.lit(date(2024, 1, 12))) & (F.col("instance_id") == 2)) | evening | (dt == F.lit(date(2024, 1, 22)))


def quality_gate_auxiliary(spark: SparkSession, folder: str) -> DataFrame:
    """The gate of every auxiliary table, landed with losses; the source of the
    sizes gained a column and a column of the waits another type."""
    result = None
    for name in AUXILIARY:
        table, source = raw_table(name), fleet_source(spark, folder, name)
        seen = source
        if name == "size_snapshot":
            seen = source.withColumn("extra", F.lit(1))
        elif name == "wait_event_snapshot":
            seen = source.withColumn("total_ms", F.col("total_ms").cast("string"))
        checks = gate.evaluate(
            spark, seen.drop("dt"), source.where(~_lost(table)), registry_ids(spark, folder), table, days_of(spark, folder), PARAMS
        )
        per_axis = checks.groupBy("table_name", "axis").agg(
            F.count_if(F.col("status") == gate.OK).alias("ok_days"),
            F.count_if(F.col("status") == gate.WARN).alias("warn_days"),
            F.count_if(F.col("status") == gate.FAIL).alias("fail_days"),
            F.count_if(F.col("status") == gate.SKIP).alias("skipped_days"),
        )
        result = per_axis if result is None else result.unionByName(per_axis)
    return result


def quality_day_status(spark: SparkSession, folder: str) -> DataFrame:
    return gate.day_status(_gate(spark, folder)).select("dt", "gate_status", "blocked")


def quality_data_tests(spark: SparkSession, folder: str) -> DataFrame:
    return data_tests.run_tests(warehouse(spark, folder).table, list(data_tests.NOT_NULL))


def quality_violations(spark: SparkSession, folder: str) -> DataFrame:
    """The same tests finding something: raw polls before series are folded."""
    raw = fleet_source(spark, folder, "query_snapshot")
    wait = fleet_source(spark, folder, "wait_event_snapshot")
    landed = _landed_with_faults(spark, folder)
    parts = [
        data_tests.row_rules(wait, {
            "not_null(category)": data_tests.not_null("category"),
            "accepted(category)": data_tests.accepted("category", ["io"]),
        }),
        data_tests.unique(raw, ["instance_id", "query_id", "captured_at"]),
        data_tests.relationship(raw, landed.where(F.col("dt") == F.lit(date(2024, 1, 15))), "instance_id"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def quality_duplicate_polls(spark: SparkSession, folder: str) -> DataFrame:
    """Grain test of the raw polls: the keys that staging has to fold."""
    raw = fleet_source(spark, folder, "query_snapshot")
    return data_tests.duplicate_keys(raw, ["instance_id", "query_id", "dt", "captured_at"])


def quality_contracts(spark: SparkSession, folder: str) -> DataFrame:
    w = warehouse(spark, folder)
    result = None
    for name in contract.CONTRACTS:
        df = w.table(name)
        rows = contract.value_violations(df, name).select(
            F.lit(name).alias("table_name"), "rule", "violations",
            F.lit(len(contract.shape_problems(df, name))).cast("long").alias("shape_problems"),
        )
        result = rows if result is None else result.unionByName(rows)
    return result


def quality_two_sided_report(spark: SparkSession, folder: str) -> DataFrame:
    return gate.two_sided_report(quality_source_counts(spark, folder), quality_landed_counts(spark, folder))


def pipeline_run_log(spark: SparkSession, folder: str) -> DataFrame:
    """One run per day, an hour after midnight, with the gate's real results."""
    checks = _gate(spark, folder)
    landed = quality_landed_counts(spark, folder).groupBy("dt").agg(F.sum("landed_rows").alias("n"))
    at = F.date_add(F.col("dt"), 1).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(1))
    records = runs.run_records(
        checks, gate.day_status(checks),
        run_id=F.concat(F.lit("run-"), F.col("dt").cast("string")), run_at=at,
        duration_sec=F.dayofmonth("dt") / F.lit(7.0), heartbeat_at=at,
    )
    return records.drop("offload_rows").join(landed, "dt", "left").withColumn("offload_rows", F.col("n")).drop("n")


_RUN_LOGS: dict[tuple[str, str], str] = {}


def stored_run_log(spark: SparkSession, folder: str) -> DataFrame:
    """The run log as written, once per session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _RUN_LOGS:
        path = f"{fresh_dir(spark, 'runs')}/log"
        pipeline_run_log(spark, folder).write.parquet(path)
        _RUN_LOGS[key] = path
    return spark.read.parquet(_RUN_LOGS[key])


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Appended in two batches, as two runs would, then read back."""
    path = f"{fresh_dir(spark, 'runs')}/log"
    records = pipeline_run_log(spark, folder).select(*_columns(runs.RUN_LOG))
    half = F.lit(date(2024, 1, 15))
    runs.append_runs(records.where(F.col("dt") <= half), path)
    runs.append_runs(records.where(F.col("dt") > half), path)
    return runs.read_runs(spark, path).select("dt", "run_id", "duration_sec", "gate_status", "gate_reconciliation",
                                              "gate_completeness", "gate_freshness", "gate_schema_drift", "offload_rows")


def _columns(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _beats(spark: SparkSession, folder: str) -> DataFrame:
    """Every healthy poll is a sign of life of its instance."""
    samples = fleet_source(spark, folder, "health_sample")
    return samples.where("up").select(
        F.concat(F.lit("collect-"), F.col("instance_id").cast("string")).alias("dag_id"),
        F.col("sampled_at").cast("timestamp").alias("last_success_at"),
        F.col("id").cast("string").alias("run_id"),
        F.lit(None).cast("string").alias("note"),
    )


def heartbeat_latest(spark: SparkSession, folder: str) -> DataFrame:
    return runs.latest_beats(_beats(spark, folder)).select(
        "dag_id", F.col("last_success_at").cast("timestamp_ntz").alias("last_success_at"), "run_id"
    )


def heartbeat_folded(spark: SparkSession, folder: str) -> DataFrame:
    """The latest beats after two folds and one that was interrupted, with beats
    before, between and after them."""
    path = f"{fresh_dir(spark, 'beats')}/beats"
    beats, third = _beats(spark, folder), F.pmod(F.xxhash64("dag_id", "last_success_at"), F.lit(3))
    for n in range(3):
        beats.where(third == n).write.mode("append").parquet(path)
        if n < 2:
            runs.fold_beats(spark, path)
    beats.limit(0).write.parquet(f"{path}/_folds/00000009")
    storage.delete_folder(spark, f"{path}/_folds/00000009/_SUCCESS")
    return runs.latest_beats(runs.read_beats(spark, path)).select(
        "dag_id", F.col("last_success_at").cast("timestamp_ntz").alias("last_success_at"), "run_id"
    )


def staleness(spark: SparkSession, folder: str) -> DataFrame:
    """Collectors with no success within an hour of the end of the data; one
    watched collector per instance that never existed as well."""
    ids = registry_ids(spark, folder)
    watched = ids.select(F.concat(F.lit("collect-"), F.col("instance_id").cast("string")).alias("dag_id")).unionByName(
        ids.select(F.concat(F.lit("forgotten-"), F.col("instance_id").cast("string")).alias("dag_id"))
    ).withColumn("max_age_seconds", F.lit(3600).cast("long"))
    verdicts = runs.staleness(
        watched, runs.latest_beats(_beats(spark, folder)), F.lit(span(spark, folder)[1] + timedelta(days=1)).cast("timestamp")
    )
    return verdicts.select("dag_id", "stale", rounded(F.col("age_seconds"), 3).alias("age_seconds"), "max_age_seconds")


# -- scale -----------------------------------------------------------------------
def scale_replicate_day(spark: SparkSession, folder: str) -> DataFrame:
    """Daily fact over 60 replicated days of one closed day."""
    raw = scale.replicate_day(fleet_source(spark, folder, "query_snapshot"), "2024-01-12", "2024-02-01", 60)
    w = Warehouse(spark, lambda _: raw, "", PARAMS)
    return w.build_fact("fct_query_daily").drop("query_text")


def scale_slow_down(spark: SparkSession, folder: str) -> DataFrame:
    raw = scale.slow_down(fleet_source(spark, folder, "query_snapshot"), span(spark, folder)[1])
    return raw.groupBy("query_id", "dt").agg(F.count(F.lit(1)).alias("rows"),
                                             rounded(F.sum("total_time_ms"), 3).alias("total_time_ms"))


def scale_spread_instances(spark: SparkSession, folder: str) -> DataFrame:
    """Two synthetic instances for each base one, cycling over all of them."""
    base = [r[0] for r in registry_ids(spark, folder).collect()]  # a registry: one number a database
    raw = scale.spread_instances(fleet_source(spark, folder, "query_snapshot"), base, 2 * len(base))
    return raw.groupBy("instance_id", "query_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("id").alias("id_sum"), F.sum("calls").alias("calls")
    )


def scale_daily_commits(spark: SparkSession, folder: str) -> DataFrame:
    """The versions left behind by one commit per day."""
    lake = Lake(spark, fresh_dir(spark, "lake"))
    scale.daily_commits(lake, "health_sample", fleet_source(spark, folder, "health_sample"), days_of(spark, folder))
    return lake.snapshots().select("version", "changes", "row_count")


def _builtin() -> dict[str, Query]:
    named: dict[str, Query] = {}
    named.update({name: _staging(name) for name in STAGING})
    named["dim_instance"] = lambda spark, folder: warehouse(spark, folder).table("dim_instance")
    named["int_change_events"] = lambda spark, folder: warehouse(spark, folder).table("int_change_events")
    named.update({name: _fact(name) for name in FACTS})
    named.update({name: _mart(name) for name in MARTS})
    named.update({name: _serving(name) for name in serving.SERVING})
    named.update({f"incremental_{name}": _incremental(name) for name in FACTS})
    named.update({f"incremental_{name}": _incremental_mart(name) for name in (*FROM_STATE, *SETTLED)})
    for f in (
        offload_extract_day, offload_primary, offload_auxiliary, offload_connections, offload_registry, offload_overwrite, offload_guard,
        instance_thresholds, lake_publish, lake_publish_after_failures, lake_load_partitions, lake_time_travel, lake_snapshots, lake_correct_row,
        lake_delete_rolled_back, lake_expire, lake_compact, lake_maintenance, lake_measure, quality_source_counts,
        quality_landed_counts, quality_newest_watermark, quality_reconciliation, quality_completeness,
        quality_freshness, quality_schema_drift, quality_gate, quality_gate_auxiliary, quality_day_status,
        quality_data_tests, quality_violations, quality_duplicate_polls, quality_contracts,
        quality_two_sided_report, run_log, heartbeat_latest, heartbeat_folded, staleness, scale_replicate_day, scale_slow_down,
        scale_spread_instances, scale_daily_commits,
    ):
        named[f.__name__] = f
    return named


QUERIES = _builtin()
