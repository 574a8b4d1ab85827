"""Time the headline queries on landed tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from obsmart import scale  # noqa: E402
from obsmart.plans.facts import FACTS  # noqa: E402
from obsmart.plans.marts import MARTS  # noqa: E402
from obsmart.plans.serving import SERVING  # noqa: E402
from obsmart.plans.warehouse import Warehouse, refresh_fact  # noqa: E402
from obsmart.quality import gate  # noqa: E402
from obsmart.registry import PARAMS  # noqa: E402
from obsmart.session import fresh_dir, local_session  # noqa: E402
from obsmart.sources.fleet import fleet_source  # noqa: E402
from obsmart.sources.landing import days_between  # noqa: E402
from obsmart.sources.tables import RAW_TABLES, raw_table  # noqa: E402

HEADLINE = [
    "stg_query_snapshot", "fct_query_daily", "fct_query_hourly", "fct_size_daily", "fct_wait_event_daily",
    "fct_backup_daily", "fct_plan_change_daily", "fct_index_daily", "fct_config_change_daily", "fct_uptime_daily",
    "mart_query_regression", "mart_baseline_longterm", "mart_capacity_forecast", "mart_wait_top",
    "mart_plan_regression", "mart_backup_rpo", "mart_weekly_ops_report", "mart_index_verdict", "mart_config_change",
    "mart_config_impact", "mart_uptime_slo", "incremental_fct_query_daily", "scale_replicate_day", "quality_gate",
    "serve_regression_ranking", "serve_daily_trend", "serve_weekly_report",
]


#: Runs of each query, of which the median counts.
RUNS = 3
YEAR_FIRST, YEAR_DAYS, YEAR_INSTANCES = "2024-02-01", 365, 600


def year(spark, folder: str, timed) -> int:
    """Full and incremental rebuild of the daily query fact over a year of a
    600-database fleet, grown from one day of the given tables (not timed)."""
    raw = fleet_source(spark, folder, "query_snapshot").where("dt = date'2024-01-12'")
    base = sorted(r[0] for r in raw.select("instance_id").distinct().collect())
    one = scale.spread_instances(raw, base, YEAR_INSTANCES)
    root = fresh_dir(spark, "year")
    one.write.parquet(f"{root}/day")
    grown = scale.replicate_day(spark.read.parquet(f"{root}/day"), "2024-01-12", YEAR_FIRST, YEAR_DAYS)
    grown.hint("rebalance", F.col("dt")).write.partitionBy("dt").parquet(f"{root}/raw")
    w = Warehouse(spark, lambda _: spark.read.parquet(f"{root}/raw"), f"{root}/facts")
    rows = timed("year_count", lambda: w.raw("").count())
    timed("year_daily_fact_full", lambda: refresh_fact(w, "fct_query_daily", full=True))
    timed("year_daily_fact_one_day", lambda: refresh_fact(w, "fct_query_daily"))
    timed("year_regression", lambda: run(w.build_mart("mart_query_regression")))
    return rows


def landed(spark, folder: str) -> Warehouse:
    """All raw tables of the fleet landed by day, all facts and the marts that
    others read written: what a day's run finds (not timed)."""
    root = fresh_dir(spark, "bench")

    def land(name: str) -> None:
        fleet_source(spark, folder, name).hint("rebalance", F.col("dt")).write.partitionBy("dt").parquet(f"{root}/raw/{name}")

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(land, RAW_TABLES))
    w = Warehouse(spark, lambda name: spark.read.parquet(f"{root}/raw/{name}"), f"{root}/facts", PARAMS)
    w.prepare(*MARTS)
    for name in MARTS:
        w.stored(name)
    return w


def headline(w: Warehouse, name: str):
    """What is timed under a headline query's name."""
    raw = w.raw("query_snapshot")
    if name == "incremental_fct_query_daily":  # the newest day, loaded again
        return lambda: refresh_fact(w, "fct_query_daily")
    if name == "scale_replicate_day":
        day = raw.agg(F.min("dt")).first()[0]
        grown = Warehouse(w.spark, lambda _: scale.replicate_day(raw, day, YEAR_FIRST, 60), "", PARAMS)
        return lambda: run(grown.build_fact("fct_query_daily"))
    if name == "quality_gate":
        first, last = raw.agg(F.min("dt"), F.max("dt")).first()
        ids, days = raw.select("instance_id").distinct(), days_between(first, last)
        return lambda: run(gate.evaluate(w.spark, raw.drop("dt"), raw, ids, raw_table("query_snapshot"), days, PARAMS))
    if name in SERVING:
        return lambda: run(SERVING[name](lambda table: w.stored(table) if table in MARTS else w.table(table)))
    if name in MARTS:
        return lambda: run(w.build_mart(name))
    return lambda: run(w.build_fact(name) if name in FACTS else w.staging(name))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, cores, **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    w = landed(spark, folder)
    seconds = {}

    def timed(name, work, runs: int = 1):
        took = []
        for _ in range(runs):
            start = time.monotonic()
            result = work()
            took.append(time.monotonic() - start)
        seconds[name] = round(statistics.median(took), 3)
        return result

    for name in HEADLINE:
        timed(name, headline(w, name), RUNS)
    rows = year(spark, folder, timed)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
        "year_rows": rows,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
