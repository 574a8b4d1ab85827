"""Physical plans: no products of tables, pruned scans, combined shuffles."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from obsmart.plans import facts, marts, staging
from obsmart.plans.marts import MARTS
from obsmart.quality import gate
from obsmart.registry import warehouse
from obsmart.session import fresh_dir
from obsmart.sources import landing
from obsmart.sources.fleet import fleet_source
from obsmart.sources.tables import raw_table

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def unbroadcast(spark):
    """Plans as they are when no side is small enough to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


@pytest.fixture(scope="module")
def landed(spark):
    root = fresh_dir(spark, "plans")
    for name in ("query_snapshot", "health_sample", "index_usage_snapshot"):
        landing.land(fleet_source(spark, FOLDER, name), root, raw_table(name))
    return lambda name: landing.read_landed(spark, root, name)


@pytest.mark.parametrize("name", [*facts.FACTS, *MARTS])
def test_no_products_and_no_python(unbroadcast, name):
    w = warehouse(unbroadcast, FOLDER)
    text = plan(w.build_fact(name) if name in facts.FACTS else w.build_mart(name))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert bad not in text


@pytest.mark.parametrize("name", [*facts.FACTS, *MARTS])
def test_windows_are_always_partitioned(unbroadcast, name):
    w = warehouse(unbroadcast, FOLDER)
    text = plan(w.build_fact(name) if name in facts.FACTS else w.build_mart(name))
    for window in re.findall(r"(?<!Group)\bWindow \[.*", text):
        assert "windowspecdefinition(specifiedwindowframe" not in window and not re.search(r"windowspecdefinition\(\w+#\d+L? (ASC|DESC)", window)


def test_daily_fact_reads_only_what_it_needs_and_combines_before_each_exchange(unbroadcast, landed):
    raw = landed("query_snapshot")
    text = plan(facts.fct_query_daily(staging.stg_query_snapshot(raw), raw))
    counters, texts = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    assert "query_text" not in counters and "rows_examined" not in counters and "calls" not in texts
    lines = text.splitlines()
    for n, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and "ENSURE_REQUIREMENTS" in line:
            assert "partial_" in lines[n + 1], line
    assert "Window" not in text


def test_incremental_bound_prunes_folders(spark, landed):
    raw = landed("query_snapshot").where(F.col("dt") >= F.lit(date(2024, 1, 28)))
    text = plan(facts.fct_query_hourly(staging.stg_query_snapshot(raw)))
    assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ >= 2024-01-28", text)


def test_marts_prune_by_the_newest_day(spark):
    w = warehouse(spark, FOLDER)
    for mart, fact in ((marts.mart_index_verdict, "fct_index_daily"), (marts.mart_query_regression, "fct_query_daily")):
        assert re.search(r"PartitionFilters: \[[^\]]*dt#\d+ > date_sub\(Subquery", plan(mart(w.fact(fact))))


def test_top_k_is_limited_before_the_shuffle(unbroadcast):
    text = plan(warehouse(unbroadcast, FOLDER).build_mart("mart_baseline_longterm"))
    assert text.count("WindowGroupLimit") == 2


def test_a_query_with_a_third_of_all_rows_gives_the_same_fact(spark):
    """The hot query's polls equal a brute-force first/last over its rows."""
    raw = fleet_source(spark, FOLDER, "query_snapshot")
    hot = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    skewed = raw.withColumn("query_id", F.when(hot, "hot").otherwise(F.col("query_id"))).withColumn(
        "instance_id", F.when(hot, F.lit(1).cast("long")).otherwise(F.col("instance_id")))
    got = {
        (r["instance_id"], r["query_id"], r["dt"]): r["delta_calls"]
        for r in facts.fct_query_daily(staging.stg_query_snapshot(skewed), skewed).collect()
    }
    polls: dict = {}
    for r in skewed.collect():
        series = polls.setdefault((r["instance_id"], r["query_id"], r["dt"]), {})
        series[r["captured_at"]] = series.get(r["captured_at"], 0) + r["calls"]
    assert got == {k: max(0, s[max(s)] - s[min(s)]) for k, s in polls.items()}


def test_the_gate_reads_each_side_once(spark, landed):
    registry = fleet_source(spark, FOLDER, "dim_instance").select(F.col("id").alias("instance_id")).distinct()
    path = f"{fresh_dir(spark, 'source')}/health"
    fleet_source(spark, FOLDER, "health_sample").drop("dt").write.parquet(path)
    days = [date(2024, 1, d) for d in (10, 11)]
    checks = gate.evaluate(spark, spark.read.parquet(path), landed("health_sample"), registry, raw_table("health_sample"), days)
    text = checks._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[[^\]]*ping_millis", text)) == 2
