"""Two databases, two days: all ten sources through staging, facts and marts."""

from __future__ import annotations

import pytest
from rows import at, d, poll, result

from obsmart.plans.warehouse import Warehouse
from obsmart.session import fresh_dir
from obsmart.sources.local import local_frame
from obsmart.sources.tables import raw_table


def _moments(kind, rows):
    """Fill (id, …, dt) rows of a raw table: dt follows the high-water column."""
    table = raw_table(kind)
    where = table.columns.index(table.watermark)
    return [(*r, r[where].date()) for r in rows]


def _raw(spark):
    def size(i, inst, name, when, data):
        return (i, inst, at(when), "table", name, 1, data, data // 10, None, None, None)

    def ping(i, inst, when, up, ms):
        return (i, inst, at(when), up, ms)

    polls = [
        poll(1, "q1", "01-01 06:00", 0, 0), poll(1, "q1", "01-01 12:00", 120, 1200), poll(1, "q1", "01-01 12:00", 80, 800),
        poll(1, "q1", "01-01 23:00", 200, 2000), poll(1, "q1", "01-02 06:00", 1000, 20000),
        poll(1, "q1", "01-02 23:00", 1300, 29000), poll(2, "q2", "01-01 06:00", 500, 5000),
        poll(2, "q2", "01-01 23:00", 100, 1000), poll(2, "q2", "01-02 06:00", 100, 1000), poll(2, "q2", "01-02 23:00", 400, 12000),
    ]
    rows = {
        "query_snapshot": [(i, p[0], p[3], p[1], p[7], p[4], p[5], p[6]) for i, p in enumerate(polls)],
        "size_snapshot": [
            size(1, 1, "orders", "01-01 06:00", 100_000), size(2, 1, "orders", "01-01 23:00", 110_000),
            size(3, 1, "orders", "01-02 23:00", 120_000), size(4, 2, "log", "01-01 23:00", 50_000),
        ],
        "wait_event_snapshot": [(1, 1, at("01-01 06:00"), "io/file", "io", 100, 1000.0), (2, 1, at("01-01 23:00"), "io/file", "io", 150, 1500.0)],
        "backup_run": [
            (1, 1, at("01-01 02:00"), "SUCCESS", "FULL", 5, None, "/b/1", "VERIFIED", at("01-02 02:00"), "s3/1"),
            (2, 1, at("01-01 03:00"), "FAILED", "LOG", 5, "disk", None, None, None, None),
        ],
        "plan_snapshot": [
            (1, 1, "q1", "h1", None, at("01-01 06:00")), (2, 1, "q1", "h1", None, at("01-01 12:00")),
            (3, 1, "q1", "h1", None, at("01-02 06:00")), (4, 1, "q1", "h2", None, at("01-02 12:00")),
        ],
        "index_usage_snapshot": [(1, 1, at("01-01 06:00"), "orders", "idx_a", 100, 10, False), (2, 1, at("01-01 23:00"), "orders", "idx_a", 340, 10, False)],
        "config_snapshot": [(1, 1, at("01-01 06:00"), "x", 0, True), (2, 1, at("01-01 12:00"), "y", 1, False)],
        "config_param_change": [(1, 2, 1, at("01-01 12:00"), "work_mem", "4MB", "1MB", "CHANGED")],
        "health_sample": [
            ping(1, 1, "01-01 06:00", True, 10), ping(2, 1, "01-01 07:00", True, 10), ping(3, 1, "01-01 08:00", True, 10),
            ping(4, 1, "01-01 09:00", False, 0), ping(5, 2, "01-01 06:00", True, 3), ping(6, 2, "01-01 07:00", True, 3),
        ],
    }
    frames = {}
    for name, values in rows.items():
        schema = raw_table(name).landed_schema
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        frames[name] = local_frame(spark, _moments(name, values), ddl)
    frames["dim_instance"] = local_frame(
        spark, [(1, "db1", "MYSQL", None, d("01-01")), (2, "db2", "POSTGRESQL", "core", d("01-01"))],
        "id BIGINT, name STRING, type STRING, team_label STRING, dt DATE",
    )
    return frames


@pytest.fixture(scope="module")
def tables(spark):
    w = Warehouse(spark, _raw(spark).get, fresh_dir(spark, "tiny"))
    return lambda name: result(w.table(name))


def test_facts(tables):
    orders = [r for r in tables("fct_size_daily") if r["object_name"] == "orders" and r["dt"] == d("01-01")]
    assert [r["total_bytes"] for r in orders] == [121_000]
    (wait,) = tables("fct_wait_event_daily")
    assert (wait["delta_count"], wait["delta_ms"], wait["observations"], wait["last_count"], wait["last_ms"]) == (50, 500.0, 2, 150, 1500.0)
    (backup,) = tables("fct_backup_daily")
    assert [backup[c] for c in ("total_runs", "success_runs", "failed_runs", "log_runs", "verified_runs", "offsite_runs")] == [2, 1, 1, 1, 1, 1]
    assert {r["dt"]: (r["plan_changes"], r["queries_flipped"]) for r in tables("fct_plan_change_daily")} == {d("01-01"): (2, 1), d("01-02"): (2, 1)}
    assert [r["delta_scans"] for r in tables("fct_index_daily")] == [240]
    (config,) = tables("fct_config_change_daily")
    assert (config["cycles_collected"], config["change_events"], config["params_changed"]) == (2, 1, 1)
    assert {r["instance_id"]: (r["uptime_pct"], r["avg_ping_ms"]) for r in tables("fct_uptime_daily")} == {1: (75.0, 10.0), 2: (100.0, 3.0)}
    assert {r["instance_id"]: r["engine"] for r in tables("dim_instance")} == {1: "MYSQL", 2: "POSTGRESQL"}


def test_marts(tables):
    assert tables("mart_query_regression") == []  # both days lie in the recent window
    (plan,) = tables("mart_plan_regression")
    assert (plan["flip_dt"], plan["before_days"], plan["after_days"], plan["verdict"]) == (d("01-02"), 1, 0, "PENDING")
    (impact,) = tables("mart_config_impact")
    assert impact["correlation"] == "followed_by_plan_flip"
    assert {r["instance_id"]: r["rpo_status"] for r in tables("mart_backup_rpo")} == {1: "ok", 2: "no_backup_observed"}
    assert {r["risk_flag"] for r in tables("mart_capacity_forecast")} == {"learning"}
    report = {r["instance_id"]: r for r in tables("mart_weekly_ops_report")}
    assert report[1]["top_wait_event"] == "io/file" and report[2]["backup_status"] == "no_backup_observed"
    assert report[1]["plan_flips_this_week"] == 1 and report[1]["capacity_worst_risk"] == "learning"
