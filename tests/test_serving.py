"""Dashboard queries: optional instance filter, ordering, NULL placement."""

from __future__ import annotations

from datetime import date, datetime

from rows import d, frame, result

from obsmart.plans import serving
from obsmart.sources.local import local_frame


def test_one_instance_or_all(spark):
    tables = {"fct_query_daily": frame(spark, "daily", (1, "q", d("01-02"), "t", 5, 10.4, 2.0), (2, "q", d("01-01"), "t", 7, 1.0, 1.0))}
    both = result(serving.daily_trend(tables.get))
    assert [(r["dt"], r["calls"], r["total_time_ms"]) for r in both] == [(d("01-01"), 7, 1.0), (d("01-02"), 5, 10.0)]
    assert [r["calls"] for r in result(serving.daily_trend(tables.get, 1))] == [5]


def _regressions(spark):
    ddl = ("instance_id BIGINT, query_id STRING, query_text STRING, recent_from_dt DATE, recent_to_dt DATE, "
           "recent_days_seen BIGINT, prior_days_seen BIGINT, prior_latency_ms DOUBLE, recent_latency_ms DOUBLE, "
           "latency_increase_ms DOUBLE, latency_increase_pct DOUBLE, recent_delta_calls BIGINT")
    text = "select  a,\n\n\tb from " + "x" * 80
    rows = [(i, "q" * 30, text, d("01-01"), d("01-02"), 1, 1, 1.0, 1.0 + inc, inc, 1.0, 100) for i, inc in ((1, 2.0), (2, 5.0))]
    return {"mart_query_regression": local_frame(spark, rows, ddl)}.get


def test_regression_ranking_shortens_and_sorts(spark):
    rows = result(serving.regression_ranking(_regressions(spark)))
    assert [r["instance_id"] for r in rows] == [2, 1] and len(rows[0]["query_id"]) == 20
    assert rows[0]["query"] == ("select a, b from " + "x" * 80)[:60]
    assert result(serving.regressed_count(_regressions(spark), 1)) == [{"regressed_queries": 1}]


def test_backup_gaps_put_unobserved_first_and_null_gaps_last(spark):
    ddl = ("instance_id BIGINT, as_of_dt DATE, last_success_dt DATE, gap_days BIGINT, no_successful_backup BOOLEAN, "
           "max_gap_days BIGINT, rpo_status STRING")
    rows = [(1, d("01-10"), d("01-01"), 9, False, 3, "breach"), (2, d("01-10"), None, None, True, 3, "no_backup_observed"),
            (3, d("01-10"), d("01-09"), 1, False, 3, "ok"), (4, d("01-10"), d("01-05"), 5, False, 3, "breach")]
    got = result(serving.backup_gaps({"mart_backup_rpo": local_frame(spark, rows, ddl)}.get))
    assert [r["instance_id"] for r in got] == [2, 1, 4]


def test_run_log_cards(spark):
    ddl = ("dt DATE, run_id STRING, run_at TIMESTAMP, duration_sec DOUBLE, gate_status STRING, gate_reconciliation STRING, "
           "gate_completeness STRING, gate_freshness STRING, gate_schema_drift STRING, offload_rows BIGINT, "
           "published_rows BIGINT, heartbeat_at TIMESTAMP")
    rows = [(date(2026, 1, n % 28 + 1), f"r{n}", datetime(2026, 1, 1, n % 24, n), 1.25, "FAIL" if n == 27 else "OK", "OK", "OK", "OK", "OK", 1, 1, None)
            for n in range(40)]
    tables = {"pipeline_run_log": local_frame(spark, rows, ddl)}.get
    assert serving.recent_runs(tables).count() == serving.RECENT_RUNS
    assert result(serving.last_successful_day(tables)) == [{"last_success_dt": date(2026, 1, 27)}]
    assert result(serving.latest_gate(tables))[0]["run_at"] == max(r[2] for r in rows)
