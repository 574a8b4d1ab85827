"""Golden vectors of the verdict marts."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

import pytest
from rows import at, d, frame, result

from obsmart.params import DEFAULTS
from obsmart.plans import facts, marts


def daily(instance, query, day, calls, latency, text="t"):
    when = d(day) if isinstance(day, str) else day
    return (instance, query, when, text, calls, None if latency is None else calls * latency, latency)


def test_regression_compares_recent_with_prior_window(spark):
    rows = [
        daily(1, "qA", "02-01", 200, 20.0), daily(1, "qA", "01-10", 200, 10.0), daily(1, "qB", "02-01", 200, 10.0),
        daily(1, "qB", "01-10", 200, 10.0), daily(1, "qC", "01-10", 200, 10.0), daily(1, "qD", "02-01", 50, 99.0),
        daily(1, "qD", "01-10", 50, 1.0),
    ]
    (row,) = result(marts.mart_query_regression(frame(spark, "daily", *rows)))
    assert row["query_id"] == "qA" and (row["recent_latency_ms"], row["prior_latency_ms"]) == (20.0, 10.0)
    assert (row["latency_increase_ms"], row["latency_increase_pct"]) == (10.0, 100.0)
    assert (row["recent_days_seen"], row["prior_days_seen"], row["recent_delta_calls"]) == (1, 1, 200)


def test_regression_window_edges(spark):
    """Newest day 02-10: 02-04 is recent, 02-03 and 01-05 are prior, 01-04 is outside."""
    rows = [daily(1, "q", day, 100, ms) for day, ms in
            (("02-10", 5.0), ("02-04", 5.0), ("02-03", 1.0), ("01-05", 3.0), ("01-04", 1000.0))]
    (row,) = result(marts.mart_query_regression(frame(spark, "daily", *rows)))
    assert (row["recent_days_seen"], row["prior_days_seen"], row["prior_latency_ms"]) == (2, 2, 2.0)


def test_baseline_top_k_and_minimum(spark):
    ddl = "instance_id BIGINT, query_id STRING, dt DATE, hour SMALLINT, delta_calls BIGINT"
    from obsmart.sources.local import local_frame

    sunday = d("01-04")
    rows = [(1, q, sunday + timedelta(days=7 * w), 5, c + w) for q, c in (("big", 100), ("mid", 50), ("small", 1)) for w in range(3)]
    rows.append((1, "big", sunday, 6, 1000))
    p = replace(DEFAULTS, baseline_top_k=2, baseline_min_observations=2)
    got = result(marts.mart_baseline_longterm(local_frame(spark, rows, ddl), p), key="query_id")
    assert set(got) == {"big", "mid"}  # rank 3 is cut, hour 6 was seen only once
    assert (got["mid"]["dow"], got["mid"]["hour"], got["mid"]["observations"]) == (0, 5, 3)
    assert (got["mid"]["mean_delta_calls"], got["mid"]["stddev_delta_calls"]) == (51.0, 1.0)


def sizes(instance, n, first, step, limit=None, day="01-01"):
    return [(instance, "table", "t", d(day) + timedelta(days=i), first + step * i, None, limit) for i in range(n)]


@pytest.mark.parametrize(
    "rows, seed, expected",
    [
        (sizes(1, 20, 10**9, 10**7), [(1, 2 * 10**9, "physical")],
         {"days_observed": 20, "learning": False, "current_bytes": 1_190_000_000, "slope_bytes_per_day": 1e7,
          "days_to_threshold": 81.0, "risk_flag": "d90", "threshold_kind": "physical", "trend_r2": 1.0}),
        (sizes(1, 14, 2 * 10**9, -(10**7)), [(1, 3 * 10**9, "physical")],
         {"days_to_threshold": None, "risk_flag": "stable_or_shrinking"}),
        (sizes(1, 14, 10**9, 10**7, 2 * 10**9), [],
         {"threshold_bytes": 2 * 10**9, "threshold_kind": "volume_reported", "days_to_threshold": 87.0, "risk_flag": "d90"}),
        (sizes(1, 13, 10**9, 10**7), [], {"learning": True, "risk_flag": "learning", "days_to_threshold": None}),
        (sizes(1, 14, 10**9, 10**7), [], {"threshold_kind": "none", "risk_flag": "growth_only"}),
        (sizes(1, 20, 10**9, 10**7), [(1, 10**9, "physical")], {"days_to_threshold": None, "risk_flag": "d30"}),
        (sizes(1, 1, 10**9, 0), [], {"slope_bytes_per_day": None, "risk_flag": "learning"}),
    ],
    ids=["d90", "shrinking", "volume", "learning", "growth-only", "already-over", "one-day"],
)
def test_capacity(spark, rows, seed, expected):
    (row,) = result(marts.mart_capacity_forecast(frame(spark, "size", *rows), frame(spark, "capacity_thresholds", *seed)))
    assert {k: row[k] for k in expected} == expected


def test_capacity_window_is_31_dates(spark):
    rows = sizes(1, 40, 10**9, 10**7)
    (row,) = result(marts.mart_capacity_forecast(frame(spark, "size", *rows), frame(spark, "capacity_thresholds")))
    assert row["days_observed"] == 31


def plans(*days, query="q", instance=1):
    return [(i, instance, query, h, at(f"{day} 12:00"), d(day)) for i, (day, h) in enumerate(days)]


def judge(spark, plan_rows, daily_rows, seed=()):
    return result(
        marts.mart_plan_regression(
            facts.fct_plan_daily(frame(spark, "plan", *plan_rows)), frame(spark, "daily", *daily_rows),
            frame(spark, "plan_regression_thresholds", *seed),
        ),
        key="flip_dt",
    )


def test_plan_regressed_with_stricter_rule(spark):
    got = judge(spark, plans(("01-09", "A"), ("01-10", "B")),
                [daily(1, "q", "01-09", 500, 10.0), daily(1, "q", "01-10", 500, 999.0), daily(1, "q", "01-11", 500, 30.0)],
                [(1, 1.5, 200)])[d("01-10")]
    assert (got["latency_ratio"], got["before_days"], got["after_days"], got["after_calls"], got["verdict"]) == (3.0, 1, 1, 500, "REGRESSED")
    assert (got["prev_plan_hash"], got["new_plan_hash"]) == ("A", "B")


@pytest.mark.parametrize(
    "after_rows, verdict",
    [
        ([], "PENDING"),
        ([daily(1, "q", "01-12", 99, 30.0)], "NEUTRAL"),
        ([daily(1, "q", "01-12", 100, 13.0)], "REGRESSED"),
        ([daily(1, "q", "01-12", 100, 12.9)], "NEUTRAL"),
        ([daily(1, "q", "01-12", 100, 7.7)], "IMPROVED"),
        ([daily(1, "q", "01-14", 500, 30.0)], "PENDING"),
    ],
    ids=["no-after", "few-calls", "at-limit", "below-limit", "improved", "outside-window"],
)
def test_plan_verdicts(spark, after_rows, verdict):
    got = judge(spark, plans(("01-09", "A"), ("01-10", "B")), [daily(1, "q", "01-09", 500, 10.0), *after_rows])
    assert got[d("01-10")]["verdict"] == verdict


def test_plan_neighbouring_flips_are_ambiguous(spark):
    got = judge(spark, plans(("01-09", "A"), ("01-10", "B"), ("01-12", "C")),
                [daily(1, "q", f"01-{day:02d}", 500, 10.0) for day in range(7, 16)])
    assert {k: v["verdict"] for k, v in got.items()} == {d("01-10"): "AMBIGUOUS", d("01-12"): "AMBIGUOUS"}


def test_plan_of_the_day_is_the_last_one(spark):
    rows = [(1, 1, "q", "A", at("01-09 01:00"), d("01-09")), (2, 1, "q", "B", at("01-09 02:00"), d("01-09")),
            (3, 1, "q", "B", at("01-10 01:00"), d("01-10"))]
    assert judge(spark, rows, []) == {}


def test_backup_gap(spark):
    days = [daily(i, "q", "01-10", 1, 1.0) for i in (1, 2, 3)]
    backups = [(1, d("01-09"), 1, 1), (2, d("01-01"), 2, 0), (3, d("01-09"), 0, 0)]
    got = result(marts.mart_backup_rpo(frame(spark, "daily", *days), frame(spark, "backup", *backups),
                                       frame(spark, "backup_rpo_thresholds", (1, 2))), key="instance_id")
    assert [(got[i]["gap_days"], got[i]["rpo_status"], got[i]["max_gap_days"]) for i in (1, 2, 3)] == [
        (1, "ok", 2), (9, "breach", 3), (None, "no_backup_observed", 3)]
    assert got[3]["no_successful_backup"] and got[2]["last_verified_dt"] is None


def test_index_verdicts_and_observation_days(spark):
    def span(name, first, last, scans=0, unique=False):
        return [(1, "t", name, day, s, 10, unique) for day, s in ((d(first), 0), (d(last), scans))]

    rows = [*span("hot", "03-20", "03-20", 5), *span("pk", "01-05", "03-22", unique=True), *span("new", "03-20", "03-20"),
            *span("dead", "01-05", "03-22")]
    got = result(marts.mart_index_verdict(frame(spark, "index_daily", *rows)), key="index_name")
    assert {k: (v["verdict"], v["observation_days"]) for k, v in got.items()} == {
        "hot": ("in_use", 0), "pk": ("constraint_backed", 76), "new": ("insufficient_observation", 0),
        "dead": ("candidate_unused", 76)}
    assert got["hot"]["note"].startswith("used 5 times") and got["hot"]["last_used_dt"] == d("03-20")


def test_wait_top_ranks_and_ties(spark):
    ddl = ("instance_id BIGINT, event_name STRING, category STRING, dt DATE, observations BIGINT, delta_count BIGINT, "
           "delta_ms DOUBLE, last_count BIGINT, last_ms DOUBLE")
    from obsmart.sources.local import local_frame

    rows = [(1, e, "io", d(day), 1, 1, ms, 1, 2.0) for day in ("03-01", "01-30", "01-29") for e, ms in (("a", 5.0), ("b", 5.0), ("c", 9.0))]
    got = result(
        marts.mart_wait_top(local_frame(spark, rows, ddl), frame(spark, "dim", (1, "db", "MYSQL", None)),
                            replace(DEFAULTS, wait_top_k=2)), key="rank_in_instance")
    assert [(r, got[r]["event_name"], got[r]["total_delta_ms"], got[r]["days_seen"]) for r in sorted(got)] == [
        (1, "c", 18.0, 2), (2, "a", 10.0, 2)]  # 01-29 lies outside the 31 dates


def change(instance, day, key="work_mem", old="4MB", new="1MB"):
    return (instance, d(day), "config", key, "CHANGED", old, new)


def impact(spark, changes, verdicts=(), days=(), size=()):
    return marts.mart_config_impact(
        frame(spark, "change", *changes), frame(spark, "verdict", *verdicts), frame(spark, "daily", *days),
        frame(spark, "size", *size))


def test_impact_counts_flips_in_the_window(spark):
    verdicts = [(1, "q", d("01-12"), "REGRESSED"), (1, "q2", d("01-12"), "NEUTRAL"), (1, "q", d("01-20"), "REGRESSED")]
    got = result(impact(spark, [change(1, "01-10"), change(2, "01-10")], verdicts), key="instance_id")
    assert (got[1]["plan_flips_after"], got[1]["regressed_after"], got[1]["correlation"]) == (1, 1, "followed_by_regression")
    assert got[2]["correlation"] == "no_signal"


def test_impact_flip_on_the_change_day_counts(spark):
    (row,) = result(impact(spark, [change(1, "01-10")], [(1, "q", d("01-10"), "PENDING")]))
    assert (row["plan_flips_after"], row["correlation"]) == (1, "followed_by_plan_flip")


def test_impact_latency_and_size(spark):
    days = [daily(1, "q", "01-09", 10, 10.0), daily(1, "q", "01-10", 10, 500.0), daily(1, "q", "01-11", 10, 20.0)]
    (row,) = result(impact(spark, [change(1, "01-10")], days=days))
    assert (row["latency_ratio"], row["correlation"]) == (2.0, "followed_by_latency_rise")
    size = [(1, "table", "t", d(day), b, None, None) for day, b in (("01-09", 100), ("01-11", 150))]
    (row,) = result(impact(spark, [change(1, "01-10")], size=size))
    assert (row["size_ratio"], row["before_bytes"], row["correlation"]) == (1.5, 100.0, "followed_by_size_growth")


def test_impact_identical_changes_collapse_and_null_values_stay(spark):
    rows = [change(1, "01-10", old=None), change(1, "01-10", old=None), change(1, "01-10", key="other", new=None)]
    assert sorted(r["change_key"] for r in result(impact(spark, rows))) == ["other", "work_mem"]


def uptime(instance, day, samples, up, ping=5.0):
    return (instance, d(day), samples, up, samples - up, round(100.0 * up / samples, 2), ping, ping)


def test_slo_budget_and_status(spark):
    rows = [uptime(1, "01-02", 100, 80), uptime(2, "01-02", 100, 100), uptime(3, "01-01", 1000, 995), uptime(3, "01-02", 1000, 996)]
    got = result(marts.mart_uptime_slo(frame(spark, "uptime", *rows), frame(spark, "dim", (1, "db", "MYSQL", None)),
                                       frame(spark, "uptime_slo_targets", (1, 99.9), (2, 99.5))), key="instance_id")
    assert [(i, got[i]["slo_status"]) for i in sorted(got)] == [(1, "breach"), (2, "meets"), (3, "at_risk")]
    assert got[3]["worst_day"] == d("01-01") and got[3]["window_uptime_pct"] == 99.55
    assert got[2]["error_budget_remaining_pct"] == 100.0 and got[2]["instance_name"] is None


def test_slo_target_of_100_has_no_budget(spark):
    (row,) = result(marts.mart_uptime_slo(frame(spark, "uptime", uptime(1, "01-02", 10, 10)), frame(spark, "dim"),
                                          frame(spark, "uptime_slo_targets", (1, 100.0))))
    assert (row["error_budget_remaining_pct"], row["slo_status"]) == (None, "meets")


def test_config_timeline_window(spark):
    from obsmart.sources.local import local_frame

    ddl = ("instance_id BIGINT, captured_at TIMESTAMP_NTZ, dt DATE, param_name STRING, old_value STRING, new_value STRING, "
           "change_kind STRING")
    rows = [(1, at(f"{day} 01:00"), d(day), "p", None, "x", "ADDED") for day in ("04-10", "01-10", "01-09")]
    got = result(marts.mart_config_change(local_frame(spark, rows, ddl)))
    assert [r["dt"] for r in got] == [d("04-10"), d("01-10")]


def test_weekly_report(spark):
    from obsmart.sources.local import local_frame

    days = [daily(1, "q", "01-14", 1, 1.0), daily(2, "q", "01-05", 1, 1.0)]  # 2026-01-14 is a Wednesday
    capacity = local_frame(spark, [(1, 12.0, "d30"), (2, None, "odd")], "instance_id BIGINT, days_to_threshold DOUBLE, risk_flag STRING")
    waits = local_frame(spark, [(1, "io", 7.0, 1), (1, "lock", 3.0, 2)],
                        "instance_id BIGINT, event_name STRING, total_delta_ms DOUBLE, rank_in_instance BIGINT")
    flips = frame(spark, "verdict", (1, "q", d("01-12"), "REGRESSED"), (1, "q", d("01-13"), "NEUTRAL"), (1, "q", d("01-11"), "REGRESSED"))
    backups = local_frame(spark, [(1, 2, "ok")], "instance_id BIGINT, gap_days BIGINT, rpo_status STRING")
    up = frame(spark, "uptime", uptime(1, "01-12", 3, 2), uptime(1, "01-11", 100, 0))
    got = result(marts.mart_weekly_ops_report(frame(spark, "daily", *days), frame(spark, "dim", (1, "db", "MYSQL", None)),
                                              capacity, waits, flips, backups, up), key="instance_id")
    one = got[1]
    assert (one["week_start"], one["week_end"], one["is_partial_week"]) == (d("01-12"), d("01-18"), True)
    assert (one["capacity_worst_risk"], one["min_days_to_threshold"], one["top_wait_event"]) == ("d30", 12.0, "io")
    assert (one["plan_flips_this_week"], one["plan_regressed_this_week"], one["this_week_uptime_pct"]) == (2, 1, 66.67)
    assert (got[2]["capacity_worst_risk"], got[2]["plan_flips_this_week"], got[2]["backup_status"]) == (None, 0, None)


def test_rounding_follows_the_double(spark):
    from pyspark.sql import functions as F

    from obsmart.functions import rounded

    row = spark.range(1).select(*[rounded(F.lit(x), 2).alias(str(i)) for i, x in enumerate((1.005, 0.285, 2.675, -1.5))]).first()
    assert tuple(row) == (1.0, 0.28, 2.68, -1.5)
