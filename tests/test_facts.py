"""Golden vectors and properties of the staging fold and the facts."""

from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import at, d, frame, poll, result

from obsmart.plans import facts, staging


def test_fold_sums_interleaved_series(spark):
    raw = frame(spark, "query", poll(1, "q1", "01-01 12:00", 120, 1200), poll(1, "q1", "01-01 12:00", 80, 800, "u"))
    (row,) = result(staging.stg_query_snapshot(raw), "calls", "total_time_ms", "query_text")
    assert row == {"calls": 200, "total_time_ms": 2000.0, "query_text": "u"}


@pytest.mark.parametrize(
    "polls, expected",
    [
        ([("06:00", 100, 1000), ("12:00", 250, 2800), ("23:00", 300, 4000)], (200, 3000.0, 15.0)),
        ([("06:00", 500, 5000), ("23:00", 100, 1000)], (0, 0.0, None)),
        ([("06:00", 777, 9999)], (0, 0.0, None)),
    ],
    ids=["first-vs-last", "reset-clamps", "single-poll"],
)
def test_daily_delta(spark, polls, expected):
    rows = [poll(1, "q1", f"01-01 {t}", calls, ms) for t, calls, ms in polls]
    (row,) = result(facts.fct_query_daily(frame(spark, "query", *rows)))
    assert (row["delta_calls"], row["delta_total_time_ms"], row["avg_latency_ms"]) == expected


def test_hourly_delta_needs_two_polls_in_the_hour(spark):
    rows = [poll(1, "q", "01-01 10:05", 10, 100), poll(1, "q", "01-01 10:55", 30, 500), poll(1, "q", "01-01 11:05", 90, 900)]
    by_hour = result(facts.fct_query_hourly(frame(spark, "query", *rows)), key="hour")
    assert (by_hour[10]["delta_calls"], by_hour[10]["avg_latency_ms"]) == (20, 20.0)
    assert (by_hour[11]["delta_calls"], by_hour[11]["avg_latency_ms"]) == (0, None)


def test_tiny_fleet_end_to_end(spark):
    raw = frame(
        spark, "query",
        poll(1, "q1", "01-01 06:00", 0, 0), poll(1, "q1", "01-01 12:00", 120, 1200), poll(1, "q1", "01-01 12:00", 80, 800),
        poll(1, "q1", "01-01 23:00", 200, 2000), poll(1, "q1", "01-02 06:00", 1000, 20000),
        poll(1, "q1", "01-02 23:00", 1300, 29000), poll(2, "q2", "01-01 06:00", 500, 5000),
        poll(2, "q2", "01-01 23:00", 100, 1000), poll(2, "q2", "01-02 06:00", 100, 1000), poll(2, "q2", "01-02 23:00", 400, 12000),
    )
    daily = facts.fct_query_daily(staging.stg_query_snapshot(raw), raw)
    got = {(r["instance_id"], r["dt"]): (r["delta_calls"], r["delta_total_time_ms"], r["avg_latency_ms"]) for r in result(daily)}
    assert got[(1, d("01-01"))] == (200, 2000.0, 10.0)
    assert got[(1, d("01-02"))] == (300, 9000.0, 30.0)
    assert got[(2, d("01-01"))] == (0, 0.0, None)
    assert got[(2, d("01-02"))][:2] == (300, 11000.0)


def test_size_keeps_last_observation_and_breaks_ties_by_id(spark):
    ddl = (
        "id BIGINT, instance_id BIGINT, captured_at TIMESTAMP_NTZ, dt DATE, object_type STRING, object_name STRING, "
        "row_estimate BIGINT, data_bytes BIGINT, index_bytes BIGINT, volume_total_bytes BIGINT, "
        "volume_available_bytes BIGINT, max_bytes BIGINT"
    )
    rows = [(i, 1, at(f"01-01 {h}:00"), d("01-01"), "table", "t", 1, b, 10, None, None, None)
            for i, h, b in ((1, "06", 100), (2, "23", 200), (3, "23", 300))]
    from obsmart.sources.local import local_frame

    (row,) = result(facts.fct_size_daily(staging.stg_size_snapshot(local_frame(spark, rows, ddl))))
    assert row["total_bytes"] == 310


def test_wait_event_keeps_delta_and_last_state(spark):
    rows = [
        (1, 1, at("01-01 01:00"), d("01-01"), "io/file", "io", 100, 1000.0),
        (2, 1, at("01-01 05:00"), d("01-01"), "io/file", None, 150, 1500.0),
        (3, 1, at("01-01 05:00"), d("01-01"), "io/file", None, 160, 1600.0),
    ]
    (row,) = result(facts.fct_wait_event_daily(frame(spark, "wait", *rows)))
    assert row["category"] == "io" and row["observations"] == 2
    assert (row["delta_count"], row["delta_ms"], row["last_count"], row["last_ms"]) == (60, 600.0, 160, 1600.0)


def _usage(*readings, unique=False):
    return [
        (i, 1, at(f"01-01 {h:02d}:00"), d("01-01"), "t", "i", scans, size, unique)
        for i, (h, scans, size) in enumerate(readings)
    ]


@pytest.mark.parametrize(
    "readings, scans, size",
    [
        ([(1, 100, 5), (9, 340, 7)], 240, 7),
        ([(1, 900, 5), (9, 50, 5)], 0, 5),
        ([(1, None, 5), (9, None, None)], 0, None),
        ([(1, 10, 5), (9, None, 6)], 0, 6),
    ],
    ids=["used", "reset", "never-reported", "last-reading-missing"],
)
def test_index_delta(spark, readings, scans, size):
    (row,) = result(facts.fct_index_daily(frame(spark, "index", *_usage(*readings, unique=True))))
    assert (row["delta_scans"], row["size_bytes"], row["is_unique"]) == (scans, size, True)


def test_uptime_counts_and_ping_of_successful_polls(spark):
    polls = [(i, 1, at(f"01-01 0{i}:00"), d("01-01"), up, ping) for i, (up, ping) in
             enumerate([(True, 10), (True, 10), (True, 10), (False, 100)])]
    down = [(9, 2, at("01-01 00:00"), d("01-01"), False, 7)]
    rows = result(facts.fct_uptime_daily(frame(spark, "health", *polls, *down)), key="instance_id")
    one = rows[1]
    assert (one["samples"], one["up_samples"], one["down_samples"], one["uptime_pct"], one["avg_ping_ms"]) == (4, 3, 1, 75.0, 10.0)
    assert (rows[2]["uptime_pct"], rows[2]["avg_ping_ms"], rows[2]["p95_ping_ms"]) == (0.0, None, None)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 50), min_size=1, max_size=40))
def test_p95_equals_interpolation_over_sorted_pings(spark, pings):
    polls = [(i, 1, at("01-01 00:00"), d("01-01"), True, p) for i, p in enumerate(pings)]
    (row,) = result(facts.fct_uptime_daily(frame(spark, "health", *polls)))
    position = 0.95 * (len(pings) - 1)
    low, ordered = int(position), sorted(pings)
    high = min(low + 1, len(pings) - 1)
    exact = ordered[low] + (ordered[high] - ordered[low]) * (position - low)
    assert row["p95_ping_ms"] == pytest.approx(exact, abs=0.0501)


def test_config_day_without_cycles_has_no_row(spark):
    from obsmart.sources.local import local_frame

    cycles = local_frame(spark, [(1, d("01-01")), (1, d("01-01")), (1, d("01-03"))], "instance_id BIGINT, dt DATE")
    changes = local_frame(
        spark, [(1, d("01-01"), "a"), (1, d("01-01"), "a"), (1, d("01-02"), "b")], "instance_id BIGINT, dt DATE, param_name STRING"
    )
    rows = result(facts.fct_config_change_daily(cycles, changes), key="dt")
    assert set(rows) == {d("01-01"), d("01-03")}
    assert (rows[d("01-01")]["cycles_collected"], rows[d("01-01")]["change_events"], rows[d("01-01")]["params_changed"]) == (2, 2, 1)
    assert rows[d("01-03")]["change_events"] == 0


def test_dimension_keeps_newest_snapshot_of_every_instance(spark):
    from obsmart.sources.local import local_frame

    rows = [(1, "old", "MYSQL", None, d("01-01")), (1, "new", "MYSQL", "x", d("01-02")), (2, "gone", "ORACLE", None, d("01-01"))]
    got = result(facts.dim_instance(local_frame(spark, rows, "id BIGINT, name STRING, type STRING, team_label STRING, dt DATE")),
                 key="instance_id")
    assert got[1]["instance_name"] == "new" and got[1]["team_label"] == "x" and got[2]["engine"] == "ORACLE"


def _random_polls(seed, days=2):
    rnd = random.Random(seed)
    rows = []
    for q in ("a", "b"):
        calls = ms = 0
        for day in range(1, days + 1):
            for h in sorted(rnd.sample(range(24), 5)):
                if rnd.random() < 0.1:
                    calls = ms = 0
                calls, ms = calls + rnd.randint(0, 50), ms + rnd.randint(0, 500)
                rows.append(poll(1, q, f"01-0{day} {h:02d}:30", calls, ms))
    return rows


def test_order_of_rows_does_not_matter_and_matches_brute_force(spark):
    rows = _random_polls(7)
    expected = {}
    for q in ("a", "b"):
        for day in ("01-01", "01-02"):
            series = sorted((r[3], r[4], r[5]) for r in rows if r[1] == q and r[2] == d(day))
            expected[(q, d(day))] = (max(0, series[-1][1] - series[0][1]), max(0.0, series[-1][2] - series[0][2]))
    for attempt in range(2):
        random.Random(attempt).shuffle(rows)
        got = {(r["query_id"], r["dt"]): (r["delta_calls"], r["delta_total_time_ms"])
               for r in result(facts.fct_query_daily(frame(spark, "query", *rows)))}
        assert got == expected


def test_shifting_all_dates_shifts_the_facts(spark):
    base = frame(spark, "query", *_random_polls(3))
    moved = base.withColumn("dt", F.date_add("dt", 40)).withColumn("captured_at", F.col("captured_at") + F.expr("interval 40 days"))
    want = facts.fct_query_daily(base).withColumn("dt", F.date_add("dt", 40))
    assert sorted(map(tuple, want.collect()), key=repr) == sorted(map(tuple, facts.fct_query_daily(moved).collect()), key=repr)
