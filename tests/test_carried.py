"""Carried states and settled marts: new days need no older ones, and nothing differs from a rebuild."""

from __future__ import annotations

import re
import threading
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from rows import at, d, frame

from obsmart import registry
from obsmart.plans import carried, facts, marts
from obsmart.plans.facts import fct_plan_daily
from obsmart.plans.warehouse import SETTLED, Warehouse, refresh_fact
from obsmart.session import fresh_dir
from obsmart.sources import storage
from obsmart.sources.fleet import fleet_source

FOLDER = "/root/testdata/sf0.001"
NEEDED = ["fct_query_daily", "fct_query_hourly", "fct_plan_daily", "fct_size_daily"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.drop("computed_at").select(sorted(set(df.columns) - {"computed_at"})).collect()))


class Fleet:
    """The fleet as it is known up to a day, with one day that is incomplete at first."""

    def __init__(self, spark, label, late=date(2024, 1, 22)):
        self.spark, self.until, self.late, self.corrected = spark, date(2024, 1, 20), late, False
        self.w = Warehouse(spark, self.raw, fresh_dir(spark, label))

    def raw(self, name):
        df = fleet_source(self.spark, FOLDER, name).where(F.col("dt") <= F.lit(self.until))
        if self.corrected or "instance_id" not in df.columns:
            return df
        return df.where((F.col("dt") != F.lit(self.late)) | (F.col("instance_id") % 2 == 0))

    def load(self, until=None, first=None):
        self.until = until or self.until
        starts = [refresh_fact(self.w, fact, first) for fact in NEEDED]
        return None if None in starts else min(starts)

    def rebuilt(self):
        return Warehouse(self.spark, self.raw, fresh_dir(self.spark, "rebuilt"))


@pytest.fixture(scope="module")
def fleet(spark):
    f = Fleet(spark, "carried")
    for until in (20, 23, 24):
        changed = f.load(date(2024, 1, until))
        for mart in SETTLED:
            f.w.refresh_mart(mart, changed)
    return f


def test_marts_equal_a_rebuild_before_and_after_a_late_correction(spark, fleet):
    names = ["mart_query_regression", "mart_baseline_longterm", *SETTLED]
    want = fleet.rebuilt()
    for name in names:
        got, expected = fleet.w.mart(name), want.mart(name)
        if name == "mart_baseline_longterm":
            both = got.alias("a").join(expected.alias("b"), marts.BUCKET, "full_outer")
            apart = F.greatest(F.abs(F.col("a.mean_delta_calls") - F.col("b.mean_delta_calls")),
                               F.abs(F.coalesce("a.stddev_delta_calls", F.lit(0.0)) - F.coalesce("b.stddev_delta_calls", F.lit(0.0))))
            assert both.where(apart.isNull() | (apart > 1e-9) | (F.col("a.observations") != F.col("b.observations"))).isEmpty()
        else:
            assert rows(got) == rows(expected), name
    settled = {n: storage.list_files(spark, f"{fleet.w.root}/mart_plan_regression/{n}")
               for n in storage.list_names(spark, f"{fleet.w.root}/mart_plan_regression") if "_day=" <= n < "_day=2024-01-19"}
    fleet.corrected = True
    changed = fleet.load(first=fleet.late)
    assert changed == fleet.late
    assert fleet.w.refresh_mart("mart_plan_regression", changed) == fleet.late - timedelta(days=3)
    assert fleet.w.refresh_mart("mart_config_impact", changed) == fleet.late - timedelta(days=10)
    want = fleet.rebuilt()
    for name in ("mart_query_regression", *SETTLED):
        assert rows(fleet.w.mart(name)) == rows(want.mart(name)), name
    assert settled and all(storage.list_files(spark, f"{fleet.w.root}/mart_plan_regression/{n}") == files for n, files in settled.items())


def test_marts_read_neither_raw_tables_nor_old_days(spark, fleet):
    since = date(2024, 1, 24)
    for name, first in (("mart_plan_regression", "2024-01-18"), ("mart_config_impact", "2024-01-07")):
        text = fleet.w.build_mart(name, since)._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan parquet .*?fct_\w+.*", text)
        assert scans and all(f"dt#" in s and f">= {first}" in s for s in scans if "PartitionFilters: [isnotnull(dt" in s)
        assert not [s for s in scans if "PartitionFilters: []" in s]
    text = plan(fleet.w.build_mart("mart_plan_regression", since))
    assert "events.parquet" not in text
    text = plan(fleet.w.build_mart("mart_query_regression"))
    fact = [s for s in re.findall(r"FileScan parquet .*", text) if "delta_calls" in s]
    assert fact and all(re.search(r"PartitionFilters: \[[^\]]*dt#\d+ > date_sub\(Subquery", s) for s in fact)
    text = plan(fleet.w.build_mart("mart_baseline_longterm"))
    assert "fct_query_hourly.state" in text and "delta_calls#" not in re.sub(r"mean_delta_calls#|stddev_delta_calls#", "", text)


def test_a_new_day_builds_on_a_state(spark, monkeypatch):
    f = Fleet(spark, "states")
    refresh_fact(f.w, "fct_query_hourly")
    state = carried.Carried(spark, f.w.root, "fct_query_hourly")
    read = []
    of_days, together = carried.STATES["fct_query_hourly"]

    def spy(rows_):
        read.extend(str(r[0]) for r in rows_.select("dt").distinct().collect())
        return of_days(rows_)

    monkeypatch.setitem(carried.STATES, "fct_query_hourly", (spy, together))
    for day in (21, 22, 23, 24):
        f.until = date(2024, 1, day)
        read.clear()
        assert refresh_fact(f.w, "fct_query_hourly") == date(2024, 1, day - 1)
        assert sorted(read) == [f"2024-01-{day - 1}", f"2024-01-{day}"]  # the day loaded again and the new one
        assert state.days()[-2:] == [date(2024, 1, day - 1), date(2024, 1, day)]
    assert len(state.days()) <= carried.KEPT
    refresh_fact(f.w, "fct_query_hourly", date(2024, 1, 22))
    assert state.days() == [date(2024, 1, n) for n in (19, 20, 21, 23, 24)]  # of the states that held day 22, two are new
    broken = f"{state.root}/until=2024-01-30"
    spark.range(1).write.parquet(broken)
    storage.delete_folder(spark, f"{broken}/_SUCCESS")  # as an interrupted write leaves it
    assert state.days()[-1] == date(2024, 1, 24)


def test_an_interrupted_refresh_is_made_up_for(spark, monkeypatch):
    f = Fleet(spark, "interrupted")
    f.w.refresh_mart("mart_plan_regression", f.load(date(2024, 1, 20)))
    moved = []

    def fail(spark_, source, target):
        moved.append(target)
        raise OSError("gone")

    changed = f.load(date(2024, 1, 23))
    with monkeypatch.context() as m:
        m.setattr(storage, "move", fail)
        with pytest.raises(OSError, match="gone"):
            f.w.refresh_mart("mart_plan_regression", changed)
    assert moved
    changed = f.load(date(2024, 1, 26))
    first = f.w.refresh_mart("mart_plan_regression", changed)
    assert first == date(2024, 1, 17) < marts.plan_open_from(changed)  # as far back as the one that failed
    assert rows(f.w.mart("mart_plan_regression")) == rows(f.rebuilt().mart("mart_plan_regression"))


def test_other_thresholds_judge_every_flip_again(spark, fleet):
    from dataclasses import replace

    changed = date(2024, 1, 24)
    assert fleet.w.refresh_mart("mart_plan_regression", changed) is not None
    before = fleet.w.params
    fleet.w.params = replace(before, plan_regress_ratio=1.01)
    assert fleet.w.refresh_mart("mart_plan_regression", changed) is None
    fleet.w.params = before
    assert fleet.w.refresh_mart("mart_plan_regression", None) is None


def test_plan_of_the_day_takes_up_the_carried_one(spark):
    def plans(*days):
        return frame(spark, "plan", *[(i, 1, q, h, at(f"{day} 12:00"), d(day)) for i, (day, q, h) in enumerate(days)])

    old = fct_plan_daily(plans(("01-01", "a", "h1"), ("01-01", "b", "h1"), ("01-03", "a", "h2")))
    state = carried.last_plans(old)
    assert sorted((r["query_id"], r["plan_hash"]) for r in state.collect()) == [("a", "h2"), ("b", "h1")]
    new = fct_plan_daily(plans(("01-05", "a", "h3"), ("01-06", "a", "h3"), ("01-05", "b", "h1"), ("01-05", "c", "h9")), state)
    got = {(r["query_id"], r["dt"].day): (r["prev_hash"], r["plan_hash"]) for r in new.collect()}
    assert got == {("a", 5): ("h2", "h3"), ("a", 6): ("h3", "h3"), ("b", 5): ("h1", "h1"), ("c", 5): (None, "h9")}
    assert {(r["query_id"], r["flip_dt"].day) for r in marts.plan_flips(new).collect()} == {("a", 5)}


def test_moments_merge_like_one_pass(spark):
    hourly = facts.fct_query_hourly(fleet_source(spark, FOLDER, "query_snapshot").select(
        "instance_id", "query_id", "dt", "captured_at", "calls", "total_time_ms"))
    cut = [date(2024, 1, n) for n in (1, 9, 17, 31)]
    parts = [marts.baseline_moments(hourly.where(F.col("dt").between(F.lit(a), F.lit(b - timedelta(days=1))))) for a, b in zip(cut, cut[1:], strict=False)]
    merged = marts.merged_moments(marts.merged_moments(parts[0], parts[1]), parts[2])
    both = merged.alias("a").join(marts.baseline_moments(hourly).alias("b"), marts.BUCKET, "full_outer")
    apart = F.abs(F.col("a.m2") - F.col("b.m2")) > 1e-9 * F.greatest(F.lit(1.0), F.col("b.m2"))
    assert both.where(F.col("a.n").isNull() | (F.col("a.n") != F.col("b.n")) | (F.col("a.calls") != F.col("b.calls")) | apart).isEmpty()


def test_several_tables_write_their_facts_side_by_side(spark, monkeypatch):
    w = Warehouse(spark, lambda name: fleet_source(spark, FOLDER, name), fresh_dir(spark, "side-by-side"))
    begun, fact = threading.Barrier(2, timeout=60), w.fact

    def met(name):
        if name in ("fct_size_daily", "fct_uptime_daily") and not storage.exists(spark, f"{w.root}/{name}/_SUCCESS"):
            begun.wait()  # ends only while the other is being written
        return fact(name)

    monkeypatch.setattr(w, "fact", met)
    found = w.tables(["fct_size_daily", "mart_uptime_slo", "dim_instance"])
    assert list(found) == ["fct_size_daily", "mart_uptime_slo", "dim_instance"]
    alone = Warehouse(spark, w.raw, fresh_dir(spark, "alone"))
    assert all(rows(df) == rows(alone.table(name)) for name, df in found.items())


def test_a_load_of_some_days_reads_no_older_counters(spark):
    for name in ("query_snapshot", "size_snapshot"):
        whole = fleet_source(spark, FOLDER, name)
        stored = registry.loaded_source(spark, FOLDER, name)
        assert rows(stored) == rows(whole) and stored.dtypes == whole.dtypes
        text = plan(stored.where(F.col("dt") >= F.lit(date(2024, 1, 25))))
        assert "events.parquet" not in text and re.search(r"PartitionFilters: \[[^\]]*>= 2024-01-25", text)
