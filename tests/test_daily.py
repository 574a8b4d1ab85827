"""The whole chain, day by day, from the event tables to published versions."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from obsmart.plans.daily import DailyRun
from obsmart.plans.facts import FACTS
from obsmart.plans.warehouse import PUBLISHED, SchemaChanged, Warehouse, refresh_fact
from obsmart.quality import gate, runs
from obsmart.session import fresh_dir
from obsmart.sources.fleet import fleet_source
from obsmart.sources.landing import read_landed

FOLDER = "/root/testdata/sf0.001"


def _registry(spark):
    return fleet_source(spark, FOLDER, "dim_instance").where("dt = date'2024-01-30'").drop("dt")


@pytest.fixture(scope="module")
def run(spark):
    source = {}
    chain = DailyRun(spark, lambda n: source[n], lambda: _registry(spark), fresh_dir(spark, "daily"))
    ids = [r["id"] for r in _registry(spark).collect()]

    def complete(name):
        """Every registered instance, polled until shortly before midnight."""
        df = fleet_source(spark, FOLDER, name)
        if name != "query_snapshot":
            return df.drop("dt")
        late = df.select(F.explode(F.array(*[F.lit(i) for i in ids])).alias("instance_id"), "dt").distinct().select(
            (F.unix_date("dt") * 1000 + F.col("instance_id")).cast("long").alias("id"), "instance_id",
            (F.col("dt").cast("timestamp_ntz") + F.expr("interval 23 hours")).alias("captured_at"),
            F.lit("heartbeat").alias("query_id"), F.lit(None).cast("string").alias("query_text"),
            F.lit(1).cast("long").alias("calls"), F.lit(1.0).alias("total_time_ms"), F.lit(0).cast("long").alias("rows_examined"),
        )
        return df.drop("dt").unionByName(late)

    from obsmart.sources.tables import RAW_TABLES

    source.update({n: complete(n) for n in RAW_TABLES})
    versions = [chain.run(f"2024-01-{day:02d}", f"run-{day}") for day in (10, 11)]
    return chain, versions, source


def test_each_day_publishes_all_tables(run):
    chain, versions, _ = run
    assert versions == [1, 2]
    assert chain.lake.tables() == sorted(PUBLISHED)
    days = [r["dt"] for r in chain.lake.read("fct_query_daily").select("dt").distinct().orderBy("dt").collect()]
    assert days == [date(2024, 1, d) for d in (10, 11)]
    assert chain.lake.read("fct_query_daily", 1).select("dt").distinct().count() == 1


def test_run_log_and_heartbeat(spark, run):
    chain, _, _ = run
    log = runs.read_runs(spark, chain.log).orderBy("dt").collect()
    assert [r["run_id"] for r in log] == ["run-10", "run-11"] and all(r["gate_status"] == "OK" for r in log)
    assert log[-1]["published_rows"] == chain.lake.rows() and log[0]["offload_rows"] > 0
    assert runs.latest_beats(spark.read.schema(runs.HEARTBEAT).parquet(chain.beats)).first()["run_id"] == "run-11"


def test_incremental_facts_equal_a_rebuild_from_landed_data(spark, run):
    chain, _, _ = run
    rebuilt = Warehouse(spark, lambda n: read_landed(spark, chain.raw_root, n), fresh_dir(spark, "rebuild"))
    for fact in FACTS:
        want, got = rebuilt.build_fact(fact), chain.warehouse.fact(fact)
        assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect())), fact


def _published(chain, fact):
    return sorted(map(repr, chain.lake.read(fact).select(sorted(chain.lake.read(fact).columns)).collect()))


def test_failed_publishes_and_older_days_lose_nothing(spark, run, monkeypatch):
    _, _, source = run
    missing = {"on": True}

    def rows(name):
        df = source[name]
        if name == "wait_event_snapshot" and missing["on"]:
            return df.where("to_date(captured_at) <> date'2024-01-11' or event_name <> 'click'")
        return df

    chain = DailyRun(spark, rows, lambda: _registry(spark), fresh_dir(spark, "failing"))
    chain.run("2024-01-10")
    with monkeypatch.context() as m:
        def refuse(self, staged):
            raise RuntimeError("contract")

        m.setattr(DailyRun, "check", refuse)
        for day in ("2024-01-11", "2024-01-12"):
            with pytest.raises(RuntimeError):
                chain.run(day)
    missing["on"] = False
    with monkeypatch.context() as m:  # an older day is landed again, and its publish fails as well
        m.setattr(DailyRun, "check", refuse)
        with pytest.raises(RuntimeError):
            chain.run("2024-01-11")
    assert chain.lake.versions() == [1]
    chain.run("2024-01-13")
    rebuilt = Warehouse(spark, lambda n: read_landed(spark, chain.raw_root, n), fresh_dir(spark, "rebuild"))
    for fact in (f for f in FACTS if f in PUBLISHED):
        want = rebuilt.build_fact(fact)
        assert _published(chain, fact) == sorted(map(repr, want.select(sorted(want.columns)).collect())), fact
    before = {p["path"] for p in chain.lake.manifest()["tables"]["fct_query_daily"]["parts"]}
    chain.lake.compact()
    chain.run("2024-01-14")
    after = chain.lake.manifest()["tables"]["fct_query_daily"]["parts"]
    assert len(before - {p["path"] for p in after}) <= 1 and len(after) == 5  # the newest day is replaced, one is added


def test_side_branches_do_not_stop_the_main_one(spark, run, monkeypatch):
    _, _, source = run
    empty = {"on": False}
    told = []

    def rows(name):
        return source[name].where("false") if name == "backup_run" and empty["on"] else source[name]

    def write_back(version):
        told.append(version)
        raise RuntimeError("no database")

    chain = DailyRun(spark, rows, lambda: _registry(spark), fresh_dir(spark, "side"), write_back=write_back)
    chain.run("2024-01-10")
    assert chain.problems == ["write back: no database"] and told == [1]
    empty["on"] = True

    def broken(*_):
        raise OSError("log store is down")

    monkeypatch.setattr(runs, "append_runs", broken)
    version = chain.run("2024-01-10")
    assert version == 2 and chain.lake.current_version() == 2
    kinds = [p.split(":")[0] for p in chain.problems]
    assert kinds == ["backup_run", "write back", "run log"]


def test_gate_failure_blocks_before_anything_is_published(spark, run):
    chain, _, source = run
    half = source["query_snapshot"].where(F.hour("captured_at") < 9)
    broken = DailyRun(spark, lambda n: half if n == "query_snapshot" else source[n], lambda: _registry(spark),
                      fresh_dir(spark, "broken"))
    with pytest.raises(gate.GateBlocked):
        broken.run("2024-01-10")
    assert broken.lake.versions() == []


def test_incremental_load_refuses_changed_columns(spark):
    w = Warehouse(spark, lambda n: fleet_source(spark, FOLDER, n), fresh_dir(spark, "drift"))
    w.build_fact("fct_backup_daily").withColumn("extra", F.lit(1)).write.partitionBy("dt").parquet(f"{w.root}/fct_backup_daily")
    with pytest.raises(SchemaChanged):
        refresh_fact(w, "fct_backup_daily")
    assert refresh_fact(w, "fct_backup_daily", full=True) is None
    assert "extra" not in w.fact("fct_backup_daily").columns


def test_vanished_key_disappears_on_reload_and_late_days_can_be_redone(spark):
    state = {"skip": None}

    def raw(name):
        df = fleet_source(spark, FOLDER, name)
        return df.where(F.col("event_name") != state["skip"]) if state["skip"] else df

    w = Warehouse(spark, raw, fresh_dir(spark, "late"))
    assert refresh_fact(w, "fct_wait_event_daily") is None
    before = w.fact("fct_wait_event_daily").count()
    state["skip"] = "click"
    assert refresh_fact(w, "fct_wait_event_daily", days_from=date(2024, 1, 20)) == date(2024, 1, 20)
    after = w.fact("fct_wait_event_daily")
    assert after.where("event_name = 'click' and dt >= date'2024-01-20'").isEmpty()
    assert not after.where("event_name = 'click'").isEmpty() and after.count() < before
