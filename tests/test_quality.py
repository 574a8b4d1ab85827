"""Gate, data tests, contracts, run log, heartbeats and staleness."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from rows import daily_contract_rows, frame, result

from obsmart.lake.versions import Lake, RowsRefused
from obsmart.plans.daily import row_rules
from obsmart.quality import contract, data_tests, gate, runs
from obsmart.session import fresh_dir
from obsmart.sources import storage
from obsmart.sources.local import local_frame
from obsmart.sources.tables import raw_table

DAY = date(2026, 1, 1)
COUNTS = "dt DATE, instance_id BIGINT, {} BIGINT"


def side(spark, name, counts):
    return local_frame(spark, [(DAY, i, n) for i, n in counts.items()], COUNTS.format(name))


@pytest.mark.parametrize(
    "source, landed, differing",
    [({1: 5, 2: 3}, {1: 5, 2: 3}, []), ({1: 5, 2: 3}, {1: 5, 2: 2}, [2]), ({1: 5}, {}, [1]), ({}, {4: 1}, [4]), ({}, {}, [])],
    ids=["equal", "lost", "missing", "unexpected", "both-empty"],
)
def test_reconciliation_both_ways(spark, source, landed, differing):
    both = gate.reconcile(side(spark, "source_rows", source), side(spark, "landed_rows", landed))
    assert [r["instance_id"] for r in both.where(~F.col("matches")).collect()] == differing


def test_instance_with_zero_rows_is_missing(spark):
    expected = local_frame(spark, [(DAY, i) for i in (1, 2, 3)], "dt DATE, instance_id BIGINT")
    missing = gate.missing_instances(side(spark, "landed_rows", {1: 4, 2: 0}), expected)
    assert sorted(r["instance_id"] for r in missing.collect()) == [2, 3]


@pytest.mark.parametrize(
    "newest, status",
    [("23:59:30", "OK"), ("21:00:00", "OK"), ("20:59:59", "WARN"), ("20:00:00", "WARN"), ("12:00:00", "WARN"),
     ("09:00:00", "FAIL"), (None, "FAIL")],
)
def test_freshness_limits_are_strict(spark, newest, status):
    at = None if newest is None else datetime.fromisoformat(f"2026-01-01 {newest}")
    df = local_frame(spark, [(DAY, at)], "dt DATE, newest_at TIMESTAMP_NTZ")
    assert df.select(gate.freshness_status(F.col("newest_at"))).first()[0] == status


def test_schema_drift():
    declared = raw_table("plan_snapshot").schema
    assert gate.schema_drift(declared, declared)[0] == "OK"
    extra = StructType([*declared.fields]).add("new_column", "string")
    assert gate.schema_drift(extra, declared) == ("WARN", "columns not taken over: ['new_column']")
    assert gate.schema_drift(StructType(declared.fields[1:]), declared)[0] == "FAIL"
    retyped = StructType([f for f in declared.fields if f.name != "id"]).add("id", "string")
    assert gate.schema_drift(retyped, declared)[0] == "FAIL"


def checks(spark, *statuses):
    rows = [(DAY, "t", axis, s, "") for axis, s in zip(("reconciliation", "completeness", "freshness", "schema_drift"), statuses, strict=True)]
    return local_frame(spark, rows, "dt DATE, table_name STRING, axis STRING, status STRING, detail STRING")


@pytest.mark.parametrize(
    "statuses, overall",
    [(("OK", "OK", "OK", "OK"), "OK"), (("OK", "SKIP", "SKIP", "OK"), "OK"), (("OK", "OK", "WARN", "OK"), "WARN"),
     (("FAIL", "OK", "WARN", "OK"), "FAIL")],
)
def test_worst_status_wins(spark, statuses, overall):
    c = checks(spark, *statuses)
    row = gate.day_status(c).first()
    assert (row["gate_status"], row["blocked"]) == (overall, overall == "FAIL")
    if overall == "FAIL":
        with pytest.raises(gate.GateBlocked):
            gate.require_pass(c)
    else:
        gate.require_pass(c)


def health(spark, *rows):
    return local_frame(
        spark, [(i, inst, datetime.fromisoformat(f"2026-01-01 {t}"), True, 5, DAY) for i, (inst, t) in enumerate(rows)],
        "id BIGINT, instance_id BIGINT, sampled_at TIMESTAMP_NTZ, up BOOLEAN, ping_millis BIGINT, dt DATE",
    )


def test_gate_profile_and_empty_day(spark):
    source = health(spark, (1, "23:00:00"))
    ids = local_frame(spark, [(1,), (2,)], "instance_id BIGINT")
    got = gate.evaluate(spark, source.drop("dt"), source, ids, raw_table("health_sample"), [DAY, date(2026, 1, 2)])
    by = {(r["dt"].day, r["axis"]): r["status"] for r in got.collect()}
    assert by == {
        (1, "reconciliation"): "OK", (1, "completeness"): "SKIP", (1, "freshness"): "OK", (1, "schema_drift"): "OK",
        (2, "reconciliation"): "OK", (2, "completeness"): "SKIP", (2, "freshness"): "FAIL", (2, "schema_drift"): "OK",
    }


def test_two_sided_report(spark):
    report = gate.two_sided_report(side(spark, "source_rows", {1: 5, 2: 1}), side(spark, "landed_rows", {1: 5}))
    assert tuple(report.first()) == (DAY, 6, 5, "MISMATCH")


def test_data_tests_count_violations(spark):
    df = local_frame(spark, [(1, "ok", 5), (None, "bad", -1), (1, None, 0)], "k BIGINT, s STRING, n BIGINT")
    got = {r["rule"]: r["violations"] for r in data_tests.row_rules(df, {
        "null": data_tests.not_null("k"), "accepted": data_tests.accepted("s", ["ok"]), "negative": data_tests.non_negative("n"),
    }).collect()}
    assert got == {"null": 1, "accepted": 1, "negative": 1}
    assert data_tests.unique(df, ["k"]).first()["violations"] == 1
    with pytest.raises(data_tests.TestsFailed):
        data_tests.require_clean(lambda _: df.select(F.col("k").alias("instance_id"), F.col("s").alias("engine")), ["dim_instance"])
    parent = local_frame(spark, [(2,)], "k BIGINT")
    assert data_tests.relationship(df.where("k is not null"), parent, "k").first()["violations"] == 1


def test_contract_accepts_and_rejects(spark):
    good = frame(spark, "daily", *daily_contract_rows())
    contract.enforce(good, "fct_query_daily")
    for broken in (
        good.drop("delta_calls"), good.withColumn("more", F.lit(1)), good.withColumn("delta_calls", F.col("delta_calls").cast("int")),
        good.withColumn("query_id", F.lit(None).cast("string")), good.withColumn("delta_calls", F.col("delta_calls") - 10),
    ):
        with pytest.raises(contract.ContractBroken):
            contract.enforce(broken, "fct_query_daily")


def test_run_record_keeps_unknown_axes_null(spark):
    c = checks(spark, "OK", "OK", "WARN", "OK").where("axis <> 'completeness'")
    df = runs.run_records(c, gate.day_status(c), F.lit("r1"), F.lit(datetime(2026, 1, 2)), F.lit(1.23456), offload_rows=F.lit(7))
    row = df.first().asDict()
    assert row["gate_completeness"] is None and row["gate_freshness"] == "WARN" and row["gate_status"] == "WARN"
    assert (row["duration_sec"], row["offload_rows"], row["published_rows"], row["heartbeat_at"]) == (1.235, 7, None, None)


def test_run_log_only_grows(spark):
    path = fresh_dir(spark, "log") + "/runs"
    c = checks(spark, "OK", "OK", "OK", "OK")
    for n in (1, 2):
        runs.append_runs(runs.run_records(c, gate.day_status(c), F.lit(f"r{n}"), F.lit(datetime(2026, 1, n)), F.lit(1.0)), path)
    assert sorted(r["run_id"] for r in runs.read_runs(spark, path).collect()) == ["r1", "r2"]


def test_heartbeat_latest_and_staleness(spark):
    path = fresh_dir(spark, "beats") + "/beats"
    now = datetime(2026, 1, 2, 12)
    runs.beat(spark, path, "daily", now - timedelta(hours=30), "old")
    runs.beat(spark, path, "daily", now - timedelta(hours=26), "new")
    runs.beat(spark, path, "weekly", now - timedelta(hours=27))
    latest = runs.latest_beats(spark.read.schema(runs.HEARTBEAT).parquet(path))
    assert result(latest, key="dag_id")["daily"]["run_id"] == "new"
    watched = local_frame(spark, [(n, 26 * 3600) for n in ("daily", "weekly", "never")], "dag_id STRING, max_age_seconds BIGINT")
    got = result(runs.staleness(watched, latest, F.lit(now)), key="dag_id")
    assert {k: v["stale"] for k, v in got.items()} == {"daily": False, "weekly": True, "never": True}
    assert got["daily"]["age_seconds"] == 26 * 3600 and got["never"]["age_seconds"] is None


def test_folding_beats_keeps_the_latest_and_few_files(spark, monkeypatch):
    path = fresh_dir(spark, "beats") + "/beats"
    now = datetime(2026, 1, 2, 12)

    def latest():
        return {r["dag_id"]: (r["last_success_at"], r["run_id"]) for r in runs.latest_beats(runs.read_beats(spark, path)).collect()}

    assert latest() == {}
    for n in range(6):
        runs.beat(spark, path, f"dag{n % 2}", now + timedelta(minutes=n), str(n))
        runs.fold_many_beats(spark, path, at=2)
        want = {f"dag{k % 2}": (now + timedelta(minutes=k), str(k)) for k in range(n + 1)}
        assert latest() == want
    assert len(storage.list_files(spark, path)) <= 3 and len(storage.list_names(spark, f"{path}/_folds")) <= 2
    with monkeypatch.context() as m:  # after the state is written, before anything is deleted
        m.setattr(storage, "create_text", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            runs.fold_beats(spark, path)
    assert latest() == want
    storage.delete_folder(spark, f"{path}/_folds/{storage.list_names(spark, f'{path}/_folds')[-1]}/_SUCCESS")  # while it is written
    assert latest() == want
    runs.fold_beats(spark, path)
    assert latest() == want


def test_rules_are_counted_by_the_write_that_publishes(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        seen.add(1)
        return x

    df = local_frame(spark, [(1, "MYSQL"), (2, None), (3, None)], "instance_id BIGINT, engine STRING").select(
        counted("instance_id").alias("instance_id"), "engine")
    lake = Lake(spark, fresh_dir(spark, "lake"))
    with pytest.raises(RowsRefused, match=r"dim_instance not_null\(engine\): 2"):
        lake.publish({"dim_instance": df}, rules=row_rules)
    assert lake.versions() == [] and seen.value == 3
    assert lake.publish({"dim_instance": df.where("engine is not null")}, rules=row_rules) == 1
    daily = frame(spark, "daily", *daily_contract_rows()).withColumn("delta_calls", F.col("delta_calls") - 3)
    with pytest.raises(RowsRefused, match=r"fct_query_daily check\(delta_calls >= 0\): 1; fct_query_daily non_negative\(delta_calls\): 1"):
        lake.publish({"fct_query_daily": daily}, daily={"fct_query_daily": None}, rules=row_rules)
    assert lake.versions() == [1]


def test_keys_are_tested_apart(spark):
    twice = local_frame(spark, [(1, "a"), (1, "b")], "instance_id BIGINT, engine STRING")
    with pytest.raises(data_tests.TestsFailed, match="unique"):
        data_tests.require_keys(lambda _: twice, ["dim_instance", "fct_size_daily"])
    data_tests.require_keys(lambda _: twice.limit(1), ["dim_instance"])
    data_tests.require_keys(lambda _: twice, ["fct_size_daily"])
