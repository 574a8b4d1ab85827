"""Versions: atomic publish, time travel, corrections, expiry, compaction, scale jobs."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from rows import frame, poll

from obsmart import scale
from obsmart.lake.versions import Lake, PublishError
from obsmart.session import fresh_dir
from obsmart.sources import storage

T0 = datetime(2026, 1, 1, tzinfo=UTC)


@pytest.fixture
def lake(spark):
    return Lake(spark, fresh_dir(spark, "lake"))


def days(spark, *dates):
    return spark.range(10).select("id", F.lit(1.5).alias("ms"), F.explode(F.array(*[F.lit(x).cast("date") for x in dates])).alias("dt"))


def test_publish_replaces_all_tables_together(spark, lake):
    assert lake.publish({"a": spark.range(3), "b": spark.range(4)}) == 1
    assert lake.publish({"a": spark.range(5), "b": spark.range(6)}) == 2
    assert [lake.read(t).count() for t in ("a", "b")] == [5, 6]
    assert [lake.read(t, 1).count() for t in ("a", "b")] == [3, 4]


def test_failed_publish_leaves_the_old_version_and_no_files(spark, lake):
    lake.publish({"a": spark.range(3), "b": spark.range(3)})
    before = lake.stored()
    bad = spark.range(4).select((F.col("id") / F.lit(0)).alias("id"))  # fails while running
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        lake.publish({"a": spark.range(9), "b": bad})
    assert lake.versions() == [1] and lake.read("a").count() == 3 and lake.stored() == before


def test_validation_sees_written_rows_before_commit(spark, lake):
    def refuse(tables):
        if tables("b").count() == 2:
            raise ValueError("contract")

    with pytest.raises(ValueError):
        lake.publish({"a": spark.range(1), "b": spark.range(2)}, validate=refuse)
    assert lake.versions() == [] and lake.current_version() is None


def test_daily_tables_take_over_untouched_days(spark, lake):
    first = days(spark, "2026-01-01", "2026-01-02", "2026-01-03")
    lake.publish({"f": first}, daily={"f": None})
    seen = {}
    changed = days(spark, "2026-01-01", "2026-01-03", "2026-01-04").withColumn("ms", F.lit(9.0))
    lake.publish({"f": changed}, daily={"f": date(2026, 1, 3)}, validate=lambda t: seen.update(n=t("f").count()))
    old, new = (lake.manifest(v)["tables"]["f"]["parts"] for v in (1, 2))
    assert [p["day"] for p in new] == ["2026-01-01", "2026-01-02", "2026-01-03", "2026-01-04"]
    assert new[:2] == old[:2] and seen == {"n": 20}  # only two days were written and checked
    sums = {r["dt"].day: r["s"] for r in lake.read("f").groupBy("dt").agg(F.sum("ms").alias("s")).collect()}
    assert sums == {1: 15.0, 2: 15.0, 3: 90.0, 4: 90.0}
    assert lake.read("f").columns == ["id", "ms", "dt"] and lake.read("f", 1).count() == 30
    lake.expire(timedelta(0))
    assert lake.read("f").count() == 40 and lake.stored()[0] > 0
    assert storage.exists(spark, new[0]["path"]) and not storage.exists(spark, old[2]["path"])


def test_second_writer_is_detected(spark, lake):
    with pytest.raises(PublishError), lake.transaction("slow") as tx:
        tx.append("a", spark.range(1))
        Lake(spark, lake.root).append("a", spark.range(2))
    assert lake.read("a").count() == 2


def test_append_counts_and_empty_tables(spark, lake):
    assert lake.append("t", days(spark, "2026-01-01"), "2026-01-01") == 10
    assert lake.append("t", days(spark, "2026-01-02"), "2026-01-02") == 10
    lake.publish({"none": spark.range(0)})
    assert lake.read("none").count() == 0 and lake.read("t").count() == 20
    assert [tuple(r) for r in lake.snapshots().orderBy("version").select("version", "row_count", "changes").collect()] == [
        (1, 10, "append t 2026-01-01"), (2, 20, "append t 2026-01-02"), (3, 20, "publish")]


def test_correction_touches_one_day_and_keeps_history(spark, lake):
    for day in ("2026-01-01", "2026-01-02"):
        lake.append("t", days(spark, day), day)
    untouched = lake.manifest()["tables"]["t"]["parts"][0]["path"]
    version = lake.correct("t", "2026-01-02", F.col("id") == 7, "ms", F.lit(1001.5))
    assert lake.read("t", version).agg(F.sum("ms")).first()[0] == 20 * 1.5 + 1000
    assert lake.read("t", version - 1).agg(F.sum("ms")).first()[0] == 20 * 1.5
    assert lake.manifest()["tables"]["t"]["parts"][0]["path"] == untouched and lake.read("t").count() == 20


def test_delete_day_and_rollback(spark, lake):
    lake.append("t", days(spark, "2026-01-01", "2026-01-02"))  # one part with two days
    lake.append("t", days(spark, "2026-01-01"), "2026-01-01")
    with pytest.raises(RuntimeError), lake.transaction("x") as tx:
        assert tx.delete_day("t", "2026-01-01") == 20
        raise RuntimeError
    assert lake.versions() == [1, 2] and lake.read("t").count() == 30
    with lake.transaction("delete") as tx:
        tx.delete_day("t", "2026-01-01")
    assert [r["dt"] for r in lake.read("t").select("dt").distinct().collect()] == [date(2026, 1, 2)]


def test_expire_keeps_current_and_removes_unreferenced_folders(spark, lake):
    for n in range(3):
        lake.publish({"a": spark.range(n + 1)}, committed_at=T0 + timedelta(days=n))
    assert lake.expire(timedelta(days=1), as_of=T0 + timedelta(days=2)) == [1]
    assert lake.versions() == [2, 3]
    assert lake.expire(timedelta(0), as_of=T0 + timedelta(days=30)) == [2]
    assert lake.read("a").count() == 3 and len(storage.list_names(spark, f"{lake.root}/data/a")) == 1
    with pytest.raises(KeyError):
        lake.read("a", 1)


def test_compaction_keeps_rows_and_old_versions(spark, lake):
    raw = days(spark, *[f"2026-01-{n:02d}" for n in range(1, 9)])
    for _ in range(2):
        scale.daily_commits(lake, "t", raw, [date(2026, 1, n) for n in range(1, 9)])
    before = sorted(map(tuple, lake.read("t").collect()))
    assert lake.compact() == {"t": (16, 8)}  # a part for each day
    assert sorted(map(tuple, lake.read("t").collect())) == before and lake.read("t", 3).count() == 30
    assert lake.compact() == {"t": (8, 8)}


def test_maintenance_reports_before_and_after(spark, lake):
    for n in (1, 1, 2, 2, 3, 4):
        lake.append("t", days(spark, f"2026-01-{n:02d}"), f"2026-01-{n:02d}", committed_at=T0 + timedelta(days=n))
    lake.publish({"u": spark.range(3)}, committed_at=T0 + timedelta(days=5))
    got = {r["metric"]: (r["before"], r["after"]) for r in lake.maintain(timedelta(0), as_of=T0 + timedelta(days=9)).collect()}
    assert got["versions"] == (7, 1) and got["parts"] == (7, 5) and got["rows"] == (63, 63) and got["tables"] == (2, 2)
    assert got["objects"][1] < got["objects"][0]
    assert lake.maintain(timedelta(0), as_of=T0 + timedelta(days=10)).where("metric = 'versions'").first()["after"] == 1


def test_maintenance_with_nothing_published(spark, lake):
    assert {r["metric"]: r["after"] for r in lake.maintain().collect()}["versions"] == 0


def test_measure_without_tables(lake):
    assert lake.measure().count() == 0 and lake.stored() == (0, 0)


def test_replicated_day_moves_times_with_dates(spark):
    raw = frame(spark, "query", poll(1, "q", "01-01 05:00", 1, 1), poll(1, "q", "01-02 05:00", 9, 9))
    got = scale.replicate_day(raw, "2026-01-01", "2026-03-01", 3)
    assert got.count() == 3 and got.where("dt <> to_date(captured_at)").count() == 0
    assert {r["dt"] for r in got.collect()} == {date(2026, 3, n) for n in (1, 2, 3)}


def test_slow_down_touches_only_late_days_of_slow_buckets(spark):
    raw = frame(spark, "query", *[poll(1, f"q{i}", f"01-{day} 05:00", 1, 100) for i in range(40) for day in ("01", "09")])
    got = scale.slow_down(raw, "2026-01-09").groupBy("dt").agg(F.collect_set("total_time_ms").alias("s"))
    by = {r["dt"].day: set(r["s"]) for r in got.collect()}
    assert by == {1: {100.0}, 9: {100.0, 150.0, 250.0}}


def test_spread_instances_cycles_over_the_base(spark):
    raw = frame(spark, "query", poll(3, "q", "01-01 05:00", 1, 1), poll(8, "q", "01-01 05:00", 2, 2)).withColumn("id", F.lit(5).cast("long"))
    got = {r["instance_id"]: (r["calls"], r["query_id"], r["id"]) for r in scale.spread_instances(raw, [8, 3], 5).collect()}
    assert got == {j: (1 if j % 2 else 2, f"q~i{j}", 5 + j * 10**9) for j in range(1, 6)}
