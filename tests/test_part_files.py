"""Files of landed partitions: written, listed, read and moved by tasks."""

from __future__ import annotations

import os
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from obsmart.session import fresh_dir
from obsmart.sources import landing, part_files, storage
from obsmart.sources.local import local_frame
from obsmart.sources.tables import raw_table

HEALTH = raw_table("health_sample")
DDL = "id BIGINT, instance_id BIGINT, sampled_at TIMESTAMP_NTZ, up BOOLEAN, ping_millis BIGINT"
DAYS = [date(2026, 1, 1), date(2026, 1, 2)]


def health(spark, *rows):
    return local_frame(spark, [(i, inst, datetime.fromisoformat(t), None, 5) for i, (inst, t) in enumerate(rows)], DDL)


@pytest.fixture
def landed(spark):
    """Three instances, one of them null, on two days."""
    root = fresh_dir(spark, "raw")
    source = health(spark, *[(i, f"2026-01-0{d} 0{h}:00:00") for i in (1, 2, None) for d in (1, 2) for h in (3, 4)])
    landing.offload(spark, source, "health_sample", root, *DAYS)
    return root


def files_of(root):
    return sorted((os.path.relpath(top, root), n) for top, _, names in os.walk(root) for n in names)


# F1
def test_a_partition_is_one_plain_file_without_a_checksum_beside_it(landed):
    found = files_of(f"{landed}/health_sample")
    parts = [f"dt={d}/instance_id={i}" for d in DAYS for i in (1, 2, part_files.NULL_PART)]
    assert [p for p, _ in found] == sorted(parts) and all(n.endswith(".zstd.parquet") for _, n in found)


# F1
def test_a_partition_of_many_batches_is_one_file_of_bounded_row_groups(spark, monkeypatch):
    monkeypatch.setattr(part_files, "GROUP_BYTES", 1 << 19)
    root = fresh_dir(spark, "raw")
    rows = spark.range(45_000).select(
        "id", F.when(F.col("id") < 40_000, 7).otherwise(8).cast("long").alias("instance_id"),
        F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("sampled_at"),
        F.lit(True).alias("up"), F.lit(5).cast("long").alias("ping_millis"),
    )
    landed = landing.load(spark, rows, "health_sample", root, DAYS[0]).landed
    assert {r["instance_id"]: (r["landed_rows"], r["newest_at"]) for r in landed.collect()} == {
        7: (40_000, datetime(2026, 1, 1, 11, 6, 39)), 8: (5_000, datetime(2026, 1, 1, 12, 29, 59))}
    top = f"{root}/health_sample/dt=2026-01-01/instance_id=7"
    (name,) = os.listdir(top)
    assert 1 < pq.ParquetFile(f"{top}/{name}").num_row_groups < 5
    assert landing.read_landed(spark, root, "health_sample").agg(F.countDistinct("id")).first()[0] == 45_000


# F1
def test_only_files_named_by_a_finished_task_are_placed(spark, monkeypatch):
    """An attempt that was lost leaves its files behind in the staging folder."""
    settle = part_files.settle

    def stray(folder):
        path = folder.removeprefix("file:")
        (attempt,) = [n for n in os.listdir(path) if n.startswith("_")]
        os.makedirs(f"{path}/_lost")
        for n in os.listdir(f"{path}/{attempt}"):
            os.link(f"{path}/{attempt}/{n}", f"{path}/_lost/again-{n}")
        return settle(folder)

    monkeypatch.setattr(part_files, "settle", stray)
    root = fresh_dir(spark, "raw")
    landing.offload(spark, health(spark, (1, "2026-01-01 03:00:00")), "health_sample", root, DAYS[0])
    assert len(files_of(root)) == 1 and landing.read_landed(spark, root, "health_sample").count() == 1


# F1
def test_a_repeated_move_finds_its_files_in_place(tmp_path):
    (staged, target), part = (tmp_path / "staged", tmp_path / "table"), "dt=2026-01-01/instance_id=1"
    for top, name in ((staged / "_a", "new.parquet"), (target / part, "old.parquet"), (target / part, ".old.parquet.crc")):
        top.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table({"id": [1, 2]}), top / name)
    written = pa.RecordBatch.from_pydict({"part": [part], "name": ["_a/new.parquet"], "rows": [2]})
    for _ in range(2):
        (found,) = part_files.settle(staged.as_uri())(iter([written]))
        assert found.to_pylist() == [{"part": part, "name": "new.parquet", "rows": 2}]
    names = pa.RecordBatch.from_pydict({"part": [part], "names": [["new.parquet"]]})
    for _ in range(2):
        list(part_files.replace(staged.as_uri(), target.as_uri())(iter([names])))
        assert os.listdir(target / part) == ["new.parquet"]


# F2
def test_landed_rows_are_counted_without_a_list_of_files_on_the_driver(spark, landed):
    counts = landing.landed_counts(spark, landed, "health_sample", *DAYS)
    assert counts.inputFiles() == [] and counts.columns == ["dt", "instance_id", "landed_rows"]
    assert sorted((r[0], r[1] or 0, r[2]) for r in counts.collect()) == [(d, i, 2) for d in DAYS for i in (0, 1, 2)]
    assert landing.landed_counts(spark, landed, "health_sample", "2026-02-01", "2026-02-02").count() == 0


# F2
def test_a_replaced_day_keeps_one_file_a_partition(spark, landed):
    again = health(spark, (1, "2026-01-01 09:00:00"), (3, "2026-01-01 09:00:00"))
    landing.offload(spark, again, "health_sample", landed, DAYS[0])
    counts = landing.landed_counts(spark, landed, "health_sample", *DAYS).where("dt = '2026-01-01'").collect()
    assert sorted((r["instance_id"] or 0, r["landed_rows"]) for r in counts) == [(0, 2), (1, 1), (2, 2), (3, 1)]
    assert len(files_of(landed)) == 7 and storage.list_names(spark, f"{landed}/_staging") == []


# F3
def test_a_whole_archive_is_read_without_a_list_of_files_on_the_driver(spark, landed, monkeypatch):
    monkeypatch.setattr(part_files, "ROWS_AT_ONCE", 4)
    part = f"{landed}/health_sample/dt=2026-01-02/instance_id=9"
    os.makedirs(part)
    older = {"id": pa.array([77], pa.int32()), "sampled_at": pa.array([datetime(2026, 1, 2)], pa.timestamp("us")), "up": [True], "other": [1]}
    pq.write_table(pa.table(older), f"{part}/older.parquet")  # no ping_millis, a narrower id
    pq.write_table(pa.table({"id": [78]}), f"{part}/_hidden.parquet")
    rows = landing.read_landed(spark, landed, "health_sample", whole=True)
    native = landing.read_landed(spark, landed, "health_sample")
    assert rows.inputFiles() == [] and rows.dtypes == native.dtypes and rows.count() == 13
    assert rows.exceptAll(native).count() == 0 and native.exceptAll(rows).count() == 0
    assert landing.read_landed(spark, landed, "health_sample", days=DAYS[:1], whole=True).count() == 6
    assert landing.read_landed(spark, landed, "plan_snapshot", whole=True).isEmpty()


# F4
def test_partitions_are_listed_without_a_list_of_files_on_the_driver(spark, landed):
    found = landing.landed_partitions(spark, landed, HEALTH, [*DAYS, date(2026, 1, 3)])
    assert not [f for f in found.inputFiles() if "instance_id=" in f]
    assert sorted((r["dt"], r["instance_id"] or 0) for r in found.collect()) == [(d, i) for d in DAYS for i in (0, 1, 2)]


# F4
def test_landing_without_a_guard_is_staged_and_placed_by_tasks(spark):
    root = fresh_dir(spark, "raw")
    rows = landing.extract_days(health(spark, (1, "2026-01-01 03:00:00"), (2, "2026-01-01 03:00:00")), HEALTH, DAYS[0])
    landing.land(rows, root, HEALTH)
    landing.land(rows.where("instance_id = 2").withColumn("up", F.lit(False)), root, HEALTH)
    landing.land(rows.where("false"), root, HEALTH)
    back = landing.read_landed(spark, root, "health_sample").orderBy("instance_id").collect()
    assert [(r["instance_id"], r["up"]) for r in back] == [(1, None), (2, False)]
    assert len(files_of(root)) == 2 and all(n.endswith(".zstd.parquet") for _, n in files_of(root))


def test_runs_of_keys_with_nulls():
    keys = [pa.array([1, 1, None, None, 2, 2]), pa.array([1, 1, 1, 1, 1, None])]
    assert part_files.runs(keys, 6) == [(0, 2), (2, 2), (4, 1), (5, 1)]
    assert part_files.runs([pa.array([], pa.int64())], 0) == []
