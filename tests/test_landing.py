"""Day slices, idempotent partition overwrite, the archive guard, JDBC pieces and seeds."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

import pytest
from pyspark.sql import functions as F
from rows import result

from obsmart.quality import gate
from obsmart.session import MANY_FOLDERS, fresh_dir
from obsmart.sources import jdbc, landing, storage
from obsmart.sources.local import local_frame
from obsmart.sources.seeds import SEED_SCHEMAS, packaged_seed, read_seed
from obsmart.sources.tables import AUXILIARY, RAW_TABLES, raw_table

HEALTH = raw_table("health_sample")


def health(spark, *rows):
    return local_frame(
        spark, [(i, inst, datetime.fromisoformat(t), True, 5) for i, (inst, t) in enumerate(rows)],
        "id BIGINT, instance_id BIGINT, sampled_at TIMESTAMP_NTZ, up BOOLEAN, ping_millis BIGINT",
    )


def registry(spark, *ids):
    return local_frame(spark, [(i,) for i in ids], "instance_id BIGINT")


def test_day_is_half_open(spark):
    source = health(spark, (1, "2026-01-01 23:59:59.999999"), (1, "2026-01-02 00:00:00"), (1, "2026-01-02 23:59:59.999999"),
                    (1, "2026-01-03 00:00:00"))
    assert [r["id"] for r in result(landing.extract_days(source, HEALTH, "2026-01-02"))] == [1, 2]


def test_extract_takes_declared_columns_and_types(spark):
    source = health(spark, (1, "2026-01-02 01:00:00")).withColumn("ping_millis", F.col("ping_millis").cast("int")).withColumn("x", F.lit(1))
    df = landing.extract_days(source, HEALTH, "2026-01-02")
    assert df.columns == [*HEALTH.columns, "dt"] and dict(df.dtypes)["ping_millis"] == "bigint"


def test_unknown_table_is_an_error():
    with pytest.raises(KeyError):
        raw_table("nope")


def test_registry_of_tables():
    assert len(RAW_TABLES) == 10 and len(AUXILIARY) == 8
    assert not raw_table("backup_run").immutable and raw_table("query_snapshot").gate == (
        "reconciliation", "completeness", "freshness", "schema_drift")
    assert raw_table("health_sample").gate == ("reconciliation", "freshness", "schema_drift")


def test_landing_twice_is_idempotent_and_leaves_other_partitions(spark):
    root = fresh_dir(spark, "raw")
    source = health(spark, (1, "2026-01-01 01:00:00"), (2, "2026-01-01 01:00:00"), (1, "2026-01-02 01:00:00"))
    for _ in range(2):
        landing.offload(spark, source, "health_sample", root, "2026-01-01", "2026-01-02")
    landed = landing.offload(spark, source, "health_sample", root, "2026-01-02")
    assert [r["landed_rows"] for r in result(landed)] == [1]
    back = landing.read_landed(spark, root, "health_sample")
    assert back.count() == 3 and dict(back.dtypes)["instance_id"] == "bigint" and dict(back.dtypes)["dt"] == "date"


def test_guard_refuses_to_replace_the_only_copy(spark):
    root = fresh_dir(spark, "raw")
    full = health(spark, (1, "2026-01-01 01:00:00"), (2, "2026-01-01 01:00:00"))
    landing.offload(spark, full, "health_sample", root, "2026-01-01", registry=registry(spark, 1, 2))
    gone = health(spark, (1, "2026-01-01 05:00:00"))
    with pytest.raises(landing.ArchiveGuardError):
        landing.offload(spark, gone, "health_sample", root, "2026-01-01", registry=registry(spark, 1, 2))
    hours = [r["sampled_at"].hour for r in result(landing.read_landed(spark, root, "health_sample"))]
    assert hours == [1, 1]  # nothing was touched, not even the instance that has rows


def test_guard_actions(spark):
    ddl = "dt DATE, instance_id BIGINT"
    day = date(2026, 1, 1)
    counts = local_frame(spark, [(day, 1, 5), (day, 2, 3)], ddl + ", source_rows BIGINT")
    existing = local_frame(spark, [(day, 2), (day, 3)], ddl)
    expected = local_frame(spark, [(day, i) for i in (1, 2, 3, 4)], ddl)
    got = result(landing.partition_actions(counts, existing, expected), key="instance_id")
    assert {i: r["action"] for i, r in got.items()} == {1: "overwrite", 2: "overwrite", 3: "refuse", 4: "skip"}


def test_quiet_new_instance_is_skipped(spark):
    root = fresh_dir(spark, "raw")
    source = health(spark, (1, "2026-01-01 01:00:00"))
    landing.offload(spark, source, "health_sample", root, "2026-01-01", registry=registry(spark, 1, 9))
    assert storage.list_names(spark, f"{root}/health_sample/dt=2026-01-01") == ["instance_id=1"]


def test_registry_snapshot(spark):
    root = fresh_dir(spark, "raw")
    ddl = "id BIGINT, name STRING, type STRING, team_label STRING"
    none = local_frame(spark, [], ddl)
    assert landing.offload_registry(spark, none, root, "2026-01-01") == 0
    rows = local_frame(spark, [(1, "a", "MYSQL", None), (2, "b", "ORACLE", "x")], ddl)
    assert [landing.offload_registry(spark, rows, root, day) for day in ("2026-01-01", "2026-01-02", "2026-01-02")] == [2, 2, 2]
    assert landing.read_landed(spark, root, "dim_instance").count() == 4
    with pytest.raises(landing.ArchiveGuardError):
        landing.offload_registry(spark, none, root, "2026-01-02")


def test_nothing_landed_reads_as_empty(spark):
    assert landing.read_landed(spark, fresh_dir(spark, "raw"), "plan_snapshot").isEmpty()


def test_partition_filter_prunes_folders(spark):
    root = fresh_dir(spark, "raw")
    source = health(spark, *[(i, f"2026-01-0{day} 01:00:00") for i in (1, 2) for day in (1, 2, 3)])
    landing.offload(spark, source, "health_sample", root, "2026-01-01", "2026-01-03")
    one = landing.read_landed(spark, root, "health_sample").where("dt = date'2026-01-02' and instance_id = 1")
    assert len(one.inputFiles()) >= 1 and "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().toString()
    assert one.count() == 1


def test_nothing_is_placed_or_left_when_a_load_is_refused(spark):
    root = fresh_dir(spark, "raw")
    full = health(spark, (1, "2026-01-01 01:00:00"), (2, "2026-01-01 01:00:00"))
    landing.offload(spark, full, "health_sample", root, "2026-01-01", registry=registry(spark, 1, 2))
    before = {n: storage.list_files(spark, f"{root}/health_sample/dt=2026-01-01/{n}") for n in ("instance_id=1", "instance_id=2")}
    more = health(spark, (1, "2026-01-01 05:00:00"), (1, "2026-01-02 05:00:00"), (2, "2026-01-02 05:00:00"))
    with pytest.raises(landing.ArchiveGuardError):
        landing.offload(spark, more, "health_sample", root, "2026-01-01", "2026-01-02", registry(spark, 1, 2))
    assert storage.list_names(spark, f"{root}/health_sample") == ["dt=2026-01-01"]
    assert {n: storage.list_files(spark, f"{root}/health_sample/dt=2026-01-01/{n}") for n in before} == before
    assert storage.list_names(spark, f"{root}/_staging") == []


def test_a_load_reads_its_source_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(_):
        seen.add(1)
        return True

    source = health(spark, *[(i % 3, f"2026-01-01 0{i % 9}:00:00") for i in range(40)]).where(counted("id"))
    load = landing.load(spark, source, "health_sample", fresh_dir(spark, "raw"), "2026-01-01", None, registry(spark, 0, 1, 2))
    checks = gate.evaluate_load(spark, load, registry(spark, 0, 1, 2))
    assert {r["axis"]: r["status"] for r in checks.collect()} == {
        "reconciliation": "OK", "completeness": "SKIP", "freshness": "FAIL", "schema_drift": "OK"}
    assert seen.value == 40 and sorted(r["source_rows"] for r in load.source.collect()) == [13, 13, 14]
    assert sorted(r["landed_rows"] for r in load.landed.collect()) == [13, 13, 14]


def test_rows_lost_while_staging_are_noticed(spark, monkeypatch):
    root = fresh_dir(spark, "raw")
    monkeypatch.setattr(landing, "arranged", lambda df, table: _Loses(df))
    with pytest.raises(landing.LostRows):
        landing.offload(spark, health(spark, (1, "2026-01-01 01:00:00"), (1, "2026-01-01 02:00:00")), "health_sample", root, "2026-01-01")
    assert storage.list_names(spark, root) == ["_staging"] and storage.list_names(spark, f"{root}/_staging") == []


class _Loses:
    """A frame whose writer loses a row after it was observed."""

    def __init__(self, df):
        self.df = df

    def observe(self, *args):
        return self.df.observe(*args).where("id > 0")


def test_a_replaced_partition_keeps_only_new_rows(spark):
    root = fresh_dir(spark, "raw")
    landing.offload(spark, health(spark, (1, "2026-01-01 01:00:00"), (2, "2026-01-01 01:00:00")), "health_sample", root, "2026-01-01")
    landing.offload(spark, health(spark, (1, "2026-01-01 07:00:00"), (3, "2026-01-01 01:00:00")), "health_sample", root, "2026-01-01")
    rows = sorted((r["instance_id"], r["sampled_at"].hour) for r in landing.read_landed(spark, root, "health_sample").collect())
    assert rows == [(1, 7), (2, 1), (3, 1)]


def test_a_day_of_many_partitions_is_listed_by_one_task(spark):
    root, sc = fresh_dir(spark, "raw"), spark.sparkContext
    source = health(spark, *[(i, f"2026-01-0{d} 01:00:00") for i in range(40) for d in (1, 2)])
    before = {k: spark.conf.get(k) for k in MANY_FOLDERS}
    for _ in range(2):
        landing.offload(spark, source, "health_sample", root, "2026-01-01", "2026-01-02", registry(spark, *range(40)))
    assert {k: spark.conf.get(k) for k in MANY_FOLDERS} == before
    days = [date(2026, 1, 1), date(2026, 1, 2)]
    try:
        for group, read in (
            ("rows", lambda: landing.read_landed(spark, root, "health_sample", days=days)),
            ("partitions", lambda: landing.landed_partitions(spark, root, HEALTH, days)),
        ):
            sc.setJobGroup(group, "listing")
            found = read()
            stages = [i for j in sc.statusTracker().getJobIdsForGroup(group) for i in sc.statusTracker().getJobInfo(j).stageIds]
            assert sum(sc.statusTracker().getStageInfo(i).numTasks for i in stages) == 2
            assert found.count() == 80
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_connections_are_few_and_balanced():
    instances, rows = list(range(1, 3001)), {i: 100 + i % 50 for i in range(1, 2901)}
    rows[7] = 500_000  # more than half of all rows
    lists = jdbc.balanced(instances, rows, 32)
    assert len(lists) == 32
    pieces = [p for pieces in lists for p in pieces]
    assert len(pieces) == len(set(pieces)) and {p.instance for p in pieces} == set(instances)
    slices = [p for p in pieces if p.instance == 7]
    assert len(slices) == slices[0].slices <= jdbc.MOST_SLICES and sorted(p.part for p in slices) == list(range(len(slices)))
    usual = sum(rows.values()) / len(rows)
    loads = [sum(rows.get(p.instance, usual) / p.slices for p in pieces) for pieces in lists]
    assert max(loads) < 1.3 * sum(loads) / len(loads)
    assert jdbc.balanced([5], {}, 32) == [[jdbc.Piece(5)]] and jdbc.balanced([], {}, 32) == []


def test_predicates_put_instances_first_and_cover_the_day_once():
    lists = [[jdbc.Piece(2), jdbc.Piece(1)], [jdbc.Piece(3, 1, 2)], [jdbc.Piece(3, 0, 2), jdbc.Piece(4)]]
    parts = jdbc.connection_predicates(lists, HEALTH, "2026-01-31")
    whole = "sampled_at >= '2026-01-31 00:00:00' AND sampled_at < '2026-02-01 00:00:00'"
    assert parts[0] == f"instance_id IN (1, 2) AND {whole}"
    assert parts[1] == "instance_id = 3 AND sampled_at >= '2026-01-31 12:00:00' AND sampled_at < '2026-02-01 00:00:00'"
    assert parts[2] == (
        f"(instance_id IN (4) AND {whole}) OR "
        "(instance_id = 3 AND sampled_at >= '2026-01-31 00:00:00' AND sampled_at < '2026-01-31 12:00:00')"
    )


def fake_reader(tables, asked):
    """Stands in for the database: a union of what each connection asks for."""

    def read(name, predicates):
        asked.append(len(predicates))
        return reduce(lambda a, b: a.unionByName(b), [tables[name].where(p) for p in predicates])

    return read


def test_day_source_reads_every_row_once(spark):
    rows = [(i, f"2026-01-0{d} {h:02d}:{m:02d}:00") for i in (1, 2, 3, 4, 5) for d in (1, 2) for h in (0, 11, 12, 23) for m in (0, 59)]
    rows += [(3, f"2026-01-0{d} 10:{m:02d}:30") for d in (1, 2) for m in range(60)]
    rows += [(9, "2026-01-02 03:00:00")]  # not registered
    table, asked = health(spark, *rows).withColumn("more", F.lit(1)), []
    ids = local_frame(spark, [(i,) for i in (1, 2, 3, 4, 5, 6)], "id BIGINT")
    root = fresh_dir(spark, "raw")
    source = jdbc.DaySource(spark, fake_reader({"health_sample": table}, asked), lambda: ids, root, connections=4)
    for day in (1, 2):
        found = source("health_sample", date(2026, 1, day))
        landing.load(spark, found, "health_sample", root, f"2026-01-0{day}")
        want = table.where(f"instance_id < 9 and to_date(sampled_at) = date'2026-01-0{day}'")
        got = landing.read_landed(spark, root, "health_sample", days=[date(2026, 1, day)])
        assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())
    assert asked == [4, 4]
    heavy = jdbc.balanced([1, 2, 3, 4, 5, 6], source.rows_before("health_sample", date(2026, 1, 2)), 4)
    assert max(p.slices for pieces in heavy for p in pieces) > 1
    assert jdbc.DaySource(spark, fake_reader({}, []), lambda: ids.where("false"), root)("health_sample", date(2026, 1, 2)).isEmpty()


class Target:
    """Stands in for the external database: a staging and a target list."""

    def __init__(self, lose=0, broken=False):
        self.staged, self.target, self.lose, self.broken = [], ["old"], lose, broken
        self.statements = None

    def stage(self, df, name):
        rows = [tuple(r) for r in df.collect()]
        self.staged = rows[: len(rows) - self.lose]

    def swap(self, statements):
        if self.broken:
            raise OSError("connection lost")
        self.statements, self.target = statements, list(self.staged)


def _write(df, target, configured=True):
    return jdbc.write_back(df, "t", ["id"], target.stage, lambda _: len(target.staged), target.swap, configured)


def test_write_back_swaps_staged_rows_in_one_transaction(spark):
    target = Target()
    assert _write(spark.range(5).withColumn("extra", F.lit(1)), target) == 5
    assert target.target == [(i,) for i in range(5)]
    assert target.statements == ["DELETE FROM t", "INSERT INTO t (id) SELECT id FROM t_staging"]


def test_write_back_failures_leave_the_target(spark):
    for target in (Target(lose=1), Target(broken=True)):
        with pytest.raises((jdbc.WriteBackError, OSError)):
            _write(spark.range(5), target)
        assert target.target == ["old"]


def test_a_published_baseline_goes_to_its_table(spark):
    target, asked = Target(), []
    columns = {c: F.lit(1) for c in jdbc.BASELINE_COLUMNS}

    def mart(version):
        asked.append(version)
        return spark.range(3).withColumns(columns)

    jdbc.baseline_write_back(mart, target.stage, lambda _: len(target.staged), target.swap)(7)
    assert asked == [7] and len(target.target) == 3 and target.statements[0] == "DELETE FROM baseline_longterm"


def test_write_back_without_target_does_nothing(spark):
    target = Target()
    assert _write(spark.range(5), target, configured=False) is None and target.staged == []


def test_seeds_from_package_and_from_folder_agree(spark):
    from pathlib import Path

    folder = str(Path(jdbc.__file__).parent.parent / "seeds")
    for name in SEED_SCHEMAS:
        a, b = packaged_seed(spark, name), read_seed(spark, name, folder)
        assert a.schema.simpleString() == b.schema.simpleString() and sorted(a.collect()) == sorted(b.collect())


def test_a_table_without_source_is_refused(monkeypatch):
    from dataclasses import replace

    monkeypatch.setitem(RAW_TABLES, "plan_snapshot", replace(raw_table("plan_snapshot"), available=False))
    with pytest.raises(RuntimeError):
        raw_table("plan_snapshot")


def test_auxiliary_tables_are_guarded_too(spark):
    from obsmart.sources.fleet import fleet_source

    root = fresh_dir(spark, "raw")
    folder = "/root/testdata/sf0.001"
    sources = {n: fleet_source(spark, folder, n) for n in AUXILIARY}
    ids = fleet_source(spark, folder, "dim_instance").where("dt = date'2024-01-30'").drop("dt")
    landing.offload_auxiliary(spark, sources, ids, root, "2024-01-05")
    sources["health_sample"] = sources["health_sample"].where("false")
    with pytest.raises(landing.ArchiveGuardError):
        landing.offload_auxiliary(spark, sources, ids, root, "2024-01-05")
