"""Landing source rows as date/instance partitions, and reading them back."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from obsmart.session import fresh_dir, many_folders
from obsmart.sources import part_files, storage
from obsmart.sources.tables import AUXILIARY, RawTable, raw_table

#: Independent Spark jobs at the same time.
SIDE_BY_SIDE = 4


class ArchiveGuardError(RuntimeError):
    """An empty source was about to replace a partition that may be the only copy."""


def as_day(value: str | date) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def extract_days(source: DataFrame, table: RawTable, first: str | date, last: str | date | None = None) -> DataFrame:
    """Rows whose high-water column lies in [first 00:00, last + 1 day 00:00) UTC,
    with exactly the declared columns and types plus ``dt``.

    The bounds are literals on the bare column, so they reach the Parquet
    footers or the remote database.
    """
    start, stop = as_day(first), as_day(last or first) + timedelta(days=1)
    at = F.col(table.watermark)
    low, high = (F.lit(d.isoformat()).cast("date").cast("timestamp_ntz") for d in (start, stop))
    declared = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema]
    return (
        source.where((at >= low) & (at < high)).select(*declared).withColumn("dt", F.to_date(table.watermark))
    )


def arranged(df: DataFrame, table: RawTable) -> DataFrame:
    """``rebalance`` keeps a partition's rows together for few files, yet lets
    adaptive execution split one that is far larger than the rest. Rows are
    ordered by time inside a partition, for compression and row-group skipping."""
    order = [*table.partitions, *([table.watermark] if table.watermark else [])]
    return df.hint("rebalance", *[F.col(c) for c in table.partitions]).sortWithinPartitions(*order)


def land(df: DataFrame, root: str, table: RawTable) -> None:
    """Replace exactly the partitions present in ``df``; others stay untouched."""
    spark, staged = df.sparkSession, f"{root}/_staging/{table.name}-{uuid.uuid4().hex}"
    try:
        files = stage_rows(df, staged, table, fresh_dir(spark, f"land-{table.name}"))
        place(spark, files, staged, root, table)
    finally:
        storage.delete_folder(spark, staged)


def day_folders(spark: SparkSession, path: str, days: Iterable[date] | None = None) -> list[str]:
    wanted = None if days is None else {f"dt={d.isoformat()}" for d in days}
    names = storage.list_names(spark, path)
    return [f"{path}/{n}" for n in names if n.startswith("dt=") and (wanted is None or n in wanted)]


def read_days(spark: SparkSession, path: str, table: RawTable, folders: list[str]) -> DataFrame:
    """The rows in folders of days; each folder is listed by one task."""
    with many_folders(spark):
        rows = spark.read.schema(table.landed_schema).option("basePath", path).parquet(*folders)
    return rows.select(*table.columns, "dt")


def read_landed(
    spark: SparkSession, root: str, name: str, location: str | None = None, days: Iterable[date] | None = None,
    whole: bool = False,
) -> DataFrame:
    """Landed rows under the declared schema (empty when nothing was landed).
    ``location`` reads one table from somewhere else. With ``days`` only their
    folders are listed, however many days the archive has. ``whole`` is for a reader
    of every row: tasks list and read the files, so that the driver keeps no list
    of them, but later filters prune none."""
    table = raw_table(name)
    path = location or f"{root}/{name}"
    folders = day_folders(spark, path, days)
    if not folders:
        return spark.createDataFrame([], table.landed_schema)
    if whole:
        schema = StructType([StructField(f.name, f.dataType) for f in table.landed_schema])
        read = part_files.scan(storage.uri(spark, path), to_arrow_schema(schema))
        return dealt(listed_files(spark, path, folders)).mapInArrow(read, schema)
    return read_days(spark, path, table, folders)


def listed_files(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """(part, name) of the data files in folders of days; each folder is listed by
    one task, and none of its files is opened."""
    find = part_files.listed(storage.uri(spark, path), [f.rpartition("/")[2] for f in folders])
    return spark.range(0, len(folders), 1, len(folders)).mapInArrow(find, part_files.LISTED)


def dealt(files: DataFrame) -> DataFrame:
    """Files in equal numbers to the tasks that open them: Spark would deal their names by bytes, to one or two tasks."""
    return files.repartition(2 * files.sparkSession.sparkContext.defaultParallelism)


def partition_values(table: RawTable) -> list[Column]:
    """The partition columns of files by ``part``, the folder they lie in; null is a folder too."""
    kinds = {f.name: f.dataType for f in table.landed_schema}
    return [
        F.regexp_extract("part", f"(?:^|/){name}=([^/]*)", 1).try_cast(kinds[name]).alias(name) for name in table.partitions
    ]


def landed_partitions(spark: SparkSession, root: str, table: RawTable, days: Iterable[date]) -> DataFrame:
    """(dt, instance_id) with landed rows on the given days, as listed by now; no
    file is opened, as none is without rows."""
    path = f"{root}/{table.name}"
    folders = day_folders(spark, path, days)
    if not folders:
        return spark.createDataFrame([], table.landed_schema).select("dt", "instance_id")
    found = listed_files(spark, path, folders).select(*partition_values(table))
    return stored(found, fresh_dir(spark, f"partitions-{table.name}")).distinct()


def stored(df: DataFrame, path: str) -> DataFrame:
    """A frame written once and read again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partition_actions(source_counts: DataFrame, existing: DataFrame, expected: DataFrame) -> DataFrame:
    """What a load would do to each (dt, instance_id).

    rows -> ``overwrite``; no rows and no partition -> ``skip``; no rows but a
    partition -> ``refuse``, because it may be the only copy left.
    """
    keys = ["dt", "instance_id"]
    marked = existing.select(*keys).distinct().withColumn("partition_exists", F.lit(True))
    rows = F.coalesce("source_rows", F.lit(0))
    found = F.coalesce("partition_exists", F.lit(False))
    return (
        expected.select(*keys).distinct()
        .join(source_counts.select(*keys, "source_rows"), keys, "left")
        .join(marked, keys, "left")
        .select(
            *keys,
            rows.alias("source_rows"),
            found.alias("partition_exists"),
            F.when(rows > 0, "overwrite").when(found, "refuse").otherwise("skip").alias("action"),
        )
    )


def days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def expected_partitions(spark: SparkSession, registry: DataFrame, days: list[date]) -> DataFrame:
    """Every registered instance on every day of the load."""
    all_days = F.array(*[F.lit(d.isoformat()).cast("date") for d in days])
    return registry.select("instance_id").distinct().select(F.explode(all_days).alias("dt"), "instance_id")


@dataclass(frozen=True)
class Load:
    """What one load read and placed, as one row a (dt, instance_id): ``source``
    (source_rows) counted while the source was read, ``landed`` (landed_rows,
    newest_at) read back. Both are small stored tables or local rows."""

    table: RawTable
    days: list[date]
    schema: StructType
    source: DataFrame
    landed: DataFrame


class LostRows(RuntimeError):
    """Fewer or more rows were staged than the source gave."""


def stage_rows(rows: DataFrame, path: str, table: RawTable, kept: str) -> DataFrame:
    """Write the partitions of a load aside: the files (part, name, rows), stored in
    ``kept``, with the rows their footers give. The source is read once: its rows
    are observed in the writing stage and compared with what the files hold."""
    spark, seen = rows.sparkSession, Observation()
    folder = storage.uri(spark, path)
    with many_folders(spark):
        observed = arranged(rows, table).observe(seen, F.count(F.lit(1)).alias("rows"))
        # stored before any file is moved: files of an attempt that was lost must not be mixed with those of the next
        written = stored(observed.mapInArrow(part_files.write(folder, table.partitions), part_files.WRITTEN), f"{kept}/written")
    files = stored(dealt(written).mapInArrow(part_files.settle(folder), part_files.WRITTEN), f"{kept}/files")
    found = files.agg(F.sum("rows")).first()[0] or 0
    if found != seen.get["rows"]:
        raise LostRows(f"{table.name}: {seen.get['rows']} rows read, {found} staged")
    return files


def summary(landed: DataFrame, table: RawTable, name: str = "landed_rows") -> DataFrame:
    """Rows and newest high-water value of each (dt, instance_id), in one pass."""
    return landed.groupBy("dt", "instance_id").agg(F.count(F.lit(1)).alias(name), F.max(table.watermark).alias("newest_at"))


def read_back(spark: SparkSession, root: str, table: RawTable, days: Iterable[date], newest: bool = True) -> DataFrame:
    """Landed rows and newest high-water value of each (dt, instance_id), in one
    pass over the files of the given days."""
    path = f"{root}/{table.name}"
    folders = day_folders(spark, path, days)
    if folders:
        read = part_files.read_back(storage.uri(spark, path), table.watermark if newest else None)
        files = dealt(listed_files(spark, path, folders)).mapInArrow(read, part_files.READ_BACK)
    else:
        files = spark.createDataFrame([], part_files.READ_BACK)
    counted = files.select(*partition_values(table), "rows", "newest_at").groupBy(*table.partitions)
    counted = counted.agg(F.sum("rows").alias("landed_rows"), F.max("newest_at").alias("newest_at"))
    return counted if newest else counted.drop("newest_at")


def place(spark: SparkSession, files: DataFrame, staged: str, root: str, table: RawTable) -> None:
    """Move staged partitions into the table. A day that is new to it moves as one
    folder. Where a partition is replaced, its new files come first and its old
    ones go last, so that at no moment the only copy is missing."""
    target = f"{root}/{table.name}"
    present = set(storage.list_names(spark, target))
    days = [n for n in storage.list_names(spark, staged) if n.startswith("dt=")]
    replaced = [day for day in days if day in present]
    for day in days:
        if day not in present:
            storage.move(spark, f"{staged}/{day}", f"{target}/{day}")
    if replaced:
        parts = files.where(F.substring_index("part", "/", 1).isin(replaced)).groupBy("part").agg(F.collect_list("name"))
        put = part_files.replace(storage.uri(spark, staged), storage.uri(spark, target))
        dealt(parts).mapInArrow(put, part_files.LISTED).write.format("noop").mode("overwrite").save()


def load(
    spark: SparkSession,
    source: DataFrame,
    name: str,
    root: str,
    first: str | date,
    last: str | date | None = None,
    registry: DataFrame | None = None,
) -> Load:
    """Land the days ``first..last`` of one table: stage, count, decide, place.

    The source is read once, into a staging folder; the counts of what was
    staged decide, and nothing is placed if any partition would be refused.
    Without a registry there is no guard.
    """
    table = raw_table(name)
    first, last = as_day(first), as_day(last or first)
    days = days_between(first, last)
    staged = f"{root}/_staging/{name}-{uuid.uuid4().hex}"
    kept = fresh_dir(spark, f"load-{name}")
    try:
        files = stage_rows(extract_days(source, table, first, last), staged, table, kept)
        sums = files.select(*partition_values(table), "rows").groupBy("dt", "instance_id").agg(F.sum("rows").alias("source_rows"))
        counts = stored(sums, f"{kept}/source")
        if registry is not None:
            plan = partition_actions(
                counts, landed_partitions(spark, root, table, days), expected_partitions(spark, registry, days)
            )
            refused = plan.where("action = 'refuse'").agg(
                F.count(F.lit(1)).alias("n"), F.min(F.struct("dt", "instance_id")).alias("example")
            ).first()
            if refused["n"]:
                raise ArchiveGuardError(
                    f"{name}: {refused['n']} partitions have no source rows but exist "
                    f"(for example {refused['example']}); refusing to touch the archive"
                )
        place(spark, files, staged, root, table)
    finally:
        storage.delete_folder(spark, staged)
    landed = stored(read_back(spark, root, table, days), f"{kept}/landed")
    return Load(table, days, source.schema, counts, landed)


def offload(
    spark: SparkSession,
    source: DataFrame,
    name: str,
    root: str,
    first: str | date,
    last: str | date | None = None,
    registry: DataFrame | None = None,
) -> DataFrame:
    """``load``, returning the landed row counts per (dt, instance_id)."""
    return load(spark, source, name, root, first, last, registry).landed.drop("newest_at")


def landed_counts(spark: SparkSession, root: str, name: str, first: str | date, last: str | date) -> DataFrame:
    return read_back(spark, root, raw_table(name), days_between(as_day(first), as_day(last)), newest=False)


def offload_registry(spark: SparkSession, registry: DataFrame, root: str, day: str | date) -> int:
    """Full snapshot of the instance registry into ``dt=``. An empty registry is
    skipped when nothing is there yet and refused when a snapshot exists."""
    table = raw_table("dim_instance")
    day = as_day(day)
    rows = registry.select(*[F.col(f.name).cast(f.dataType) for f in table.schema]).withColumn(
        "dt", F.lit(day.isoformat()).cast("date")
    )
    if rows.isEmpty():
        if storage.exists(spark, f"{root}/dim_instance/dt={day.isoformat()}"):
            raise ArchiveGuardError(f"registry is empty but a snapshot of {day} exists")
        return 0
    land(rows, root, table)
    return read_landed(spark, root, "dim_instance", days=[day]).count()


def offload_auxiliary(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    registry: DataFrame,
    root: str,
    first: str | date,
    last: str | date | None = None,
) -> DataFrame:
    """Every auxiliary table under the same contract (guard included), plus the
    registry snapshot of the last day. Returns (table_name, dt, instance_id, landed_rows)."""
    ids = registry.select(F.col("id").alias("instance_id"))

    def one(name: str) -> DataFrame:
        return offload(spark, sources[name], name, root, first, last, ids).select(
            F.lit(name).alias("table_name"), "dt", "instance_id", "landed_rows"
        )

    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:  # small independent jobs share the cluster
        landed = reduce(DataFrame.unionByName, pool.map(one, AUXILIARY))
    offload_registry(spark, registry, root, last or first)
    return landed
