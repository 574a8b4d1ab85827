"""Reading the monitoring database and writing marts back, through Spark's JDBC source."""

from __future__ import annotations

import heapq
from collections.abc import Callable
from datetime import date, datetime, time, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from obsmart.sources.landing import as_day, landed_counts
from obsmart.sources.tables import RawTable, raw_table

FETCH_ROWS = 50_000
#: Connections that one load opens at most, however many databases there are;
#: slices of the day that one database is cut into at most.
CONNECTIONS, MOST_SLICES = 32, 24


class Piece(NamedTuple):
    """Slice ``part`` of ``slices`` of the day of one instance."""

    instance: int
    part: int = 0
    slices: int = 1


def balanced(instances: list[int], rows: dict[int, int], connections: int = CONNECTIONS) -> list[list[Piece]]:
    """What each connection reads, at most ``connections`` lists of about equal weight.

    An instance weighs as many rows as it had the day before, an unknown one as
    many as the average. One that weighs more than a connection's share is cut
    into equal slices of the day; pieces are then dealt, heaviest first, to the
    connection with the least so far. The registry is one number a database.
    """
    known = [rows[i] for i in instances if i in rows]
    usual = max(1, sum(known) // max(1, len(known)))
    weights = {i: max(1, rows.get(i, usual)) for i in sorted(set(instances))}
    share = max(1, -(-sum(weights.values()) // connections))
    pieces = []
    for i, weight in weights.items():
        slices = min(MOST_SLICES, -(-weight // share))
        pieces += [(weight / slices, Piece(i, k, slices)) for k in range(slices)]
    lists: list[list[Piece]] = [[] for _ in range(min(connections, len(pieces)))]
    heap = [(0.0, n) for n in range(len(lists))]
    for weight, piece in sorted(pieces, key=lambda x: (-x[0], x[1])):
        have, n = heapq.heappop(heap)
        lists[n].append(piece)
        heapq.heappush(heap, (have + weight, n))
    return lists


def connection_predicates(lists: list[list[Piece]], table: RawTable, day: str | date) -> list[str]:
    """One predicate, hence one Spark partition and one connection, per list.

    Instances come first, so that the source's (instance_id, time) index serves
    every branch.
    """
    start = datetime.combine(as_day(day), time())

    def span(k: int, slices: int) -> str:
        low, high = (start + timedelta(days=1) * n / slices for n in (k, k + 1))
        return f"{table.watermark} >= '{low}' AND {table.watermark} < '{high}'"

    out = []
    for pieces in lists:
        whole = sorted(p.instance for p in pieces if p.slices == 1)
        branches = [f"instance_id IN ({', '.join(map(str, whole))}) AND {span(0, 1)}"] if whole else []
        branches += [f"instance_id = {p.instance} AND {span(p.part, p.slices)}" for p in sorted(pieces) if p.slices > 1]
        out.append(" OR ".join(f"({b})" for b in branches) if len(branches) > 1 else branches[0])
    return out


def registry_ids(registry: DataFrame) -> list[int]:
    """The registry is the list of monitored databases; it drives the scan."""
    return [r["id"] for r in registry.select("id").orderBy("id").toLocalIterator()]


Reader = Callable[[str, list[str]], DataFrame]


def jdbc_reader(spark: SparkSession, url: str, **properties: str) -> Reader:
    """The usual reader: one connection a predicate."""
    options = {"fetchsize": str(FETCH_ROWS), "preferTimestampNTZ": "true", **properties}
    return lambda name, predicates: spark.read.jdbc(url, name, predicates=predicates, properties=options)


def read_day(
    reader: Reader, table: RawTable, instances: list[int], rows: dict[int, int], day: str | date, connections: int = CONNECTIONS
) -> DataFrame:
    """One day of one table through at most ``connections`` connections. Only the
    declared columns are asked for."""
    found = reader(table.name, connection_predicates(balanced(instances, rows, connections), table, day))
    return found.select(*table.columns)


class DaySource:
    """A day of any table of the monitoring database, as ``DailyRun`` asks for it:
    the registry drives the scan, yesterday's landed rows balance it."""

    def __init__(
        self, spark: SparkSession, reader: Reader, registry: Callable[[], DataFrame], raw_root: str, connections: int = CONNECTIONS
    ):
        self.spark, self.reader, self.registry, self.raw_root, self.connections = spark, reader, registry, raw_root, connections

    def rows_before(self, name: str, day: date) -> dict[int, int]:
        """Landed rows by instance of the day before, from file footers: one number a database."""
        before = day - timedelta(days=1)
        counts = landed_counts(self.spark, self.raw_root, name, before, before)
        return {r["instance_id"]: r["landed_rows"] for r in counts.toLocalIterator()}

    def __call__(self, name: str, day: date) -> DataFrame:
        table = raw_table(name)
        instances = registry_ids(self.registry())
        if not instances:
            return self.spark.createDataFrame([], table.schema)
        return read_day(self.reader, table, instances, self.rows_before(name, day), day, self.connections)


class WriteBackError(RuntimeError):
    """The staged rows are not the rows that were meant to be written."""


def swap_statements(target: str, staging: str, columns: list[str]) -> list[str]:
    """Replace the target's rows by the staged ones; run in one transaction."""
    names = ", ".join(columns)
    return [f"DELETE FROM {target}", f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging}"]


def write_back(
    df: DataFrame,
    target: str,
    columns: list[str],
    stage: Callable[[DataFrame, str], None],
    staged_rows: Callable[[str], int],
    run_in_transaction: Callable[[list[str]], None],
    configured: bool = True,
) -> int | None:
    """Write a mart to an existing external table, all or nothing.

    The rows are staged in parallel by Spark, counted, and swapped in by the
    target database inside one transaction: no row passes through the driver
    and a failure at any step leaves the old rows. Returns the row count, or
    ``None`` when no target is configured.
    """
    if not configured:
        return None
    payload = df.select(*columns)
    staging = f"{target}_staging"
    stage(payload, staging)
    expected, staged = payload.count(), staged_rows(staging)
    if expected != staged:
        raise WriteBackError(f"{target}: {staged} rows staged, {expected} expected")
    run_in_transaction(swap_statements(target, staging, columns))
    return staged


def jdbc_stage(url: str, **properties: str) -> Callable[[DataFrame, str], None]:
    """The usual ``stage``: Spark's JDBC writer, emptying the staging table first."""

    def stage(df: DataFrame, staging: str) -> None:
        df.write.mode("overwrite").option("truncate", "true").jdbc(url, staging, properties=properties)

    return stage


def jdbc_staged_rows(spark: SparkSession, url: str, **properties: str) -> Callable[[str], int]:
    return lambda staging: spark.read.jdbc(url, staging, properties=properties).count()


# The external baseline table and its columns.
BASELINE_TARGET = "baseline_longterm"
BASELINE_COLUMNS = [
    "instance_id", "query_id", "dow", "hour", "mean_delta_calls", "stddev_delta_calls", "observations", "computed_at",
]


def baseline_write_back(
    mart: Callable[[int], DataFrame],
    stage: Callable[[DataFrame, str], None],
    staged_rows: Callable[[str], int],
    run_in_transaction: Callable[[list[str]], None],
    configured: bool = True,
) -> Callable[[int], None]:
    """What ``DailyRun`` calls after a publish: the published baseline goes to its
    external table. ``mart`` reads the mart as of a version."""

    def after(version: int) -> None:
        write_back(mart(version), BASELINE_TARGET, BASELINE_COLUMNS, stage, staged_rows, run_in_transaction, configured)

    return after
