"""One day of the pipeline: land, gate, transform, check, publish, record."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.lake.versions import Lake
from obsmart.params import DEFAULTS, Params
from obsmart.plans.facts import FACTS
from obsmart.plans.warehouse import PUBLISHED, SETTLED, Warehouse, load_start, refresh_fact
from obsmart.quality import contract, data_tests, gate, runs
from obsmart.sources import storage
from obsmart.sources.landing import SIDE_BY_SIDE, ArchiveGuardError, Load, as_day, load, offload_registry, read_landed
from obsmart.sources.tables import AUXILIARY, PRIMARY, raw_table


CHILDREN = {parent: child for child, (parent, _) in data_tests.PARENTS.items()}


def row_rules(name: str) -> dict[str, Column]:
    """What no published row of a table may be: counted while it is written."""
    promised = contract.value_rules(name) if name in contract.CONTRACTS else {}
    return {**data_tests.table_rules(name), **promised}


class DailyRun:
    """Folders and sources of one deployment."""

    def __init__(
        self,
        spark: SparkSession,
        source: Callable[[str], DataFrame],
        registry: Callable[[], DataFrame],
        root: str,
        params: Params = DEFAULTS,
        name: str = "daily",
        write_back: Callable[[int], None] | None = None,
        read_day: Callable[[str, date], DataFrame] | None = None,
    ):
        """``source`` gives a whole source table; ``read_day``, where it is given, only
        what a load of one day needs (see ``jdbc.DaySource``)."""
        self.spark, self.source, self.registry, self.params, self.name = spark, source, registry, params, name
        self.raw_root, self.log, self.beats = f"{root}/raw", f"{root}/run_log", f"{root}/heartbeat"
        self.pending, self.write_back, self.read_day = f"{root}/unpublished", write_back, read_day
        #: What went wrong beside the main branch of the last run.
        self.problems: list[str] = []
        #: First day of each fact that the present publish replaces.
        self.since: dict[str, date | None] = {}
        self.lake = Lake(spark, f"{root}/lake")
        self.warehouse = Warehouse(spark, lambda n: read_landed(spark, self.raw_root, n), f"{root}/facts", params)

    def instances(self) -> DataFrame:
        return self.registry().select(F.col("id").alias("instance_id"))

    def rows(self, name: str, day: date) -> DataFrame:
        """The source rows of one table that a load of ``day`` picks from."""
        return self.read_day(name, day) if self.read_day else self.source(name)

    def land(self, name: str, day: date) -> Load:
        """Land one table, guarded; its source is read once."""
        return load(self.spark, self.rows(name, day), name, self.raw_root, day, None, self.instances())

    def gate_load(self, landed: Load) -> DataFrame:
        """The gate of what was just landed, from the counts the load took."""
        return gate.evaluate_load(self.spark, landed, self.instances(), self.params)

    def land_auxiliary(self, day: date) -> list[str]:
        """Land and gate each auxiliary table and the registry on its own; what
        is refused or fails its gate is returned and keeps back nothing else."""

        def one(name: str) -> str | None:
            try:
                gate.require_pass(self.gate_load(self.land(name, day)))
            except (ArchiveGuardError, gate.GateBlocked) as refused:
                return f"{name}: {refused}"
            return None

        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            found = list(pool.map(one, AUXILIARY))
        try:
            offload_registry(self.spark, self.registry(), self.raw_root, day)
        except ArchiveGuardError as refused:
            found.append(f"dim_instance: {refused}")
        return [x for x in found if x]

    def unpublished(self, starts: dict[str, date | None]) -> dict[str, date | None]:
        """Note the first day of each fact that is about to change, and return the
        oldest day noted since the last publish that went through. The notes
        outlive a failed run, so that its days are published by the next."""
        for fact, start in starts.items():
            storage.create_text(self.spark, f"{self.pending}/{fact}={start or 'all'}={uuid.uuid4().hex}", "")
        oldest = dict(starts)
        for name in storage.list_names(self.spark, self.pending):
            fact, start, _ = name.split("=")
            if start == "all" or oldest.get(fact, None) is None:
                oldest[fact] = None
            else:
                oldest[fact] = min(oldest[fact], date.fromisoformat(start))
        return oldest

    def gate(self, name: str, days: list[date]) -> DataFrame:
        """The gate of days landed earlier: both sides are read."""
        return gate.evaluate(
            self.spark, self.source(name), read_landed(self.spark, self.raw_root, name, days=days), self.instances(),
            raw_table(name), days, self.params,
        )

    def check(self, staged: Callable[[str], DataFrame]) -> None:
        """Uniqueness and relationships of the rows as written, before they are
        visible. Only the days of this publish are read, of parents as well."""

        def tables(name: str) -> DataFrame:
            if name in PUBLISHED:
                return staged(name)
            return self.warehouse.staging(name, self.since.get(CHILDREN[name]))

        data_tests.require_keys(tables, [n for n in PUBLISHED if n in data_tests.NOT_NULL])

    def beat(self, now: datetime, run_id: str | None) -> None:
        runs.beat(self.spark, self.beats, self.name, now, run_id)
        runs.fold_many_beats(self.spark, self.beats)

    def run(self, day: str | date, run_id: str | None = None, full: bool = False) -> int:
        """Process one closed day, the newest or an older one; returns the published
        version. A failing gate, contract or data test raises, and what is
        published stays as it was. What fails beside the main branch (auxiliary
        tables, writing back, the run log) is listed in ``problems``."""
        day, started = as_day(day), time.monotonic()
        primary = self.land(PRIMARY, day)
        self.problems = self.land_auxiliary(day)
        checks = self.gate_load(primary)
        gate.require_pass(checks)
        offloaded = primary.landed.agg(F.sum("landed_rows")).first()[0] or 0
        starts = {fact: load_start(self.warehouse, fact, day, full) for fact in FACTS}
        since = self.unpublished(starts)
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            list(pool.map(lambda fact: refresh_fact(self.warehouse, fact, starts[fact], starts[fact] is None), FACTS))
        changed = None if None in since.values() else min(since.values())
        for mart in SETTLED:  # in this order: the second reads the first
            self.warehouse.refresh_mart(mart, changed)
        tables = {name: self.warehouse.table(name) for name in PUBLISHED}
        for name in contract.CONTRACTS:
            contract.require_shape(tables[name], name)
        self.since = since
        version = self.lake.publish(tables, f"publish {day}", validate=self.check, daily=since, rules=row_rules)
        storage.delete_folder(self.spark, self.pending)
        published = self.lake.rows(version)
        now = datetime.now(UTC)
        with ThreadPoolExecutor(2) as pool:
            beat = pool.submit(self.beat, now, run_id)
            if self.write_back:
                failed = pool.submit(self.write_back, version).exception()
                if failed:
                    self.problems.append(f"write back: {failed}")
            beat.result()
        records = runs.run_records(
            checks, gate.day_status(checks), F.lit(run_id), F.lit(now), F.lit(time.monotonic() - started),
            F.lit(offloaded), F.lit(published), F.lit(now),
        )
        try:
            runs.append_runs(records.coalesce(1), self.log)
        except Exception as failed:  # the version is published: a log must not undo that
            self.problems.append(f"run log: {failed}")
        return version

