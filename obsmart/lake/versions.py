"""All-or-nothing publishing, time travel and maintenance of published tables.

A version is one small manifest naming, per table, the Parquet folders
("parts") it consists of. Data is written first and the manifest is put in
place last, so a reader sees a whole version or the one before. Parts are
never changed; a new version reuses the parts it did not touch. One writer at
a time is assumed, and a second one is detected.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsmart.sources import storage
from obsmart.sources.local import local_frame


class PublishError(RuntimeError):
    """Written rows differ from the rows that were to be published."""


class RowsRefused(RuntimeError):
    """Rows that break a rule were written; the version is not published."""


Rules = Callable[[str], dict[str, Column]]


class Lake:
    def __init__(self, spark: SparkSession, root: str, writers: int = 4):
        self.spark, self.root, self.writers = spark, root, writers
        self._manifests: dict[int, dict] = {}

    # -- reading ---------------------------------------------------------------
    def versions(self) -> list[int]:
        names = storage.list_names(self.spark, f"{self.root}/versions")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def current_version(self) -> int | None:
        return max(self.versions(), default=None)

    def manifest(self, version: int | None = None) -> dict:
        version = self.current_version() if version is None else version
        if version is None:
            return {"version": 0, "tables": {}}
        if version not in self._manifests:
            path = f"{self.root}/versions/{version:08d}.json"
            if not storage.exists(self.spark, path):
                raise KeyError(f"version {version} does not exist or has expired")
            self._manifests[version] = json.loads(self.spark.read.text(path, wholetext=True).first()[0])
        return self._manifests[version]

    def tables(self, version: int | None = None) -> list[str]:
        return sorted(self.manifest(version)["tables"])

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The table as of a version (default: now), under its recorded schema."""
        entry = self.manifest(version)["tables"][table]
        schema = StructType.fromJson(entry["schema"])
        if not entry["parts"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[p["path"] for p in entry["parts"]])

    def rows(self, version: int | None = None) -> int:
        return sum(p["rows"] for t in self.manifest(version)["tables"].values() for p in t["parts"])

    def snapshots(self) -> DataFrame:
        """(version, committed_at, changes, table_count, row_count) of every version."""
        rows = []
        for v in self.versions():
            m = self.manifest(v)
            rows.append(
                (v, datetime.fromisoformat(m["committed_at"]), m["changes"], len(m["tables"]), self.rows(v))
            )
        return local_frame(
            self.spark, rows, "version BIGINT, committed_at TIMESTAMP, changes STRING, table_count BIGINT, row_count BIGINT"
        )

    # -- writing ---------------------------------------------------------------
    @contextmanager
    def transaction(self, changes: str, committed_at: datetime | None = None):
        """Collect changes to any number of tables and commit them as one version.
        An exception leaves no version behind."""
        tx = Transaction(self)
        try:
            yield tx
        except BaseException:
            tx.discard()
            raise
        base = self.current_version() or 0
        if base != tx.base:
            tx.discard()
            raise PublishError(f"another writer committed version {base} meanwhile")
        body = {
            "version": base + 1,
            "committed_at": (committed_at or datetime.now(UTC)).isoformat(),
            "changes": changes,
            "tables": tx.tables,
        }
        storage.create_text(self.spark, f"{self.root}/versions/{base + 1:08d}.json", json.dumps(body))
        tx.version = base + 1

    def publish(
        self,
        tables: dict[str, DataFrame],
        changes: str = "publish",
        committed_at: datetime | None = None,
        validate: Callable[[Callable[[str], DataFrame]], None] | None = None,
        daily: dict[str, date | None] | None = None,
        rules: Rules | None = None,
    ) -> int:
        """Publish all given tables together as one version.

        Tables are replaced, except those in ``daily``: there only days from the
        given one on are written (all days for ``None``) and the others are
        taken over from the version before. ``rules`` names conditions on the rows
        of a table that none may fulfil: they are counted by the write itself.
        ``validate`` gets a reader of the rows written, before anything becomes
        visible, and may raise.
        """
        daily = daily or {}
        with self.transaction(changes, committed_at) as tx:
            tx.rules = rules
            tx.side_by_side(
                [lambda n=n, df=df: tx.replace_days(n, df, daily[n]) if n in daily else tx.replace(n, df)
                 for n, df in tables.items()]
            )
            tx.refuse_broken()
            if validate:
                validate(tx.read_written)
        return tx.version

    def append(self, table: str, df: DataFrame, day: str | None = None, committed_at: datetime | None = None) -> int:
        """Add rows (of one day) as one version; returns the rows added."""
        with self.transaction(f"append {table}" + (f" {day}" if day else ""), committed_at) as tx:
            added = tx.append(table, df, day)
        return added

    def correct(self, table: str, day: str, where: Column, column: str, value: Column,
                committed_at: datetime | None = None) -> int:
        """Change one column of matching rows. Only the parts of that day are rewritten."""
        with self.transaction(f"correct {table} {day}", committed_at) as tx:
            tx.rewrite_day(table, day, lambda df: df.withColumn(
                column, F.when(where, value.cast(df.schema[column].dataType)).otherwise(F.col(column))))
        return tx.version

    # -- maintenance -------------------------------------------------------------
    def expire(self, older_than: timedelta = timedelta(days=7), as_of: datetime | None = None) -> list[int]:
        """Forget versions committed before ``as_of - older_than`` (never the current
        one), then delete the folders no remaining version refers to."""
        limit = (as_of or datetime.now(UTC)) - older_than
        current = self.current_version()
        old = [
            v for v in self.versions()
            if v != current and datetime.fromisoformat(self.manifest(v)["committed_at"]) < limit
        ]
        for v in old:
            storage.delete_folder(self.spark, f"{self.root}/versions/{v:08d}.json")
            self._manifests.pop(v, None)
        kept = {p["path"] for v in self.versions() for t in self.manifest(v)["tables"].values() for p in t["parts"]}
        written_with = {p.rsplit("/", 1)[0] for p in kept if "/_day=" in p}
        for table in storage.list_names(self.spark, f"{self.root}/data"):
            for name in storage.list_names(self.spark, f"{self.root}/data/{table}"):
                folder = f"{self.root}/data/{table}/{name}"
                unused = [folder]
                if folder in written_with:  # some of its days are still in use
                    days = [f"{folder}/{n}" for n in storage.list_names(self.spark, folder) if n.startswith("_day=")]
                    unused = [d for d in days if d not in kept]
                elif folder in kept:
                    unused = []
                for path in unused:
                    storage.delete_folder(self.spark, path)
        return old

    def compact(self, target_bytes: int = 128 << 20, committed_at: datetime | None = None) -> dict[str, tuple[int, int]]:
        """Merge parts of the same day (or of none) smaller than ``target_bytes``, as
        one version: a table published by day stays in parts by day.
        Returns (parts before, parts after) per table; row counts may not change."""
        tables = self.manifest()["tables"]
        done = {name: (len(t["parts"]), len(t["parts"])) for name, t in tables.items()}
        groups = []
        for name, t in tables.items():
            for day in dict.fromkeys(p["day"] for p in t["parts"]):
                of_day = [p for p in t["parts"] if p["day"] == day]
                if len(of_day) > 1:
                    groups.append((name, [p for p in of_day if storage.folder_size(self.spark, p["path"])[1] < target_bytes]))
        groups = [(name, parts) for name, parts in groups if len(parts) > 1]
        if not groups:
            return done  # nothing to merge, no new version
        with self.transaction("compact", committed_at) as tx:
            for name, parts in groups:
                tx.merge_parts(name, parts, target_bytes)
                done[name] = (done[name][0], len(tx.tables[name]["parts"]))
        return done

    def maintain(
        self,
        older_than: timedelta = timedelta(days=7),
        target_bytes: int = 128 << 20,
        as_of: datetime | None = None,
    ) -> DataFrame:
        """Expire, compact, then drop what only expired versions used.

        Returns (metric, before, after); raises if any table's row count changed.
        """
        before, rows = self._state()
        self.expire(older_than, as_of)
        self.compact(target_bytes, committed_at=as_of)
        self.expire(older_than, as_of)
        after, rows_after = self._state()
        if rows != rows_after:
            raise PublishError(f"maintenance changed row counts: {rows} -> {rows_after}")
        return local_frame(
            self.spark, [(m, before[m], after[m]) for m in before], "metric STRING, before BIGINT, after BIGINT"
        )

    def _state(self) -> tuple[dict[str, int], dict[str, int]]:
        tables = self.manifest()["tables"]
        objects, size = self.stored()
        metrics = {
            "versions": len(self.versions()), "tables": len(tables),
            "parts": sum(len(t["parts"]) for t in tables.values()), "rows": self.rows(),
            "objects": objects, "bytes": size,
        }
        return metrics, {n: sum(p["rows"] for p in t["parts"]) for n, t in tables.items()}

    def measure(self) -> DataFrame:
        """(table_name, parts, files, bytes, row_count) of the current version; no
        rows when nothing is published."""
        rows = []
        for table, entry in sorted(self.manifest()["tables"].items()):
            sizes = [storage.folder_size(self.spark, p["path"]) for p in entry["parts"]]
            rows.append((table, len(sizes), sum(s[0] for s in sizes), sum(s[1] for s in sizes),
                         sum(p["rows"] for p in entry["parts"])))
        return local_frame(
            self.spark, rows, "table_name STRING, parts BIGINT, files BIGINT, bytes BIGINT, row_count BIGINT"
        )

    def stored(self) -> tuple[int, int]:
        """(objects, bytes) below the data folder, including what only old versions use."""
        return storage.folder_size(self.spark, f"{self.root}/data")


class Transaction:
    """Tables of the version being prepared."""

    def __init__(self, lake: Lake):
        self.lake = lake
        self.base = lake.current_version() or 0
        self.tables: dict[str, dict] = json.loads(json.dumps(lake.manifest()["tables"]))
        self.version: int | None = None
        self._written: list[str] = []
        self.rules: Rules | None = None
        self.broken: list[str] = []

    def observed(self, table: str, df: DataFrame, seen: Observation) -> DataFrame:
        """The rows, counted on their way to the writer, with those that break a rule."""
        rules = self.rules(table) if self.rules else {}
        counts = [F.count_if(broken).alias(f"rule{i}") for i, broken in enumerate(rules.values())]
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)

    def note_broken(self, table: str, seen: Observation) -> None:
        rules = self.rules(table) if self.rules else {}
        self.broken += [f"{table} {rule}: {seen.get[f'rule{i}']}" for i, rule in enumerate(rules) if seen.get[f"rule{i}"]]

    def refuse_broken(self) -> None:
        if self.broken:
            raise RowsRefused("; ".join(sorted(self.broken)))

    def _write(self, table: str, df: DataFrame, day: str | None = None) -> dict:
        """Write one part and compare the rows handed to the writer with the rows
        that can be read back. The first number is observed while writing, in
        the writing stage itself, so the plan runs once; the second comes from
        file footers."""
        path = f"{self.lake.root}/data/{table}/{uuid.uuid4().hex}"
        self._written.append(path)
        seen = Observation()
        self.observed(table, df, seen).write.parquet(path)
        self.note_broken(table, seen)
        landed = self.lake.spark.read.schema(df.schema).parquet(path).count()
        if landed != seen.get["rows"]:
            raise PublishError(f"{table}: {seen.get['rows']} rows written, {landed} found")
        return {"path": path, "rows": landed, "day": day}

    def read_written(self, table: str) -> DataFrame:
        """The rows of the table that this transaction has written."""
        entry = self.tables[table]
        schema = StructType.fromJson(entry["schema"])
        paths = [p["path"] for p in entry["parts"] if p["path"].startswith(tuple(self._written))]
        if not paths:
            return self.lake.spark.createDataFrame([], schema)
        return self.lake.spark.read.schema(schema).parquet(*paths)

    def side_by_side(self, jobs: list[Callable[[], object]]) -> None:
        """Run independent writes at the same time."""
        with ThreadPoolExecutor(self.lake.writers) as pool:
            for job in [pool.submit(j) for j in jobs]:
                job.result()

    def replace(self, table: str, df: DataFrame) -> int:
        part = self._write(table, df)
        self.tables[table] = {"schema": df.schema.jsonValue(), "parts": [part]}
        return part["rows"]

    def replace_days(self, table: str, df: DataFrame, since: date | None, column: str = "dt") -> int:
        """Replace the days from ``since`` on, as one part per day; earlier days keep
        their parts. Falls back to all days when there is nothing to build on."""
        old = self.tables.get(table, {"parts": []})["parts"]
        if since is None or not old or any(p["day"] is None for p in old):
            since, old = None, []
        else:  # days that an earlier, failed publish should have added are still missing
            since = min(since, date.fromisoformat(max(p["day"] for p in old)))
        rows = df if since is None else df.where(F.col(column) >= F.lit(since))
        path = f"{self.lake.root}/data/{table}/{uuid.uuid4().hex}"
        self._written.append(path)
        seen = Observation()
        (
            self.observed(table, rows, seen)
            .withColumn("_day", F.col(column))
            .write.partitionBy("_day")
            .parquet(path)
        )
        self.note_broken(table, seen)
        names = [n for n in storage.list_names(self.lake.spark, path) if n.startswith("_day=")]
        landed = {}
        if names:
            back = self.lake.spark.read.schema(df.schema).parquet(*[f"{path}/{n}" for n in names])
            landed = {str(r[0]): r[1] for r in back.groupBy(column).count().collect()}  # one row per day
        if sum(landed.values()) != seen.get["rows"]:
            raise PublishError(f"{table}: {seen.get['rows']} rows written, {sum(landed.values())} found")
        new = [{"path": f"{path}/{n}", "rows": landed[n.removeprefix("_day=")], "day": n.removeprefix("_day=")} for n in names]
        kept = [p for p in old if p["day"] < since.isoformat()] if since else []
        self.tables[table] = {"schema": df.schema.jsonValue(), "parts": kept + new}
        return len(new)

    def append(self, table: str, df: DataFrame, day: str | None = None) -> int:
        entry = self.tables.setdefault(table, {"schema": df.schema.jsonValue(), "parts": []})
        part = self._write(table, df, day)
        entry["parts"].append(part)
        return part["rows"]

    def delete_day(self, table: str, day: str, column: str = "dt") -> int:
        """Drop a day: parts holding only that day are left out without reading them."""
        gone = sum(p["rows"] for p in self.tables[table]["parts"] if p["day"] == day)
        self.tables[table]["parts"] = [p for p in self.tables[table]["parts"] if p["day"] != day]
        before = self.rows(table)
        self._rewrite(table, lambda p: p["day"] is None,
                      lambda df: df.where(F.col(column) != F.lit(day).cast("date")), keep_rows=False)
        return gone + before - self.rows(table)

    def rewrite_day(self, table: str, day: str, change) -> None:
        """Apply ``change`` to the parts that can hold the day; row counts stay."""
        self._rewrite(table, lambda p: p["day"] in (day, None), change, keep_rows=True)

    def _rewrite(self, table: str, touched, change, keep_rows: bool) -> None:
        entry = self.tables[table]
        schema = StructType.fromJson(entry["schema"])
        parts = []
        for p in entry["parts"]:
            if touched(p):
                old = self.lake.spark.read.schema(schema).parquet(p["path"])
                new = self._write(table, change(old).select(*schema.fieldNames()), p["day"])
                if keep_rows and new["rows"] != p["rows"]:
                    raise PublishError(f"{table}: {p['rows']} rows became {new['rows']}")
                p = new
            parts.append(p)
        entry["parts"] = parts

    def merge_parts(self, table: str, small: list[dict], target_bytes: int) -> None:
        entry = self.tables[table]
        schema = StructType.fromJson(entry["schema"])
        size = sum(storage.folder_size(self.lake.spark, p["path"])[1] for p in small)
        merged = self.lake.spark.read.schema(schema).parquet(*[p["path"] for p in small])
        new = self._write(table, merged.coalesce(max(1, -(-size // target_bytes))), small[0]["day"])
        if new["rows"] != sum(p["rows"] for p in small):
            raise PublishError(f"{table}: compaction changed the row count")
        paths = {p["path"] for p in small}
        entry["parts"] = [p for p in entry["parts"] if p["path"] not in paths] + [new]

    def rows(self, table: str) -> int:
        return sum(p["rows"] for p in self.tables[table]["parts"])

    def discard(self) -> None:
        for path in self._written:
            storage.delete_folder(self.lake.spark, path)
