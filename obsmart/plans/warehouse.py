"""All relations by name, with facts written once and read many times."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsmart.params import DEFAULTS, Params
from obsmart.plans.carried import STATES, Carried, last_plans
from obsmart.plans.facts import FACTS, dim_instance, fct_plan_daily, fct_query_daily, int_change_events
from obsmart.plans.marts import MARTS, impact_open_from, plan_open_from
from obsmart.plans.staging import STAGING
from obsmart.sources import storage
from obsmart.sources.landing import SIDE_BY_SIDE
from obsmart.sources.seeds import SEED_SCHEMAS, packaged_seed

# The tables a publish makes visible, together.
PUBLISHED = (
    "fct_query_daily", "mart_query_regression", "fct_query_hourly", "mart_baseline_longterm", "fct_size_daily",
    "mart_capacity_forecast", "fct_wait_event_daily", "fct_backup_daily", "fct_plan_change_daily", "mart_wait_top",
    "mart_plan_regression", "mart_backup_rpo", "mart_weekly_ops_report", "fct_index_daily", "mart_index_verdict",
    "fct_config_change_daily", "mart_config_change", "mart_config_impact", "dim_instance", "fct_uptime_daily",
    "mart_uptime_slo",
)

TAKES_PARAMS = {name for name in MARTS if name != "mart_weekly_ops_report"}
#: Marts whose old rows are settled: their day, and the first one that a change can reach.
SETTLED = {"mart_plan_regression": ("flip_dt", plan_open_from), "mart_config_impact": ("change_dt", impact_open_from)}
#: Marts that read a carried state of a fact instead of its days, and as which argument.
FROM_STATE = {"mart_query_regression": ("fct_query_daily", "days"), "mart_baseline_longterm": ("fct_query_hourly", "moments")}


class Warehouse:
    """Composes raw -> staging -> facts -> marts.

    ``raw`` gives a raw table by name. Facts are materialised below ``root``,
    partitioned by day: six marts read the daily query fact, and none of them
    should recompute it or carry its lineage.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[str], DataFrame],
        root: str,
        params: Params = DEFAULTS,
        seed: Callable[[str], DataFrame] | None = None,
    ):
        self.spark, self.raw, self.root, self.params = spark, raw, root, params
        self.seed = seed or (lambda name: packaged_seed(spark, name))
        self._marts: dict[str, str] = {}
        self._superseded: dict[str, str] = {}
        self._settled: set[str] = set()

    # -- lazy builders -----------------------------------------------------
    def staging(self, name: str, since: date | None = None) -> DataFrame:
        builder, source = STAGING[name]
        raw = self.raw(source)
        return builder(raw if since is None else raw.where(F.col("dt") >= F.lit(since)))

    def build_fact(self, name: str, since: date | None = None) -> DataFrame:
        """The fact computed from raw, optionally only from day ``since`` on.
        The bound is a literal on the partition column, so old days are not listed."""
        builder, inputs = FACTS[name]
        if builder is fct_plan_daily and since is not None:
            return builder(self.staging(*inputs, since), self.plans_before(since))
        if builder is fct_query_daily:
            raw = self.raw("query_snapshot").withColumn("dt", F.col("dt").cast("date"))
            texts = raw if since is None else raw.where(F.col("dt") >= F.lit(since))
            return builder(self.staging(*inputs, since), texts)
        return builder(*[self.staging(i, since) for i in inputs])

    def plans_before(self, day: date) -> DataFrame:
        """The last plan of each query before a day, carried along or, where no
        state is that old, from the stored days."""
        name = "fct_plan_daily"
        found = Carried(self.spark, self.root, name).before(day)
        past = self.spark.read.parquet(f"{self.root}/{name}").where(F.col("dt") < F.lit(day))
        if found is None:
            return last_plans(past)
        return last_plans(found[1].unionByName(past.where(F.col("dt") > F.lit(found[0])).select(*found[1].columns)))

    def build_mart(self, name: str, since: date | None = None) -> DataFrame:
        """The mart from the facts; with ``since`` only the rows of a settled mart
        that a change of days from there on can reach."""
        builder, inputs = MARTS[name]
        self.prepare(name)
        args = [self.table(i) for i in inputs]
        more = {"since": since} if since is not None else {}
        if name in FROM_STATE:
            fact, argument = FROM_STATE[name]
            more[argument] = self.state(fact)
        return builder(*args, self.params, **more) if name in TAKES_PARAMS else builder(*args)

    def state(self, fact: str) -> DataFrame | None:
        """What is carried along a stored fact up to its newest day, if it is there."""
        newest = newest_day(self.spark, f"{self.root}/{fact}")
        carried = Carried(self.spark, self.root, fact)
        return carried.until(newest) if newest in carried.days() else None

    def carry(self, fact: str, since: date | None) -> None:
        """Bring what is carried along a fact up to its newest day."""
        path = f"{self.root}/{fact}"
        newest = newest_day(self.spark, path)
        if fact in STATES and newest is not None:
            Carried(self.spark, self.root, fact).advance(self.spark.read.parquet(path), since, newest)

    def prepare(self, *names: str) -> None:
        """Write the facts among the names and the missing tables the marts among
        them read, independent ones side by side: facts first, then the marts that
        other marts read."""
        marts = [n for n in names if n in MARTS]
        below = _inputs_below(marts) | {n for n in names if n in FACTS}
        if len(marts) > 1:  # one alone is written by its own reader
            below |= READ_BY_MARTS.intersection(marts)
        for level, write in ((FACTS, self.fact), (READ_BY_MARTS, self.mart)):
            wanted = [n for n in level if n in below]
            with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
                list(pool.map(write, wanted))

    # -- relations by name --------------------------------------------------
    def tables(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Several relations; what has to be written for them is written first,
        independent tables side by side."""
        names = list(names)
        self.prepare(*names)
        return {name: self.table(name) for name in names}

    def table(self, name: str) -> DataFrame:
        if name in SEED_SCHEMAS:
            return self.seed(name)
        if name in STAGING:
            return self.staging(name)
        if name == "dim_instance":
            return dim_instance(self.staging("stg_dim_instance"))
        if name == "int_change_events":
            return int_change_events(self.staging("stg_config_param_change"))
        if name in FACTS:
            return self.fact(name)
        if name in MARTS:
            return self.mart(name)
        raise KeyError(name)

    def fact(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if not storage.exists(self.spark, f"{path}/_SUCCESS"):
            write_fact(self.build_fact(name), path, whole=True)
            self.carry(name, None)
        return self.spark.read.parquet(path)

    def mart(self, name: str) -> DataFrame:
        """Marts other marts read are written once per state of the facts."""
        if name in self._settled:
            return read_settled(self.spark, f"{self.root}/{name}")
        return self.stored(name) if name in READ_BY_MARTS else self.build_mart(name)

    def stored(self, name: str) -> DataFrame:
        """A mart as written for the present state of the facts; the folder it
        replaces is deleted."""
        if name in self._settled:
            return self.mart(name)
        if name not in self._marts:
            path = f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"
            self.build_mart(name).write.parquet(path)
            self._marts[name] = path
            if old := self._superseded.pop(name, None):
                storage.delete_folder(self.spark, old)
        return self.spark.read.parquet(self._marts[name])

    def facts_changed(self) -> None:
        self._superseded.update(self._marts)
        self._marts.clear()
        self._settled.clear()

    # -- settled marts ---------------------------------------------------------
    def fingerprint(self) -> str:
        """What the verdicts depend on besides the facts: thresholds and parameters."""
        seed = self.seed("plan_regression_thresholds")
        rows = seed.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*seed.columns).cast("decimal(38,0)"))).first()
        return hashlib.md5(repr((self.params, tuple(rows))).encode()).hexdigest()

    def refresh_mart(self, name: str, since: date | None) -> date | None:
        """Bring a settled mart up to date after days from ``since`` on changed
        (``None``: all of them). Rows before the first one that can change stay in
        their files; the others are computed aside and then put in their place.
        Returns the first day that was computed, None for all.

        Other thresholds or parameters than those of the stored rows mean all of
        them, and so does a missing table. A day noted as open by a refresh that
        did not end is open still.
        """
        day, open_from = SETTLED[name]
        path, spark = f"{self.root}/{name}", self.spark
        by = f"_by={self.fingerprint()}"
        names = storage.list_names(spark, path)
        whole = since is None or by not in names
        first = None if whole else open_from(since, self.params)
        for note in names:
            if note.startswith("_open="):
                noted = note.removeprefix("_open=")
                first = None if noted == "all" or first is None else min(first, date.fromisoformat(noted))
        if first is None:
            rows = self.build_mart(name)
        else:  # whatever is open reaches back as far as the oldest note
            rows = self.build_mart(name, since - (open_from(since, self.params) - first))
        aside = f"{path}/_new-{uuid.uuid4().hex}"
        rows.withColumn("_day", F.col(day)).write.partitionBy("_day").parquet(aside)
        note = f"{path}/_open={first.isoformat() if first else 'all'}"
        if not storage.exists(spark, note):
            storage.create_text(spark, note, "")
        for part in [n for n in names if n.startswith("_day=")]:
            if first is None or part.removeprefix("_day=") >= first.isoformat():
                storage.delete_folder(spark, f"{path}/{part}")
        for part in storage.list_names(spark, aside):
            if part.startswith("_day="):
                storage.move(spark, f"{aside}/{part}", f"{path}/{part}")
        for name_ in storage.list_names(spark, path):
            if name_.startswith(("_open=", "_new-", "_by=")) and name_ != by:
                storage.delete_folder(spark, f"{path}/{name_}")
        if by not in names:
            storage.create_text(spark, f"{path}/{by}", rows.schema.json())
        self._settled.add(name)
        return first


READ_BY_MARTS = {i for _, inputs in MARTS.values() for i in inputs if i in MARTS}


def read_settled(spark: SparkSession, path: str) -> DataFrame:
    names = storage.list_names(spark, path)
    by = next(n for n in names if n.startswith("_by="))
    schema = StructType.fromJson(json.loads(spark.read.text(f"{path}/{by}", wholetext=True).first()[0]))
    days = [f"{path}/{n}" for n in names if n.startswith("_day=")]
    return spark.read.schema(schema).parquet(*days) if days else spark.createDataFrame([], schema)


def _inputs_below(marts: Iterable[str]) -> set[str]:
    direct = {i for m in marts for i in MARTS[m][1]}
    nested = [i for i in direct if i in MARTS]
    return direct | (_inputs_below(nested) if nested else set())


def write_fact(df: DataFrame, path: str, whole: bool = False) -> None:
    """Overwrite the days present in ``df``, or the whole table (only that
    leaves a success marker behind). ``rebalance`` aims at one well-sized file
    per day but lets adaptive execution split a day that is too large."""
    (
        df.hint("rebalance", F.col("dt"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )


def newest_day(spark: SparkSession, path: str) -> date | None:
    """Newest day of a fact from its folder names; no file is opened."""
    names = [n.removeprefix("dt=") for n in storage.list_names(spark, path) if n.startswith("dt=")]
    days = [date.fromisoformat(n) for n in names if n != "__HIVE_DEFAULT_PARTITION__"]
    return max(days, default=None)


def load_start(warehouse: Warehouse, name: str, day: date | None = None, full: bool = False) -> date | None:
    """First day that an incremental load replaces: the newest day of the target,
    or ``day`` where that is older; None for a full load."""
    path = f"{warehouse.root}/{name}"
    if full or not storage.exists(warehouse.spark, f"{path}/_SUCCESS"):
        return None
    newest = newest_day(warehouse.spark, path)
    return min(newest, day) if newest and day else newest


class SchemaChanged(RuntimeError):
    """An incremental load would mix two shapes in one table; rebuild it instead."""


def require_same_columns(old: DataFrame, new: DataFrame, name: str) -> None:
    before, after = sorted(old.dtypes), sorted(new.dtypes)
    if before != after:
        raise SchemaChanged(f"{name}: {sorted(set(before) ^ set(after))}")


def refresh_fact(warehouse: Warehouse, name: str, days_from: date | None = None, full: bool = False) -> date | None:
    """Incremental load: recompute from the newest day of the target (or from
    ``days_from`` for late corrections) and replace those days whole.

    An empty target means a full load. Returns the day the load started from.
    """
    path = f"{warehouse.root}/{name}"
    spark = warehouse.spark
    since = None
    if not full and storage.exists(spark, f"{path}/_SUCCESS"):
        since = days_from or newest_day(spark, path)
    fact = warehouse.build_fact(name, since)
    if since is not None:
        require_same_columns(spark.read.parquet(path), fact, name)
    if name in STATES:
        Carried(spark, warehouse.root, name).forget_from(since)
    write_fact(fact, path, whole=since is None)
    warehouse.carry(name, since)
    warehouse.facts_changed()
    return since
