"""Run log, heartbeats and staleness."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.functions import rounded
from obsmart.operators.ranking import latest_per_key
from obsmart.sources import storage
from obsmart.sources.tables import AXES

# Columns of the two operational tables.
RUN_LOG = (
    "dt DATE, run_id STRING, run_at TIMESTAMP, duration_sec DOUBLE, gate_status STRING, gate_reconciliation STRING, "
    "gate_completeness STRING, gate_freshness STRING, gate_schema_drift STRING, offload_rows BIGINT, "
    "published_rows BIGINT, heartbeat_at TIMESTAMP"
)
HEARTBEAT = "dag_id STRING, last_success_at TIMESTAMP, run_id STRING, note STRING"


def run_records(
    checks: DataFrame,
    day_status: DataFrame,
    run_id: Column,
    run_at: Column,
    duration_sec: Column,
    offload_rows: Column | None = None,
    published_rows: Column | None = None,
    heartbeat_at: Column | None = None,
) -> DataFrame:
    """One run-log row per gated day. An axis without a result stays NULL."""
    axes = checks.groupBy("dt").agg(
        *[F.max(F.when(F.col("axis") == a, F.col("status"))).alias(f"gate_{a}") for a in AXES]
    )

    def typed(value: Column | None, kind: str, name: str) -> Column:
        return (F.lit(None) if value is None else value).cast(kind).alias(name)

    return axes.join(day_status.select("dt", "gate_status"), "dt").select(
        "dt",
        typed(run_id, "string", "run_id"),
        typed(run_at, "timestamp", "run_at"),
        rounded(duration_sec, 3).alias("duration_sec"),
        "gate_status",
        *[f"gate_{a}" for a in AXES],
        typed(offload_rows, "bigint", "offload_rows"),
        typed(published_rows, "bigint", "published_rows"),
        typed(heartbeat_at, "timestamp", "heartbeat_at"),
    )


def append_runs(records: DataFrame, path: str) -> None:
    """The log only ever grows."""
    records.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)


def beat(spark: SparkSession, path: str, dag_id: str, at: datetime, run_id: str | None = None,
         note: str | None = None) -> None:
    """Record a success. History is kept; the newest row per pipeline counts."""
    spark.createDataFrame([(dag_id, at, run_id, note)], HEARTBEAT).coalesce(1).write.mode("append").parquet(path)


def latest_beats(beats: DataFrame) -> DataFrame:
    return latest_per_key(
        beats.withColumn("_at", F.col("last_success_at")), ["dag_id"], ["_at", "run_id"],
        ["last_success_at", "run_id", "note"],
    )


#: Files of single beats from which they are folded.
FOLD_AT = 64


def _folds(spark: SparkSession, path: str) -> list[str]:
    """Complete folds, oldest first; one without its marker was interrupted."""
    names = storage.list_names(spark, f"{path}/_folds")
    return [n for n in names if storage.exists(spark, f"{path}/_folds/{n}/_SUCCESS")]


def read_beats(spark: SparkSession, path: str) -> DataFrame:
    """All beats that still matter: the newest fold and the files beside it. A file
    that the fold holds already changes nothing, for only the latest counts."""
    folds = _folds(spark, path)
    places = [f"{path}/{n}" for n in storage.list_files(spark, path)] + [f"{path}/_folds/{n}" for n in folds[-1:]]
    return spark.read.schema(HEARTBEAT).parquet(*places) if places else spark.createDataFrame([], HEARTBEAT)


def fold_beats(spark: SparkSession, path: str) -> str:
    """Write the latest beat of each pipeline as one state; returns its name.

    The state counts from the moment its marker is written, and until then it is
    ignored. Files that it holds are deleted by the next fold, not by this one:
    a reader that began before finds its files, and whatever an interruption
    leaves behind is folded again. Reads so grow with the pipelines and the
    beats of two folds, not with age.
    """
    files, folds = storage.list_files(spark, path), _folds(spark, path)
    number = 1 + max([int(n) for n in storage.list_names(spark, f"{path}/_folds")], default=0)
    name = f"{number:08d}"
    latest_beats(read_beats(spark, path)).select("dag_id", "last_success_at", "run_id", "note").write.parquet(f"{path}/_folds/{name}")
    storage.create_text(spark, f"{path}/_folds/{name}/_covered", "\n".join(files))
    if folds:
        covered = f"{path}/_folds/{folds[-1]}/_covered"
        if storage.exists(spark, covered):
            for old in storage.read_text(spark, covered).splitlines():
                storage.delete_folder(spark, f"{path}/{old}")
        for old in folds[:-1]:
            storage.delete_folder(spark, f"{path}/_folds/{old}")
    return name


def fold_many_beats(spark: SparkSession, path: str, at: int = FOLD_AT) -> None:
    if len(storage.list_files(spark, path)) >= at:
        fold_beats(spark, path)


def staleness(watched: DataFrame, latest: DataFrame, as_of: Column) -> DataFrame:
    """Is each watched pipeline (dag_id, max_age_seconds) overdue at ``as_of``?
    Never having succeeded is stale; being exactly at the deadline is not."""
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros("last_success_at")) / F.lit(1_000_000.0)
    return (
        watched.join(latest.select("dag_id", "last_success_at"), "dag_id", "left")
        .withColumn("age_seconds", age)
        .select(
            "dag_id",
            (F.col("age_seconds").isNull() | (F.col("age_seconds") > F.col("max_age_seconds"))).alias("stale"),
            "age_seconds",
            "max_age_seconds",
            "last_success_at",
        )
    )
