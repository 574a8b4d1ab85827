"""Per-instance thresholds kept as small typed CSV files."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from obsmart.sources.local import local_frame

SEED_SCHEMAS = {
    "capacity_thresholds": "instance_id BIGINT, threshold_bytes BIGINT, threshold_kind STRING",
    "plan_regression_thresholds": "instance_id BIGINT, regress_ratio DOUBLE, min_after_calls BIGINT",
    "uptime_slo_targets": "instance_id BIGINT, target_pct DOUBLE",
    "backup_rpo_thresholds": "instance_id BIGINT, max_gap_days BIGINT",
}


def read_seed(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """A seed kept on storage every executor can reach."""
    return (
        spark.read.schema(SEED_SCHEMAS[name])
        .option("header", True)
        .option("comment", "#")
        .csv(f"{folder}/{name}.csv")
    )


def packaged_seed(spark: SparkSession, name: str) -> DataFrame:
    """The seed shipped with the package. Its few lines are read on the driver,
    because a path inside a Python package means nothing to an executor."""
    text = (Path(__file__).parent.parent / "seeds" / f"{name}.csv").read_text().splitlines()
    header, *lines = [line for line in text if line and not line.startswith("#")]
    rows = [tuple(v or None for v in line.split(",")) for line in lines]
    strings = local_frame(spark, rows, ", ".join(f"{c} STRING" for c in header.split(",")))
    return strings.selectExpr(
        *[f"cast({c} as {t}) as {c}" for c, t in (f.split() for f in SEED_SCHEMAS[name].split(", "))]
    )
