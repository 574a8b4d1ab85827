"""The gate between landing and transforming: four checks per table and day.

All checks come from one count of the source and one sum of the landed rows by
(day, instance). Nothing is transformed while one of them fails.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsmart.functions import hours_between
from obsmart.params import DEFAULTS, Params
from obsmart.sources.landing import Load, expected_partitions, extract_days, summary
from obsmart.sources.local import local_frame
from obsmart.sources.tables import AXES, RawTable

OK, WARN, FAIL, SKIP = "OK", "WARN", "FAIL", "SKIP"


class GateBlocked(RuntimeError):
    """At least one day failed the gate."""


def counts(df: DataFrame, name: str) -> DataFrame:
    """Rows per (dt, instance_id)."""
    return df.groupBy("dt", "instance_id").agg(F.count(F.lit(1)).alias(name))


def source_counts(source: DataFrame, table: RawTable, days: list[date]) -> DataFrame:
    return counts(extract_days(source, table, min(days), max(days)), "source_rows").where(F.col("dt").isin(days))


def newest_watermark(landed: DataFrame, table: RawTable) -> DataFrame:
    return landed.groupBy("dt").agg(F.max(table.watermark).alias("newest_at"))


def reconcile(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Both sides per (dt, instance_id); a partition missing on one side counts as 0."""
    zero = F.lit(0).cast("long")
    return source.join(landed, ["dt", "instance_id"], "full_outer").select(
        "dt",
        "instance_id",
        F.coalesce("source_rows", zero).alias("source_rows"),
        F.coalesce("landed_rows", zero).alias("landed_rows"),
        (F.coalesce("source_rows", zero) == F.coalesce("landed_rows", zero)).alias("matches"),
    )


def missing_instances(landed: DataFrame, expected: DataFrame) -> DataFrame:
    """Registered (dt, instance_id) without a landed row."""
    return expected.join(landed.where("landed_rows > 0"), ["dt", "instance_id"], "left_anti")


def freshness_status(newest_at: Column, p: Params = DEFAULTS) -> Column:
    """Distance of the last row from the end of its day; strictly beyond a limit counts."""
    gap = freshness_gap(newest_at)
    return (
        F.when(newest_at.isNull() | (gap > p.freshness_fail_hours), FAIL)
        .when(gap > p.freshness_warn_hours, WARN)
        .otherwise(OK)
    )


def freshness_gap(newest_at: Column) -> Column:
    return hours_between(F.date_add(F.col("dt"), 1).cast("timestamp_ntz"), newest_at)


def schema_drift(actual: StructType, declared: StructType) -> tuple[str, str]:
    """Missing or retyped columns break the extract; extra ones are only lost."""
    have = {f.name: f.dataType for f in actual}
    missing = [f.name for f in declared if f.name not in have]
    retyped = [f.name for f in declared if f.name in have and have[f.name] != f.dataType]
    extra = sorted(set(have) - {f.name for f in declared})
    if missing or retyped:
        return FAIL, f"missing {missing}, retyped {retyped}"
    if extra:
        return WARN, f"columns not taken over: {extra}"
    return OK, f"{len(declared)} columns as declared"


def evaluate(
    spark: SparkSession,
    source: DataFrame,
    landed: DataFrame,
    registry: DataFrame,
    table: RawTable,
    days: list[date],
    p: Params = DEFAULTS,
) -> DataFrame:
    """(dt, table_name, axis, status, detail) for every requested day and axis.

    The source is counted and the landed rows are summed up once, whatever the
    number of axes. Axes the table is not held to are reported as skipped, not
    as passed.
    """
    inside = landed.where(F.col("dt").isin(days))
    return judge(spark, source_counts(source, table, days), summary(inside, table), source.schema, registry, table, days, p)


def evaluate_load(spark: SparkSession, load: Load, registry: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """The gate of a load that has just been placed, from the counts taken when its
    rows were read and when they were read back: neither side is read again."""
    return judge(spark, load.source, load.landed, load.schema, registry, load.table, load.days, p)


def judge(
    spark: SparkSession,
    source: DataFrame,
    landed: DataFrame,
    schema: StructType,
    registry: DataFrame,
    table: RawTable,
    days: list[date],
    p: Params = DEFAULTS,
) -> DataFrame:
    """All axes from one row a (dt, instance_id) of either side: (source_rows) and
    (landed_rows, newest_at). The sides and the expected partitions are laid
    over one another once and summed up by day."""
    rows, zero = F.lit(0).cast("long"), F.lit(0)
    nothing = F.lit(None).cast("timestamp_ntz")
    expected = expected_partitions(spark, registry, days)
    sides = (
        source.select("dt", "instance_id", "source_rows", rows.alias("landed_rows"), nothing.alias("newest_at"), F.lit(False).alias("wanted"))
        .unionByName(landed.select("dt", "instance_id", rows.alias("source_rows"), "landed_rows", "newest_at", F.lit(False).alias("wanted")))
        .unionByName(expected.select("dt", "instance_id", rows.alias("source_rows"), rows.alias("landed_rows"), nothing.alias("newest_at"), F.lit(True).alias("wanted")))
    )
    parts = sides.groupBy("dt", "instance_id").agg(
        F.sum("source_rows").alias("source_rows"), F.sum("landed_rows").alias("landed_rows"),
        F.max("newest_at").alias("newest_at"), F.bool_or("wanted").alias("wanted"),
    )
    per_day = parts.groupBy("dt").agg(
        F.sum("source_rows").alias("s"), F.sum("landed_rows").alias("l"),
        F.count_if(F.col("source_rows") != F.col("landed_rows")).alias("bad"),
        F.count_if(F.col("wanted") & (F.col("landed_rows") == 0)).alias("gone"), F.max("newest_at").alias("newest_at"),
    )
    day_rows = local_frame(spark, [(d,) for d in days], "dt DATE")
    whole = day_rows.join(per_day, "dt", "left")
    newest_at, bad, gone = F.col("newest_at"), F.coalesce("bad", zero), F.coalesce("gone", zero)
    drift, drift_detail = schema_drift(schema, table.schema)
    found = {
        "reconciliation": (
            F.when(bad > 0, FAIL).otherwise(OK),
            F.format_string("source %d, landed %d, %d instances differ", F.coalesce("s", zero), F.coalesce("l", zero), bad),
        ),
        "completeness": (F.when(gone > 0, FAIL).otherwise(OK), F.format_string("%d instances missing", gone)),
        "freshness": (
            freshness_status(newest_at, p),
            F.when(newest_at.isNull(), "no rows").otherwise(
                F.format_string("%.1f hours before the end of the day", freshness_gap(newest_at))
            ),
        ),
        "schema_drift": (F.lit(drift), F.lit(drift_detail)),
    }
    skipped = (F.lit(SKIP), F.lit("not required for this table"))
    axes = []
    for axis in AXES:
        status, detail = found[axis] if axis in table.gate else skipped
        axes.append(F.struct(F.lit(axis).alias("axis"), status.alias("status"), detail.alias("detail")))
    return whole.select("dt", F.lit(table.name).alias("table_name"), F.inline(F.array(*axes)))


def day_status(checks: DataFrame) -> DataFrame:
    """Worst status per table and day (FAIL over WARN over OK), and whether it blocks."""
    severity = F.max(F.when(F.col("status") == FAIL, 2).when(F.col("status") == WARN, 1).otherwise(0))
    return checks.groupBy("dt", "table_name").agg(severity.alias("s")).select(
        "dt",
        "table_name",
        F.when(F.col("s") == 2, FAIL).when(F.col("s") == 1, WARN).otherwise(OK).alias("gate_status"),
        (F.col("s") == 2).alias("blocked"),
    )


def require_pass(checks: DataFrame) -> None:
    """Fail closed: raise when any day is blocked."""
    blocked = day_status(checks).where("blocked").agg(
        F.count(F.lit(1)).alias("n"), F.min("dt").alias("first"), F.min("table_name").alias("name")
    ).first()
    if blocked["n"]:
        raise GateBlocked(f"{blocked['name']}: {blocked['n']} days failed the gate, first {blocked['first']}")


def two_sided_report(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Total rows on both sides per day."""
    totals = reconcile(source, landed).groupBy("dt").agg(
        F.sum("source_rows").alias("source_rows"), F.sum("landed_rows").alias("landed_rows")
    )
    return totals.withColumn(
        "result", F.when(F.col("source_rows") == F.col("landed_rows"), "OK").otherwise("MISMATCH")
    )
