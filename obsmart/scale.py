"""Growing a day of raw rows into years and large fleets, as Spark jobs."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.lake.versions import Lake
from obsmart.sources.landing import as_day
from obsmart.sources.local import local_frame

# Slow-down per query bucket, days slowed down, id distance of copies.
SLOWDOWNS = [0.0, 0.0, 0.0, 0.5, 1.5]
SLOW_DAYS = 7
COPY_ID_STRIDE = 1_000_000_000


def replicate_day(raw: DataFrame, day: str | date, first: str | date, days: int, at: str = "captured_at") -> DataFrame:
    """Repeat one closed day on ``days`` dates from ``first`` on. Times move with
    the date, so a row always lies inside its partition's day."""
    day, first = as_day(day), as_day(first)
    shift = (first - day).days
    return (
        raw.where(F.col("dt") == F.lit(day))
        .withColumn("_n", F.explode(F.sequence(F.lit(shift), F.lit(shift + days - 1))))
        .withColumn("dt", F.date_add(F.lit(day), F.col("_n")))
        .withColumn(at, F.col(at) + F.make_dt_interval(F.col("_n")))
        .drop("_n")
    )


def query_bucket(query_id: Column) -> Column:
    """A bucket 0..4 that depends on the text of the id alone."""
    return F.conv(F.substring(F.md5(query_id), 1, 8), 16, 10).cast("long") % len(SLOWDOWNS)


def slow_down(raw: DataFrame, last: str | date, days: int = SLOW_DAYS) -> DataFrame:
    """Make two of five query buckets slower during the last ``days`` days."""
    factors = F.array(*[F.lit(1.0 + s) for s in SLOWDOWNS])
    factor = F.element_at(factors, (query_bucket(F.col("query_id")) + 1).cast("int"))
    late = F.col("dt") > F.lit(as_day(last) - timedelta(days=days))
    return raw.withColumn("total_time_ms", F.when(late, F.col("total_time_ms") * factor).otherwise(F.col("total_time_ms")))


def spread_instances(raw: DataFrame, base: list[int], copies: int) -> DataFrame:
    """``copies`` synthetic instances cycling over the ``base`` ones.

    Each base row is expanded to the copies it stands for; nothing is paired
    that is not kept.
    """
    positions = local_frame(
        raw.sparkSession, [(b, i) for i, b in enumerate(sorted(base))], "instance_id BIGINT, _position INT"
    )
    return (
        raw.join(positions, "instance_id")
        .where(F.col("_position") < copies)
        .withColumn("_copy", F.explode(F.sequence(F.col("_position") + 1, F.lit(copies), F.lit(len(base)))))
        .withColumn("instance_id", F.col("_copy").cast("long"))
        .withColumn("query_id", F.concat("query_id", F.lit("~i"), F.col("_copy").cast("string")))
        .withColumn("id", F.col("id") + F.col("_copy").cast("long") * F.lit(COPY_ID_STRIDE))
        .drop("_position", "_copy")
    )


def daily_commits(lake: Lake, table: str, raw: DataFrame, days: list[date]) -> int:
    """One committed version per day, as a daily pipeline leaves them behind."""
    for day in days:
        lake.append(table, raw.where(F.col("dt") == F.lit(day)), day.isoformat())
    return lake.current_version()
