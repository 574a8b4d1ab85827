"""Change detection, date-window joins and quantiles of histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flips(df: DataFrame, keys: Sequence[str], day: str, value: str, before: str) -> DataFrame:
    """Days on which ``value`` differs from ``before``, its value on the previous
    observed day, with the days of the neighbouring flips.

    Expects one row per (keys, day), so a window holds flips, not raw rows.
    Output: keys, flip_dt, prev_value, new_value, prev_flip_dt, next_flip_dt.
    """
    changed = df.where(F.col(before).isNotNull() & (F.col(value) != F.col(before))).select(
        *keys, F.col(day).alias("flip_dt"), F.col(before).alias("prev_value"), F.col(value).alias("new_value")
    )
    by_flip = Window.partitionBy(*keys).orderBy("flip_dt")
    return changed.withColumn("prev_flip_dt", F.lag("flip_dt").over(by_flip)).withColumn(
        "next_flip_dt", F.lead("flip_dt").over(by_flip)
    )


def dates_around(df: DataFrame, center: str, before: int, after: int, day: str = "dt") -> DataFrame:
    """One row per date of the window around ``center``, with ``day_offset``.

    Turns "date between a and b" into an equality on the date: the join that
    follows hashes on (keys, date), so neither a busy key nor a long history
    makes one task compare all events with all days of that key.
    """
    return df.withColumn(
        "day_offset", F.explode(F.sequence(F.lit(-before), F.lit(after)))
    ).withColumn(day, F.date_add(F.col(center), F.col("day_offset")))


def rank_ranges(counts: DataFrame, keys: Sequence[str], value: str, n: str) -> DataFrame:
    """Give each (value, count) row the 0-based ranks it stands for:
    ``rank_from`` up to but excluding ``rank_to``, out of ``rank_all``.

    The window runs over distinct values in order and can spill, so no group
    is ever held in an aggregation buffer.
    """
    ordered = Window.partitionBy(*keys).orderBy(value)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        counts.withColumn("rank_to", F.sum(n).over(so_far))
        .withColumn("rank_all", F.sum(n).over(whole))
        .withColumn("rank_from", F.col("rank_to") - F.col(n))
    )


def interpolated_percentile(value: str, percent: int, only: Column) -> Column:
    """Exact, linearly interpolated percentile of integers, in hundredths, as an
    aggregate over ``rank_ranges``; worked out in integers."""
    position = F.lit(percent).cast("long") * (F.col("rank_all") - 1)
    rest = F.pmod(position, F.lit(100).cast("long"))
    low = ((position - rest) / 100).cast("long")
    high = low + F.when(rest > 0, 1).otherwise(0)

    def at(rank: Column) -> Column:
        inside = only & (F.col("rank_from") <= rank) & (rank < F.col("rank_to"))
        return F.max(F.when(inside, F.col(value).cast("long")))

    return at(low) * 100 + (at(high) - at(low)) * F.max(F.when(only, rest))
