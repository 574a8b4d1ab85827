"""Turning cumulative counters into what happened inside a window.

A counter is read at its first and last poll of the window; a restart inside
the window makes the difference negative and is clamped to zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_hour(df: DataFrame, at: str = "captured_at") -> DataFrame:
    return df.withColumn("hour", F.hour(at).cast("smallint"))


def endpoints(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    counters: Sequence[str],
    *extra: Column,
    tiebreak: str | None = None,
) -> DataFrame:
    """First and last reading of each counter per key.

    One aggregation with map-side partials. Without ``tiebreak`` the ordering
    is one timestamp and every buffer is fixed-width, so Spark keeps it in a
    HashAggregate; with it the ordering is a struct and Spark sorts locally.
    """
    order = F.struct(at, tiebreak) if tiebreak else F.col(at)
    aggs: list[Column] = [F.min(at).alias("first_at"), F.max(at).alias("last_at")]
    for c in counters:
        aggs += [F.min_by(c, order).alias(f"first_{c}"), F.max_by(c, order).alias(f"last_{c}")]
    return df.groupBy(*keys).agg(*aggs, *extra)


def per_poll(
    df: DataFrame, keys: Sequence[str], at: str, counters: Sequence[str], tiebreak: str = "id"
) -> DataFrame:
    """One row per (key, poll time): the lowest and highest ``tiebreak`` row stand
    for the poll, so that later steps can order by time alone."""
    aggs: list[Column] = []
    for c in counters:
        aggs += [F.min_by(c, tiebreak).alias(f"first_{c}"), F.max_by(c, tiebreak).alias(f"last_{c}")]
    return (
        df.groupBy(*keys, at)
        .agg(*aggs)
        .withColumn("first_at", F.col(at))
        .withColumn("last_at", F.col(at))
    )


def merge_endpoints(
    df: DataFrame, keys: Sequence[str], counters: Sequence[str], *extra: Column
) -> DataFrame:
    """Endpoints of a window from the endpoints of its parts (here: its polls)."""
    aggs: list[Column] = []
    for c in counters:
        aggs += [
            F.min_by(f"first_{c}", "first_at").alias(f"first_{c}"),
            F.max_by(f"last_{c}", "last_at").alias(f"last_{c}"),
        ]
    return df.groupBy(*keys).agg(
        *aggs, F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"), *extra
    )


def reset_safe_delta(counter: str) -> Column:
    """last - first, never below zero; a counter never read counts as zero."""
    return F.greatest(F.lit(0), F.col(f"last_{counter}") - F.col(f"first_{counter}"))


def label_per_key(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Greatest text value per key.

    Texts are first counted per distinct value, by hash: ``max`` over strings
    alone would sort every input row. The test on the count is always true and
    keeps the optimizer from folding the two steps back into one.
    """
    counted = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 0)
    return counted.groupBy(*keys).agg(F.max(label).alias(label))
