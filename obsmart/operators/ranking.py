"""Latest row per key and top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The row with the greatest ``order`` per key, as one partial aggregation:
    a hot key is reduced on the map side instead of being sorted in one window."""
    row = F.max_by(F.struct(*columns), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*")


def top_k(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The first ``k`` rows per group. Spark limits each group before the
    shuffle (WindowGroupLimit), so at most k rows per group and task travel."""
    window = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
    return ranked.withColumn(rank, F.col(rank).cast("long"))
