"""Anchors on the newest data date and per-instance overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, day: str = "dt") -> Column:
    """Newest date of the data (never the wall clock) as a scalar subquery.

    Spark evaluates it once and prunes date partitions with the result.
    """
    return df.agg(F.max(day).alias("newest")).scalar()


def with_override(df: DataFrame, seed: DataFrame, columns: list[str], key: str = "instance_id") -> DataFrame:
    """Attach seed columns. No broadcast hint: Spark broadcasts a seed only when
    its measured size is below the session threshold and shuffles it otherwise."""
    return df.join(seed.select(key, *columns), key, "left")
