"""State that is carried along a fact, so that a new day needs no older one.

A state sums up all days of a fact up to one. It is kept for the last few
days: when a day is loaded again, the newest state before it is taken and the
days from there on are added. What is read is a state and the changed days,
however long the history.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.operators.ranking import latest_per_key
from obsmart.plans.marts import baseline_moments, day_statistics, merged_moments
from obsmart.sources import storage

#: States kept; a correction further back sums the whole fact up again.
KEPT = 8


def last_plans(plan_days: DataFrame) -> DataFrame:
    """The last plan seen of each query."""
    return latest_per_key(plan_days, ["instance_id", "query_id"], ["dt"], ["plan_hash", "dt"])


def later_plans(old: DataFrame, new: DataFrame) -> DataFrame:
    return last_plans(old.unionByName(new))


# fact -> (state of some of its days, state of earlier and later days together)
STATES: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame, DataFrame], DataFrame]]] = {
    "fct_query_daily": (day_statistics, DataFrame.unionByName),
    "fct_query_hourly": (baseline_moments, merged_moments),
    "fct_plan_daily": (last_plans, later_plans),
}


class Carried:
    """The kept states of one fact, a folder each, named by their last day."""

    def __init__(self, spark: SparkSession, root: str, fact: str):
        self.spark, self.root, self.fact = spark, f"{root}/{fact}.state", fact

    def days(self) -> list[date]:
        """Last days of the complete states; one without its marker was interrupted."""
        names = [n for n in storage.list_names(self.spark, self.root) if n.startswith("until=")]
        whole = [n for n in names if storage.exists(self.spark, f"{self.root}/{n}/_SUCCESS")]
        return sorted(date.fromisoformat(n.removeprefix("until=")) for n in whole)

    def until(self, day: date) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/until={day.isoformat()}")

    def before(self, day: date | None) -> tuple[date, DataFrame] | None:
        """The newest state that holds only days before ``day``."""
        older = [d for d in self.days() if day is not None and d < day]
        return (older[-1], self.until(older[-1])) if older else None

    def forget_from(self, day: date | None) -> None:
        """Drop states that hold a day which is about to change."""
        for d in self.days():
            if day is None or d >= day:
                storage.delete_folder(self.spark, f"{self.root}/until={d.isoformat()}")

    def advance(self, rows: DataFrame, since: date | None, newest: date) -> None:
        """The states up to ``newest`` and up to the day before it, after the days
        from ``since`` on changed. The next load begins with the newest day again:
        it builds on the earlier one. Every changed day is read once."""
        of_days, together = STATES[self.fact]
        base, eve = self.before(since), newest - timedelta(days=1)
        if base is None or base[0] < eve:
            older = rows.where(F.col("dt") <= F.lit(eve))
            if base is not None:
                older = older.where(F.col("dt") > F.lit(base[0]))
            self._save(of_days(older) if base is None else together(base[1], of_days(older)), eve)
        self._save(together(self.until(eve), of_days(rows.where(F.col("dt") == F.lit(newest)))), newest)
        for d in self.days()[:-KEPT]:
            storage.delete_folder(self.spark, f"{self.root}/until={d.isoformat()}")

    def _save(self, state: DataFrame, day: date) -> None:
        state.write.mode("overwrite").parquet(f"{self.root}/until={day.isoformat()}")
