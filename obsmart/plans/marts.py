"""Verdict marts. When the data cannot carry a verdict, the result says so."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.functions import daynum, pct, ratio, rounded, tenths
from obsmart.operators.counters import label_per_key
from obsmart.operators.lookup import newest, with_override
from obsmart.operators.ranking import top_k
from obsmart.operators.windows import dates_around, flips
from obsmart.params import DEFAULTS, Params

# Verdict words, in the order they are decided or ranked.
RISKS = ["d30", "d90", "growth_only", "ok", "stable_or_shrinking", "learning"]
PLAN_VERDICTS = ["REGRESSED", "IMPROVED", "NEUTRAL", "PENDING", "AMBIGUOUS"]
RPO_STATUSES = ["ok", "breach", "no_backup_observed"]
INDEX_VERDICTS = ["in_use", "constraint_backed", "insufficient_observation", "candidate_unused"]
CORRELATIONS = [
    "followed_by_regression", "followed_by_plan_flip", "followed_by_latency_rise",
    "followed_by_size_growth", "no_signal",
]
SLO_STATUSES = ["meets", "at_risk", "breach"]


def _stamp(df: DataFrame, computed_at: datetime | None) -> DataFrame:
    return df.withColumn("computed_at", F.lit(computed_at) if computed_at else F.current_timestamp())


def _cases(*cases: tuple[Column, str], otherwise: str) -> Column:
    """First matching condition names the verdict."""
    chain = F.when(*cases[0])
    for condition, verdict in cases[1:]:
        chain = chain.when(condition, verdict)
    return chain.otherwise(otherwise)


def day_statistics(daily: DataFrame) -> DataFrame:
    """(dt, most_calls) of the daily query fact: the most calls of a query with a
    latency. A row a day, from which any threshold finds the newest busy day."""
    timed = F.when(F.col("avg_latency_ms").isNotNull(), F.col("delta_calls"))
    return daily.groupBy("dt").agg(F.max(timed).alias("most_calls"))


def mart_query_regression(daily: DataFrame, p: Params = DEFAULTS, days: DataFrame | None = None) -> DataFrame:
    """Queries whose mean latency rose from the prior window to the recent one.

    The anchor is the newest day among days with enough calls, not of all days.
    It comes from ``days`` (``day_statistics`` as stored) where that is given, so
    that no day outside the two windows is read.
    """
    busy = daily.where((F.col("delta_calls") >= p.regression_min_calls) & F.col("avg_latency_ms").isNotNull())
    anchor = newest(busy if days is None else days.where(F.col("most_calls") >= p.regression_min_calls))
    seen = busy.where(F.col("dt") > F.date_sub(anchor, p.regression_recent_days + p.regression_prior_days))
    recent = F.col("dt") > F.date_sub(anchor, p.regression_recent_days)
    key = ["instance_id", "query_id"]
    compared = seen.withColumn("_recent", recent).groupBy(*key).agg(
        F.avg(F.when(F.col("_recent"), F.col("avg_latency_ms"))).alias("recent_latency_ms"),
        F.avg(F.when(~F.col("_recent"), F.col("avg_latency_ms"))).alias("prior_latency_ms"),
        F.sum(F.when(F.col("_recent"), F.col("delta_calls"))).alias("recent_delta_calls"),
        F.count_if(F.col("_recent")).alias("recent_days_seen"),
        F.count_if(~F.col("_recent")).alias("prior_days_seen"),
        F.min(F.when(F.col("_recent"), F.col("dt"))).alias("recent_from_dt"),
        F.max(F.when(F.col("_recent"), F.col("dt"))).alias("recent_to_dt"),
    )
    increase = F.col("recent_latency_ms") - F.col("prior_latency_ms")
    return (
        compared.where(increase > 0)  # NULL when one window is empty
        .join(label_per_key(seen, key, "query_text"), key, "left")
        .select(
            *key, "query_text", "recent_from_dt", "recent_to_dt", "recent_days_seen", "prior_days_seen",
            "prior_latency_ms", "recent_latency_ms",
            increase.alias("latency_increase_ms"),
            pct(increase, F.col("prior_latency_ms"), 1).alias("latency_increase_pct"),
            "recent_delta_calls",
        )
        .orderBy(F.desc("latency_increase_ms"), *key)
    )


BUCKET = ["instance_id", "query_id", "dow", "hour"]


def baseline_moments(hourly: DataFrame) -> DataFrame:
    """Observations, mean, squared deviations and calls of each weekday and hour of
    each query. Combined before the exchange, however much one query makes up."""
    n = F.count("delta_calls")
    return (
        hourly.withColumn("dow", (F.dayofweek("dt") - 1).cast("smallint"))
        .groupBy(*BUCKET)
        .agg(
            n.alias("n"), F.avg("delta_calls").alias("mean"), (F.var_pop("delta_calls") * n).alias("m2"),
            F.sum("delta_calls").alias("calls"),
        )
    )


def merged_moments(old: DataFrame, new: DataFrame) -> DataFrame:
    """Moments of two disjoint sets of days from the moments of either; one row of
    each side per bucket meets, and no observation is read again."""
    a, b = old.alias("a"), new.alias("b")
    joined = a.join(b, BUCKET, "full_outer")
    zero = F.lit(0).cast("long")
    na, nb = F.coalesce("a.n", zero), F.coalesce("b.n", zero)
    gap = F.coalesce(F.col("b.mean") - F.col("a.mean"), F.lit(0.0))
    n = na + nb
    return joined.select(
        *BUCKET, n.alias("n"),
        F.when(na == 0, F.col("b.mean")).when(nb == 0, F.col("a.mean")).otherwise(F.col("a.mean") + gap * nb / n).alias("mean"),
        (F.coalesce("a.m2", F.lit(0.0)) + F.coalesce("b.m2", F.lit(0.0)) + gap * gap * na * nb / n).alias("m2"),
        (F.coalesce("a.calls", zero) + F.coalesce("b.calls", zero)).alias("calls"),
    )


def baseline_from(moments: DataFrame, p: Params = DEFAULTS, computed_at: datetime | None = None) -> DataFrame:
    """Calls per weekday and hour for the busiest queries of each instance."""
    key = ["instance_id", "query_id"]
    totals = moments.groupBy(*key).agg(F.sum("calls").alias("total_calls"))
    busiest = top_k(totals, ["instance_id"], [F.desc("total_calls"), F.asc("query_id")], p.baseline_top_k)
    spread = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.lit(0.0), F.col("m2")) / (F.col("n") - 1)))
    buckets = moments.where(F.col("n") >= p.baseline_min_observations).select(
        *BUCKET, F.col("mean").alias("mean_delta_calls"), spread.alias("stddev_delta_calls"), F.col("n").alias("observations")
    )
    return _stamp(buckets.join(busiest.select(*key), key, "left_semi"), computed_at)


def mart_baseline_longterm(
    hourly: DataFrame, p: Params = DEFAULTS, computed_at: datetime | None = None, moments: DataFrame | None = None
) -> DataFrame:
    """The baseline from all hours, or from ``moments`` that were carried along."""
    return baseline_from(baseline_moments(hourly) if moments is None else moments, p, computed_at)


def mart_capacity_forecast(
    sizes: DataFrame, thresholds: DataFrame, p: Params = DEFAULTS, computed_at: datetime | None = None
) -> DataFrame:
    """Linear trend of total bytes and days left until the limit.

    The limit an instance reports itself counts only when it was reported on
    the newest day of the whole warehouse.
    """
    anchor = newest(sizes)
    window = sizes.where(F.col("dt") >= F.date_sub(anchor, p.capacity_window_days))
    daily = window.groupBy("instance_id", "dt").agg(F.sum("total_bytes").alias("total_bytes"))
    reported = (
        sizes.where(F.col("dt") == anchor)
        .groupBy("instance_id")
        .agg(F.max(F.coalesce("max_bytes", "volume_total_bytes")).alias("volume_bytes"))
    )
    day = daynum(F.col("dt"))
    trend = daily.groupBy("instance_id").agg(
        F.max("dt").alias("latest_dt"),
        F.count(F.lit(1)).alias("days_observed"),
        F.max_by("total_bytes", "dt").alias("current_bytes"),
        rounded(F.regr_slope("total_bytes", day), 2).alias("slope_bytes_per_day"),
        rounded(F.regr_r2("total_bytes", day), 4).alias("trend_r2"),
    )
    limit, slope, days = F.col("threshold_bytes"), F.col("slope_bytes_per_day"), F.col("days_observed")
    left = ratio(limit - F.col("current_bytes"), slope)
    learning = days < p.capacity_min_days
    judged = (
        with_override(
            trend,
            thresholds.withColumnsRenamed({"threshold_bytes": "_seed_bytes", "threshold_kind": "_seed_kind"}),
            ["_seed_bytes", "_seed_kind"],
        )
        .join(reported, "instance_id", "left")
        .withColumn("threshold_bytes", F.coalesce("_seed_bytes", "volume_bytes"))
        .withColumn(
            "threshold_kind",
            F.when(F.col("_seed_bytes").isNotNull(), F.coalesce("_seed_kind", F.lit("none")))
            .when(F.col("volume_bytes").isNotNull(), "volume_reported")
            .otherwise("none"),
        )
        .select(
            "instance_id", "latest_dt", "days_observed", learning.alias("learning"), "current_bytes",
            "slope_bytes_per_day", "trend_r2", "threshold_bytes", "threshold_kind",
            F.when(
                ~learning & (slope > 0) & (limit > F.col("current_bytes")), F.floor(left).cast("double")
            ).alias("days_to_threshold"),
            _cases(
                (learning, "learning"),
                (slope <= 0, "stable_or_shrinking"),
                (limit.isNull(), "growth_only"),
                (left <= 30, "d30"),
                (left <= 90, "d90"),
                otherwise="ok",
            ).alias("risk_flag"),
        )
    )
    return _stamp(judged, computed_at)


def mart_wait_top(
    waits: DataFrame, instances: DataFrame, p: Params = DEFAULTS, computed_at: datetime | None = None
) -> DataFrame:
    """What each instance mostly waited for in the last days."""
    window = waits.where(F.col("dt") >= F.date_sub(newest(waits), p.wait_window_days))
    key = ["instance_id", "event_name"]
    totals = window.groupBy(*key).agg(
        F.sum("delta_ms").alias("total_delta_ms"),
        F.sum("delta_count").alias("total_delta_count"),
        F.sum("last_ms").alias("sum_last_ms"),
        F.count(F.lit(1)).alias("days_seen"),
    )
    top = top_k(
        totals, ["instance_id"], [F.desc("total_delta_ms"), F.asc("event_name")], p.wait_top_k, "rank_in_instance"
    )
    return _stamp(
        top.join(label_per_key(window, key, "category"), key, "left")
        .join(instances.select("instance_id", "instance_name", "engine"), "instance_id", "left")
        .select(
            "instance_id", "instance_name", "engine", "rank_in_instance", "event_name", "category",
            "total_delta_ms", "total_delta_count", "sum_last_ms", "days_seen",
        ),
        computed_at,
    )


def plan_flips(plan_days: DataFrame) -> DataFrame:
    """Days on which a query's plan of the day changed, from ``fct_plan_daily``."""
    return flips(plan_days, ["instance_id", "query_id"], "dt", "plan_hash", "prev_hash")


def mart_plan_regression(
    plan_days: DataFrame,
    daily: DataFrame,
    thresholds: DataFrame,
    p: Params = DEFAULTS,
    computed_at: datetime | None = None,
    since: date | None = None,
) -> DataFrame:
    """Latency before and after each plan flip; the flip day itself is left out.

    With ``since``, the first day that changed, only flips that a change there
    can touch are judged: those from ``plan_open_from`` on. Flips and days
    before their windows are not read.
    """
    n = p.plan_window_days
    key = ["instance_id", "query_id", "flip_dt"]
    measured = daily.select("instance_id", "query_id", "dt", "delta_calls", "avg_latency_ms")
    if since is not None:
        first = plan_open_from(since, p)
        earliest = F.lit(first - timedelta(days=n))
        plan_days, measured = plan_days.where(F.col("dt") >= earliest), measured.where(F.col("dt") >= earliest)
    found = plan_flips(plan_days)  # a neighbour before `earliest` is too far away to matter
    if since is not None:
        found = found.where(F.col("flip_dt") >= F.lit(first))
    before, after = F.col("day_offset") < 0, F.col("day_offset") > 0
    latency = F.col("avg_latency_ms")
    compared = (
        dates_around(found, "flip_dt", n, n)
        .where(F.col("day_offset") != 0)
        .join(measured, ["instance_id", "query_id", "dt"], "left")
        .groupBy(*key, "prev_value", "new_value", "prev_flip_dt", "next_flip_dt")
        .agg(
            F.avg(F.when(before, latency)).alias("_before"),
            F.avg(F.when(after, latency)).alias("_after"),
            F.count(F.when(before, latency)).alias("before_days"),
            F.count(F.when(after, latency)).alias("after_days"),
            F.coalesce(F.sum(F.when(after, F.col("delta_calls"))), F.lit(0).cast("long")).alias("after_calls"),
        )
    )
    contaminated = (F.datediff("flip_dt", "prev_flip_dt") <= n) | (F.datediff("next_flip_dt", "flip_dt") <= n)
    limit = F.coalesce("regress_ratio", F.lit(p.plan_regress_ratio))
    judged = (
        with_override(compared, thresholds, ["regress_ratio", "min_after_calls"])
        .withColumn("latency_ratio", rounded(ratio(F.col("_after"), F.col("_before")), 2))
        .select(
            *key,
            F.col("prev_value").alias("prev_plan_hash"),
            F.col("new_value").alias("new_plan_hash"),
            rounded(F.col("_before"), 2).alias("before_avg_ms"),
            rounded(F.col("_after"), 2).alias("after_avg_ms"),
            "latency_ratio", "before_days", "after_days", "after_calls",
            _cases(
                ((F.col("before_days") == 0) | (F.col("after_days") == 0), "PENDING"),
                (F.coalesce(contaminated, F.lit(False)), "AMBIGUOUS"),
                (F.col("after_calls") < F.coalesce("min_after_calls", F.lit(p.plan_min_calls)), "NEUTRAL"),
                (F.col("latency_ratio") >= limit, "REGRESSED"),
                (F.col("latency_ratio") <= rounded(F.lit(1.0) / limit, 2), "IMPROVED"),
                otherwise="NEUTRAL",
            ).alias("verdict"),
        )
    )
    return _stamp(judged, computed_at)


def plan_open_from(since: date, p: Params = DEFAULTS) -> date:
    """First flip day whose window reaches a day from ``since`` on: verdicts of
    earlier flips are settled."""
    return since - timedelta(days=p.plan_window_days)


def mart_backup_rpo(
    daily: DataFrame,
    backups: DataFrame,
    thresholds: DataFrame,
    p: Params = DEFAULTS,
    computed_at: datetime | None = None,
) -> DataFrame:
    """Days since the last successful backup of every instance that runs queries."""
    state = backups.groupBy("instance_id").agg(
        F.max(F.when(F.col("success_runs") > 0, F.col("dt"))).alias("last_success_dt"),
        F.max(F.when(F.col("verified_runs") > 0, F.col("dt"))).alias("last_verified_dt"),
    )
    last, gap = F.col("last_success_dt"), F.col("gap_days")
    judged = (
        with_override(
            daily.select("instance_id").distinct().join(state, "instance_id", "left"),
            thresholds.withColumnRenamed("max_gap_days", "_seed_gap"),
            ["_seed_gap"],
        )
        .withColumns(
            {
                "as_of_dt": newest(daily),
                "max_gap_days": F.coalesce("_seed_gap", F.lit(p.backup_max_gap_days).cast("long")),
            }
        )
        .withColumn("gap_days", F.datediff("as_of_dt", last).cast("long"))
        .select(
            "instance_id", "as_of_dt", "last_success_dt", "last_verified_dt", "gap_days",
            last.isNull().alias("no_successful_backup"),
            "max_gap_days",
            _cases(
                (last.isNull(), "no_backup_observed"), (gap > F.col("max_gap_days"), "breach"), otherwise="ok"
            ).alias("rpo_status"),
        )
    )
    return _stamp(judged, computed_at)


def mart_weekly_ops_report(
    daily: DataFrame,
    instances: DataFrame,
    capacity: DataFrame,
    waits: DataFrame,
    plans: DataFrame,
    backups: DataFrame,
    uptime: DataFrame,
    computed_at: datetime | None = None,
) -> DataFrame:
    """One row per instance for the (Monday-based) week of the newest day."""
    anchor = newest(daily)
    start = F.date_trunc("week", anchor).cast("date")
    end = F.date_add(start, 6)
    severity = F.coalesce(
        *[F.when(F.col("risk_flag") == r, F.lit(i)) for i, r in enumerate(RISKS, 1)], F.lit(9)
    )
    cap = capacity.groupBy("instance_id").agg(
        F.min("days_to_threshold").alias("min_days_to_threshold"), F.min(severity).alias("_worst")
    )
    top_wait = waits.where("rank_in_instance = 1").select(
        "instance_id", F.col("event_name").alias("top_wait_event"), F.col("total_delta_ms").alias("top_wait_delta_ms")
    )
    week_flips = (
        plans.where((F.col("flip_dt") >= start) & (F.col("flip_dt") <= end))
        .groupBy("instance_id")
        .agg(F.count(F.lit(1)).alias("_flips"), F.count_if(F.col("verdict") == "REGRESSED").alias("_regressed"))
    )
    backup = backups.select(
        "instance_id", F.col("gap_days").alias("backup_gap_days"), F.col("rpo_status").alias("backup_status")
    )
    week_up = (
        uptime.where((F.col("dt") >= start) & (F.col("dt") <= end))
        .groupBy("instance_id")
        .agg(pct(F.sum("up_samples"), F.sum("samples"), 2).alias("this_week_uptime_pct"))
    )
    report = daily.select("instance_id").distinct()
    for part in (instances, cap, top_wait, week_flips, backup, week_up):
        report = report.join(part, "instance_id", "left")
    worst = F.coalesce(*[F.when(F.col("_worst") == i, F.lit(r)) for i, r in enumerate(RISKS, 1)])
    zero = F.lit(0).cast("long")
    return _stamp(
        report.select(
            start.alias("week_start"), end.alias("week_end"), (anchor < end).alias("is_partial_week"),
            "instance_id", "instance_name", "engine", "min_days_to_threshold",
            worst.alias("capacity_worst_risk"), "top_wait_event", "top_wait_delta_ms",
            F.coalesce("_flips", zero).alias("plan_flips_this_week"),
            F.coalesce("_regressed", zero).alias("plan_regressed_this_week"),
            "backup_gap_days", "backup_status", "this_week_uptime_pct",
        ),
        computed_at,
    )


def mart_index_verdict(daily: DataFrame, p: Params = DEFAULTS) -> DataFrame:
    """May an index go? Advice only: foreign keys and replica reads are not visible here."""
    window = daily.where(F.col("dt") > F.date_sub(newest(daily), p.index_window_days))
    seen = window.groupBy("instance_id", "table_name", "index_name").agg(
        F.sum("delta_scans").alias("total_scans"),
        F.max(F.when(F.col("delta_scans") > 0, F.col("dt"))).alias("last_used_dt"),
        F.datediff(F.max("dt"), F.min("dt")).cast("long").alias("observation_days"),
        F.bool_or("is_unique").alias("is_unique"),
        F.max("size_bytes").alias("size_bytes"),
    )
    used, short = F.col("total_scans") > 0, F.col("observation_days") < p.index_min_obs_days
    return seen.select(
        "*",
        _cases(
            (used, "in_use"),
            (F.col("is_unique"), "constraint_backed"),
            (short, "insufficient_observation"),
            otherwise="candidate_unused",
        ).alias("verdict"),
        F.when(used, F.format_string("used %d times in the window", "total_scans"))
        .when(F.col("is_unique"), "backs a unique or primary key; needed even when never scanned")
        .when(short, F.format_string("observed %d days, fewer than %d; judge later", "observation_days",
                                     F.lit(p.index_min_obs_days)))
        .otherwise(
            f"not used within {p.index_window_days} days; review before dropping, foreign keys and replica "
            "reads are not counted"
        )
        .alias("note"),
    )


def mart_config_change(
    changes: DataFrame, p: Params = DEFAULTS, computed_at: datetime | None = None
) -> DataFrame:
    """What was reconfigured, when and how, newest first."""
    window = changes.where(F.col("dt") >= F.date_sub(newest(changes), p.config_window_days))
    return _stamp(
        window.select("instance_id", "captured_at", "dt", "param_name", "old_value", "new_value", "change_kind"),
        computed_at,
    ).orderBy(F.desc("captured_at"), "instance_id", "param_name")


def mart_config_impact(
    changes: DataFrame,
    plan_verdicts: DataFrame,
    daily: DataFrame,
    sizes: DataFrame,
    p: Params = DEFAULTS,
    computed_at: datetime | None = None,
    since: date | None = None,
) -> DataFrame:
    """What followed each change within a few days: correlation, not cause.

    The three series depend only on (instance, change day) and have one row per
    (instance, day). They are attached to the dates around each distinct change
    day by equality and reduced to that day, so many changes on one day never
    multiply the series. With ``since``, the first day that changed, only changes
    from ``impact_open_from`` on are looked at, and no day before their windows.
    """
    n = p.impact_window_days
    key = ["instance_id", "change_dt"]
    if since is not None:
        first = impact_open_from(since, p)
        earliest = F.lit(first - timedelta(days=n))
        changes, plan_verdicts = changes.where(F.col("change_dt") >= F.lit(first)), plan_verdicts.where(F.col("flip_dt") >= F.lit(first))
        daily, sizes = daily.where(F.col("dt") >= earliest), sizes.where(F.col("dt") >= earliest)
    distinct_changes = changes.select(
        *key, "change_source", "change_key", "change_kind", "old_value", "new_value"
    ).distinct()
    flip_days = plan_verdicts.groupBy("instance_id", F.col("flip_dt").alias("dt")).agg(
        F.bool_or(F.col("verdict") == "REGRESSED").alias("regressed")
    )
    latency = daily.where(F.col("avg_latency_ms").isNotNull()).groupBy("instance_id", "dt").agg(
        F.avg("avg_latency_ms").alias("latency_ms")
    )
    volume = sizes.groupBy("instance_id", "dt").agg(F.sum("total_bytes").alias("bytes"))
    around = dates_around(changes.select(*key).distinct(), "change_dt", n, n)
    for series in (flip_days, latency, volume):
        around = around.join(series, ["instance_id", "dt"], "left")
    before, onward, after = F.col("day_offset") < 0, F.col("day_offset") >= 0, F.col("day_offset") > 0
    followed = around.groupBy(*key).agg(
        F.count_if(onward & F.col("regressed").isNotNull()).alias("plan_flips_after"),
        F.count_if(onward & F.col("regressed")).alias("regressed_after"),
        *[
            F.avg(F.when(side, F.col(value))).alias(f"{label}_{value}")
            for value in ("latency_ms", "bytes")
            for label, side in (("before", before), ("after", after))
        ],
    )
    joined = distinct_changes.join(followed, key)
    joined = joined.withColumns(
        {
            "latency_ratio": rounded(ratio(F.col("after_latency_ms"), F.col("before_latency_ms")), 2),
            "size_ratio": rounded(ratio(F.col("after_bytes"), F.col("before_bytes")), 2),
        }
    )
    return _stamp(
        joined.select(
            *key, "change_source", "change_key", "change_kind", "old_value", "new_value",
            "plan_flips_after", "regressed_after",
            rounded(F.col("before_latency_ms"), 2).alias("before_latency_ms"),
            rounded(F.col("after_latency_ms"), 2).alias("after_latency_ms"),
            "latency_ratio", "before_bytes", "after_bytes", "size_ratio",
            _cases(
                (F.col("regressed_after") > 0, "followed_by_regression"),
                (F.col("plan_flips_after") > 0, "followed_by_plan_flip"),
                (F.col("latency_ratio") >= p.impact_latency_ratio, "followed_by_latency_rise"),
                (F.col("size_ratio") >= p.impact_size_ratio, "followed_by_size_growth"),
                otherwise="no_signal",
            ).alias("correlation"),
        ),
        computed_at,
    )


def impact_open_from(since: date, p: Params = DEFAULTS) -> date:
    """First change day whose result a day from ``since`` on can alter: within its
    window a flip may lie whose verdict is still open."""
    return plan_open_from(since, p) - timedelta(days=p.impact_window_days)


def mart_uptime_slo(
    uptime: DataFrame,
    instances: DataFrame,
    targets: DataFrame,
    p: Params = DEFAULTS,
    computed_at: datetime | None = None,
) -> DataFrame:
    """Availability of the window against its target, with the error budget left."""
    window = uptime.where(F.col("dt") >= F.date_sub(newest(uptime), p.uptime_window_days))
    seen = window.groupBy("instance_id").agg(
        F.min("dt").alias("window_from_dt"),
        F.max("dt").alias("window_to_dt"),
        F.count(F.lit(1)).alias("days_observed"),
        F.sum("samples").alias("total_samples"),
        F.sum("down_samples").alias("total_down_samples"),
        pct(F.sum("up_samples"), F.sum("samples"), 3).alias("window_uptime_pct"),
        F.min("uptime_pct").alias("worst_day_uptime_pct"),
        F.min_by("dt", F.struct("uptime_pct", "dt")).alias("worst_day"),
        # the daily means are tenths: added as integers, the result does not depend on row order
        tenths(F.sum(F.round(F.col("avg_ping_ms") * 10, 0).cast("long")), F.count("avg_ping_ms") * 10).alias("avg_ping_ms"),
    )
    up, target = F.col("window_uptime_pct"), F.col("target_pct")
    spent = ratio(F.lit(100.0) - up, F.lit(100.0) - target)
    budget = F.lit(100.0) * (F.lit(1.0) - spent)
    judged = (
        with_override(seen, targets.withColumnRenamed("target_pct", "_seed_target"), ["_seed_target"])
        .join(instances.select("instance_id", "instance_name", "engine"), "instance_id", "left")
        .withColumn("target_pct", F.coalesce("_seed_target", F.lit(p.uptime_target_pct)))
        .select(
            "instance_id", "instance_name", "engine", "window_from_dt", "window_to_dt", "days_observed",
            "total_samples", "total_down_samples", "window_uptime_pct", "worst_day_uptime_pct", "worst_day",
            "avg_ping_ms", "target_pct",
            rounded(budget, 1).alias("error_budget_remaining_pct"),
            _cases((up < target, "breach"), (budget < 20, "at_risk"), otherwise="meets").alias("slo_status"),
        )
    )
    return _stamp(judged, computed_at)


# mart -> (builder, fact/staging/mart inputs, seeds), in dependency order.
MARTS = {
    "mart_query_regression": (mart_query_regression, ("fct_query_daily",)),
    "mart_baseline_longterm": (mart_baseline_longterm, ("fct_query_hourly",)),
    "mart_capacity_forecast": (mart_capacity_forecast, ("fct_size_daily", "capacity_thresholds")),
    "mart_wait_top": (mart_wait_top, ("fct_wait_event_daily", "dim_instance")),
    "mart_plan_regression": (
        mart_plan_regression, ("fct_plan_daily", "fct_query_daily", "plan_regression_thresholds")
    ),
    "mart_backup_rpo": (mart_backup_rpo, ("fct_query_daily", "fct_backup_daily", "backup_rpo_thresholds")),
    "mart_weekly_ops_report": (
        mart_weekly_ops_report,
        ("fct_query_daily", "dim_instance", "mart_capacity_forecast", "mart_wait_top",
         "mart_plan_regression", "mart_backup_rpo", "fct_uptime_daily"),
    ),
    "mart_index_verdict": (mart_index_verdict, ("fct_index_daily",)),
    "mart_config_change": (mart_config_change, ("stg_config_param_change",)),
    "mart_config_impact": (
        mart_config_impact, ("int_change_events", "mart_plan_regression", "fct_query_daily", "fct_size_daily")
    ),
    "mart_uptime_slo": (mart_uptime_slo, ("fct_uptime_daily", "dim_instance", "uptime_slo_targets")),
}
