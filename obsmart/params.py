"""Tunable thresholds of the verdict marts, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # The defaults every published verdict is defined by.
    regression_recent_days: int = 7
    regression_prior_days: int = 30
    regression_min_calls: int = 100
    baseline_top_k: int = 500
    baseline_min_observations: int = 8
    capacity_window_days: int = 30
    capacity_min_days: int = 14
    wait_window_days: int = 30
    wait_top_k: int = 10
    plan_window_days: int = 3
    plan_regress_ratio: float = 1.3
    plan_min_calls: int = 100
    backup_max_gap_days: int = 3
    index_window_days: int = 90
    index_min_obs_days: int = 60
    config_window_days: int = 90
    impact_window_days: int = 7
    impact_latency_ratio: float = 1.3
    impact_size_ratio: float = 1.1
    uptime_window_days: int = 30
    uptime_target_pct: float = 99.5
    freshness_warn_hours: float = 3.0
    freshness_fail_hours: float = 12.0


DEFAULTS = Params()
