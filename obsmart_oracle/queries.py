"""One comparison statement per registered query."""

from __future__ import annotations

from obsmart_oracle.ctes import block, compose

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = compose(sql.strip())


# --- staging, facts, marts -----------------------------------------------------
oracle("stg_query_snapshot", "SELECT * FROM stg_query")
oracle("stg_backup_run", """
SELECT id, instance_id, started_at, dt, status, backup_type, duration_ms, verify_status, verified_at, remote_location
FROM backup_run""")
oracle("stg_plan_snapshot", "SELECT id, instance_id, query_id, plan_hash, captured_at, dt FROM plan_snapshot")
oracle("stg_wait_event", """
SELECT id, instance_id, captured_at, dt, event_name, category, wait_count, total_ms FROM wait_event_snapshot""")
oracle("stg_size_snapshot", "SELECT *, data_bytes + index_bytes AS total_bytes FROM size_snapshot")
oracle("stg_index_usage_snapshot", "SELECT * FROM index_usage_snapshot")
oracle("stg_config_snapshot", "SELECT * FROM config_snapshot")
oracle("stg_config_param_change", "SELECT * FROM config_param_change")
oracle("stg_dim_instance", "SELECT * FROM dim_snapshot")
oracle("stg_health_sample", "SELECT * FROM health_sample")
oracle("dim_instance", "SELECT * FROM dim_now")
oracle("int_change_events", "SELECT * FROM change_events")

FACT_BLOCKS = {
    "fct_query_daily": "f_query_daily", "fct_query_hourly": "f_query_hourly", "fct_size_daily": "f_size",
    "fct_wait_event_daily": "f_wait", "fct_backup_daily": "f_backup", "fct_plan_change_daily": "f_plan", "fct_plan_daily": "plan_steps",
    "fct_index_daily": "f_index", "fct_config_change_daily": "f_config", "fct_uptime_daily": "f_uptime",
}
for _name, _block in FACT_BLOCKS.items():
    oracle(_name, f"SELECT * FROM {_block}")
    oracle(f"incremental_{_name}", f"SELECT * FROM {_block}")

MART_BLOCKS = {
    "mart_query_regression": "m_regression", "mart_baseline_longterm": "m_baseline",
    "mart_capacity_forecast": "m_capacity", "mart_wait_top": "m_wait_top", "mart_plan_regression": "m_plan",
    "mart_backup_rpo": "m_rpo", "mart_weekly_ops_report": "m_weekly", "mart_index_verdict": "m_index",
    "mart_config_change": "m_config_change", "mart_config_impact": "m_impact", "mart_uptime_slo": "m_slo",
}
ROUNDED = {
    "mart_query_regression": ["prior_latency_ms", "recent_latency_ms", "latency_increase_ms"],
    "mart_baseline_longterm": ["mean_delta_calls", "stddev_delta_calls"],
    "mart_config_impact": ["before_bytes", "after_bytes"],
}
for _name, _block in MART_BLOCKS.items():
    _r = ", ".join(f"round({c}, 6) AS {c}" for c in ROUNDED.get(_name, []))
    oracle(_name, f"SELECT * {f'REPLACE ({_r}) ' if _r else ''}FROM {_block}")
    if _name in ("mart_query_regression", "mart_baseline_longterm", "mart_plan_regression", "mart_config_impact"):
        oracle(f"incremental_{_name}", f"SELECT * {f'REPLACE ({_r}) ' if _r else ''}FROM {_block}")

# --- gate ----------------------------------------------------------------------
block("landed", """
SELECT * FROM query_snapshot
WHERE NOT ((dt = DATE '2024-01-10' AND extract(hour FROM captured_at) = 12)
        OR (dt = DATE '2024-01-15' AND instance_id = 3)
        OR (dt = DATE '2024-01-20' AND extract(hour FROM captured_at) >= 18)
        OR (dt = DATE '2024-01-25' AND extract(hour FROM captured_at) >= 9)
        OR dt = DATE '2024-01-28')
""")
block("days", "SELECT CAST(d AS DATE) AS dt FROM range((SELECT CAST(min(ts) AS DATE) FROM events), "
      "(SELECT CAST(max(ts) AS DATE) + 1 FROM events), INTERVAL 1 DAY) r(d)")
block("instances", "SELECT DISTINCT instance_id FROM ev")
block("src_counts", "SELECT dt, instance_id, count(*) AS source_rows FROM query_snapshot GROUP BY ALL")
block("land_counts", "SELECT dt, instance_id, count(*) AS landed_rows FROM landed GROUP BY ALL")
block("reconciled", """
SELECT coalesce(s.dt, l.dt) AS dt, coalesce(s.instance_id, l.instance_id) AS instance_id,
       coalesce(s.source_rows, 0) AS source_rows, coalesce(l.landed_rows, 0) AS landed_rows,
       coalesce(s.source_rows, 0) = coalesce(l.landed_rows, 0) AS matches
FROM src_counts s FULL JOIN land_counts l ON s.dt = l.dt AND s.instance_id = l.instance_id
""")
block("absent", """
SELECT d.dt, i.instance_id FROM days d CROSS JOIN instances i
WHERE NOT EXISTS (SELECT 1 FROM land_counts l WHERE l.dt = d.dt AND l.instance_id = i.instance_id)
""")
block("watermarks", "SELECT dt, max(captured_at) AS newest_at FROM landed GROUP BY dt")


def _freshness(newest: str) -> str:
    gap = f"date_diff('microsecond', {newest}, CAST(d.dt AS TIMESTAMP) + INTERVAL 1 DAY)"
    return (
        f"CASE WHEN {newest} IS NULL OR {gap} > 43200000000 THEN 'FAIL' "
        f"WHEN {gap} > 10800000000 THEN 'WARN' ELSE 'OK' END"
    )


block("axis_status", f"""
SELECT d.dt, 'reconciliation' AS axis,
       CASE WHEN EXISTS (SELECT 1 FROM reconciled r WHERE r.dt = d.dt AND NOT r.matches)
            THEN 'FAIL' ELSE 'OK' END AS status FROM days d
UNION ALL
SELECT d.dt, 'completeness', CASE WHEN EXISTS (SELECT 1 FROM absent a WHERE a.dt = d.dt) THEN 'FAIL' ELSE 'OK' END
FROM days d
UNION ALL
SELECT d.dt, 'freshness', {_freshness('w.newest_at')} FROM days d LEFT JOIN watermarks w ON w.dt = d.dt
UNION ALL
SELECT dt, 'schema_drift', 'OK' FROM days
""")
block("gate_days", """
SELECT dt, CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' WHEN bool_or(status = 'WARN') THEN 'WARN' ELSE 'OK' END
             AS gate_status, bool_or(status = 'FAIL') AS blocked
FROM axis_status GROUP BY dt
""")
block("run_rows", """
SELECT g.dt, 'run-' || g.dt AS run_id, CAST(g.dt AS TIMESTAMP) + INTERVAL 25 HOUR AS run_at,
       round(extract(day FROM g.dt) / 7.0::DOUBLE, 3) AS duration_sec, g.gate_status,
       max(a.status) FILTER (WHERE a.axis = 'reconciliation') AS gate_reconciliation,
       max(a.status) FILTER (WHERE a.axis = 'completeness') AS gate_completeness,
       max(a.status) FILTER (WHERE a.axis = 'freshness') AS gate_freshness,
       max(a.status) FILTER (WHERE a.axis = 'schema_drift') AS gate_schema_drift,
       CAST((SELECT count(*) FROM landed l WHERE l.dt = g.dt) AS BIGINT) AS landed_n
FROM gate_days g JOIN axis_status a ON a.dt = g.dt GROUP BY g.dt, g.gate_status
""")
oracle("quality_source_counts", "SELECT * FROM src_counts")
oracle("quality_landed_counts", "SELECT * FROM land_counts")
oracle("quality_newest_watermark", "SELECT * FROM watermarks")
oracle("quality_reconciliation", "SELECT * FROM reconciled")
oracle("quality_completeness", "SELECT * FROM absent")
oracle("quality_freshness", f"""
SELECT d.dt, round(date_diff('microsecond', d.newest_at, CAST(d.dt AS TIMESTAMP) + INTERVAL 1 DAY) / 3600000000.0, 3)
         AS gap_hours, {_freshness('d.newest_at')} AS status
FROM watermarks d""")
oracle("quality_schema_drift", """
SELECT * FROM (VALUES ('query_snapshot', 'OK'), ('backup_run', 'OK'), ('plan_snapshot', 'OK'),
  ('wait_event_snapshot', 'OK'), ('size_snapshot', 'OK'), ('index_usage_snapshot', 'OK'), ('config_snapshot', 'OK'),
  ('config_param_change', 'OK'), ('health_sample', 'OK'), ('dim_instance', 'OK'),
  ('query_snapshot lost a column', 'FAIL'), ('query_snapshot retyped', 'FAIL'),
  ('query_snapshot gained a column', 'WARN')) t(table_name, status)""")
oracle("quality_gate", "SELECT * FROM axis_status")
oracle("quality_day_status", "SELECT * FROM gate_days")
oracle("quality_two_sided_report", """
SELECT dt, CAST(sum(source_rows) AS BIGINT) AS source_rows, CAST(sum(landed_rows) AS BIGINT) AS landed_rows,
       CASE WHEN sum(source_rows) = sum(landed_rows) THEN 'OK' ELSE 'MISMATCH' END AS result
FROM reconciled GROUP BY dt""")
_RAW_AT = {
    "query_snapshot": "captured_at", "backup_run": "started_at", "plan_snapshot": "captured_at",
    "wait_event_snapshot": "captured_at", "size_snapshot": "captured_at", "index_usage_snapshot": "captured_at",
    "config_snapshot": "captured_at", "config_param_change": "captured_at", "health_sample": "sampled_at",
}
_POLLED = ("wait_event_snapshot", "index_usage_snapshot", "health_sample")


# Planted: see the query. Sources that changed, by what the change is worth.
_CHANGED = {"size_snapshot": "WARN", "wait_event_snapshot": "FAIL"}


def _aux_axes(table: str) -> str:
    at = _RAW_AT[table]
    left = (
        f"(SELECT * FROM {table} WHERE NOT (dt = DATE '2024-01-12' AND instance_id = 2) AND dt <> DATE '2024-01-22' "
        f"AND NOT (dt = DATE '2024-01-18' AND extract(hour FROM {at}) >= 15))"
    )
    fresh = (
        f"SELECT {_freshness('w.newest')} AS status FROM days d "
        f"LEFT JOIN (SELECT dt, max({at}) AS newest FROM {left} GROUP BY dt) w ON w.dt = d.dt"
        if table in _POLLED
        else "SELECT 'SKIP' AS status FROM days"
    )
    axes = {
        "reconciliation": f"SELECT CASE WHEN EXISTS (SELECT instance_id, count(*) FROM {table} s WHERE s.dt = d.dt GROUP BY 1 "
        f"EXCEPT SELECT instance_id, count(*) FROM {left} l WHERE l.dt = d.dt GROUP BY 1) THEN 'FAIL' ELSE 'OK' END AS status FROM days d",
        "completeness": "SELECT 'SKIP' AS status FROM days",
        "freshness": fresh,
        "schema_drift": f"SELECT '{_CHANGED.get(table, 'OK')}' AS status FROM days",
    }
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{axis}' AS axis, count(*) FILTER (WHERE status = 'OK') AS ok_days, "
        f"count(*) FILTER (WHERE status = 'WARN') AS warn_days, count(*) FILTER (WHERE status = 'FAIL') AS fail_days, "
        f"count(*) FILTER (WHERE status = 'SKIP') AS skipped_days FROM ({sql}) s"
        for axis, sql in axes.items()
    )


oracle("quality_gate_auxiliary", "\nUNION ALL ".join(_aux_axes(t) for t in _RAW_AT if t != "query_snapshot"))
oracle("quality_duplicate_polls", """
SELECT instance_id, query_id, dt, captured_at, count(*) AS rows FROM query_snapshot GROUP BY ALL HAVING count(*) > 1""")
oracle("quality_violations", """
SELECT 'not_null(category)' AS rule, count(*) FILTER (WHERE category IS NULL) AS violations FROM wait_event_snapshot
UNION ALL SELECT 'accepted(category)', count(*) FILTER (WHERE category <> 'io') FROM wait_event_snapshot
UNION ALL SELECT 'unique(instance_id, query_id, captured_at)', count(*) FROM (
  SELECT 1 FROM query_snapshot GROUP BY instance_id, query_id, captured_at HAVING count(*) > 1) d
UNION ALL SELECT 'relationship(instance_id)', count(*) FROM (
  SELECT DISTINCT instance_id FROM query_snapshot q WHERE NOT EXISTS (
    SELECT 1 FROM landed l WHERE l.dt = DATE '2024-01-15' AND l.instance_id = q.instance_id)) r""")


def _table_block(name: str) -> str:
    return {**FACT_BLOCKS, **MART_BLOCKS, "dim_instance": "dim_now", "int_change_events": "change_events",
            "stg_query_snapshot": "stg_query"}[name]


def _data_tests() -> str:
    # The columns and words that the tables must have.
    not_null = {
        "stg_query_snapshot": ["instance_id", "query_id", "dt", "captured_at", "calls"],
        "fct_query_daily": ["instance_id", "query_id", "dt", "delta_calls", "delta_total_time_ms"],
        "mart_query_regression": ["instance_id", "query_id", "latency_increase_ms"],
        "fct_query_hourly": ["instance_id", "query_id", "dt", "hour"], "fct_size_daily": ["instance_id", "object_name", "dt"],
        "mart_capacity_forecast": ["instance_id", "risk_flag"], "fct_wait_event_daily": ["instance_id", "event_name", "dt"],
        "fct_backup_daily": ["instance_id", "dt"], "fct_plan_change_daily": ["instance_id", "dt"],
        "mart_wait_top": ["instance_id", "event_name"], "mart_plan_regression": ["instance_id", "query_id", "verdict"],
        "mart_backup_rpo": ["instance_id", "as_of_dt", "rpo_status"], "mart_weekly_ops_report": ["week_start", "instance_id"],
        "fct_config_change_daily": ["instance_id", "dt"], "mart_config_change": ["instance_id", "change_kind"],
        "int_change_events": ["instance_id", "change_source"],
        "mart_config_impact": ["instance_id", "change_source", "correlation"], "fct_uptime_daily": ["instance_id", "dt"],
        "mart_uptime_slo": ["instance_id", "slo_status"], "dim_instance": ["instance_id", "engine"],
        "fct_index_daily": ["instance_id", "index_name", "dt", "delta_scans"],
        "mart_index_verdict": ["instance_id", "index_name", "verdict"],
    }
    rows = [(t, f"not_null({c})", f"SELECT count(*) FROM {_table_block(t)} WHERE {c} IS NULL")
            for t, cs in not_null.items() for c in cs]
    accepted = {
        "mart_plan_regression": ("verdict", ["REGRESSED", "IMPROVED", "NEUTRAL", "PENDING", "AMBIGUOUS"]),
        "mart_backup_rpo": ("rpo_status", ["ok", "breach", "no_backup_observed"]),
        "mart_config_impact": ("correlation", ["followed_by_regression", "followed_by_plan_flip", "followed_by_latency_rise",
                                              "followed_by_size_growth", "no_signal"]),
        "mart_uptime_slo": ("slo_status", ["meets", "at_risk", "breach"]),
        "mart_index_verdict": ("verdict", ["in_use", "constraint_backed", "insufficient_observation", "candidate_unused"]),
    }
    for t, (c, values) in accepted.items():
        listed = ", ".join(f"'{v}'" for v in values)
        rows.append((t, f"accepted({c})", f"SELECT count(*) FROM {_table_block(t)} WHERE {c} NOT IN ({listed})"))
    for t in ("fct_query_daily", "fct_query_hourly"):
        for c in ("delta_calls", "delta_total_time_ms"):
            rows.append((t, f"non_negative({c})", f"SELECT count(*) FROM {_table_block(t)} WHERE {c} < 0"))
    for t, keys in {
        "dim_instance": "instance_id", "mart_uptime_slo": "instance_id",
        "stg_query_snapshot": "instance_id, query_id, dt, captured_at", "fct_query_daily": "instance_id, query_id, dt",
    }.items():
        rows.append((t, f"unique({keys})",
                     f"SELECT count(*) FROM (SELECT 1 FROM {_table_block(t)} GROUP BY {keys} HAVING count(*) > 1) x"))
    rows.append(("fct_query_daily", "relationship(instance_id)",
                 "SELECT count(*) FROM (SELECT DISTINCT instance_id FROM f_query_daily "
                 "EXCEPT SELECT instance_id FROM stg_query) x"))
    return "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, '{r}' AS rule, ({q}) AS violations" for t, r, q in rows)


oracle("quality_data_tests", _data_tests())
_CONTRACT_RULES = {
    "fct_query_daily": ["not_null(instance_id)", "not_null(query_id)", "not_null(dt)", "not_null(delta_calls)",
                        "not_null(delta_total_time_ms)", "check(delta_calls >= 0)", "check(delta_total_time_ms >= 0)"],
    "mart_query_regression": ["not_null(instance_id)", "not_null(query_id)", "not_null(latency_increase_ms)"],
    "mart_baseline_longterm": ["not_null(instance_id)", "not_null(query_id)", "not_null(dow)", "not_null(hour)"],
    "mart_plan_regression": ["not_null(instance_id)", "not_null(query_id)", "not_null(flip_dt)", "not_null(verdict)"],
    "mart_backup_rpo": ["not_null(instance_id)", "not_null(as_of_dt)", "not_null(no_successful_backup)",
                        "not_null(rpo_status)"],
}


def _contract_row(table: str, rule: str) -> str:
    kind, inner = rule[:-1].split("(", 1)
    broken = f"{inner} IS NULL" if kind == "not_null" else f"NOT ({inner})"
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
            f"(SELECT count(*) FROM {_table_block(table)} WHERE {broken}) AS violations, 0::BIGINT AS shape_problems")


oracle("quality_contracts", "\nUNION ALL ".join(_contract_row(t, r) for t, rs in _CONTRACT_RULES.items() for r in rs))

# --- run log, heartbeats ---------------------------------------------------------
oracle("run_log", """
SELECT dt, run_id, duration_sec, gate_status, gate_reconciliation, gate_completeness, gate_freshness,
       gate_schema_drift, CASE WHEN landed_n > 0 THEN landed_n END AS offload_rows FROM run_rows""")
block("signs_of_life", """
SELECT 'collect-' || instance_id AS dag_id, sampled_at, id FROM health_sample WHERE up
""")
block("last_life", """
SELECT dag_id, sampled_at AS last_success_at, CAST(id AS VARCHAR) AS run_id FROM signs_of_life
QUALIFY row_number() OVER (PARTITION BY dag_id ORDER BY sampled_at DESC, CAST(id AS VARCHAR) DESC) = 1
""")
oracle("heartbeat_latest", "SELECT * FROM last_life")
oracle("heartbeat_folded", "SELECT * FROM last_life")
oracle("staleness", """
SELECT w.dag_id, l.dag_id IS NULL OR l.age > 3600 AS stale, round(l.age, 3) AS age_seconds, 3600::BIGINT AS max_age_seconds
FROM (SELECT 'collect-' || instance_id AS dag_id FROM instances
      UNION ALL SELECT 'forgotten-' || instance_id FROM instances) w
LEFT JOIN (SELECT dag_id, date_diff('microsecond', last_success_at, (SELECT CAST(max(dt) + 1 AS TIMESTAMP) FROM days)) / 1000000.0 AS age
           FROM last_life) l ON l.dag_id = w.dag_id""")

# --- serving -----------------------------------------------------------------------
oracle("serve_regression_ranking", """
SELECT instance_id, substr(query_id, 1, 20) AS query_id, recent_from_dt, recent_to_dt,
       round(prior_latency_ms, 2) AS prior_avg_latency_ms, round(recent_latency_ms, 2) AS recent_avg_latency_ms,
       round(latency_increase_ms, 2) AS increase_ms, latency_increase_pct AS increase_pct, recent_delta_calls,
       substr(regexp_replace(query_text, '\\s+', ' ', 'g'), 1, 60) AS query FROM m_regression""")
oracle("serve_daily_trend", """
SELECT dt, CAST(sum(delta_calls) AS BIGINT) AS calls, round(sum(delta_total_time_ms), 0) AS total_time_ms
FROM f_query_daily GROUP BY dt""")
oracle("serve_regressed_count", "SELECT count(*) AS regressed_queries FROM m_regression")
oracle("serve_last_successful_day", "SELECT max(dt) AS last_success_dt FROM run_rows WHERE gate_status <> 'FAIL'")
oracle("serve_latest_gate", """
SELECT dt, gate_status, gate_reconciliation, gate_completeness, gate_freshness, gate_schema_drift, run_at
FROM run_rows ORDER BY run_at DESC LIMIT 1""")
oracle("serve_recent_runs", """
SELECT dt, run_at, gate_status, round(duration_sec, 1) AS duration_sec,
       CASE WHEN landed_n > 0 THEN landed_n END AS offload_rows, CAST(NULL AS BIGINT) AS published_rows
FROM run_rows ORDER BY run_at DESC LIMIT 30""")
oracle("serve_weekly_report", """
SELECT instance_id, instance_name, engine, capacity_worst_risk AS capacity_risk, min_days_to_threshold AS d_day,
       top_wait_event AS top_wait, plan_flips_this_week AS plan_flips, plan_regressed_this_week AS plan_regressed,
       backup_gap_days, backup_status, this_week_uptime_pct AS uptime_pct FROM m_weekly""")
oracle("serve_uptime_slo", """
SELECT instance_id, instance_name, engine, days_observed, window_uptime_pct, worst_day_uptime_pct,
       round(avg_ping_ms, 1) AS avg_ping_ms, target_pct, error_budget_remaining_pct, slo_status FROM m_slo""")
oracle("serve_backup_gaps", """
SELECT instance_id, as_of_dt, last_success_dt, gap_days, max_gap_days, rpo_status FROM m_rpo WHERE rpo_status <> 'ok'""")
oracle("serve_plan_regressions", """
SELECT instance_id, substr(query_id, 1, 20) AS query_id, flip_dt, prev_plan_hash, new_plan_hash, before_avg_ms,
       after_avg_ms, latency_ratio, after_calls, verdict FROM m_plan""")
oracle("serve_config_timeline", """
SELECT instance_id, dt AS change_dt, param_name, old_value, new_value, change_kind FROM m_config_change""")
oracle("serve_config_impact", """
SELECT instance_id, change_dt, change_source, change_key, new_value, plan_flips_after, before_latency_ms,
       after_latency_ms, latency_ratio, correlation FROM m_impact""")
oracle("serve_config_daily", "SELECT instance_id, dt, cycles_collected, change_events, params_changed FROM f_config")

# --- landing -------------------------------------------------------------------------
oracle("offload_extract_day", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, dt, count(*) AS rows, min({at}) AS first_at, max({at}) AS last_at, "
    f"CAST(sum(id) AS BIGINT) AS id_sum FROM {t} GROUP BY dt" for t, at in _RAW_AT.items()))
oracle("offload_primary", "SELECT * FROM query_snapshot")
oracle("offload_auxiliary", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, dt, instance_id, count(*) AS landed_rows FROM {t} GROUP BY dt, instance_id"
    for t in _RAW_AT if t != "query_snapshot"))
oracle("offload_connections", """
SELECT dt, instance_id, count(*) AS rows, CAST(sum(id) AS BIGINT) AS id_sum FROM health_sample GROUP BY dt, instance_id""")
oracle("offload_registry", "SELECT *, 0::BIGINT AS landed_before, 1::BIGINT AS refused FROM dim_snapshot")
oracle("offload_overwrite", """
SELECT dt, instance_id, count(*) AS first_rows, count(*) AS second_rows FROM plan_snapshot GROUP BY ALL""")
block("health_counts", "SELECT dt, instance_id, count(*) AS n FROM health_sample GROUP BY ALL")
block("guard_rows", """
SELECT d.dt, i.instance_id, CASE WHEN d.dt - (SELECT min(dt) FROM days) >= 7 THEN coalesce(h.n, 0) ELSE 0 END AS source_rows,
       h.n IS NOT NULL AND d.dt - (SELECT min(dt) FROM days) <> 19 AS partition_exists
FROM days d CROSS JOIN instances i LEFT JOIN health_counts h ON h.dt = d.dt AND h.instance_id = i.instance_id
""")
oracle("offload_guard", """
SELECT *, CASE WHEN source_rows > 0 THEN 'overwrite' WHEN partition_exists THEN 'refuse' ELSE 'skip' END AS action
FROM guard_rows""")
oracle("instance_thresholds", """
SELECT i.instance_id, c.threshold_bytes, coalesce(c.threshold_kind, 'none') AS threshold_kind,
       coalesce(p.regress_ratio, 1.3) AS regress_ratio, coalesce(p.min_after_calls, 100) AS min_after_calls,
       coalesce(u.target_pct, 99.5) AS target_pct, coalesce(b.max_gap_days, 3) AS max_gap_days
FROM instances i LEFT JOIN capacity_thresholds c USING (instance_id)
LEFT JOIN plan_regression_thresholds p USING (instance_id) LEFT JOIN uptime_slo_targets u USING (instance_id)
LEFT JOIN backup_rpo_thresholds b USING (instance_id)""")

# --- versions ----------------------------------------------------------------------------
oracle("lake_publish", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {b}"
    for t, b in {**FACT_BLOCKS, **MART_BLOCKS, "dim_instance": "dim_now"}.items() if t != "fct_plan_daily"))
oracle("lake_publish_after_failures", """
SELECT instance_id, dt, samples FROM f_uptime""")
block("halves", """
SELECT *, CASE WHEN dt > DATE '2024-01-15' THEN 1 ELSE 2 END AS loaded_in FROM query_snapshot
""")
block("seen_by", "SELECT h.*, v.version FROM halves h JOIN (VALUES (1), (2)) v(version) ON h.loaded_in <= v.version")
oracle("lake_load_partitions", "SELECT loaded_in::BIGINT AS version, count(*) AS rows_added FROM halves GROUP BY 1")
oracle("lake_time_travel", """
SELECT version::BIGINT AS version, dt, count(*) AS rows, CAST(sum(calls) AS BIGINT) AS calls FROM seen_by GROUP BY 1, 2""")
oracle("lake_snapshots", """
SELECT version::BIGINT AS version, 'append query_snapshot' AS changes, 1::BIGINT AS table_count, count(*) AS row_count FROM seen_by GROUP BY 1""")
oracle("lake_correct_row", """
SELECT dt, count(*) AS rows_before, sum(total_time_ms) AS time_before, count(*) AS rows_after,
       sum(total_time_ms) + CASE WHEN dt = DATE '2024-01-16' THEN 1000 ELSE 0 END AS time_after
FROM query_snapshot GROUP BY dt""")
oracle("lake_delete_rolled_back", """
SELECT dt, count(*) AS rows_kept, CASE WHEN dt <> DATE '2024-01-10' THEN count(*) END AS rows_deleted, 3::BIGINT AS versions
FROM query_snapshot GROUP BY dt""")
oracle("lake_expire", "SELECT dt, count(*) AS rows, 1::BIGINT AS versions_left FROM query_snapshot GROUP BY dt")
oracle("lake_compact", """
SELECT count(*) AS rows, CAST(sum(id) AS BIGINT) AS id_sum, count(DISTINCT dt) AS parts_before, count(DISTINCT dt) AS parts_after, count(DISTINCT dt) AS versions
FROM plan_snapshot""")
oracle("lake_maintenance", """
SELECT * FROM (VALUES ('versions', 2::BIGINT, 1::BIGINT), ('tables', 1, 1), ('parts', 2, 1)) m(metric, before, after)
UNION ALL SELECT 'rows', count(*), count(*) FROM query_snapshot""")
oracle("lake_measure", "SELECT 'query_snapshot' AS table_name, 2::BIGINT AS parts, count(*) AS row_count FROM query_snapshot")

# --- scale ---------------------------------------------------------------------------------
oracle("scale_replicate_day", """
SELECT f.instance_id, f.query_id, CAST(DATE '2024-02-01' + CAST(r.n AS INTEGER) AS DATE) AS dt, f.delta_calls,
       f.delta_total_time_ms, f.avg_latency_ms
FROM f_query_daily f CROSS JOIN range(60) r(n) WHERE f.dt = DATE '2024-01-12'""")
oracle("scale_slow_down", """
SELECT query_id, dt, count(*) AS rows,
       round(sum(total_time_ms * CASE WHEN dt > (SELECT max(dt) - 7 FROM days)
                 THEN [1.0, 1.0, 1.0, 1.5, 2.5][CAST(('0x' || substr(md5(query_id), 1, 8)) AS BIGINT) % 5 + 1]
                 ELSE 1.0 END), 3) AS total_time_ms
FROM query_snapshot GROUP BY query_id, dt""")
oracle("scale_spread_instances", """
SELECT j.n AS instance_id, q.query_id || '~i' || j.n AS query_id, count(*) AS rows,
       CAST(sum(q.id + j.n * 1000000000) AS BIGINT) AS id_sum, CAST(sum(q.calls) AS BIGINT) AS calls
FROM query_snapshot q JOIN (SELECT instance_id, row_number() OVER (ORDER BY instance_id) AS place, count(*) OVER () AS m
                            FROM instances) i ON i.instance_id = q.instance_id
JOIN range(1, (SELECT 2 * count(*) + 1 FROM instances)) j(n) ON j.n IN (i.place, i.place + i.m)
GROUP BY 1, 2""")
oracle("scale_daily_commits", """
SELECT row_number() OVER (ORDER BY dt) AS version, 'append health_sample ' || dt AS changes,
       CAST(sum(count(*)) OVER (ORDER BY dt) AS BIGINT) AS row_count
FROM health_sample GROUP BY dt""")
