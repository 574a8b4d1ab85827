"""The ten raw tables: schema, high-water column and gate profile."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

AXES = ("reconciliation", "completeness", "freshness", "schema_drift")


@dataclass(frozen=True)
class RawTable:
    name: str
    ddl: str
    watermark: str | None
    gate: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ("dt", "instance_id")
    immutable: bool = True  # False: a closed day may still change, re-extract on D+1
    available: bool = True

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema]

    @property
    def schema(self) -> StructType:
        """What the source table must look like."""
        return StructType.fromDDL(self.ddl)

    @property
    def landed_schema(self) -> StructType:
        """What a reader of the landed files declares: the source columns plus
        ``dt``. Partition columns are typed here, never inferred from paths."""
        day = StructType.fromDDL("dt DATE NOT NULL")
        return StructType([*self.schema.fields, *day.fields])


def _t(name: str, ddl: str, watermark: str | None, gate: tuple[str, ...], **kw) -> RawTable:
    return RawTable(name, ddl, watermark, gate, **kw)


# Column names, types and nullability of the source tables, and
# which gate axes each table is held to.
_ALL = AXES
_EVENTS = ("reconciliation", "schema_drift")
_POLLED = ("reconciliation", "freshness", "schema_drift")

RAW_TABLES: dict[str, RawTable] = {
    t.name: t
    for t in [
        _t(
            "query_snapshot",
            "id BIGINT NOT NULL, instance_id BIGINT NOT NULL, captured_at TIMESTAMP_NTZ NOT NULL, "
            "query_id STRING NOT NULL, query_text STRING, calls BIGINT NOT NULL, "
            "total_time_ms DOUBLE NOT NULL, rows_examined BIGINT NOT NULL",
            "captured_at",
            _ALL,
        ),
        _t(
            "backup_run",
            "id BIGINT NOT NULL, instance_id BIGINT NOT NULL, started_at TIMESTAMP_NTZ NOT NULL, "
            "status STRING NOT NULL, backup_type STRING, duration_ms BIGINT NOT NULL, detail STRING, "
            "location STRING, verify_status STRING, verified_at TIMESTAMP_NTZ, remote_location STRING",
            "started_at",
            _EVENTS,
            immutable=False,
        ),
        _t(
            "plan_snapshot",
            "id BIGINT NOT NULL, instance_id BIGINT NOT NULL, query_id STRING NOT NULL, "
            "plan_hash STRING NOT NULL, plan_shape STRING, captured_at TIMESTAMP_NTZ NOT NULL",
            "captured_at",
            _EVENTS,
        ),
        _t(
            "wait_event_snapshot",
            "id BIGINT NOT NULL, instance_id BIGINT NOT NULL, captured_at TIMESTAMP_NTZ NOT NULL, "
            "event_name STRING NOT NULL, category STRING, wait_count BIGINT NOT NULL, "
            "total_ms DOUBLE NOT NULL",
            "captured_at",
            _POLLED,
        ),
        _t(
            "size_snapshot",
            "id BIGINT NOT NULL, instance_id BIGINT NOT NULL, captured_at TIMESTAMP_NTZ NOT NULL, "
            "object_type STRING NOT NULL, object_name STRING NOT NULL, row_estimate BIGINT NOT NULL, "
            "data_bytes BIGINT NOT NULL, index_bytes BIGINT NOT NULL, volume_total_bytes BIGINT, "
            "volume_available_bytes BIGINT, max_bytes BIGINT",
            "captured_at",
            _EVENTS,
        ),
        _t(
            "index_usage_snapshot",
            "id BIGINT NOT NULL, instance_id BIGINT NOT NULL, captured_at TIMESTAMP_NTZ NOT NULL, "
            "table_name STRING NOT NULL, index_name STRING NOT NULL, scan_count BIGINT, "
            "size_bytes BIGINT, is_unique BOOLEAN NOT NULL",
            "captured_at",
            _POLLED,
        ),
        _t(
            "config_snapshot",
            "id BIGINT NOT NULL, instance_id BIGINT NOT NULL, captured_at TIMESTAMP_NTZ NOT NULL, "
            "param_hash STRING NOT NULL, change_count INT NOT NULL, baseline BOOLEAN NOT NULL",
            "captured_at",
            _EVENTS,
        ),
        _t(
            "config_param_change",
            "id BIGINT NOT NULL, snapshot_id BIGINT NOT NULL, instance_id BIGINT NOT NULL, "
            "captured_at TIMESTAMP_NTZ NOT NULL, param_name STRING NOT NULL, old_value STRING, "
            "new_value STRING, change_kind STRING NOT NULL",
            "captured_at",
            _EVENTS,
        ),
        _t(
            "health_sample",
            "id BIGINT NOT NULL, instance_id BIGINT NOT NULL, sampled_at TIMESTAMP_NTZ NOT NULL, "
            "up BOOLEAN NOT NULL, ping_millis BIGINT NOT NULL",
            "sampled_at",
            _POLLED,
        ),
        _t(
            "dim_instance",
            "id BIGINT NOT NULL, name STRING, type STRING, team_label STRING",
            None,
            (),
            partitions=("dt",),
        ),
    ]
}

PRIMARY = "query_snapshot"
AUXILIARY = tuple(n for n, t in RAW_TABLES.items() if n not in (PRIMARY, "dim_instance") and t.available)


def raw_table(name: str) -> RawTable:
    """Look a table up; an unknown or not yet available one is an error, not a skip."""
    table = RAW_TABLES.get(name)
    if table is None:
        raise KeyError(f"unknown raw table {name!r}; known: {', '.join(RAW_TABLES)}")
    if not table.available:
        raise RuntimeError(f"raw table {name!r} has no source yet")
    return table

