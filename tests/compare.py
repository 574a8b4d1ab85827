"""Run a registered query next to its comparison SQL and diff the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
from pathlib import Path

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(f).stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _value(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() and abs(v) < 2**53 else float(f"{v:.12g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return sorted(columns), _rows(columns, cur.fetchall())


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


def type_difference(df, con, sql) -> str | None:
    theirs = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    ours = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    return str({c: (ours[c], theirs.get(c)) for c in ours if ours[c] != theirs.get(c)} or "") or None


def difference(df, con, sql) -> str | None:
    sc, sr = spark_rows(df)
    oc, orows = oracle_rows(con, sql)
    if sc != oc:
        return f"columns {sc} != {oc}"
    if len(sr) != len(orows):
        return f"{len(sr)} rows != {len(orows)}; e.g. {sorted(set(sr) ^ set(orows), key=repr)[:3]}"
    bad = [(a, b) for a, b in zip(sr, orows, strict=True) if a != b]
    return f"{len(bad)} of {len(sr)} rows differ, e.g. {bad[:2]} ({sc})" if bad else None
