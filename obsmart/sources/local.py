"""Small driver-side rows as DataFrames whose size Spark knows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def local_frame(spark: SparkSession, rows: Iterable[Sequence], ddl: str) -> DataFrame:
    """Rows the driver already holds (days, seeds, folder listings).

    Going through Arrow makes a local relation: its exact size is known when
    the plan is made, so Spark broadcasts it when small and shuffles it
    otherwise, without a hint.
    """
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) or [()] * len(arrow)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
    return spark.createDataFrame(table, schema)
