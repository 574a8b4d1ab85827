"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import weakref
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsmart.session import fresh_dir

#: White space that separates words: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Text handled at once inside a task, in bytes.
SLICE_BYTES = 3 << 20


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run: it is sent as
    one archive through Spark, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="obsmart-code-")) / "obsmart_code.zip"  # read by this driver alone
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: its work is done
    once, and a lost executor costs no more than a read. The shuffle files of the
    write, which nothing reads any more, go when it ends."""
    path = fresh_dir(df.sparkSession, label)
    with shuffles_go(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    _STORED[stored] = path
    return stored


@contextlib.contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that ends in here go at its end."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


#: Spark's own setting: a query's shuffle files are deleted at its end, not at the driver's next clean-up.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STORED: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def unstage(*frames: DataFrame) -> None:
    """Delete the folders of staged frames that nothing reads any more."""
    for df in frames:
        store, path = pafs.FileSystem.from_uri(_STORED.pop(df))
        store.delete_dir(path)


def n_words(text: Column) -> Column:
    """Words of a text; null and empty texts have none."""
    text = F.coalesce(text, F.lit(""))
    spaces = [" ", "\t", "\n", "\v", "\f", "\r"]
    outer = F.substring(text, 1, 1).isin(spaces).cast("long") + F.substring(text, -1, 1).isin(spaces).cast("long")
    return F.when(text == "", F.lit(0).cast("long")).otherwise(F.size(F.split(text, SPACE)) - outer)


def unit_hash(*values: Column | str) -> Column:
    """A number in [0, 1) from the MD5 of the values; SQL engines agree on it."""
    key = F.concat_ws("|", *[F.coalesce(v.cast("string"), F.lit("null")) if isinstance(v, Column) else F.lit(v) for v in values])
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) in runs of about ``limit`` bytes; a longer text stands alone."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1])
    begin, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield begin, column.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if begin < len(column):
        yield begin, column.slice(begin)


def texts(column: pa.Array) -> pa.Array:
    """Text column with nulls as empty texts."""
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def given_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; when it ends, memory that its arrays no longer use
    goes back to the system, for Python workers live on beside the next stage."""
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def partition_id() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def offsets(df: DataFrame, part: str, amount: str) -> DataFrame:
    """(part, part_start): what all earlier partitions hold. One row and one
    number on the driver for each partition, however many rows there are."""
    totals = df.groupBy(part).agg(F.sum(amount).alias("n")).collect()
    rows, start = [], 0
    for p, n in sorted((r[0], r[1] or 0) for r in totals):
        rows.append((p, start))
        start += n
    return df.sparkSession.createDataFrame(rows, f"{part} int, part_start long")


#: Rows of a key, in thousandths of all, from which it no longer goes through one task.
HEAVY_SHARE = 1


def met(left: DataFrame, right: DataFrame, keys: list[str], n: str, how: str = "inner") -> DataFrame:
    """``left`` joined to ``right``, stored and with one row for each key, whose
    column ``n`` says how many rows of ``left`` at most it meets. Keys with more
    than a thousandth of all rows, so at most a thousand of them, are sent to
    every task; all others are joined by Spark as it sees fit."""
    total = right.agg(F.sum(n)).first()[0] or 0
    limit = max(100, total * HEAVY_SHARE // 1000)
    heavy = right.where(F.col(n) > limit)
    if heavy.isEmpty():
        return left.join(right, keys, how)
    few = F.broadcast(heavy)  # a thousand rows at most: their n add up to no more than the total
    rest = left.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return left.join(few, keys, how).unionByName(rest.join(right.where(F.col(n) <= limit), keys, how))


def numbered(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """Add ``row_index``: the row's place in the whole order, from 0, without
    gaps. Range partitions are sorted and numbered side by side."""
    ship_code(df.sparkSession)
    names = [f.name for f in df.schema]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = partition_id(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(done, done + n, dtype=np.int64))],
                [*names, "part", "local_index"],
            )
            done += n

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    dealt = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    placed = stage(dealt.mapInArrow(count, f"{schema}, part int, local_index long"), label)
    starts = offsets(placed.withColumn("one", F.lit(1)), "part", "one")
    return (
        placed.join(F.broadcast(starts), "part")  # a row for each partition
        .withColumn("row_index", F.col("part_start") + F.col("local_index"))
        .drop("part", "local_index", "part_start")
    )
