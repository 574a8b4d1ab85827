"""Files of partitions, written, listed, read and moved by the tasks themselves.

A fleet has one file for each day and instance, most of them of a few rows. Through
Hadoop's file system each would cost some 15 ms of a core, and Spark's own file
index a kilobyte of the driver; here the worker of a task opens its files itself and
what it did travels as rows. The store is reached by the URI that Hadoop gives.

Each function returns what ``mapInArrow`` runs. Failed attempts are harmless: files
are written under new names, only those named by finished tasks are used, and
a move that is repeated finds its file in place.
"""

from __future__ import annotations

import itertools
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle

#: Workers get this module's functions by value: the package need not be installed where they run.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Batches = Iterator[pa.RecordBatch]

#: How Hive names the folder of a null, bytes after which a row group is closed, rows given back at once.
NULL_PART, GROUP_BYTES, ROWS_AT_ONCE = "__HIVE_DEFAULT_PARTITION__", 64 << 20, 10_000

WRITTEN = "part STRING, name STRING, rows BIGINT"
LISTED = "part STRING, name STRING"
READ_BACK = "part STRING, rows BIGINT, newest_at TIMESTAMP_NTZ"
_ARROW = {"part": pa.string(), "name": pa.string(), "rows": pa.int64(), "newest_at": pa.timestamp("us")}


def _batches(rows: Iterable[tuple], *names: str) -> Batches:
    rows, schema = iter(rows), pa.schema([(n, _ARROW[n]) for n in names])
    while some := list(itertools.islice(rows, ROWS_AT_ONCE)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def runs(keys: list[pa.Array], rows: int) -> list[tuple[int, int]]:
    """(start, length) of the consecutive rows that agree on all keys."""
    new = np.zeros(rows, bool)
    new[:1] = True
    for key in keys:
        if key.null_count:
            nulls = key.is_null().to_numpy(zero_copy_only=False)
            new[1:] |= nulls[1:] != nulls[:-1]
        new[1:] |= pc.fill_null(pc.not_equal(key[1:], key[:-1]), False).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(new)
    return list(zip(starts.tolist(), np.diff([*starts, rows]).tolist(), strict=True))


class _Growing:
    """One file of one partition; rows are held until they fill a row group."""

    def __init__(self, store: pafs.FileSystem, root: str, part: str, name: str):
        self.store, self.path, self.part, self.name = store, f"{root}/{name}", part, name
        self.held, self.size, self.rows, self.out = [], 0, 0, None

    def add(self, rows: pa.RecordBatch) -> None:
        self.held.append(rows)
        self.size, self.rows = self.size + rows.nbytes, self.rows + rows.num_rows
        if self.size >= GROUP_BYTES:
            self.put()

    def put(self) -> None:
        if self.held:
            group = pa.Table.from_batches(self.held)
            if self.out is None:
                self.sink = self.store.open_output_stream(self.path)
                self.out = pq.ParquetWriter(self.sink, group.schema, compression="zstd", store_schema=False)
            self.out.write_table(group, group.num_rows)
            self.held, self.size = [], 0

    def close(self) -> tuple[str, str, int]:
        self.put()
        self.out.close()
        self.sink.close()
        return self.part, self.name, self.rows


def write(folder: str, keys: tuple[str, ...]) -> Callable[[Batches], Batches]:
    """Rows that lie together by ``keys`` into one file a partition, all in a folder
    of this attempt: what was written."""

    def put(batches: Batches) -> Batches:
        store, root = pafs.FileSystem.from_uri(folder)
        attempt, numbers, task = uuid.uuid4().hex, itertools.count(), TaskContext.get().partitionId()

        def closed() -> Iterator[tuple[str, str, int]]:
            now, growing = None, None
            for batch in batches:
                values = [batch.column(k) for k in keys]
                kept = batch.select([n for n in batch.schema.names if n not in keys])
                for start, length in runs(values, batch.num_rows):
                    key = tuple(v[start].as_py() for v in values)
                    if growing is None or key != now:
                        if growing:
                            yield growing.close()
                        else:
                            store.create_dir(f"{root}/_{attempt}")
                        part = "/".join(f"{k}={NULL_PART if v is None else v}" for k, v in zip(keys, key, strict=True))
                        name = f"_{attempt}/part-{task:05d}-{attempt}-{next(numbers)}.zstd.parquet"
                        now, growing = key, _Growing(store, root, part, name)
                    growing.add(kept.slice(start, length))
            if growing:
                yield growing.close()

        yield from _batches(closed(), "part", "name", "rows")

    return put


def settle(folder: str) -> Callable[[Batches], Batches]:
    """Each written file into the folder of its partition: rows by its own footer."""

    def move(batches: Batches) -> Batches:
        store, root = pafs.FileSystem.from_uri(folder)

        def one(part: str, name: str, _: int) -> tuple[str, str, int]:
            short = name.rpartition("/")[2]
            store.create_dir(f"{root}/{part}")
            _move(store, f"{root}/{name}", f"{root}/{part}/{short}")
            return part, short, pq.read_metadata(f"{root}/{part}/{short}", filesystem=store).num_rows

        yield from _batches((one(*row) for row in _rows(batches)), "part", "name", "rows")

    return move


def _move(store: pafs.FileSystem, source: str, target: str) -> None:
    try:
        store.move(source, target)
    except OSError:  # an earlier attempt of this task may have moved it
        if store.get_file_info(target).type != pafs.FileType.File:
            raise


def replace(staged: str, target: str) -> Callable[[Batches], Batches]:
    """Partitions (part, names of their new files) into the table: new files come
    first, old ones go last, so that at no moment the only copy is missing."""

    def put(batches: Batches) -> Batches:
        (store, old_root), (_, new_root) = pafs.FileSystem.from_uri(target), pafs.FileSystem.from_uri(staged)

        def one(part: str, names: list[str]) -> tuple[str, str]:
            old, new = f"{old_root}/{part}", f"{new_root}/{part}"
            store.create_dir(old)
            for name in names:
                _move(store, f"{new}/{name}", f"{old}/{name}")
            there = {f.base_name for f in store.get_file_info(pafs.FileSelector(old))}
            for name in there - set(names):
                if name.endswith(".parquet") and name[0] not in "._":
                    store.delete_file(f"{old}/{name}")
                    if f".{name}.crc" in there:  # of Hadoop's local file system
                        store.delete_file(f"{old}/.{name}.crc")
            if store.get_file_info(new).type != pafs.FileType.NotFound:
                store.delete_dir(new)
            return part, ""

        yield from _batches((one(*row) for row in _rows(batches)), "part", "name")

    return put


def listed(folder: str, days: list[str]) -> Callable[[Batches], Batches]:
    """The data files in folders of days, which come as positions in ``days``."""

    def find(batches: Batches) -> Batches:
        store, root = pafs.FileSystem.from_uri(folder)

        def files() -> Iterator[tuple[str, str]]:
            for (n,) in _rows(batches):
                for found in store.get_file_info(pafs.FileSelector(f"{root}/{days[n]}", recursive=True)):
                    part, _, name = found.path[len(root) + 1 :].rpartition("/")
                    hidden = any(x[0] in "._" for x in (*part.split("/"), name))
                    if name.endswith(".parquet") and not hidden and found.type == pafs.FileType.File:
                        yield part, name

        yield from _batches(files(), "part", "name")

    return find


def read_back(folder: str, watermark: str | None) -> Callable[[Batches], Batches]:
    """Rows and newest high-water value of each file, the rows by its footer, the
    value read from its column, one row group after the other."""

    def read(batches: Batches) -> Batches:
        store, root = pafs.FileSystem.from_uri(folder)

        def one(part: str, name: str) -> tuple:
            with store.open_input_file(f"{root}/{part}/{name}") as source:
                file, newest = pq.ParquetFile(source), None
                if watermark is not None and watermark in file.schema_arrow.names:
                    for n in range(file.num_row_groups):
                        top = pc.max(file.read_row_group(n, [watermark]).column(0)).cast(pa.timestamp("us")).as_py()
                        newest = max(filter(None, (newest, top)), default=None)
                return part, file.metadata.num_rows, newest

        yield from _batches((one(*row) for row in _rows(batches)), "part", "rows", "newest_at")

    return read


def scan(folder: str, schema: pa.Schema) -> Callable[[Batches], Batches]:
    """All rows of files. Columns that name the folder come from it, others that a
    file lacks are null; small files are given back together."""

    def read(batches: Batches) -> Batches:
        store, root = pafs.FileSystem.from_uri(folder)

        def column(field: pa.Field, found: pa.RecordBatch, named: dict[str, str]) -> pa.Array:
            if field.name in named and named[field.name] != NULL_PART:
                return pa.repeat(pa.scalar(named[field.name]).cast(field.type), found.num_rows)
            if field.name in named or field.name not in found.schema.names:
                return pa.nulls(found.num_rows, field.type)
            return found.column(field.name).cast(field.type)

        held, rows = [], 0
        for part, name in _rows(batches):
            named = dict(x.split("=", 1) for x in part.split("/"))
            with store.open_input_file(f"{root}/{part}/{name}") as source:
                file = pq.ParquetFile(source)
                there = set(file.schema_arrow.names)
                for found in file.iter_batches(ROWS_AT_ONCE, columns=[n for n in schema.names if n in there]):
                    held.append(pa.RecordBatch.from_arrays([column(f, found, named) for f in schema], schema=schema))
                    rows += found.num_rows
                    if rows >= ROWS_AT_ONCE:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                        held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return read
