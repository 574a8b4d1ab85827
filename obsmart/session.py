"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

#: While tables of many small folders are landed and read back. A folder of a day
#: is listed by one task, not by one task for each folder in it, and writers share
#: files evenly: those of a small table are as many as those of a large one.
MANY_FOLDERS = {
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "0",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
}

_LOCAL_ROOTS: dict[str, str] = {}
_BEFORE: dict[str, dict[str, str]] = {}
_USERS: dict[str, int] = {}
_LOCK = threading.Lock()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("obsmart")
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    driver-local path would be invisible to the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="obsmart-")
    return _LOCAL_ROOTS[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def many_folders(spark: SparkSession) -> Iterator[None]:
    """``MANY_FOLDERS`` until the last of the threads in this block has left it."""
    app = spark.sparkContext.applicationId
    with _LOCK:
        if not _USERS.get(app):
            _BEFORE[app] = {k: spark.conf.get(k) for k in MANY_FOLDERS}
            for key, value in MANY_FOLDERS.items():
                spark.conf.set(key, value)
        _USERS[app] = _USERS.get(app, 0) + 1
    try:
        yield
    finally:
        with _LOCK:
            _USERS[app] -= 1
            if not _USERS[app]:
                for key, value in _BEFORE.pop(app).items():
                    spark.conf.set(key, value)
