"""Folder and small-file helpers on the cluster's own file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def uri(spark: SparkSession, path: str) -> str:
    """A path with its scheme, as tasks need it to reach the same file system."""
    p, fs = _path(spark, path)
    full = p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri().toString()
    return full.replace("s3a://", "s3://", 1)


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """(files, bytes) below a folder."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return 0, 0
    summary = fs.getContentSummary(p)
    return summary.getFileCount(), summary.getLength()


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files directly in a folder; markers are left out."""
    return [n for n in list_names(spark, path) if not n.startswith(("_", "."))]


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the parent of the target is made if it is missing."""
    p, fs = _path(spark, source)
    q, _ = _path(spark, target)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"could not move {source} to {target}")


def delete_folder(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file that this package wrote."""
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet: written aside, then renamed
    into place, so a reader sees all of it or none of it."""
    target, fs = _path(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    aside, _ = _path(spark, f"{path}.pending")
    out = fs.create(aside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if not fs.rename(aside, target):
        raise OSError(f"could not publish {path}")
