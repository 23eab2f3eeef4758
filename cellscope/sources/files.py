"""Small file operations through Hadoop's FileSystem, so that any store Spark reads works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file; parent folders are made."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def create(spark: SparkSession, path: str) -> None:
    """An empty file that must not be there yet; parent folders are made."""
    fs, p = _fs(spark, path)
    fs.create(p, False).close()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of this library's own output, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def set_time(spark: SparkSession, path: str, changed_ms: int) -> None:
    """Set a file's modification time."""
    fs, p = _fs(spark, path)
    fs.setTimes(p, changed_ms, -1)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a finished folder to its final name (one operation of the store)."""
    fs, p = _fs(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")


def listing(spark: SparkSession, pattern: str, deep: bool = False) -> list[tuple[str, int, int]]:
    """(path, modification time in ms, length) of what matches, sorted; with ``deep`` the
    visible files below it.  Names that begin with ``_`` or ``.`` below it are hidden."""
    fs, p = _fs(spark, pattern)
    found = list(fs.globStatus(p) or [])
    if deep:
        files, todo = [], found
        while todo:
            f = todo.pop()
            if f.isDirectory():
                todo += [x for x in fs.listStatus(f.getPath())
                         if not x.getPath().getName().startswith(("_", "."))]
            else:
                files.append(f)
        found = files
    return sorted((f.getPath().toString(), f.getModificationTime(), f.getLen()) for f in found)
