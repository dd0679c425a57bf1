"""Folders of the shared storage, whatever file system it is on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _system(spark, path)
    return system.exists(where)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a folder in one step, so that readers see all of it or nothing."""
    system, where = _system(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    system.mkdirs(target.getParent())
    if not system.rename(where, target):
        raise OSError(f"cannot move {path} to {to}")


def remove(spark: SparkSession, path: str) -> None:
    system, where = _system(spark, path)
    system.delete(where, True)


def count(spark: SparkSession, path: str, pattern: str) -> int:
    """How many files of a folder have names of a pattern."""
    system, where = _system(spark, f"{path}/{pattern}")
    return len(system.globStatus(where) or [])


def versions(spark: SparkSession, path: str) -> list[int]:
    """The finished versions of a table kept as ``version=N`` folders, oldest first."""
    system, where = _system(spark, f"{path}/version=*/_SUCCESS")
    found = system.globStatus(where) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)
