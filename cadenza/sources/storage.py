"""Folders of the table store, through Spark's own file systems (any scheme)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.delete(where, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted (none if it does not exist)."""
    fs, where = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, where = _open(spark, source)
    to = _open(spark, target)[1]
    fs.mkdirs(to.getParent())
    if not fs.rename(where, to):
        raise OSError(f"cannot move {source} to {target}")


def staging(path: str) -> str:
    """A fresh folder beside ``path``; the leading dot hides it from readers."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}-{uuid.uuid4().hex[:12]}"


def swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put the staged folder in the place of ``path`` by two renames; the old table is deleted
    last. If the second rename fails the old table is put back, and the error raised. Between
    the renames there is no table: readers that must never meet that moment read a
    published table (:func:`cadenza.sources.sinks.refresh_published`)."""
    old = staging(path)
    had = exists(spark, path)
    if had:
        move(spark, path, old)
    try:
        move(spark, staged, path)
    except Exception:
        if had:
            move(spark, old, path)
        raise
    if had:
        delete(spark, old)


def create_empty(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.mkdirs(where.getParent())
    fs.create(where, True).close()
