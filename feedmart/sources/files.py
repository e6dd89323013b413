"""Files and folders through Spark's own file systems, for the few steps that are about names and not about rows."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern, none if its folder does not exist."""
    where, fs = _open(spark, pattern)
    return [str(found.getPath()) for found in fs.globStatus(where) or ()]


def create(spark: SparkSession, path: str, text: str) -> None:
    where, fs = _open(spark, path)
    out = fs.create(where, True)
    out.write(text.encode("utf-8"))
    out.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that appears with all its text, by one rename; False if there is one of that name already."""
    where, fs = _open(spark, path)
    beside, _ = _open(spark, f"{where.getParent()}/_{uuid.uuid4().hex}")
    create(spark, str(beside), text)
    if not fs.exists(where) and fs.rename(beside, where):
        return True
    fs.delete(beside, False)
    return False


def text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    where, fs = _open(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    where, fs = _open(spark, path)
    fs.delete(where, True)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to where another one may be; that one is set aside first and goes only when the new one is there."""
    old, fs = _open(spark, target)
    new, _ = _open(spark, source)
    aside, _ = _open(spark, f"{old.getParent()}/_{uuid.uuid4().hex}")
    fs.mkdirs(old.getParent())
    had = fs.exists(old) and fs.rename(old, aside)
    moved = False
    try:
        moved = fs.rename(new, old)
    finally:
        if had and not moved:
            fs.rename(aside, old)
    if not moved:
        raise OSError(f"cannot move {source} to {target}")
    if had:
        fs.delete(aside, True)
