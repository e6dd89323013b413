"""Helpers of the corpus operators: columns by name, tables in the shared folder, text blocks, digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart.session import work_dir

# Words of every contract: runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, also if others differ from them in case alone."""
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"_{df.columns.index(name)}").alias(name) for name in names])


def settle(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """The frame as a table in the shared folder: cuts lineage, survives lost executors, is computed once.

    `parts` is the number of tasks that write it, for a table known to be small.
    """
    path = work_dir(df.sparkSession, name)
    (df.coalesce(parts) if parts else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def blocks(rows: list, size_of, limit: int = 1 << 20) -> Iterable[list]:
    """Consecutive rows in lists of about `limit` in size, so that array work on long texts stays bounded."""
    part: list = []
    total = 0
    for row in rows:
        part.append(row)
        total += size_of(row)
        if total >= limit:
            yield part
            part, total = [], 0
    if part:
        yield part


def unit_hash(*columns: Column) -> Column:
    """A number from 0 (included) to 1 by hash, the same in every run."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / F.lit(float(1 << 40))
