"""Pages of an ordered result: the rows are sorted once, into ranges, and a page is read by a continuation key."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Key(NamedTuple):
    column: str
    falling: bool = False


BY_SCORE = (Key("score", True), Key("id"))
BY_POST_COUNT = (Key("post_count", True), Key("author"))
BY_AUTHOR = (Key("author"),)
_RANGE = "_range"


def _order(keys: Sequence[Key]) -> list[Column]:
    return [F.desc(key.column) if key.falling else F.asc(key.column) for key in keys]


def write_pages(df: DataFrame, path: str, keys: Sequence[Key], per_range: int = 100_000) -> None:
    """Write `df` in the order of `keys` as ranges of about `per_range` rows, with an index of one row per range.

    The keys must be without nulls, and no two rows may have the same ones. This
    is the only sort of the whole; ranges are cut by a sample of the keys.
    """
    spark = df.sparkSession
    ranges = max(1, -(-df.count() // per_range))
    ordered = df.repartitionByRange(ranges, *_order(keys)).withColumn(_RANGE, F.spark_partition_id())
    ordered.sortWithinPartitions(*_order(keys)).write.partitionBy(_RANGE).parquet(f"{path}/rows")
    df.limit(0).write.mode("append").parquet(f"{path}/rows/{_RANGE}=0")  # names the columns also where there are no rows
    rows = spark.read.schema(ordered.schema).parquet(f"{path}/rows")
    last = F.max_by(F.struct(*[key.column for key in keys]), F.struct(*[_rising(F.col(key.column), key) for key in keys]))
    index = rows.groupBy(_RANGE).agg(F.count("*").alias("n"), last.alias("last")).select(_RANGE, "n", "last.*")
    index.coalesce(1).write.parquet(f"{path}/index")


def _rising(column: Column, key: Key) -> Column:
    return -column.cast("decimal(38,9)") if key.falling else column


def _behind(keys: Sequence[Key], after: Sequence[Any]) -> Column:
    """Whether a row comes after the keys' values `after`."""
    found = F.lit(False)
    for key, value in reversed(list(zip(keys, after))):
        column = F.col(key.column)
        further = column < F.lit(value) if key.falling else column > F.lit(value)
        found = further | ((column == F.lit(value)) & found)
    return found


def page(spark: SparkSession, path: str, keys: Sequence[Key], size: int, after: Sequence[Any] | None = None) -> DataFrame:
    """The first `size` rows that come after the keys `after`, or the first of all, in order.

    The index tells which ranges hold them; only these, one or two as a rule,
    are read and sorted, whatever comes before or behind. The next page comes
    after the keys of this page's last row.
    """
    index = spark.read.parquet(f"{path}/index")
    open_ = index.where(_behind(keys, after)) if after is not None else index
    ranges, held = [], 0
    # A range of which a part lies before `after` counts as one row, so enough are taken; no more than a page has rows.
    for row in open_.orderBy(_RANGE).limit(size + 1).collect():
        ranges.append(row[_RANGE])
        held += 1 if after is not None and len(ranges) == 1 else row.n
        if held >= size + (after is not None):
            break
    folders = [f"{path}/rows/{_RANGE}={number}" for number in ranges or [0]]
    rows = spark.read.option("basePath", f"{path}/rows").parquet(*folders)
    rows = rows.where(_behind(keys, after) if after is not None else F.lit(bool(ranges)))
    return rows.drop(_RANGE).orderBy(*_order(keys)).limit(size)
