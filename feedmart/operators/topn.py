"""Top rows per group for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Into how many parts the candidates of one group are split in the first round.
GROUP_PARTS = 64


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, spread: Sequence[str], rank: str = "rank"
) -> DataFrame:
    """The first `n` rows of each group by `order`, numbered from 1 in `rank`.

    For a group read by a hundred thousand tasks, `n` rows of each task would
    still be millions for one reducer. Candidates are therefore cut within
    (group, part), where a row's part follows from a hash of the columns
    `spread`, and only the survivors meet in one place: a task passes on at most
    `n` x GROUP_PARTS rows per group, a reducer of the first round gets at most
    `n` per task, one of the second round `n` x GROUP_PARTS. The part is the same
    in every run, so a filter on the keys behind this reaches the scan. `order`
    must not leave ties.
    """
    part = "_part"
    first = Window.partitionBy(*keys, part).orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(part, F.pmod(F.xxhash64(*spread), F.lit(GROUP_PARTS)))
        .withColumn("_n", F.row_number().over(first))
        .where(F.col("_n") <= n)
        .drop("_n", part)
        .withColumn(rank, F.row_number().over(final))
        .where(F.col(rank) <= n)
        .withColumn(rank, F.col(rank).cast("bigint"))
    )
