"""Column checks on built models, and the gate that fails a run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Check(NamedTuple):
    model: str
    column: str
    kind: str  # "not_null" or "unique"


class QualityError(RuntimeError):
    """At least one check found failing rows; `failed` has (model, column, check, failures) of each."""

    def __init__(self, message: str, failed: list[tuple] = ()):
        super().__init__(message)
        self.failed = failed


# The checks that a build must pass.
CHECKS = (
    Check("stg_stories", "id", "not_null"),
    Check("stg_stories", "title", "not_null"),
    Check("stg_stories", "author", "not_null"),
    Check("stg_articles", "id", "not_null"),
    Check("stg_articles", "author", "not_null"),
    Check("top_stories", "id", "not_null"),
    Check("top_stories", "title", "not_null"),
    Check("top_stories", "rank", "not_null"),
    Check("author_stats", "author", "not_null"),
    Check("author_stats", "author", "unique"),
    Check("author_stats", "post_count", "not_null"),
    Check("article_author_stats", "author", "not_null"),
)


def run_checks(models: Mapping[str, DataFrame], checks: Iterable[Check] = CHECKS) -> DataFrame:
    """One row per check: model, column, check, failures.

    `not_null` counts NULL rows, `unique` the values that occur more than once,
    NULLs left out. All checks of a model come from one pass over it; a model
    with checks of several `unique` columns needs one pass for each.
    """
    not_null: dict[str, list[str]] = {}
    unique: dict[str, list[str]] = {}
    for check in checks:
        if check.kind not in ("not_null", "unique"):
            raise ValueError(f"unknown check {check.kind!r}")
        chosen = not_null if check.kind == "not_null" else unique
        chosen.setdefault(check.model, []).append(check.column)
    results = []
    for model in dict.fromkeys([*not_null, *unique]):
        nulls, keys = not_null.get(model, []), unique.get(model, [None])
        results += [_checked(models[model], model, nulls if i == 0 else [], key) for i, key in enumerate(keys)]
    return reduce(DataFrame.unionByName, results)


def gate(results: DataFrame) -> None:
    """Raise if any check failed. Reads at most one row per check."""
    failed = results.where("failures > 0").collect()
    if failed:
        listed = ", ".join(sorted(f"{r.model}.{r.column} {r.check}: {r.failures}" for r in failed))
        raise QualityError(f"checks failed: {listed}", [(r.model, r.column, r.check, r.failures) for r in failed])


def _checked(df: DataFrame, model: str, not_null: list[str], unique: str | None) -> DataFrame:
    """Null counts and, with `unique`, repeated values of that column, which are counted per value first."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(not_null)]
    kinds = [(c, "not_null", f"_{i}") for i, c in enumerate(not_null)]
    if unique is None:
        counts = df.agg(*nulls)
    else:
        per_value = df.groupBy(F.col(unique).alias("_value")).agg(F.count("*").alias("_n"), *nulls)
        repeated = F.count_if(F.col("_value").isNotNull() & (F.col("_n") > 1)).alias("_repeated")
        counts = per_value.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for _, _, name in kinds], repeated)
        kinds.append((unique, "unique", "_repeated"))
    rows = [
        F.struct(F.lit(model).alias("model"), F.lit(c).alias("column"), F.lit(kind).alias("check"), F.col(name).alias("failures"))
        for c, kind, name in kinds
    ]
    return counts.select(F.inline(F.array(*rows)))
