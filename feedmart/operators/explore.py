"""Exploration of the marts: filters, ranges, top rows.

Every function takes and returns a DataFrame, so filters stay in the plan and
reach the scan. Empty input gives empty results or NULLs, never an error. A
caller that asks several questions of one filtered frame can `persist()` it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmart.schemas import TOP_AUTHORS


def stories(top_stories: DataFrame) -> DataFrame:
    """Stories in the common shape of both feeds."""
    return top_stories.select("id", "title", "score", "author", "num_comments", "published_at", "url", "story_date")


def articles(stg_articles: DataFrame) -> DataFrame:
    """Articles in the common shape: positive reactions are the score."""
    return stg_articles.select(
        "id",
        "title",
        F.col("positive_reactions_count").alias("score"),
        "author",
        F.col("comments_count").alias("num_comments"),
        "published_at",
        "url",
        "story_date",
        "reading_time_minutes",
        "tag_list",
    )


def filtered(df: DataFrame, min_score: int | None = None, authors: Sequence[str] | DataFrame = ()) -> DataFrame:
    """Rows with at least `min_score` whose author is one of `authors`.

    No authors means all authors, in an empty list as in an empty DataFrame. A
    long list belongs in a DataFrame with an `author` column, which is
    semi-joined instead of written into the plan. A hot author on the left is
    split by adaptive execution if the list is too long to broadcast.
    """
    if min_score is not None:
        df = df.where(F.col("score") >= min_score)
    if isinstance(authors, DataFrame):
        if authors.isEmpty():
            return df
        return df.join(authors.select("author"), "author", "left_semi").select(*df.columns)
    return df.where(F.col("author").isin(list(authors))) if authors else df


def by_score(df: DataFrame) -> DataFrame:
    """Highest score first."""
    return df.orderBy(F.desc("score"), F.asc("id"))


def timeline(df: DataFrame) -> DataFrame:
    """What a plot of scores over time needs of each row."""
    return df.select("published_at", "score", "num_comments", "title", "author")


def score_range(df: DataFrame) -> DataFrame:
    """One row: lowest score and highest, the latter one higher if they are equal."""
    bounds = df.agg(F.min("score").alias("min_score"), F.max("score").alias("top"))
    top = F.when(F.col("min_score") == F.col("top"), F.col("top") + 1).otherwise(F.col("top"))
    return bounds.select("min_score", top.alias("max_score"))


def authors(df: DataFrame) -> DataFrame:
    """The distinct authors in order."""
    return df.select("author").where(F.col("author").isNotNull()).distinct().orderBy("author")


def summary(df: DataFrame) -> DataFrame:
    """One row: row count, score and author of the top row, most active author and their row count.

    One pass gives the count and the top row; the other counts per author. Each
    ends in a single row, and the two rows are folded by one last aggregate.
    Rows without a score count but are never the top row.
    """
    row = F.struct((-F.col("score").cast("bigint")).alias("neg"), "id", "author", "score")
    top = F.min(F.when(F.col("score").isNotNull(), row))
    overall = df.agg(F.count("*").alias("row_count"), top.alias("top")).select(
        "row_count",
        F.col("top.score").alias("top_score"),
        F.col("top.author").alias("top_author"),
        F.lit(None).cast("string").alias("active_author"),
        F.lit(None).cast("bigint").alias("active_count"),
    )
    per_author = df.where(F.col("author").isNotNull()).groupBy("author").agg(F.count("*").alias("n"))
    most = F.min(F.struct((-F.col("n")).alias("neg"), "author", "n"))
    active = per_author.agg(most.alias("most")).select(
        F.lit(None).cast("bigint").alias("row_count"),
        F.lit(None).cast("int").alias("top_score"),
        F.lit(None).cast("string").alias("top_author"),
        F.col("most.author").alias("active_author"),
        F.col("most.n").alias("active_count"),
    )
    both = overall.unionByName(active)
    return both.agg(*[F.max(name).alias(name) for name in both.columns])


def top_authors(df: DataFrame, n: int = TOP_AUTHORS) -> DataFrame:
    """The `n` authors with the highest total score."""
    totals = df.groupBy("author").agg(F.sum("score").alias("score"))
    return totals.orderBy(F.desc("score"), F.asc("author")).limit(n)


# --- any threshold from one small table -------------------------------------------------------


def cells(df: DataFrame, *keys: str) -> DataFrame:
    """What the questions below need, per score and author (and `keys`, such as the day): rows, and the smallest id of the top row.

    Cells of parts of the data can be added up: the same functions work on
    their union. `filtered` and `score_range` work on cells as on rows.
    """
    return df.groupBy(*keys, "score", "author").agg(F.count("*").alias("n"), F.min("id").alias("id"))


def summary_of_cells(cells: DataFrame) -> DataFrame:
    """`summary` from cells."""
    row = F.struct((-F.col("score").cast("bigint")).alias("neg"), "id", "author", "score")
    top = F.min(F.when(F.col("score").isNotNull(), row))
    per_author = cells.groupBy("author").agg(F.sum("n").alias("n"), top.alias("top"))
    most = F.min(F.when(F.col("author").isNotNull(), F.struct((-F.col("n")).alias("neg"), "author", "n")))
    return per_author.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.min("top").alias("top"), most.alias("most")).select(
        "row_count", F.col("top.score").alias("top_score"), F.col("top.author").alias("top_author"),
        F.col("most.author").alias("active_author"), F.col("most.n").alias("active_count"),
    )


def top_authors_of_cells(cells: DataFrame, n: int = TOP_AUTHORS) -> DataFrame:
    """`top_authors` from cells."""
    totals = cells.groupBy("author").agg(F.sum(F.col("score") * F.col("n")).alias("score"))
    return totals.orderBy(F.desc("score"), F.asc("author")).limit(n)
