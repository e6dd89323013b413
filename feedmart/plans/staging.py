"""Staging models: one cleaned row per raw row, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.functions.scalars import epoch_to_timestamp, iso_to_timestamp
from feedmart.schemas import NO_AUTHOR, NO_TITLE


def _or(column: str, default: str | int, alias: str | None = None) -> Column:
    return F.coalesce(F.col(column), F.lit(default)).alias(alias or column)


def stg_stories(raw: DataFrame) -> DataFrame:
    """Stories with defaults for missing values, and the epoch second as timestamp and date."""
    published = epoch_to_timestamp(F.col("time"))
    return raw.select(
        "id",
        _or("title", NO_TITLE),
        _or("score", 0),
        _or("by", NO_AUTHOR, "author"),
        _or("descendants", 0, "num_comments"),
        published.alias("published_at"),
        F.to_date(published).alias("story_date"),
        "url",
        "ingested_date",
    )


def stg_articles(raw: DataFrame) -> DataFrame:
    """Articles with defaults for missing values, and the ISO text as timestamp and date."""
    published = iso_to_timestamp(F.col("published_at"))
    return raw.select(
        "id",
        _or("title", NO_TITLE),
        _or("positive_reactions_count", 0),
        _or("public_reactions_count", 0),
        _or("comments_count", 0),
        _or("author", NO_AUTHOR),
        published.alias("published_at"),
        F.to_date(published).alias("story_date"),
        "tag_list",
        "url",
        _or("reading_time_minutes", 0),
        "ingested_date",
    )
