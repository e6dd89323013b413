"""Mart models over the staging models.

Orders that leave ties get one more key (id, tag or author), so results do not
depend on how rows were distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmart.functions.scalars import mean, round2
from feedmart.operators.topn import top_n_per_group
from feedmart.schemas import MODELS, TAG_JOIN, TAG_SEPARATOR, TOP_STORIES_PER_DAY, TOP_TAGS_PER_AUTHOR


def top_stories(stg_stories: DataFrame, n: int = TOP_STORIES_PER_DAY) -> DataFrame:
    """The `n` stories with the highest score of each ingestion day, with their rank."""
    ranked = top_n_per_group(stg_stories, ["ingested_date"], [F.desc("score"), F.asc("id")], n, spread=["id"])
    return ranked.select(*MODELS["top_stories"].names)


def author_stats(stg_stories: DataFrame) -> DataFrame:
    """Posts, average score, comments, first and last date of each story author."""
    return stg_stories.groupBy("author").agg(
        F.count("*").alias("post_count"),
        round2(mean("score")).alias("avg_score"),
        F.sum("num_comments").alias("total_comments"),
        F.min("story_date").alias("first_seen"),
        F.max("story_date").alias("last_seen"),
    )


def author_days(stg_stories: DataFrame) -> DataFrame:
    """What `author_stats` needs of each day."""
    return stg_stories.groupBy("ingested_date", "author").agg(
        F.count("*").alias("post_count"),
        F.sum("score").alias("score_sum"),
        F.count("score").alias("score_count"),
        F.sum("num_comments").alias("total_comments"),
        F.min("story_date").alias("first_seen"),
        F.max("story_date").alias("last_seen"),
    )


def author_months(days: DataFrame) -> DataFrame:
    """The rows of `author_days` summed by month, under the month's first day."""
    return _by_month(days, "author").agg(
        *[F.sum(name).alias(name) for name in ("post_count", "score_sum", "score_count", "total_comments")],
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )


def article_author_months(days: DataFrame) -> DataFrame:
    sums = ("post_count", "total_reactions", "minutes_sum", "minutes_count")
    return _by_month(days, "author").agg(*[F.sum(name).alias(name) for name in sums])


def article_tag_months(tag_days: DataFrame) -> DataFrame:
    return _by_month(tag_days, "author", "tag").agg(F.sum("tag_count").alias("tag_count"))


def _by_month(days: DataFrame, *keys: str):
    return days.groupBy(F.trunc("ingested_date", "month").alias("ingested_date"), *keys)


def author_stats_of_days(days: DataFrame) -> DataFrame:
    """`author_stats` from the rows of `author_days` or `author_months` that together make up all days."""
    return days.groupBy("author").agg(
        F.sum("post_count").alias("post_count"),
        round2(F.sum("score_sum") / F.sum("score_count")).alias("avg_score"),
        F.sum("total_comments").alias("total_comments"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )


def article_author_days(stg_articles: DataFrame) -> DataFrame:
    """What `article_author_stats` needs of each day, but for tags."""
    return stg_articles.groupBy("ingested_date", "author").agg(
        F.count("*").alias("post_count"),
        F.sum(F.col("positive_reactions_count") + F.col("public_reactions_count")).alias("total_reactions"),
        F.sum("reading_time_minutes").alias("minutes_sum"),
        F.count("reading_time_minutes").alias("minutes_count"),
    )


def article_tag_days(stg_articles: DataFrame) -> DataFrame:
    """How often each author used each tag on each day."""
    return article_tags(stg_articles, "ingested_date").groupBy("ingested_date", "author", "tag").agg(F.count("*").alias("tag_count"))


def article_author_stats_of_days(days: DataFrame, tag_days: DataFrame) -> DataFrame:
    """`article_author_stats` from the rows by author and by author and tag, of days or months, that make up all days."""
    base = days.groupBy("author").agg(
        F.sum("post_count").alias("post_count"),
        F.sum("total_reactions").alias("total_reactions"),
        round2(F.sum("minutes_sum") / F.sum("minutes_count")).alias("avg_reading_time"),
    )
    counts = tag_days.groupBy("author", "tag").agg(F.sum("tag_count").alias("tag_count"))
    return base.join(_top_tags(counts, TOP_TAGS_PER_AUTHOR), "author", "left")


def article_tags(stg_articles: DataFrame, *keep: str) -> DataFrame:
    """One row per author and tag occurrence, with the columns `keep`; empty pieces count as a tag."""
    tagged = stg_articles.where(F.col("tag_list").isNotNull() & (F.col("tag_list") != ""))
    return tagged.select(*keep, "author", F.explode(F.split("tag_list", TAG_SEPARATOR)).alias("piece")).select(
        *keep, "author", F.trim("piece").alias("tag")
    )


def author_tags(stg_articles: DataFrame) -> DataFrame:
    """How often each author used each tag."""
    return article_tags(stg_articles).groupBy("author", "tag").agg(F.count("*").alias("tag_count"))


def author_top_tags(stg_articles: DataFrame, n: int = TOP_TAGS_PER_AUTHOR) -> DataFrame:
    """Each author's `n` most used tags in one text, most used first.

    The window sees one row per author and tag, and each reducer of that count
    passes on at most `n` rows per author, so a hot author stays small here.
    """
    return _top_tags(author_tags(stg_articles), n)


def _top_tags(counts: DataFrame, n: int) -> DataFrame:
    by_use = Window.partitionBy("author").orderBy(F.desc("tag_count"), F.asc("tag"))
    top = counts.withColumn("rn", F.row_number().over(by_use)).where(F.col("rn") <= n)
    tags = F.expr(f"listagg(tag, '{TAG_JOIN}') WITHIN GROUP (ORDER BY tag_count DESC, tag)")
    return top.groupBy("author").agg(tags.alias("most_used_tags"))


def article_author_stats(stg_articles: DataFrame) -> DataFrame:
    """Posts, reactions, average reading time and most used tags of each article author.

    Both sides are reduced to one row per author before the join, so the join
    reuses their partitioning and has no skew.
    """
    base = stg_articles.groupBy("author").agg(
        F.count("*").alias("post_count"),
        F.sum(F.col("positive_reactions_count") + F.col("public_reactions_count")).alias("total_reactions"),
        round2(mean("reading_time_minutes")).alias("avg_reading_time"),
    )
    return base.join(author_top_tags(stg_articles), "author", "left")


def by_post_count(stats: DataFrame) -> DataFrame:
    """Author statistics in reading order. Tables are written unsorted; readers ask for order."""
    return stats.orderBy(F.desc("post_count"), F.asc("author"))
