"""Column layouts of the two feeds and of the models built from them."""

from __future__ import annotations

from pyspark.sql import types as T

FEEDS = ("stories", "articles")

# Results depend on them.
FEED_CAP = 500  # records taken of a feed's listing
TOP_STORIES_PER_DAY = 100
TOP_TAGS_PER_AUTHOR = 3
TOP_AUTHORS = 10
NO_TITLE = "Untitled"
NO_AUTHOR = "unknown"
TAG_SEPARATOR = ","  # in a record's tag_list
NULL_TAG = "None"  # a null in a list of tags
TAG_JOIN = ", "  # between an author's most used tags


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Parsed records as they are landed. Integers are read wide and narrowed on load,
# so a value too large for the raw table fails the load instead of the parse.
PARSED = {
    "stories": _struct("id bigint, title string, score bigint, by string, descendants bigint, time bigint, url string"),
    "articles": _struct(
        "id bigint, title string, positive_reactions_count bigint, public_reactions_count bigint, "
        "comments_count bigint, author string, published_at string, tag_list string, url string, "
        "reading_time_minutes bigint"
    ),
}

# Fixed values from here to MODELS: names, types and order of the columns.
# Raw tables, partitioned by ingested_date.
RAW = {
    "stories": _struct(
        "id bigint, title string, score int, by string, descendants int, time bigint, url string, ingested_date date"
    ),
    "articles": _struct(
        "id bigint, title string, positive_reactions_count int, public_reactions_count int, comments_count int, "
        "author string, published_at string, tag_list string, url string, reading_time_minutes int, ingested_date date"
    ),
}

RUN_LOG = _struct("run_at timestamp, feed string, rows_fetched bigint, errors bigint, path string")

MODELS = {
    "stg_stories": _struct(
        "id bigint, title string, score int, author string, num_comments int, published_at timestamp_ntz, "
        "story_date date, url string, ingested_date date"
    ),
    "stg_articles": _struct(
        "id bigint, title string, positive_reactions_count int, public_reactions_count int, comments_count int, "
        "author string, published_at timestamp_ntz, story_date date, tag_list string, url string, "
        "reading_time_minutes int, ingested_date date"
    ),
    "top_stories": _struct(
        "id bigint, title string, score int, author string, num_comments int, published_at timestamp_ntz, "
        "story_date date, url string, ingested_date date, rank bigint"
    ),
    "author_stats": _struct(
        "author string, post_count bigint, avg_score double, total_comments bigint, first_seen date, last_seen date"
    ),
    "article_author_stats": _struct(
        "author string, post_count bigint, total_reactions bigint, avg_reading_time double, most_used_tags string"
    ),
}

# What author statistics are summed from: one row per day and author (and tag), partitioned by day.
PARTIALS = {
    "author_days": _struct(
        "author string, post_count bigint, score_sum bigint, score_count bigint, total_comments bigint, first_seen date, "
        "last_seen date, ingested_date date"
    ),
    "article_author_days": _struct(
        "author string, post_count bigint, total_reactions bigint, minutes_sum bigint, minutes_count bigint, ingested_date date"
    ),
    "article_tag_days": _struct("author string, tag string, tag_count bigint, ingested_date date"),
}

# The same summed over each closed month, under the month's first day.
MONTHS = {"author_days": "author_months", "article_author_days": "article_author_months", "article_tag_days": "article_tag_months"}
PARTIALS |= {months: PARTIALS[days] for days, months in MONTHS.items()}

# The test tables that stand for the feeds.
TEST_TABLES = {
    "events": _struct(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "part": _struct(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
}
