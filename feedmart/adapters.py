"""The test tables in the shape of the two feeds.

`events` stands for stories and `part` for articles. `*_raw` give the columns of
a raw table; `*_json` give the same records as unparsed JSON text, with unknown
keys, left-out keys, ids written as text, and tags as a list or as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart.operators.topn import top_n_per_group
from feedmart.schemas import TEST_TABLES


def stories_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    user, event = F.col("user_id"), F.col("event_id")
    return events.select(
        event.alias("id"),
        F.when(event % 11 != 0, F.col("event_type")).alias("title"),
        F.floor("value").cast("int").alias("score"),
        F.when(user % 13 != 0, F.concat(F.lit("user_"), user.cast("string"))).alias("by"),
        F.get_json_object("props", "$.k").cast("int").alias("descendants"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"),
        F.when(event % 7 != 0, F.concat(F.lit("https://example.com/s/"), event.cast("string"))).alias("url"),
        F.col("ts").cast("date").alias("ingested_date"),
    )


def articles_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir).drop("tags")


def stories_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns record, ingested_date and value. Keys without a value are left out, as is a comment count of 0."""
    record = F.struct(
        _sometimes_text("id"),
        "title",
        "score",
        "by",
        F.nullif(F.col("descendants"), F.lit(0)).alias("descendants"),
        "time",
        "url",
        F.lit("story").alias("type"),
        F.array(F.col("id") + 1, F.col("id") + 2).alias("kids"),
    )
    rows = stories_raw(spark, sf_dir)
    return rows.select(F.col("id").alias("record"), "ingested_date", F.to_json(record).alias("value"))


def articles_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns record, ingested_date and value. Even ids carry their tags as a list."""
    as_list = F.to_variant_object("tags")
    as_text = F.col("tag_list").cast("variant")
    record = F.struct(
        _sometimes_text("id"),
        "title",
        "positive_reactions_count",
        "public_reactions_count",
        "comments_count",
        F.struct(F.col("author").alias("username"), F.lit("x").alias("name")).alias("user"),
        "published_at",
        F.when(F.col("id") % 2 == 0, as_list).otherwise(as_text).alias("tag_list"),
        "url",
        "reading_time_minutes",
        F.lit("article").alias("type_of"),
    )
    rows = _articles(spark, sf_dir)
    return rows.select(F.col("id").alias("record"), "ingested_date", F.to_json(record).alias("value"))


def listings(stories: DataFrame, length: int) -> DataFrame:
    """Per ingested_date one listing: an array of at most `length` ids, newest first."""
    order = [F.desc("time"), F.asc("id")]
    first = top_n_per_group(stories.select("ingested_date", "id", "time"), ["ingested_date"], order, length, spread=["id"], rank="pos")
    ids = F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"])
    return first.groupBy("ingested_date").agg(ids.alias("ids"))


def damaged(records: DataFrame) -> DataFrame:
    """JSON records of which some became null items and some lost their id to a null."""
    value = (
        F.when(F.col("record") % 13 == 0, "null")
        .when(F.col("record") % 23 == 0, '{"id":null}')
        .otherwise(F.col("value"))
    )
    return records.withColumn("value", value)


def story_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns record and value: one odd story per event, of sixteen kinds."""
    events = _table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return events.select(
        F.col("id").alias("record"),
        _pick(F.col("id"), [
            '{"id":%d}',
            '{"id":"%d"}',
            '{"score":%d}',
            '{"id":%d,"title":""}',
            '{"id":7,"score":%d.9}',
            '{"id":%d,"score":null}',
            '{"id":7,"score":"%d.7"}',
            "null",
            '{"id":null}',
            "[%d]",
            '"%d"',
            '{"id":%d,',
            '{"id":7,"title":%d}',
            '{"id":7,"score":" %d "}',
            '{"id":%d,"score":true}',
            '{"id":%d,"custom":"x","foo":[1],"title":"t"}',
        ]).alias("value"),
    )


def article_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns record and value: one odd article per part, of thirteen kinds."""
    part = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return part.select(
        F.col("id").alias("record"),
        _pick(F.col("id"), [
            '{"id":%d}',
            '{"id":%d,"user":null}',
            '{"id":7,"tag_list":"a, %d"}',
            '{"id":%d,"tag_list":[]}',
            '{"id":%d,"tag_list":{"a":1}}',
            '{"id":%d,"user":{}}',
            '{"id":%d,"user":"x"}',
            '{"id":7,"tag_list":["a",null,%d]}',
            "%d",
            '{"id":7,"user":{"username":"u%d"}}',
            '{"id":%d,"user":""}',
            '{"id":%d,"user":0}',
            '{"id":7,"user":[%d]}',
        ]).alias("value"),
    )


def _pick(key: Column, kinds: list[str]) -> Column:
    """The text of kind `key % len(kinds)` with the key written into it."""
    text = F.lit(None).cast("string")
    for i, kind in enumerate(kinds):
        filled = F.format_string(kind, key) if "%d" in kind else F.lit(kind)
        text = F.when(key % len(kinds) == i, filled).otherwise(text)
    return text


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TEST_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int"))
    untagged = (F.col("p_brand") == "Brand#7") | (size % 7 == 0)
    return part.select(
        key.alias("id"),
        F.when(key % 17 != 0, F.col("p_name")).alias("title"),
        F.floor("p_retailprice").cast("int").alias("positive_reactions_count"),
        size.alias("public_reactions_count"),
        size.alias("comments_count"),
        F.col("p_brand").alias("author"),
        F.when(key % 19 != 0, F.concat(day.cast("string"), F.lit("T12:30:15Z"))).alias("published_at"),
        F.when(untagged, None)
        .when(size % 7 == 1, F.lit(""))
        .otherwise(F.replace("p_name", F.lit(" "), F.lit(", ")))
        .alias("tag_list"),
        F.lit(None).cast("string").alias("url"),
        size.alias("reading_time_minutes"),
        day.alias("ingested_date"),
        F.when(~untagged & (size % 7 != 1), F.split("p_name", " ")).alias("tags"),
    )


def _sometimes_text(column: str) -> Column:
    """A number as a JSON number, or as text where it divides by 5."""
    number = F.col(column)
    text = number.cast("string").cast("variant")
    return F.when(number % 5 == 0, text).otherwise(number.cast("variant")).alias(column)

