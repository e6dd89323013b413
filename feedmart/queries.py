"""Every operator as a query over the test tables: (spark, sf_dir) -> DataFrame.

Queries that land and load data write to a folder of their own in the work
folder and return what they read back from it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmart import adapters
from feedmart.functions import parse
from feedmart.operators import explore, pages, quality
from feedmart.plans import daily, marts, staging
from feedmart.schemas import FEEDS, MODELS, PARSED
from feedmart.session import pin, work_dir
from feedmart.sources import landing as land
from feedmart.sources import tables, versions

Query = Callable[[SparkSession, str], DataFrame]

DAY = "2024-01-15"
OTHER_DAY = "2024-01-04"
KEPT_SCORE = 20
MIN_SCORE = 100
MIN_REACTIONS = 910
STORY_AUTHORS = ("user_1", "user_2", "user_3", "user_5", "user_8", "unknown")
LISTING_LENGTH = 1000  # ids that a landed listing names
PAGE = 25  # rows of a first page
PAGE_ROWS, RANGE_ROWS = 400, 150  # rows of each page when all are walked, and of a sorted range
THRESHOLDS = (0, MIN_SCORE, 300)

QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _json(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"stories": adapters.stories_json(spark, sf_dir), "articles": adapters.articles_json(spark, sf_dir)}


def _stg_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_stories(adapters.stories_raw(spark, sf_dir))


def _stg_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_articles(adapters.articles_raw(spark, sf_dir))


def _land_all(spark: SparkSession, sf_dir: str, landing: str, *feeds: str) -> None:
    records = _json(spark, sf_dir)
    for feed in feeds:
        parsed = parse.PARSERS[feed](land.spread(records[feed]), keep=["ingested_date"])
        land.land_days(parsed, landing, feed)


# --- parsing ----------------------------------------------------------------------------------


@_query
def parse_stories(spark, sf_dir):
    good, _ = parse.split_bad(parse.parse_stories(adapters.stories_json(spark, sf_dir)))
    return good.drop("raw")


@_query
def parse_articles(spark, sf_dir):
    good, _ = parse.split_bad(parse.parse_articles(adapters.articles_json(spark, sf_dir)))
    return good.drop("raw")


@_query
def parse_edge_cases(spark, sf_dir):
    def shown(column: str, type_: str = "string"):
        return F.when(F.col("ok"), F.col(column)).cast(type_).alias(column)

    stories = parse.parse_stories(adapters.story_edges(spark, sf_dir), keep=["record"]).select(
        F.lit("stories").alias("feed"), "record", "ok", shown("id", "bigint"), shown("title"),
        shown("score", "bigint"), F.lit(None).cast("string").alias("author"), F.lit(None).cast("string").alias("tag_list"),
    )
    articles = parse.parse_articles(adapters.article_edges(spark, sf_dir), keep=["record"]).select(
        F.lit("articles").alias("feed"), "record", "ok", shown("id", "bigint"), shown("title"),
        F.when(F.col("ok"), F.col("positive_reactions_count")).alias("score"), shown("author"), shown("tag_list"),
    )
    return stories.unionByName(articles)


@_query
def parse_quarantine(spark, sf_dir):
    counts = [
        parse.count_outcomes(parse.PARSERS[feed](adapters.damaged(records))).select(F.lit(feed).alias("feed"), "rows_fetched", "errors")
        for feed, records in _json(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, counts)


@_query
def parse_fail_mode(spark, sf_dir):
    """Records without broken ones but with null items, parsed so that a broken one would end the run."""
    def nulled(records):
        return records.withColumn("value", F.when(F.col("record") % 13 != 0, F.col("value")))

    counts = [
        parse.count_outcomes(parse.PARSERS[feed](nulled(records), on_bad="fail")).select(F.lit(feed).alias("feed"), "rows_fetched", "errors")
        for feed, records in _json(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, counts)


# --- landing and loading ----------------------------------------------------------------------


@_query
def feed_cap(spark, sf_dir):
    """Stories by month, cut to the first ids of that month's listing, which is landed as one array of ids and read back."""
    records = adapters.stories_raw(spark, sf_dir).withColumn("ingested_date", F.trunc("ingested_date", "month"))
    path = work_dir(spark, "listings")
    adapters.listings(records, LISTING_LENGTH).write.parquet(path)
    listing = land.listing_rows(spark.read.parquet(path))
    return land.cap_feed(records, listing, [F.asc("pos")]).select("id", "title", "score", "ingested_date")


@_query
def landing_array_files(spark, sf_dir):
    """Both feeds as files of JSON arrays, several per day, read back unparsed and parsed, and loaded."""
    landing, warehouse = work_dir(spark, "arrays"), work_dir(spark, "warehouse")
    out = []
    for feed, records in _json(spark, sf_dir).items():
        land.write_arrays(records.select("ingested_date", "value"), f"{landing}/{feed}")
        parsed = parse.PARSERS[feed](land.read_arrays(spark, f"{landing}/{feed}"), keep=["ingested_date"])
        good, _ = parse.split_bad(parsed)
        tables.load_frame(good, warehouse, feed)
        out.append(tables.read_raw(spark, warehouse, feed).groupBy("ingested_date").agg(
            F.count("*").alias("row_count"), F.sum("id").alias("ids"), F.count("title").alias("titles")
        ).select(F.lit(feed).alias("feed"), "ingested_date", "row_count", "ids", "titles"))
    return reduce(DataFrame.unionByName, out)


@_query
def landing_large_arrays(spark, sf_dir):
    """Both feeds as one indented array per day, cut between records when read."""
    landing = work_dir(spark, "arrays")
    out = []
    for feed, records in _json(spark, sf_dir).items():
        land.write_arrays(records.select("ingested_date", "value"), f"{landing}/{feed}", per_file=1_000_000, indent=True)
        parsed = parse.PARSERS[feed](land.read_large_arrays(spark, f"{landing}/{feed}"), keep=["ingested_date"])
        good, _ = parse.split_bad(parsed)
        out.append(good.groupBy("ingested_date").agg(
            F.count("*").alias("row_count"), F.sum("id").alias("ids"), F.count("title").alias("titles")
        ).select(F.lit(feed).alias("feed"), "ingested_date", "row_count", "ids", "titles"))
    return reduce(DataFrame.unionByName, out)


@_query
def landing_roundtrip(spark, sf_dir):
    landing = work_dir(spark, "landing")
    _land_all(spark, sf_dir, landing, "stories")
    day = land.day_in_path(F.regexp_extract(F.col("_metadata.file_path"), r"^(.*?)/status=", 1))
    rows = land.read_landing(spark, landing, "stories")
    return rows.select(*PARSED["stories"].names, day.alias("landed_date"))


@_query
def landing_latest_day(spark, sf_dir):
    landing = work_dir(spark, "landing")
    _land_all(spark, sf_dir, landing, *FEEDS)
    newest = [(feed, land.latest_day(spark, landing, feed)) for feed in FEEDS]
    return spark.createDataFrame(newest, "feed string, latest_day string").withColumn("latest_day", F.col("latest_day").cast("date"))


def _loaded(spark: SparkSession, sf_dir: str, feed: str) -> tuple[str, str]:
    landing, warehouse = work_dir(spark, "landing"), work_dir(spark, "warehouse")
    _land_all(spark, sf_dir, landing, feed)
    tables.load_days(spark, landing, warehouse, feed)
    return landing, warehouse


@_query
def raw_stories(spark, sf_dir):
    _, warehouse = _loaded(spark, sf_dir, "stories")
    return tables.read_raw(spark, warehouse, "stories")


@_query
def raw_articles(spark, sf_dir):
    _, warehouse = _loaded(spark, sf_dir, "articles")
    return tables.read_raw(spark, warehouse, "articles")


@_query
def replace_day(spark, sf_dir):
    """All days loaded, then one day landed and loaded again with fewer stories."""
    landing, warehouse = _loaded(spark, sf_dir, "stories")
    again = adapters.stories_json(spark, sf_dir).where(F.col("ingested_date") == F.lit(DAY).cast("date"))
    land.land_day(parse.parse_stories(again).where(F.col("score") >= KEPT_SCORE), landing, "stories", DAY)
    tables.load_day(spark, landing, warehouse, "stories", DAY)
    return tables.read_raw(spark, warehouse, "stories").select("id", "score", "by", "ingested_date")


@_query
def replace_day_empty(spark, sf_dir):
    """All days loaded, then one day landed and loaded again without any story."""
    landing, warehouse = _loaded(spark, sf_dir, "stories")
    nothing = adapters.stories_json(spark, sf_dir).where(F.lit(False))
    land.land_day(parse.parse_stories(nothing), landing, "stories", DAY)
    tables.load_day(spark, landing, warehouse, "stories", DAY)
    return tables.read_raw(spark, warehouse, "stories").select("id", "score", "by", "ingested_date")


@_query
def replace_day_interrupted(spark, sf_dir):
    """All days loaded, one day replaced, and another day's replacement written but broken off before it became current."""
    landing, warehouse = _loaded(spark, sf_dir, "stories")
    _land_again(spark, sf_dir, landing, OTHER_DAY)
    tables.load_day(spark, landing, warehouse, "stories", OTHER_DAY)
    _land_again(spark, sf_dir, landing, DAY)
    rows = tables.to_raw(land.read_landing(spark, landing, "stories", DAY), "stories")
    versions.write_part(rows.drop("ingested_date"), tables.raw_path(warehouse, "stories"), tables.part_of(DAY))
    return tables.read_raw(spark, warehouse, "stories").select("id", "score", "by", "ingested_date")


@_query
def reload_days_empty(spark, sf_dir):
    """All days loaded, one landed again without any story, then all days loaded again."""
    landing, warehouse = _loaded(spark, sf_dir, "stories")
    nothing = adapters.stories_json(spark, sf_dir).where(F.lit(False))
    land.land_day(parse.parse_stories(nothing), landing, "stories", DAY)
    tables.load_days(spark, landing, warehouse, "stories")
    return tables.read_raw(spark, warehouse, "stories").select("id", "score", "by", "ingested_date")


@_query
def land_days_again(spark, sf_dir):
    """All days landed with damaged records, then the days up to one landed again whole; good rows and bad rows left per day."""
    landing = work_dir(spark, "landing")
    records = adapters.stories_json(spark, sf_dir)
    land.land_days(parse.parse_stories(adapters.damaged(records), keep=["ingested_date"]), landing, "stories")
    again = records.where(F.col("ingested_date") <= F.lit(DAY).cast("date"))
    land.land_days(parse.parse_stories(again, keep=["ingested_date"]), landing, "stories")
    good = land.read_landing(spark, landing, "stories").select("ingested_date", F.lit(1).alias("good"), F.lit(0).alias("bad"))
    bad = land.read_quarantine(spark, landing, "stories").select("ingested_date", F.lit(0).alias("good"), F.lit(1).alias("bad"))
    return good.unionByName(bad).groupBy("ingested_date").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


@_query
def loaded_day_count(spark, sf_dir):
    _, warehouse = _loaded(spark, sf_dir, "stories")
    return tables.day_count(tables.read_raw(spark, warehouse, "stories"), DAY)


@_query
def run_log(spark, sf_dir):
    landing, warehouse = work_dir(spark, "landing"), work_dir(spark, "warehouse")
    for feed, records in _json(spark, sf_dir).items():
        daily.ingest_day(spark, adapters.damaged(records), landing, warehouse, feed, DAY)
    return tables.read_run_log(spark, warehouse).select(
        "feed", "rows_fetched", "errors",
        (F.col("run_at") <= F.current_timestamp()).alias("run_before_now"),
        F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("path_end"),
    )


@_query
def daily_run(spark, sf_dir):
    """Every day landed and loaded, then the daily job for the newest day; rows per table."""
    landing, warehouse = work_dir(spark, "landing"), work_dir(spark, "warehouse")
    _land_all(spark, sf_dir, landing, *FEEDS)
    for feed in FEEDS:
        tables.load_days(spark, landing, warehouse, feed)
    daily.run_daily(spark, landing, warehouse)
    built = {f"raw_{feed}": tables.read_raw(spark, warehouse, feed) for feed in FEEDS}
    built |= {name: tables.read_model(spark, warehouse, name) for name in MODELS}
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in built.items()]
    return reduce(DataFrame.unionByName, counts)


def _land_again(spark: SparkSession, sf_dir: str, landing: str, *days: str) -> None:
    """The stories of some days landed again, without those of a low score."""
    for day in days:
        again = adapters.stories_json(spark, sf_dir).where(F.col("ingested_date") == F.lit(day).cast("date"))
        land.land_day(parse.parse_stories(land.spread(again)).where(F.col("score") >= KEPT_SCORE), landing, "stories", day)


@_query
def run_log_repeated(spark, sf_dir):
    """Each feed's run logged often enough to be folded, always under one key: first with damaged records, last with whole ones."""
    landing, warehouse = work_dir(spark, "landing"), work_dir(spark, "warehouse")
    for feed, records in _json(spark, sf_dir).items():
        damaged = daily.ingest_day(spark, adapters.damaged(records), landing, warehouse, feed, DAY, run_key=f"{feed} {DAY}")
        for other in range(tables.RUNS_APART // 2):
            tables.append_run(spark, warehouse, f"{feed} again", damaged, f"{feed} {other}")
        daily.ingest_day(spark, records, landing, warehouse, feed, DAY, run_key=f"{feed} {DAY}")
    return tables.read_run_log(spark, warehouse).select("feed", "rows_fetched", "errors")


@_query
def daily_catch_up(spark, sf_dir):
    """All days built, then two days loaded in bulk and a third by the daily job, which finds all three; rows and sums per table."""
    landing, later, warehouse = (work_dir(spark, name) for name in ("landing", "later", "warehouse"))
    _land_all(spark, sf_dir, landing, *FEEDS)
    for feed in FEEDS:
        tables.load_days(spark, landing, warehouse, feed)
    daily.build_models(spark, warehouse)
    _land_again(spark, sf_dir, later, OTHER_DAY, DAY)
    tables.load_days(spark, later, warehouse, "stories")
    _land_again(spark, sf_dir, landing, land.latest_day(spark, landing, "stories"))
    daily.run_daily(spark, landing, warehouse)
    sums = {
        "stg_stories": F.col("id") * F.col("score"), "stg_articles": F.col("id"), "top_stories": F.col("id") * F.col("rank"),
        "author_stats": F.col("post_count") * F.col("total_comments"), "article_author_stats": F.col("post_count") * F.col("total_reactions"),
    }
    rows = [
        tables.read_model(spark, warehouse, name).agg(F.count("*").alias("row_count"), F.sum(of).cast("bigint").alias("total"))
        .select(F.lit(name).alias("table_name"), "row_count", "total")
        for name, of in sums.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@_query
def daily_author_stats_months(spark, sf_dir):
    """Stories dealt over three months, built, then one day of a closed month replaced and the daily job run for it."""
    landing, warehouse = work_dir(spark, "landing"), work_dir(spark, "warehouse")
    _land_all(spark, sf_dir, landing, "articles")
    records = adapters.stories_json(spark, sf_dir)
    spread = records.withColumn("ingested_date", F.add_months("ingested_date", (F.col("record") % 3).cast("int")))
    land.land_days(parse.parse_stories(spread, keep=["ingested_date"]), landing, "stories")
    for feed in FEEDS:
        tables.load_days(spark, landing, warehouse, feed)
    daily.build_models(spark, warehouse)
    again = spread.where(F.col("ingested_date") == F.lit(DAY).cast("date"))
    land.land_day(parse.parse_stories(again).where(F.col("score") >= KEPT_SCORE), landing, "stories", DAY)
    tables.load_day(spark, landing, warehouse, "stories", DAY)
    daily.build_models(spark, warehouse, changed_only=True)
    return tables.read_model(spark, warehouse, "author_stats")


def _built(spark: SparkSession, sf_dir: str, incremental: bool) -> str:
    """The warehouse after every day was loaded, all models were built, and the daily job ran once more for one day that had changed."""
    landing, warehouse = work_dir(spark, "landing"), work_dir(spark, "warehouse")
    _land_all(spark, sf_dir, landing, *FEEDS)
    for feed in FEEDS:
        tables.load_days(spark, landing, warehouse, feed)
    daily.build_models(spark, warehouse)
    again = adapters.stories_json(spark, sf_dir).where(F.col("ingested_date") == F.lit(DAY).cast("date"))
    land.land_day(parse.parse_stories(land.spread(again)).where(F.col("score") >= KEPT_SCORE), landing, "stories", DAY)
    daily.run_daily(spark, landing, warehouse, DAY, incremental=incremental)
    return warehouse


@_query
def daily_author_stats(spark, sf_dir):
    return tables.read_model(spark, _built(spark, sf_dir, True), "author_stats")


@_query
def daily_author_stats_full(spark, sf_dir):
    return tables.read_model(spark, _built(spark, sf_dir, False), "author_stats")


@_query
def daily_article_author_stats(spark, sf_dir):
    return tables.read_model(spark, _built(spark, sf_dir, True), "article_author_stats")


@_query
def daily_top_stories(spark, sf_dir):
    return tables.read_model(spark, _built(spark, sf_dir, True), "top_stories")


@_query
def quality_gate(spark, sf_dir):
    """The failing checks on stories of which some lost id, title or author."""
    lost = F.when(F.col("id") % 29 != 0, F.col("id"))
    stories = _stg_stories(spark, sf_dir).withColumn("author", F.when(F.col("id") % 31 != 0, F.col("author"))).withColumn("id", lost)
    results = quality.run_checks({"stg_stories": stories, "author_stats": marts.author_stats(stories).unionByName(marts.author_stats(stories))},
                                 [c for c in quality.CHECKS if c.model in ("stg_stories", "author_stats")])
    try:
        quality.gate(results)
    except quality.QualityError as error:
        return spark.createDataFrame(error.failed, "model string, column string, check string, failures bigint")
    return results.where(F.lit(False))


# --- models -----------------------------------------------------------------------------------


@_query
def stg_stories(spark, sf_dir):
    return _stg_stories(spark, sf_dir)


@_query
def stg_articles(spark, sf_dir):
    return _stg_articles(spark, sf_dir)


@_query
def top_stories(spark, sf_dir):
    return marts.top_stories(_stg_stories(spark, sf_dir))


@_query
def author_stats(spark, sf_dir):
    return marts.by_post_count(marts.author_stats(_stg_stories(spark, sf_dir)))


@_query
def article_tags(spark, sf_dir):
    return marts.article_tags(_stg_articles(spark, sf_dir))


@_query
def author_tags(spark, sf_dir):
    return marts.author_tags(_stg_articles(spark, sf_dir))


@_query
def author_top_tags(spark, sf_dir):
    return marts.author_top_tags(_stg_articles(spark, sf_dir))


@_query
def article_author_stats(spark, sf_dir):
    return marts.by_post_count(marts.article_author_stats(_stg_articles(spark, sf_dir)))


@_query
def quality_checks(spark, sf_dir):
    stories, articles = _stg_stories(spark, sf_dir), _stg_articles(spark, sf_dir)
    return quality.run_checks({
        "stg_stories": stories,
        "stg_articles": articles,
        "top_stories": marts.top_stories(stories),
        "author_stats": marts.author_stats(stories),
        "article_author_stats": marts.article_author_stats(articles),
    })


# --- exploration ------------------------------------------------------------------------------


def _stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.stories(marts.top_stories(_stg_stories(spark, sf_dir)))


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explore.articles(_stg_articles(spark, sf_dir))


@_query
def explore_filtered(spark, sf_dir):
    return explore.by_score(explore.filtered(_stories(spark, sf_dir), MIN_SCORE, STORY_AUTHORS))


@_query
def explore_articles(spark, sf_dir):
    return explore.by_score(explore.filtered(_articles(spark, sf_dir), MIN_REACTIONS))


@_query
def explore_timeline(spark, sf_dir):
    return explore.timeline(explore.filtered(_stories(spark, sf_dir), MIN_SCORE))


@_query
def explore_score_range(spark, sf_dir):
    return explore.score_range(_stories(spark, sf_dir))


@_query
def explore_authors(spark, sf_dir):
    return explore.authors(_stories(spark, sf_dir))


@_query
def explore_summary(spark, sf_dir):
    return explore.summary(explore.filtered(_stories(spark, sf_dir), MIN_SCORE))


@_query
def explore_top_authors(spark, sf_dir):
    return explore.top_authors(explore.filtered(_stories(spark, sf_dir), MIN_SCORE))


@_query
def top_stories_of_day(spark, sf_dir):
    """One day of the top stories of a stored staging table; the day is asked for afterwards."""
    warehouse = work_dir(spark, "warehouse")
    tables.write_model(_stg_stories(spark, sf_dir), warehouse, "stg_stories")
    return tables.of_day(marts.top_stories(tables.read_model(spark, warehouse, "stg_stories")), DAY)


@_query
def explore_stored(spark, sf_dir):
    """Two questions of one filtered, kept frame over a stored mart, as one row."""
    warehouse = work_dir(spark, "warehouse")
    tables.write_model(marts.top_stories(_stg_stories(spark, sf_dir)), warehouse, "top_stories")
    kept = explore.filtered(explore.stories(tables.read_model(spark, warehouse, "top_stories")), MIN_SCORE).persist()
    try:
        bounds, whole = explore.score_range(kept).first(), explore.summary(kept).first()
    finally:
        kept.unpersist()
    row = (bounds.min_score, bounds.max_score, whole.row_count, whole.top_author, whole.active_author)
    return spark.createDataFrame([row], "min_score int, max_score int, row_count bigint, top_author string, active_author string")


@_query
def explore_empty(spark, sf_dir):
    return explore.summary(explore.filtered(_stories(spark, sf_dir), 1_000_000_000))


def _page(df: DataFrame, *columns: str) -> DataFrame:
    """The first page of an ordered frame with the rows' places, so that the order is compared."""
    rows = df.limit(PAGE).select(*columns)
    return rows.sparkSession.createDataFrame(
        [(i, *r) for i, r in enumerate(rows.collect(), 1)],  # at most PAGE rows
        "place bigint, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields),
    )


@_query
def author_stats_page(spark, sf_dir):
    return _page(marts.by_post_count(marts.author_stats(_stg_stories(spark, sf_dir))), "author", "post_count")


@_query
def explore_filtered_page(spark, sf_dir):
    return _page(explore.by_score(explore.filtered(_stories(spark, sf_dir), MIN_SCORE)), "id", "score")


@_query
def explore_authors_page(spark, sf_dir):
    return _page(explore.authors(_stories(spark, sf_dir)), "author")


@_query
def explore_pages(spark, sf_dir):
    """All pages of the stories by score, each asked for by the last keys of the one before."""
    path = work_dir(spark, "pages")
    pages.write_pages(_stories(spark, sf_dir), path, pages.BY_SCORE, RANGE_ROWS)
    out, after = [], None
    while True:
        rows = pages.page(spark, path, pages.BY_SCORE, PAGE_ROWS, after).select("score", "id").collect()  # at most PAGE_ROWS rows
        if not rows:
            break
        number, after = len(out) // PAGE_ROWS + 1, tuple(rows[-1])
        out += [(number, len(out) + i, row.id, row.score) for i, row in enumerate(rows, 1)]
    return spark.createDataFrame(out, "page bigint, place bigint, id bigint, score int")


@_query
def explore_thresholds(spark, sf_dir):
    """Three thresholds answered from one stored table of cells per day, score and author."""
    path = work_dir(spark, "cells")
    top = marts.top_stories(_stg_stories(spark, sf_dir))
    explore.cells(top, "ingested_date").write.partitionBy("ingested_date").parquet(path)
    cells = spark.read.parquet(path)
    out = []
    for threshold in THRESHOLDS:
        some = explore.filtered(cells, threshold)
        best = explore.top_authors_of_cells(some).agg(F.sum("score").alias("top_authors_score"))
        rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [explore.summary_of_cells(some), explore.score_range(some), best])
        out.append(rows.agg(F.lit(threshold).alias("threshold"), *[F.max(name).alias(name) for name in rows.columns]))
    return reduce(DataFrame.unionByName, out)
