"""Physical plans: no Python on rows, pruned scans, early limits, no needless shuffles."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from feedmart.functions.parse import parse_stories
from feedmart.operators import explore, quality
from feedmart.plans import marts, staging
from feedmart.sources import landing as land
from feedmart.sources import tables

SF = "/root/testdata/sf0.001"
READ_ONLY = [
    "parse_stories", "parse_articles", "parse_edge_cases", "parse_quarantine", "parse_fail_mode", "stg_stories", "stg_articles",
    "top_stories", "author_stats", "article_tags", "author_tags", "author_top_tags", "article_author_stats",
    "quality_checks", "explore_filtered", "explore_articles", "explore_timeline", "explore_score_range",
    "explore_authors", "explore_summary", "explore_top_authors",
]


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def staged(spark, stories, articles, tmp_path):
    """Staging tables on disk, so scans can be inspected."""
    warehouse = str(tmp_path)
    s = stories(*[(i, "t", i % 7, f"a{i % 5}", 1, i, f"2024-03-0{1 + i % 3}") for i in range(50)])
    a = articles(*[(i, f"a{i % 5}", 1, 1, 1, "x,y", "2024-03-01") for i in range(50)])
    tables.write_model(staging.stg_stories(s), warehouse, "stg_stories")
    tables.write_model(staging.stg_articles(a), warehouse, "stg_articles")
    return (tables.read_model(spark, warehouse, name) for name in ("stg_stories", "stg_articles"))


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_python_and_no_cross_join(spark, name):
    plan = _plan(queries()[name](spark, SF))
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_top_stories_limits_before_each_shuffle(staged):
    stories, _ = staged
    plan = _plan(marts.top_stories(stories))
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Partial") == 2 and plan.count("WindowGroupLimit") == 4


def test_one_day_of_top_stories_reads_one_partition(staged):
    stories, _ = staged
    plan = _plan(marts.top_stories(tables.of_day(stories, "2024-03-02")))
    assert re.search(r"PartitionFilters: \[isnotnull\(ingested_date#\d+\), \(ingested_date#\d+ = 2024-03-02\)\]", plan)


def test_one_day_asked_for_after_ranking_reads_one_partition(staged):
    stories, _ = staged
    plan = _plan(tables.of_day(marts.top_stories(stories), "2024-03-02"))
    assert re.search(r"PartitionFilters: \[isnotnull\(ingested_date#\d+\), \(ingested_date#\d+ = 2024-03-02\)\]", plan)


def test_capping_a_feed_does_not_shuffle_it(spark, stories):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feed = stories(*[(i, "t", 1, "a", 0, i, "2024-03-01") for i in range(20)])
        plan = _plan(land.cap_feed(feed, feed.select("ingested_date", "id", "time"), [F.desc("time"), F.asc("id")], 3))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_author_stats_reads_four_columns_and_shuffles_once(staged):
    stories, _ = staged
    plan = _plan(marts.author_stats(stories))
    assert "ReadSchema: struct<score:int,author:string,num_comments:int,story_date:date>" in plan
    assert plan.count("Exchange") == 1 and "partial_sum(score" in plan


def test_article_author_stats_joins_without_another_shuffle(spark, staged):
    _, articles = staged
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(marts.article_author_stats(articles))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    # base by author, tag counts by (author, tag), top tags by author; the join adds none.
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(re.findall(r"ReadSchema: struct<(.*?)>", plan)) == [
        "author:string,tag_list:string",
        "positive_reactions_count:int,public_reactions_count:int,author:string,reading_time_minutes:int",
    ]


def test_filters_reach_the_scan(staged):
    stories, articles = staged
    plan = _plan(explore.timeline(explore.filtered(explore.articles(articles), 3, ["a1", "a2"])))
    assert "GreaterThanOrEqual(positive_reactions_count,3)" in plan and "In(author, [a1,a2])" in plan
    assert "url" not in plan
    tags = _plan(marts.article_tags(articles))
    assert "IsNotNull(tag_list)" in tags


def test_top_rows_are_taken_without_a_full_sort(staged):
    _, articles = staged
    assert "TakeOrderedAndProject" in _plan(explore.top_authors(explore.articles(articles)))


def test_landing_scan_is_pruned_to_day_and_good_records(spark, records, tmp_path):
    root = str(tmp_path)
    for day in ("2024-03-01", "2024-03-02"):
        land.land_day(parse_stories(records({"id": 1}, "null")), root, "stories", day)
    frame = land.read_landing(spark, root, "stories").where(F.col("ingested_date") == F.lit("2024-03-01").cast("date"))
    plan = _plan(frame)
    pruned = re.search(r"PartitionFilters: \[(.*?)\]", plan).group(1)
    assert "status" in pruned and "ingested_date" in pruned
    assert frame.count() == 1


def _scanned(frame):
    """How many rows the scan of a frame gave, after row groups were skipped."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_scores_and_authors_skip_row_groups_inside_a_day(spark, stories, tmp_path):
    rows = stories(*[(i, "t", i * 7919 % 20_000, f"user {i * 31 % 20_000} of some length", 1, i, "2024-03-01") for i in range(20_000)]).repartition(1)
    conf = spark._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", "65536")
    try:
        tables.write_model(staging.stg_stories(rows), str(tmp_path), "stg_stories")
    finally:
        conf.unset("parquet.block.size")
    table = tables.read_model(spark, str(tmp_path), "stg_stories")
    assert table.count() == 20_000
    high = explore.filtered(explore.stories(table), 19_900)
    assert high.count() == 100 and _scanned(high) < 5_000
    one = explore.filtered(explore.stories(table), authors=["user 31 of some length"])
    assert [r.id for r in one.collect()] == [1] and _scanned(one) < 10_000
    assert _scanned(explore.filtered(explore.stories(table), authors=["user 31 of some length", "user x"])) < 10_000


def test_checks_read_each_model_once(spark, staged):
    stories, articles = staged
    frames = {"stg_stories": stories, "stg_articles": articles, "author_stats": marts.author_stats(stories)}
    checks = [c for c in quality.CHECKS if c.model in frames]
    plan = _plan(quality.run_checks(frames, checks))
    assert plan.count("FileScan parquet") == 3
