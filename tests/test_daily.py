"""The daily job end to end on landed days."""

import json
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from feedmart.operators.quality import QualityError
from feedmart.plans import daily
from feedmart.schemas import MODELS, PARTIALS
from feedmart.sources import landing as land
from feedmart.sources import tables, versions

D1, D2, D3 = "2024-03-01", "2024-03-02", "2024-03-03"


def _story(i, **more):
    return {"id": i, "title": f"t{i}", "score": i, "by": f"u{i % 3}", "time": 1_709_251_200 + i, **more}


def _article(i, **more):
    return {"id": i, "title": f"t{i}", "user": {"username": f"w{i % 2}"}, "tag_list": ["x", f"y{i}"],
            "published_at": "2024-03-01T08:00:00Z", "positive_reactions_count": i, **more}


@pytest.fixture
def feeds(spark, records, tmp_path):
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")

    def ingest(feed, day, *values):
        return daily.ingest_day(spark, records(*values), landing, warehouse, feed, day)

    return landing, warehouse, ingest


def _tables(spark, warehouse):
    return {name: sorted(map(repr, tables.read_model(spark, warehouse, name).collect())) for name in MODELS}


def test_daily_run(spark, feeds):
    landing, warehouse, ingest = feeds
    assert ingest("stories", D1, *[_story(i) for i in range(5)], "null").errors == 1
    ingest("articles", D1, *[_article(i) for i in range(4)], {"id": None})
    assert daily.run_daily(spark, landing, warehouse) == {"stories": 5, "articles": 4}
    top = tables.read_model(spark, warehouse, "top_stories").orderBy("rank").collect()
    assert [r.id for r in top] == [4, 3, 2, 1, 0]
    stats = {r.author: r.most_used_tags for r in tables.read_model(spark, warehouse, "article_author_stats").collect()}
    assert stats == {"w0": "x, y0, y2", "w1": "x, y1, y3"}
    log = tables.read_run_log(spark, warehouse).collect()
    assert sorted((r.feed, r.rows_fetched, r.errors) for r in log) == [("articles", 4, 1), ("stories", 5, 1)]


def test_newest_day_of_each_feed_is_loaded(spark, feeds):
    landing, warehouse, ingest = feeds
    ingest("stories", D1, _story(1))
    ingest("stories", D2, _story(2), _story(3))
    ingest("articles", D1, _article(1))
    assert daily.run_daily(spark, landing, warehouse) == {"stories": 2, "articles": 1}
    assert {r.ingested_date for r in tables.read_raw(spark, warehouse, "stories").collect()} == {date(2024, 3, 2)}


def test_incremental_equals_full(spark, feeds, tmp_path):
    landing, warehouse, ingest = feeds
    ingest("stories", D1, *[_story(i) for i in range(6)])
    ingest("articles", D1, *[_article(i) for i in range(6)])
    daily.run_daily(spark, landing, warehouse, D1)
    ingest("stories", D2, *[_story(i) for i in range(4, 9)])
    ingest("articles", D2, *[_article(i, tag_list="z") for i in range(3)])
    daily.run_daily(spark, landing, warehouse, D2, incremental=True)
    step_by_step = _tables(spark, warehouse)
    daily.build_models(spark, warehouse)
    assert _tables(spark, warehouse) == step_by_step
    # A day landed again without records leaves no trace in any model.
    ingest("stories", D1)
    daily.run_daily(spark, landing, warehouse, D1, incremental=True)
    again = _tables(spark, warehouse)
    daily.build_models(spark, warehouse)
    assert _tables(spark, warehouse) == again
    assert {r.ingested_date for r in tables.read_model(spark, warehouse, "top_stories").collect()} == {date(2024, 3, 2)}


def test_every_changed_day_is_rebuilt(spark, feeds):
    """Days loaded in bulk since the last run are as stale as the day that the run loads."""
    landing, warehouse, ingest = feeds
    ingest("stories", D1, _story(1, by="ann"), _story(2, by="ann"))
    ingest("articles", D1, _article(1))
    daily.run_daily(spark, landing, warehouse)
    ingest("stories", D2, _story(3, by="ann"))
    ingest("stories", D3, _story(4, by="ben"))
    for feed in ("stories", "articles"):
        tables.load_days(spark, landing, warehouse, feed)
    daily.run_daily(spark, landing, warehouse)
    assert tables.read_model(spark, warehouse, "stg_stories").count() == 4
    stats = tables.read_model(spark, warehouse, "author_stats").collect()
    assert sorted((r.author, r.post_count) for r in stats) == [("ann", 3), ("ben", 1)]
    once = _tables(spark, warehouse)
    daily.build_models(spark, warehouse)
    assert _tables(spark, warehouse) == once


def test_untouched_days_are_neither_read_nor_written(spark, feeds, monkeypatch):
    landing, warehouse, ingest = feeds
    for day in (D1, D2, D3):
        ingest("stories", day, _story(int(day[-1])))
        ingest("articles", day, _article(1))
    for feed in ("stories", "articles"):
        tables.load_days(spark, landing, warehouse, feed)
    daily.build_models(spark, warehouse)
    states = lambda: {name: versions.current(spark, f"{warehouse}/{name}") for name in (*MODELS, *PARTIALS)}
    before = states()
    ingest("stories", D2, _story(9))
    read, parts = versions.read, []

    def seen(spark_, table, schema, only=None):
        parts.append((table.rsplit("/", 1)[1], None if only is None else sorted(only)))
        return read(spark_, table, schema, only)

    monkeypatch.setattr(versions, "read", seen)
    tables.load_day(spark, landing, warehouse, "stories", D2)
    parts.clear()
    daily.build_models(spark, warehouse, changed_only=True)
    assert sorted(parts, key=str) == sorted(
        [("raw_stories", [f"ingested_date={D2}"]), ("stg_stories", [f"ingested_date={D2}"]), ("stg_stories", [f"ingested_date={D2}"]),
         *[(name, [f"ingested_date={day}" for day in (D1, D2, D3)]) for name in ("author_days", "article_author_days", "article_tag_days")]], key=str)
    after = states()
    for name in before:
        changed = {part for part in before[name] if before[name][part] != after[name][part]}
        assert changed == ({""} if name == "author_stats" else {f"ingested_date={D2}"} if name in ("stg_stories", "top_stories", "author_days") else set())
    daily.build_models(spark, warehouse, changed_only=True)
    assert states() == after


def test_a_run_broken_between_tables_is_made_up_for(spark, feeds, monkeypatch):
    landing, warehouse, ingest = feeds
    ingest("stories", D1, _story(1))
    ingest("articles", D1, _article(1))
    daily.run_daily(spark, landing, warehouse, D1)
    ingest("stories", D1, _story(5, by="zoe"))
    monkeypatch.setattr(daily.marts, "author_days", lambda df: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        daily.run_daily(spark, landing, warehouse, D1)
    monkeypatch.undo()
    daily.build_models(spark, warehouse, changed_only=True)  # nothing was loaded anew
    assert [r.author for r in tables.read_model(spark, warehouse, "author_stats").collect()] == ["zoe"]


def test_closed_months_are_read_as_one_row_per_author(spark, feeds):
    landing, warehouse, ingest = feeds
    for day in ("2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02", D1):
        ingest("stories", day, *[_story(i) for i in range(6)])
        ingest("articles", day, *[_article(i, tag_list=["x", f"y{i}"]) for i in range(4)])
    for feed in ("stories", "articles"):
        tables.load_days(spark, landing, warehouse, feed)
    daily.build_models(spark, warehouse)
    months = tables.read_model(spark, warehouse, "author_months").collect()
    assert sorted((str(r.ingested_date), r.author, r.post_count) for r in months) == [
        (month, author, 4) for month in ("2024-01-01", "2024-02-01") for author in ("u0", "u1", "u2")
    ]
    rows, _ = daily._Builder(spark, warehouse, True).history("author_days")
    assert rows.count() == 3 * 3  # two closed months and one open day
    folders = {re.search(r"/(author_\w+)/.*ingested_date=([\d-]+)", f).groups() for f in rows.inputFiles()}
    assert folders == {("author_months", "2024-01-01"), ("author_months", "2024-02-01"), ("author_days", D1)}

    before = versions.current(spark, f"{warehouse}/author_months")
    ingest("stories", "2024-01-30", _story(1, by="late"))  # a day of a closed month
    tables.load_day(spark, landing, warehouse, "stories", "2024-01-30")
    daily.build_models(spark, warehouse, changed_only=True)
    after = versions.current(spark, f"{warehouse}/author_months")
    assert {m for m in before if before[m] != after[m]} == {"ingested_date=2024-01-01"}
    step_by_step = _tables(spark, warehouse)
    assert any("late" in row for row in step_by_step["author_stats"])
    daily.build_models(spark, warehouse)
    assert _tables(spark, warehouse) == step_by_step


def test_a_failed_check_fails_again_until_the_day_is_mended(spark, feeds):
    landing, warehouse, ingest = feeds
    ingest("stories", D1, _story(1), {"score": 5})
    ingest("articles", D1, _article(1))
    with pytest.raises(QualityError):
        daily.run_daily(spark, landing, warehouse, D1)
    ingest("stories", D2, _story(2))
    ingest("articles", D2, _article(2))
    with pytest.raises(QualityError):
        daily.run_daily(spark, landing, warehouse, D2)  # the first day has not passed yet
    ingest("stories", D1, _story(1))
    assert daily.run_daily(spark, landing, warehouse, D1) == {"stories": 1, "articles": 1}


def test_running_twice_changes_nothing(spark, feeds):
    landing, warehouse, ingest = feeds
    ingest("stories", D1, _story(1))
    ingest("articles", D1, _article(1))
    daily.run_daily(spark, landing, warehouse, D1)
    once = _tables(spark, warehouse)
    daily.run_daily(spark, landing, warehouse, D1)
    assert _tables(spark, warehouse) == once


def test_failing_check_raises_and_leaves_the_tables(spark, feeds):
    landing, warehouse, ingest = feeds
    ingest("stories", D1, _story(1), {"score": 5})
    ingest("articles", D1, _article(1))
    with pytest.raises(QualityError, match="stg_stories.id not_null: 1"):
        daily.run_daily(spark, landing, warehouse, D1)
    assert tables.read_model(spark, warehouse, "top_stories").count() == 2


def test_day_without_landing_is_an_error(spark, feeds):
    landing, warehouse, ingest = feeds
    ingest("stories", D1, _story(1))
    ingest("articles", D1, _article(1))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        daily.run_daily(spark, landing, warehouse, "2024-03-09")


def test_default_day_is_today_in_utc(spark, records, tmp_path):
    landed = daily.ingest_day(spark, records(_story(1)), str(tmp_path / "l"), str(tmp_path / "w"), "stories")
    assert landed.path.endswith(f"ingested_date={daily.utc_today()}")
    assert json.loads(land.read_landing(spark, str(tmp_path / "l"), "stories").toJSON().first())["id"] == 1


def test_a_day_in_one_task_is_parsed_by_many(spark, tmp_path):
    long = F.concat(*[F.sha2(F.concat("id", F.lit(i)).cast("string"), 256) for i in range(5)])
    one = spark.range(20_000).coalesce(1).select(F.to_json(F.struct("id", long.alias("title"))).alias("value"))
    landed = daily.ingest_day(spark, one, str(tmp_path / "landing"), str(tmp_path / "warehouse"), "stories", D1)
    assert landed[:2] == (20_000, 0)
    assert len(list((tmp_path / "landing" / "stories" / f"ingested_date={D1}" / "status=good").glob("part-*"))) > 2
    assert land.read_landing(spark, str(tmp_path / "landing"), "stories", D1).select("id").distinct().count() == 20_000
