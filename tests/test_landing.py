"""Landing folders, unparsed input, capping, day discovery."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from feedmart.functions.parse import parse_articles, parse_stories
from feedmart.schemas import PARSED
from feedmart.sources import landing as land


def _lines(folder):
    return sorted(line for file in folder.glob("part-*") for line in file.read_text("utf-8").splitlines())


def test_land_day_keeps_good_and_bad_apart(records, tmp_path):
    parsed = parse_stories(records({"id": 1, "title": "Größe 本", "kids": [2]}, {"id": None}, "null"))
    landed = land.land_day(parsed, str(tmp_path), "stories", "2024-03-01")
    day = tmp_path / "stories" / "ingested_date=2024-03-01"
    assert landed == (1, 2, str(day))
    good = _lines(day / "status=good")
    assert "Größe 本" in good[0]
    assert json.loads(good[0]) == {
        "id": 1, "title": "Größe 本", "score": 0, "by": None, "descendants": 0, "time": 0, "url": None,
    }
    assert sorted(json.loads(line)["raw"] for line in _lines(day / "status=bad")) == ["null", '{"id": null}']


def test_landing_reads_back(spark, records, tmp_path):
    parsed = parse_articles(records({"id": 1, "user": {"username": "ann"}, "tag_list": ["a", "b"]}, {"id": 2}, "x"))
    land.land_day(parsed, str(tmp_path), "articles", "2024-03-01")
    land.land_day(parse_articles(records({"id": 3})), str(tmp_path), "articles", "2024-03-02")
    rows = land.read_landing(spark, str(tmp_path), "articles")
    assert rows.columns == [*PARSED["articles"].names, "ingested_date"]
    got = {(r.id, r.author, r.tag_list, r.ingested_date) for r in rows.collect()}
    assert got == {
        (1, "ann", "a,b", date(2024, 3, 1)), (2, None, None, date(2024, 3, 1)), (3, None, None, date(2024, 3, 2)),
    }
    one = land.read_landing(spark, str(tmp_path), "articles", "2024-03-02")
    assert [(r.id, r.ingested_date) for r in one.collect()] == [(3, date(2024, 3, 2))]
    bad = land.read_quarantine(spark, str(tmp_path), "articles")
    assert [(r.raw, r.ingested_date) for r in bad.collect()] == [("x", date(2024, 3, 1))]


def test_landing_a_day_again_replaces_it(spark, records, tmp_path):
    root = str(tmp_path)
    land.land_day(parse_stories(records({"id": 1}, {"id": 2}, "null")), root, "stories", "2024-03-01")
    again = land.land_day(parse_stories(records({"id": 3})), root, "stories", "2024-03-01")
    assert (again.rows_fetched, again.errors) == (1, 0)
    assert [r.id for r in land.read_landing(spark, root, "stories").collect()] == [3]
    assert land.read_quarantine(spark, root, "stories", "2024-03-01").count() == 0


def test_day_without_records_is_found_and_empty(spark, records, tmp_path):
    root = str(tmp_path)
    land.land_day(parse_stories(records({"id": 1})), root, "stories", "2024-03-01")
    assert land.land_day(parse_stories(records()), root, "stories", "2024-03-02")[:2] == (0, 0)
    assert land.land_day(parse_stories(records("null")), root, "stories", "2024-02-01")[:2] == (0, 1)
    days = land.landed_days(spark, root, "stories")
    assert days == {"2024-02-01": False, "2024-03-01": True, "2024-03-02": False}
    assert land.latest_day(spark, root, "stories") == "2024-03-02"
    assert land.read_landing(spark, root, "stories", "2024-03-02").count() == 0
    assert land.read_landing(spark, root, "stories").count() == 1


def test_latest_day_needs_a_landing(spark, tmp_path):
    (tmp_path / "stories").mkdir()
    with pytest.raises(FileNotFoundError):
        land.latest_day(spark, str(tmp_path), "stories")


@pytest.mark.parametrize("clustered", [True, False])
def test_land_days_equals_landing_each_day(spark, records, tmp_path, clustered):
    many = spark.createDataFrame(
        [(date(2024, 3, 1 + i % 3), json.dumps({"id": i}) if i % 5 else "null") for i in range(30)],
        "ingested_date date, value string",
    )
    land.land_days(parse_stories(many, keep=["ingested_date"]), str(tmp_path), "stories", clustered)
    rows = land.read_landing(spark, str(tmp_path), "stories")
    assert {(r.id, r.ingested_date.day) for r in rows.collect()} == {(i, 1 + i % 3) for i in range(30) if i % 5}
    assert land.read_quarantine(spark, str(tmp_path), "stories").count() == 6


def test_corrupt_landing_raises(spark, tmp_path):
    day = tmp_path / "stories" / "ingested_date=2024-03-01" / "status=good"
    day.mkdir(parents=True)
    (day / "part-0.txt").write_text('{"id": 1}\n{"id": \n')
    with pytest.raises(Exception, match="[Mm]alformed"):
        land.read_landing(spark, str(tmp_path), "stories").collect()


def test_absent_keys_load_as_null(spark, tmp_path):
    day = tmp_path / "stories" / "ingested_date=2024-03-01" / "status=good"
    day.mkdir(parents=True)
    (day / "part-0.txt").write_text('{"id": 1}\n')
    row = land.read_landing(spark, str(tmp_path), "stories").first()
    assert (row.id, row.title, row.score, row.time) == (1, None, None, None)


def test_unparsed_lines(spark, tmp_path):
    (tmp_path / "feed.jsonl").write_text('{"id": 1}\n\n[]\n  \nnull\n{"id": 2}\n')
    parsed = parse_stories(land.read_lines(spark, str(tmp_path / "feed.jsonl")))
    assert sorted((r.id, r.ok) for r in parsed.where("id is not null").collect()) == [(1, True), (2, True)]
    assert parsed.where("not ok").count() == 2


def test_unparsed_array_files_keep_every_element(spark, tmp_path):
    (tmp_path / "feed_2024-03-01.json").write_text('[{"id": 1, "score": "3"}, 7, null, {"id": 2}]')
    (tmp_path / "feed_2024-03-02.json").write_text("[\n {\"id\": 3}\n]")
    (tmp_path / "feed_2024-03-03.json").write_text("[]")
    frame = land.read_arrays(spark, str(tmp_path / "feed_*.json"))
    rows = parse_stories(frame, keep=["ingested_date"]).collect()
    assert sorted((r.id, r.score, r.ingested_date.day) for r in rows if r.ok) == [(1, 3, 1), (2, 0, 1), (3, 0, 2)]
    assert sum(not r.ok for r in rows) == 2


def test_broken_array_file_raises(spark, tmp_path):
    (tmp_path / "feed_2024-03-01.json").write_text('[{"id": 1}, {"id"')
    with pytest.raises(Exception, match="[Mm]alformed"):
        land.read_arrays(spark, str(tmp_path)).collect()


def test_parsed_array_files(spark, tmp_path):
    (tmp_path / "feed_2024-03-01.json").write_text(
        json.dumps([{"id": 1, "title": "ü", "score": 2}, {"id": 2}], indent=2, ensure_ascii=False), "utf-8"
    )
    rows = land.read_parsed_arrays(spark, str(tmp_path / "feed_2024-03-01.json"), "stories").collect()
    assert sorted((r.id, r.title, r.score, r.ingested_date) for r in rows) == [
        (1, "ü", 2, date(2024, 3, 1)), (2, None, None, date(2024, 3, 1)),
    ]


@pytest.mark.parametrize("path, day", [
    ("/x/feed_2024-01-15.json", "2024-01-15"),
    ("/x/ingested_date=2024-01-15", "2024-01-15"),
    ("/2023-01-01/feed_2024-01-15.json", "2024-01-15"),
    ("/2023-01-01.json/feed_2024-01-15.json/part-0.txt", "2024-01-15"),
    ("/x/feed.json", None),
])
def test_day_in_path(spark, path, day):
    got = spark.range(1).select(land.day_in_path(F.lit(path)).cast("string")).first()[0]
    assert got == day
    if day:
        assert land.day_of(path) == day


def test_cap_from_a_landed_listing(spark):
    listings = spark.createDataFrame([("2024-03-01", [9, 8, 7, 6]), ("2024-03-02", [1])], "day string, ids array<bigint>")
    rows = land.listing_rows(listings, n=3).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("2024-03-01", 0, 9), ("2024-03-01", 1, 8), ("2024-03-01", 2, 7), ("2024-03-02", 0, 1),
    ]


def test_cap_feed_takes_the_first_of_each_day(stories):
    rows = [(i, f"t{i}", 1, "a", 0, 0, f"2024-03-0{1 + i % 2}") for i in range(20)]
    feed = stories(*rows)
    listing = feed.select("ingested_date", "id", (F.lit(100) - F.col("id")).alias("pos"))
    capped = land.cap_feed(feed, listing, [F.asc("pos")], 3)
    assert set(capped.columns) == set(feed.columns)
    assert {r.id for r in capped.collect()} == {19, 18, 17, 16, 15, 14}


def test_land_days_replaces_only_the_days_it_is_given(spark, records, tmp_path):
    root = str(tmp_path)

    def landed(*rows):
        many = spark.createDataFrame([(date(2024, 3, d), v) for d, v in rows], "ingested_date date, value string")
        land.land_days(parse_stories(many, keep=["ingested_date"]), root, "stories")

    landed((1, '{"id": 1}'), (1, "null"), (2, '{"id": 2}'), (2, "null"), (3, "null"))
    landed((2, '{"id": 3}'), (4, '{"id": 4}'))
    rows = land.read_landing(spark, root, "stories").collect()
    assert {(r.id, r.ingested_date.day) for r in rows} == {(1, 1), (3, 2), (4, 4)}
    assert sorted(r.ingested_date.day for r in land.read_quarantine(spark, root, "stories").collect()) == [1, 3]
    days = land.landed_days(spark, root, "stories")
    assert days == {"2024-03-01": True, "2024-03-02": True, "2024-03-03": False, "2024-03-04": True}
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_array_files_written_and_read(spark, tmp_path):
    rows = [(date(2024, 3, 1 + i % 2), json.dumps({"id": i})) for i in range(50)]
    land.write_arrays(spark.createDataFrame(rows, "ingested_date date, value string"), str(tmp_path / "a"), per_file=10)
    back = parse_stories(land.read_arrays(spark, str(tmp_path / "a")), keep=["ingested_date"])
    assert {(r.id, r.ingested_date.day) for r in back.collect()} == {(i, 1 + i % 2) for i in range(50)}
    assert len(list((tmp_path / "a").glob("day=2024-03-01.json/piece=*"))) > 1


def test_records_of_one_task_are_spread(spark):
    one = spark.range(20_000).coalesce(1).select(F.concat(*[F.sha2(F.concat("id", F.lit(i)).cast("string"), 256) for i in range(5)]).alias("value"))
    spread = land.spread(one)
    assert one.rdd.getNumPartitions() == 1 and spread.rdd.getNumPartitions() > 2
    assert sorted(r.value for r in spread.collect()) == sorted(r.value for r in one.collect())


def test_indented_arrays_are_printed_by_one_call_and_cut_when_read(spark, tmp_path):
    texts = [json.dumps({"id": i, "title": 'a\n  },\n  {"', "score": None, "tag": [1, {"x": "ü"}]}, ensure_ascii=False) for i in range(20)]
    rows = spark.createDataFrame([(date(2024, 3, 1), t) for t in [*texts, "{}", "null"]], "ingested_date date, value string")
    assert "lambda" not in rows.select(land._indented(F.col("value")))._jdf.queryExecution().executedPlan().toString()
    land.write_arrays(rows, str(tmp_path / "a"), per_file=1000, indent=True)
    (file,) = (tmp_path / "a").glob("day=*/piece=*/part-*")
    lines = file.read_text("utf-8").splitlines()
    assert lines[0] == "[" and lines[-1] == "]" and lines.count("  },") == 20 and '    "score" : null,' in lines
    assert sorted(map(json.dumps, json.loads(file.read_text("utf-8")))) == sorted(json.dumps(json.loads(t)) for t in [*texts, "{}"])
    values = [json.loads(r.v) for r in land.read_large_arrays(spark, str(tmp_path / "a")).select(F.to_json("value").alias("v")).collect()]
    assert sorted(map(json.dumps, values)) == sorted(json.dumps(json.loads(t), sort_keys=True) for t in [*texts, "{}"])
