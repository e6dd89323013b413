"""Raw tables: types, replacing days, counts, run log."""

import json
from datetime import date

import pytest
from pyspark.errors import PySparkException

from feedmart.functions.parse import parse_stories
from feedmart.schemas import RAW
from feedmart.sources import landing as land
from feedmart.sources import tables, versions

D1, D2 = "2024-03-01", "2024-03-02"


@pytest.fixture
def shop(spark, records, tmp_path):
    """Landing and warehouse folders, and a function that lands stories by id."""
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")

    def put(day, *ids, **fields):
        return land.land_day(parse_stories(records(*[{"id": i, **fields} for i in ids])), landing, "stories", day)

    return landing, warehouse, put


def _ids(spark, warehouse):
    return sorted((r.ingested_date.isoformat(), r.id) for r in tables.read_raw(spark, warehouse, "stories").collect())


def test_load_day_types_and_count(spark, shop):
    landing, warehouse, put = shop
    put(D1, 1, 2, title="x", score=5)
    assert tables.load_day(spark, landing, warehouse, "stories", D1) == 2
    raw = tables.read_raw(spark, warehouse, "stories")
    assert raw.schema == RAW["stories"]
    row = raw.where("id = 1").first()
    assert (row.title, row.score, row.descendants, row.ingested_date) == ("x", 5, 0, date(2024, 3, 1))


def test_loading_twice_equals_loading_once(spark, shop):
    landing, warehouse, put = shop
    put(D1, 1, 2)
    put(D2, 3)
    for day in (D1, D2, D1, D1):
        tables.load_day(spark, landing, warehouse, "stories", day)
    assert _ids(spark, warehouse) == [(D1, 1), (D1, 2), (D2, 3)]


def test_reloading_replaces_only_that_day(spark, shop):
    landing, warehouse, put = shop
    put(D1, 1, 2)
    put(D2, 3, 4)
    tables.load_days(spark, landing, warehouse, "stories")
    put(D1, 9)
    assert tables.load_day(spark, landing, warehouse, "stories", D1) == 1
    assert _ids(spark, warehouse) == [(D1, 9), (D2, 3), (D2, 4)]


def test_reloading_with_nothing_empties_the_day(spark, shop):
    landing, warehouse, put = shop
    put(D1, 1)
    put(D2, 2)
    tables.load_days(spark, landing, warehouse, "stories")
    put(D1)
    assert tables.load_day(spark, landing, warehouse, "stories", D1) == 0
    assert _ids(spark, warehouse) == [(D2, 2)]


def test_load_days_replaces_landed_days_and_keeps_others(spark, shop, tmp_path):
    landing, warehouse, put = shop
    put(D1, 1)
    put(D2, 2)
    put("2024-03-03", 3)
    tables.load_days(spark, landing, warehouse, "stories")
    later = str(tmp_path / "later")
    for day, ids in ((D1, [7]), (D2, [])):
        put_records = spark.createDataFrame([(f'{{"id": {i}}}',) for i in ids], "value string")
        land.land_day(parse_stories(put_records), later, "stories", day)
    tables.load_days(spark, later, warehouse, "stories")
    assert _ids(spark, warehouse) == [(D1, 7), ("2024-03-03", 3)]


def test_files_of_one_day_each(spark, tmp_path):
    warehouse, files = str(tmp_path / "w"), tmp_path / "in"
    files.mkdir()
    for day, records in ((D1, [{"id": 1, "title": "ä"}, {"id": 2, "score": 5}]), (D2, [{"id": 3}])):
        (files / f"feed_{day}.json").write_text(json.dumps(records, indent=2, ensure_ascii=False), "utf-8")
    newest = land.latest_file(spark, str(files / "feed_*.json"))
    assert newest.endswith(f"feed_{D2}.json")
    assert tables.load_file(spark, newest, warehouse, "stories") == 1
    assert tables.load_file(spark, str(files / f"feed_{D1}.json"), warehouse, "stories") == 2
    assert _ids(spark, warehouse) == [(D1, 1), (D1, 2), (D2, 3)]
    row = tables.read_raw(spark, warehouse, "stories").where("id = 1").first()
    assert (row.title, row.score) == ("ä", None)
    (files / f"feed_{D2}.json").write_text("[]")
    assert tables.load_file(spark, newest, warehouse, "stories") == 0
    assert _ids(spark, warehouse) == [(D1, 1), (D1, 2)]


def test_a_file_needs_a_day_in_its_name(spark, tmp_path):
    (tmp_path / "feed.json").write_text("[]")
    with pytest.raises(ValueError, match="no day"):
        tables.load_file(spark, str(tmp_path / "feed.json"), str(tmp_path / "w"), "stories")
    with pytest.raises(FileNotFoundError):
        land.latest_file(spark, str(tmp_path / "*.json"))


def test_numbers_too_large_for_the_table_fail_the_load(spark, shop):
    landing, warehouse, put = shop
    assert put(D1, 1, score=3_000_000_000).rows_fetched == 1
    with pytest.raises(PySparkException):
        tables.load_day(spark, landing, warehouse, "stories", D1)


def test_day_count_reads_one_partition(spark, shop):
    landing, warehouse, put = shop
    put(D1, 1, 2)
    put(D2, 3)
    tables.load_days(spark, landing, warehouse, "stories")
    raw = tables.read_raw(spark, warehouse, "stories")
    counted = tables.day_count(raw, D1)
    assert counted.first().row_count == 2
    assert tables.day_count(raw, "2030-01-01").first().row_count == 0
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingested_date" in plan


def test_run_log_appends(spark, shop):
    landing, warehouse, put = shop
    tables.append_run(spark, warehouse, "stories", put(D1, 1, 2))
    tables.append_run(spark, warehouse, "stories", put(D1, 1, score=None))
    log = tables.read_run_log(spark, warehouse).orderBy("run_at").collect()
    assert [(r.feed, r.rows_fetched, r.errors) for r in log] == [("stories", 2, 0), ("stories", 0, 1)]
    assert all(r.path.endswith(f"ingested_date={D1}") for r in log)


def test_a_load_broken_before_the_switch_leaves_the_old_day(spark, shop, monkeypatch):
    landing, warehouse, put = shop
    put(D1, 1, 2)
    put(D2, 3)
    tables.load_days(spark, landing, warehouse, "stories")
    put(D1, 9)
    switch = versions.switch

    def broken(*args, **more):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(versions, "switch", broken)
    for load in (lambda: tables.load_day(spark, landing, warehouse, "stories", D1), lambda: tables.load_days(spark, landing, warehouse, "stories")):
        with pytest.raises(RuntimeError):
            load()
        assert _ids(spark, warehouse) == [(D1, 1), (D1, 2), (D2, 3)]
    monkeypatch.setattr(versions, "switch", switch)
    assert tables.load_day(spark, landing, warehouse, "stories", D1) == 1
    assert _ids(spark, warehouse) == [(D1, 9), (D2, 3)]


def test_a_repeated_run_replaces_its_row(spark, shop):
    _, warehouse, put = shop
    landed = put(D1, 1, 2)
    for key in ("a", "b", "a"):
        tables.append_run(spark, warehouse, "stories", landed, key)
    tables.append_run(spark, warehouse, "stories", landed._replace(rows_fetched=7), "b")
    assert sorted(r.rows_fetched for r in tables.read_run_log(spark, warehouse).collect()) == [2, 7]


def test_many_runs_are_few_files(spark, shop, monkeypatch):
    _, warehouse, put = shop
    monkeypatch.setattr(tables, "RUNS_APART", 3)
    landed = put(D1, 1)
    for run in range(3 * tables.RUNS_APART):
        tables.append_run(spark, warehouse, "stories", landed._replace(rows_fetched=run), f"run {run}")
    tables.append_run(spark, warehouse, "stories", landed._replace(rows_fetched=1000), "run 0")  # long folded
    log = tables.read_run_log(spark, warehouse)
    assert sorted(r.rows_fetched for r in log.collect()) == [*range(1, 3 * tables.RUNS_APART), 1000]
    assert len(log.inputFiles()) <= tables.RUNS_APART + 1


@pytest.mark.parametrize("compressed", ["true", "false"])
def test_reloading_an_emptied_day_removes_its_rows(spark, records, tmp_path, compressed):
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("mapreduce.output.fileoutputformat.compress")
    conf.set("mapreduce.output.fileoutputformat.compress", compressed)
    try:
        landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "warehouse")
        for day in ("2024-03-01", "2024-03-02"):
            land.land_day(parse_stories(records({"id": 1}, {"id": 2})), landing, "stories", day)
        tables.load_days(spark, landing, warehouse, "stories")
        land.land_day(parse_stories(records("null")), landing, "stories", "2024-03-01")
        tables.load_days(spark, landing, warehouse, "stories")
        left = tables.read_raw(spark, warehouse, "stories").groupBy("ingested_date").count().collect()
        assert [(str(r.ingested_date), r["count"]) for r in left] == [("2024-03-02", 2)]
    finally:
        conf.set("mapreduce.output.fileoutputformat.compress", before or "false")
