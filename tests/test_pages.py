"""Pages by continuation keys, cells for any threshold, and large array files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from feedmart.operators import explore, pages
from feedmart.sources import landing as land

SF = "/root/testdata/sf0.001"


@pytest.fixture
def rows(spark):
    rng = random.Random(4)
    data = [(i, rng.randint(0, 30), f"a{rng.randint(0, 12)}", f"2024-01-0{1 + i % 4}") for i in range(700)]
    return spark.createDataFrame(data, "id long, score int, author string, day string").repartition(5)


@pytest.mark.parametrize("keys,order", [
    (pages.BY_SCORE, lambda r: (-r.score, r.id)), ((pages.Key("author"), pages.Key("id", True)), lambda r: (r.author, -r.id)),
])
def test_walking_all_pages_gives_the_whole_order(spark, rows, tmp_path, keys, order):
    pages.write_pages(rows, str(tmp_path / "p"), keys, per_range=100)
    wanted = [r.id for r in sorted(rows.collect(), key=order)]
    for size in (1000, 90):
        got, after, most = [], None, 0
        while True:
            frame = pages.page(spark, str(tmp_path / "p"), keys, size, after)
            most = max(most, len({f.split("_range=")[1].split("/")[0] for f in frame.inputFiles()}))
            found = frame.collect()
            if not found:
                break
            got += [r.id for r in found]
            after = [found[-1][key.column] for key in keys]
        assert got == wanted
        assert size > 700 or most <= 3  # of seven ranges


def test_a_page_reads_its_ranges_only(spark, rows, tmp_path):
    pages.write_pages(rows, str(tmp_path / "p"), pages.BY_SCORE, per_range=50)
    frame = pages.page(spark, str(tmp_path / "p"), pages.BY_SCORE, 20, (10, 0))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan
    assert len(frame.inputFiles()) <= 3  # of fourteen ranges
    assert pages.page(spark, str(tmp_path / "p"), pages.BY_SCORE, 20, (-1, 0)).collect() == []


def test_empty_pages(spark, rows, tmp_path):
    pages.write_pages(rows.where("false"), str(tmp_path / "p"), pages.BY_SCORE)
    assert pages.page(spark, str(tmp_path / "p"), pages.BY_SCORE, 5).collect() == []


def test_cells_answer_what_rows_answer(spark, rows):
    rows = rows.unionByName(spark.createDataFrame([(900, None, "b", "x"), (901, 30, None, "x"), (902, 30, None, "x")], rows.schema))
    cells = explore.cells(rows, "day")
    assert cells.count() < rows.count()
    for threshold in (None, 0, 12, 30, 99):
        direct, some = explore.filtered(rows, threshold), explore.filtered(cells, threshold)
        assert explore.summary_of_cells(some).collect() == explore.summary(direct).collect()
        assert explore.score_range(some).collect() == explore.score_range(direct).collect()
        assert explore.top_authors_of_cells(some).collect() == explore.top_authors(direct).collect()
    named = ["a1", "a5"]
    assert explore.summary_of_cells(explore.filtered(cells, 5, named)).collect() == explore.summary(explore.filtered(rows, 5, named)).collect()


def test_thresholds_join_nothing(spark):
    plan = queries()["explore_thresholds"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "score:int" in plan and "title" not in plan


def _texts(frame):
    return sorted((str(r.ingested_date), r.text) for r in frame.select("ingested_date", F.to_json("value").alias("text")).collect())


def test_one_large_array_is_read_by_many_tasks(spark, tmp_path):
    records = [{"id": i, "title": f'tricky "\\n  }},\n  {{" {i}', "kids": [{"a": [i]}, {}], "none": None} for i in range(3000)]
    (tmp_path / "stories_2024-03-01.json").write_text(json.dumps(records, indent=2))
    path = str(tmp_path / "*.json")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        frame = land.read_large_arrays(spark, path)
        assert frame.rdd.getNumPartitions() > 3
        assert _texts(frame) == _texts(land.read_arrays(spark, path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_other_arrays_are_read_as_before(spark, tmp_path):
    texts = {
        "2024-03-01": json.dumps([{"id": 1}, {"id": 2}], indent=2), "2024-03-02": json.dumps([{"id": 3}, 7, None]),
        "2024-03-03": json.dumps([{"id": 4}, 8, {"id": 5}], indent=2), "2024-03-04": json.dumps([{"id": 6}], indent=2) + "\n",
        "2024-03-05": json.dumps([{"id": 9}, {"id": 10}], indent=4), "2024-03-06": "[]", "2024-03-07": json.dumps([{}, {"id": 11}], indent=2),
    }
    for day, text in texts.items():
        (tmp_path / f"x_{day}.json").write_text(text)
    path = str(tmp_path / "*.json")
    assert _texts(land.read_large_arrays(spark, path)) == _texts(land.read_arrays(spark, path))
    (tmp_path / "x_2024-03-08.json").write_text('[\n  {\n    "id": 1\n  },\n  {\n    "id": \n  }\n]')
    with pytest.raises(Exception):
        land.read_large_arrays(spark, path).collect()
