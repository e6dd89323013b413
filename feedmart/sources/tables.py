"""Raw and model tables in a warehouse folder: Parquet, most of them in parts by ingested_date, replaced without a gap."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmart.schemas import MODELS, PARTIALS, RAW, RUN_LOG
from feedmart.sources import versions
from feedmart.sources.landing import Landed, day_of, landed_days, read_landing, read_parsed_arrays
from feedmart.sources.versions import Part

DAY = "ingested_date"


# --- raw tables -------------------------------------------------------------------------------


def raw_path(warehouse: str, feed: str) -> str:
    return f"{warehouse}/raw_{feed}"


def to_raw(parsed: DataFrame, feed: str) -> DataFrame:
    """Parsed records in the raw table's columns and types; a number that does not fit raises."""
    return parsed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW[feed].fields])


def read_raw(spark: SparkSession, warehouse: str, feed: str) -> DataFrame:
    return versions.read(spark, raw_path(warehouse, feed), RAW[feed])


def load_day(spark: SparkSession, landing: str, warehouse: str, feed: str, day: str) -> int:
    """Load one landed day into the raw table, replacing that day; returns the day's row count."""
    rows = read_landing(spark, landing, feed, day)
    replace_day(to_raw(rows, feed), raw_path(warehouse, feed), day)
    return day_count(read_raw(spark, warehouse, feed), day).first().row_count


def load_file(spark: SparkSession, path: str, warehouse: str, feed: str) -> int:
    """Load a file that holds one JSON array of a day's parsed records, replacing the day it is named after."""
    day = day_of(path)
    replace_day(to_raw(read_parsed_arrays(spark, path, feed), feed), raw_path(warehouse, feed), day)
    return day_count(read_raw(spark, warehouse, feed), day).first().row_count


def load_frame(parsed: DataFrame, warehouse: str, feed: str, without: tuple[str, ...] = ()) -> None:
    """Load parsed records of any days, replacing the days that have records among them, and emptying the days `without`."""
    spark, path = parsed.sparkSession, raw_path(warehouse, feed)
    version, days = versions.write(to_raw(parsed, feed), path, DAY)
    put = {day: Part(version) for day in days}
    versions.switch(spark, path, {part_of(day): Part(version, False) for day in without} | put)


def load_days(spark: SparkSession, landing: str, warehouse: str, feed: str) -> None:
    """Load every landed day in one job, replacing those days and no others, all at once."""
    empty = tuple(day for day, has_records in landed_days(spark, landing, feed).items() if not has_records)
    load_frame(read_landing(spark, landing, feed), warehouse, feed, empty)


def part_of(day: str) -> str:
    return f"{DAY}={day}"


def replace_day(rows: DataFrame, path: str, day: str) -> None:
    """Make `rows` the whole content of one day of the table, also if there are none. Until then readers have the old day."""
    version = versions.write_part(rows.drop(DAY), path, part_of(day))
    versions.switch(rows.sparkSession, path, {part_of(day): Part(version)})


def of_day(table: DataFrame, day: str) -> DataFrame:
    """The rows of one day, reading that partition only."""
    return table.where(F.col(DAY) == F.lit(day).cast("date"))


def day_count(table: DataFrame, day: str) -> DataFrame:
    """One row: how many rows the table has for a day."""
    return of_day(table, day).agg(F.count("*").alias("row_count"))


# --- run log ----------------------------------------------------------------------------------

_LOG = T.StructType([*RUN_LOG.fields, T.StructField("run_key", T.StringType()), T.StructField("part", T.StringType())])
_FOLDED = "part=folded"
RUNS_APART = 16  # logged runs that have a file of their own before they are folded into one


def append_run(spark: SparkSession, warehouse: str, feed: str, landed: Landed, run_key: str | None = None) -> None:
    """Add one row about a landing run to the log; a run that is repeated under its key replaces its row."""
    key = hashlib.sha256(run_key.encode()).hexdigest() if run_key else uuid.uuid4().hex
    row = spark.range(1).select(
        F.current_timestamp().alias("run_at"),
        F.lit(feed).alias("feed"),
        F.lit(landed.rows_fetched).cast("bigint").alias("rows_fetched"),
        F.lit(landed.errors).cast("bigint").alias("errors"),
        F.lit(landed.path).alias("path"),
        F.lit(key).alias("run_key"),
    )
    log, part = f"{warehouse}/run_log", f"part={key}"
    versions.switch(spark, log, {part: Part(versions.write_part(row.coalesce(1), log, part))})
    known = versions.current(spark, log)
    apart = {name: of for name, of in known.items() if name != _FOLDED}
    if len(apart) > RUNS_APART:
        folded = versions.write_part(_runs(spark, warehouse).drop("part").coalesce(1), log, _FOLDED)
        versions.switch(spark, log, {_FOLDED: Part(folded)}, drop=apart)


def read_run_log(spark: SparkSession, warehouse: str) -> DataFrame:
    return _runs(spark, warehouse).select(*RUN_LOG.names)


def _runs(spark: SparkSession, warehouse: str) -> DataFrame:
    """All rows; one that was folded and then logged again under its key counts no more."""
    log = f"{warehouse}/run_log"
    rows = versions.read(spark, log, _LOG)
    again = [name.removeprefix("part=") for name in versions.current(spark, log) if name != _FOLDED]  # few: see RUNS_APART
    return rows.where((F.col("part") != _FOLDED.removeprefix("part=")) | ~F.col("run_key").isin(again))


# --- model tables -----------------------------------------------------------------------------


def layout(name: str) -> T.StructType:
    return {**MODELS, **PARTIALS}[name]


# The column by which exploration asks for a model's rows, which are therefore sorted by it within each file, falling.
SCORES = {"stg_stories": "score", "top_stories": "score", "stg_articles": "positive_reactions_count"}


def write_version(df: DataFrame, warehouse: str, name: str) -> tuple[str, set[str]]:
    """Write a version of a model, or of some of its days, such that thresholds and authors skip row groups."""
    order = [F.desc(SCORES[name])] if name in SCORES else []
    return versions.write(df, f"{warehouse}/{name}", DAY if DAY in df.columns else None, order, ["author"] if order else [])


def write_model(df: DataFrame, warehouse: str, name: str, source: str = "") -> None:
    """Rebuild a model's table. Models that have an ingestion day are in parts by it."""
    path = f"{warehouse}/{name}"
    version, parts = write_version(df, warehouse, name)
    versions.switch(df.sparkSession, path, {part: Part(version, True, source) for part in parts}, whole=True)


def read_model(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """A model's table, or one that models are summed from, in the layout's column order."""
    return versions.read(spark, f"{warehouse}/{name}", layout(name))
