"""Landed feed data: one folder per feed and day, good and bad records side by side.

    <landing>/<feed>/ingested_date=<YYYY-MM-DD>/status=good   JSON Lines, one parsed record each
    <landing>/<feed>/ingested_date=<YYYY-MM-DD>/status=bad    JSON Lines, {"raw": <record as received>}
    <landing>/<feed>/ingested_date=<YYYY-MM-DD>/status=empty  a file that marks a day without good records

Good and bad records come out of one pass over the input, so none is parsed twice.
"""

from __future__ import annotations

import re
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmart.operators.topn import top_n_per_group
from feedmart.schemas import FEED_CAP, PARSED
from feedmart.sources import files

_DAY_IN_PATH = r".*(\d{4}-\d{2}-\d{2})(?:\.json)?(?:/|$)"
_EMPTY = "status=empty/part-0.txt"
_PARTITIONS = [T.StructField("ingested_date", T.DateType()), T.StructField("status", T.StringType())]


class Landed(NamedTuple):
    """What one landing run did: records kept, records set aside, and where they are."""

    rows_fetched: int
    errors: int
    path: str


# --- unparsed input ---------------------------------------------------------------------------


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Unparsed JSON Lines as a `value` column. Splittable, so the form for large feeds."""
    return spark.read.text(path).where(F.trim("value") != "")


def spread(records: DataFrame) -> DataFrame:
    """Unparsed records dealt evenly over tasks, before they are parsed.

    Parsing costs far more than reading. A few row groups of a compact table, or
    a few files of arrays, hold many records, which would be parsed by as many
    tasks while the other cores wait.
    """
    return records.hint("rebalance")


def read_arrays(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Unparsed files that hold one JSON array each, as a variant `value` per element and the file's day.

    A file is one task. An element that is no object stays a row of its own and
    does not spoil its neighbours; a file that is no JSON raises.
    """
    items = F.from_json("value", "array<variant>", {"mode": "FAILFAST"})
    return spark.read.text(path, wholetext=True).select(
        F.explode(items).alias("value"), day_in_path(F.col("_metadata.file_path")).alias("ingested_date")
    )


# Between two objects of an array that is written with an indent of two. Text in JSON has no line breaks, and what lies
# deeper is indented further, so this stands nowhere else.
_BETWEEN = "\n  },\n  {"


def read_large_arrays(spark: SparkSession, path: str) -> DataFrame:
    """`read_arrays` for arrays of objects with an indent of two, however large: such a file is cut between its objects and read by many tasks.

    Every piece must be an object by itself, and each file must have one
    beginning and one end. Files that are written in another way, or are broken,
    are left to `read_arrays`.
    """
    text = F.col("value")
    first, last = F.startswith(text, F.lit("[\n  {")), text.rlike(r"\n  \}\n\]\s*\z")
    inner = F.regexp_replace(F.regexp_replace(text, r"\A\[\n  \{", ""), r"\n  \}\n\]\s*\z", "")
    pieces = spark.read.option("lineSep", _BETWEEN).text(path).select(
        F.col("_metadata.file_path").alias("file"), first.alias("first"), last.alias("last"),
        F.from_json(F.concat(F.lit("[{"), inner, F.lit("}]")), "array<variant>").alias("values"),
    )
    one = F.coalesce(F.size("values") == 1, F.lit(False))  # two objects side by side are no piece
    whole = pieces.groupBy("file").agg(
        (F.count_if(~one) == 0).alias("whole"), F.count_if("first").alias("firsts"), F.count_if("last").alias("lasts")
    ).withColumn("whole", F.col("whole") & (F.col("firsts") == 1) & (F.col("lasts") == 1))
    others = [row.file for row in whole.where(~F.col("whole")).select("file").collect()]  # file names only
    found = pieces.where(~F.col("file").isin(others)) if others else pieces
    rows = found.select(F.col("values")[0].alias("value"), day_in_path(F.col("file")).alias("ingested_date"))
    return rows.unionByName(read_arrays(spark, others)) if others else rows


def write_arrays(records: DataFrame, path: str, per_file: int = 1000, indent: bool = False) -> None:
    """Unparsed records (ingested_date, value) as files of one JSON array each, of at most about `per_file` records.

    The files of a day are in a folder `<path>/<YYYY-MM-DD>.json`; records are
    dealt by hash, so no day meets in one task.
    """
    sizes = records.groupBy("ingested_date").agg(F.count("*").alias("n"))
    pieces = F.greatest(F.ceil(F.col("n") / per_file), F.lit(1))
    part = F.pmod(F.xxhash64("value"), pieces)
    if indent:
        records = spread(records).withColumn("value", _indented(F.col("value")))
    arrays = records.join(sizes, "ingested_date").groupBy("ingested_date", part.alias("piece")).agg(F.collect_list("value").alias("values"))
    lines = arrays.select(
        F.concat(F.col("ingested_date").cast("string"), F.lit(".json")).alias("day"), "piece",
        F.concat(F.lit("[\n" if indent else "["), F.array_join("values", ",\n" if indent else ","), F.lit("\n]" if indent else "]")).alias("value"),
    )
    lines.write.partitionBy("day", "piece").text(path)


def _indented(record: Column) -> Column:
    """A flat JSON object with one line per key, two deep. The members are printed by one call for the whole record."""
    pairs = F.from_json(record, "map<string,variant>")
    text = F.when(F.size(pairs) == 0, "{\n}").otherwise(F.to_json(pairs, {"pretty": "true"}))
    return F.concat(F.lit("  "), F.replace(text, F.lit("\n"), F.lit("\n  ")))


def read_parsed_arrays(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Files named `<prefix><YYYY-MM-DD>.json` that hold one JSON array of parsed records each."""
    files = spark.read.schema(PARSED[feed]).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return files.select(*PARSED[feed].names, day_in_path(F.col("_metadata.file_path")).alias("ingested_date"))


def day_of(path: str) -> str:
    """The day that one file or folder is named after."""
    found = re.search(_DAY_IN_PATH, path)
    if not found:
        raise ValueError(f"no day in the name of {path}")
    return found.group(1)


def latest_file(spark: SparkSession, pattern: str) -> str:
    """The newest of the files named after a day that match a pattern such as `/in/stories_*.json`."""
    files = spark.read.format("binaryFile").load(pattern).select("path", day_in_path(F.col("path")).alias("day"))
    newest = files.where(F.col("day").isNotNull()).orderBy(F.desc("day"), F.desc("path")).first()
    if newest is None:
        raise FileNotFoundError(f"no file named after a day matches {pattern}")
    return newest.path


def day_in_path(path: Column) -> Column:
    """The day a landed file is named after: a file `…YYYY-MM-DD.json` or a folder ending in the day."""
    return F.to_date(F.nullif(F.regexp_extract(path, _DAY_IN_PATH, 1), F.lit("")))


# --- capping a feed ---------------------------------------------------------------------------


def listing_rows(listings: DataFrame, ids: str = "ids", n: int = FEED_CAP) -> DataFrame:
    """Landed listings, one array of ids per row, as rows of position and id, at most `n` per listing."""
    others = [name for name in listings.columns if name != ids]
    return listings.select(*others, F.posexplode(F.slice(ids, 1, n)).alias("pos", "id"))


def cap_feed(
    records: DataFrame, listing: DataFrame, order: list[Column], n: int = FEED_CAP, broadcast_ids: int = 2_000_000
) -> DataFrame:
    """The records of the first `n` ids that each day's listing names.

    `listing` has ingested_date, id and whatever `order` sorts by; `order` must
    not leave ties. The ids taken are at most `n` per listed day. They are
    counted, and broadcast up to `broadcast_ids`, so that the feed itself is not
    shuffled; beyond that the join is by shuffle.
    """
    first = top_n_per_group(listing, ["ingested_date"], order, n, spread=["id"], rank="_pos").select("ingested_date", "id")
    small = first.count() <= broadcast_ids
    return records.join(F.broadcast(first) if small else first, ["ingested_date", "id"], "left_semi")


# --- landing ----------------------------------------------------------------------------------


def land_day(parsed: DataFrame, landing: str, feed: str, day: str) -> Landed:
    """Write one day of parsed records (with `raw` and `ok`), replacing what was landed for that day.

    The counts are taken while writing, in the job's last stage, where a task
    that is run again counts once.
    """
    spark = parsed.sparkSession
    path = f"{landing}/{feed}/ingested_date={day}"
    seen = Observation()
    counted = parsed.observe(
        seen,
        F.count_if(F.col("ok")).alias("rows_fetched"),
        F.count_if(~F.col("ok")).alias("errors"),
    )
    _write(_lines(counted, feed), path, "status")
    landed = Landed(seen.get["rows_fetched"], seen.get["errors"], path)
    if landed.rows_fetched == 0:
        files.create(spark, f"{path}/{_EMPTY}", "no records\n")
    return landed


def land_days(parsed: DataFrame, landing: str, feed: str, clustered: bool = False) -> str:
    """Write many days at once, by the `ingested_date` column, replacing those days and no others.

    Rows are first gathered by day, in pieces of bounded size, so that a day is
    not scattered over as many files as there are tasks. Input that already
    comes in day order is `clustered` and skips that shuffle. All days are
    written beside the landing and then moved, each replacing its folder whole,
    so that neither good nor bad records of the day before stay.
    """
    spark = parsed.sparkSession
    lines = _lines(parsed, feed, "ingested_date")
    if not clustered:
        lines = lines.hint("rebalance", "ingested_date")
    path, beside = f"{landing}/{feed}", f"{landing}/_{feed}-{uuid.uuid4().hex}"
    _write(lines, beside, "ingested_date", "status")
    good = {day_of(p) for p in files.matching(spark, f"{beside}/ingested_date=*/status=good")}
    for folder in files.matching(spark, f"{beside}/ingested_date=*"):  # at most one per calendar day
        day = day_of(folder)
        if day not in good:
            files.create(spark, f"{folder}/{_EMPTY}", "no records\n")
        files.replace(spark, folder, f"{path}/ingested_date={day}")
    files.remove(spark, beside)
    return path


def read_landing(spark: SparkSession, landing: str, feed: str, day: str | None = None) -> DataFrame:
    """Landed good records with their day; keys absent from a record are NULL, malformed ones raise."""
    root = f"{landing}/{feed}"
    schema = T.StructType([*PARSED[feed].fields, *_PARTITIONS])
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("basePath", root)
    rows = reader.json(f"{root}/ingested_date={day}" if day else root)
    return rows.where(F.col("status") == "good").drop("status")


def read_quarantine(spark: SparkSession, landing: str, feed: str, day: str | None = None) -> DataFrame:
    """Landed bad records as received, with their day."""
    root = f"{landing}/{feed}"
    schema = T.StructType([T.StructField("raw", T.StringType()), *_PARTITIONS])
    rows = spark.read.schema(schema).option("basePath", root).json(f"{root}/ingested_date={day}" if day else root)
    return rows.where(F.col("status") == "bad").drop("status")


def landed_days(spark: SparkSession, landing: str, feed: str) -> dict[str, bool]:
    """The landed days and whether they have good records, from the names of the day folders alone."""
    days = f"{landing}/{feed}/ingested_date=*"
    good = {day_of(path) for path in files.matching(spark, f"{days}/status=good")}
    return {day: day in good for day in map(day_of, files.matching(spark, days))}


def latest_day(spark: SparkSession, landing: str, feed: str) -> str:
    """The newest landed day; an error if there is none."""
    days = landed_days(spark, landing, feed)
    if not days:
        raise FileNotFoundError(f"nothing landed in {landing}/{feed}")
    return max(days)


def _lines(parsed: DataFrame, feed: str, *keep: str) -> DataFrame:
    record = F.to_json(F.struct(*PARSED[feed].names), {"ignoreNullFields": "false"})
    received = F.to_json(F.struct("raw"), {"ignoreNullFields": "false"})
    return parsed.select(
        *keep,
        F.when(F.col("ok"), "good").otherwise("bad").alias("status"),
        F.when(F.col("ok"), record).otherwise(received).alias("value"),
    )


def _write(lines: DataFrame, path: str, *partitions: str) -> None:
    lines.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partitions).text(path)
