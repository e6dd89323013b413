"""Session set-up and the shared working folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "feedmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job of this package expects.

    Shuffle parallelism is left to adaptive execution: start from many small
    partitions and let it merge them to the advisory size or split skewed ones.
    On a cluster, set `spark.sql.shuffle.partitions` to a few times the number
    of cores through `conf` or `spark-defaults.conf`.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return pin(builder.getOrCreate())


def pin(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results.

    Text timestamps are UTC, bad casts raise, and a JSON key given twice keeps
    its last value.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables that one query writes and reads again.

    It lies in the folder that the cluster names in `spark.checkpoint.dir`, or
    in the warehouse where that is unset. A warehouse on the driver's own disk
    is taken in local mode only: on a cluster the executors would not see it.
    Who runs the queries empties the folder when their results have been read.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        local = re.match(r"local(\[|$)", spark.sparkContext.master)
        if not local and re.match(r"/|file:|(?![a-zA-Z0-9+.-]+:)", shared):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors reach; {shared} is on the driver's machine")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
