import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from feedmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def records(spark):
    """A frame of unparsed records from Python values; text is taken as it is."""

    def make(*values):
        texts = [v if isinstance(v, str) or v is None else json.dumps(v) for v in values]
        return spark.createDataFrame([(t,) for t in texts], "value string")

    return make


@pytest.fixture
def stories(spark):
    """A raw stories frame from (id, title, score, by, descendants, time, day) rows."""

    def make(*rows):
        ddl = "id bigint, title string, score int, by string, descendants int, time bigint, day string"
        frame = spark.createDataFrame(list(rows), ddl)
        return frame.selectExpr(
            "id", "title", "score", "by", "descendants", "time", "cast(null as string) url", "cast(day as date) ingested_date"
        )

    return make


@pytest.fixture
def articles(spark):
    """A raw articles frame from (id, author, positive, public, minutes, tags, day) rows."""

    def make(*rows):
        ddl = "id bigint, author string, pos int, pub int, minutes int, tags string, day string"
        frame = spark.createDataFrame(list(rows), ddl)
        return frame.selectExpr(
            "id", "concat('t', id) title", "pos positive_reactions_count", "pub public_reactions_count",
            "1 comments_count", "author", "'2024-03-01T10:00:00Z' published_at", "tags tag_list",
            "cast(null as string) url", "minutes reading_time_minutes", "cast(day as date) ingested_date",
        )

    return make
