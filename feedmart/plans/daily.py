"""The daily batch job: landed feeds to raw tables, models and checks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from feedmart.functions.parse import PARSERS
from feedmart.operators.quality import CHECKS, gate, run_checks
from feedmart.plans import marts, staging
from feedmart.schemas import FEEDS, MODELS, MONTHS, RAW
from feedmart.session import pin
from feedmart.sources import landing as land
from feedmart.sources import tables, versions

Model = Callable[[DataFrame], DataFrame]


def utc_today() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d")


def ingest_day(
    spark: SparkSession,
    records: DataFrame,
    landing: str,
    warehouse: str,
    feed: str,
    day: str | None = None,
    on_bad: str = "mark",
    run_key: str | None = None,
) -> land.Landed:
    """Parse and land one day of unparsed records (column `value`) and log the run.

    Bad records are set aside and counted, or with `on_bad="fail"` end the run.
    A run that is repeated under its `run_key` replaces its row of the log.
    """
    pin(spark)
    parsed = PARSERS[feed](land.spread(records), "value", on_bad=on_bad)
    landed = land.land_day(parsed, landing, feed, day or utc_today())
    tables.append_run(spark, warehouse, feed, landed, run_key)
    return landed


class _Builder:
    """Builds tables from tables, each only as far as what it was built from has changed.

    Every part of a table names the version of the part it was built from (see
    `versions`), so the tables themselves tell what is stale, also after days
    were loaded in bulk or a run broke off between two tables.
    """

    def __init__(self, spark: SparkSession, warehouse: str, changed_only: bool):
        self.spark, self.warehouse, self.changed_only = spark, warehouse, changed_only

    def path(self, name: str) -> str:
        return f"{self.warehouse}/{name}"

    def days(self, name: str, source: str, layout: StructType, model: Model, gather: bool = False) -> None:
        """Rebuild in one job all days whose day in `source` changed, and drop those that are gone; no other day is read."""
        of, mine = (versions.current(self.spark, self.path(table)) for table in (source, name))
        tokens = {day: part.version for day, part in of.items()}
        changed = [day for day, token in tokens.items() if not (self.changed_only and day in mine and mine[day].source == token)]
        self._parts(name, source, layout, model, tokens, changed, {day: [day] for day in changed}, gather)

    def months(self, name: str, model: Model) -> None:
        """Sum up the closed months of a table by day, those before its newest month, where any of their days changed."""
        closed, _ = self._closed(name)
        tokens = {month: _token(parts.values()) for month, parts in closed.items()}
        mine = versions.current(self.spark, self.path(MONTHS[name]))
        changed = [m for m, token in tokens.items() if not (self.changed_only and m in mine and mine[m].source == token)]
        self._parts(MONTHS[name], name, tables.layout(name), model, tokens, changed, {m: list(closed[m]) for m in changed}, True)

    def _parts(self, name, source, layout, model, tokens, changed, days_of, gather) -> None:
        table = self.path(name)
        gone = {part: of for part, of in versions.current(self.spark, table).items() if part not in tokens}
        put = {}
        if changed:
            rows = versions.read(self.spark, self.path(source), layout, [day for part in changed for day in days_of[part]])
            built = model(rows)
            if gather and len(changed) > 1:  # else each of many days is scattered over as many files as there are tasks
                built = built.hint("rebalance", tables.DAY)
            version, stored = tables.write_version(built, self.warehouse, name)
            put = {part: versions.Part(version, part in stored, tokens[part]) for part in changed}
        if put or gone:
            versions.switch(self.spark, table, put, gone)

    def _closed(self, name: str) -> tuple[dict[str, dict[str, versions.Part]], dict[str, versions.Part]]:
        """The days of each closed month, and the days that stay by themselves: those of the newest month and rows without a day."""
        months: dict[str, dict[str, versions.Part]] = {}
        apart = {}
        for day, part in versions.current(self.spark, self.path(name)).items():
            dated = re.fullmatch(rf"{tables.DAY}=(\d{{4}}-\d{{2}})-\d{{2}}", day)
            if dated:
                months.setdefault(tables.part_of(f"{dated[1]}-01"), {})[day] = part
            else:
                apart[day] = part
        newest = max(months, default=None)
        return months, apart | months.pop(newest, {})

    def history(self, name: str) -> tuple[DataFrame, str]:
        """All rows of a table by day, closed months as one row per key, and a token of what they were read from."""
        _, apart = self._closed(name)
        months = versions.current(self.spark, self.path(MONTHS[name]))
        layout = tables.layout(name)
        rows = versions.read(self.spark, self.path(name), layout, apart)
        if months:
            rows = rows.unionByName(versions.read(self.spark, self.path(MONTHS[name]), layout))
        return rows, _token([*months.values(), *apart.values()])

    def whole(self, name: str, model: Callable[..., DataFrame], *sources: str) -> None:
        rows, tokens = zip(*[self.history(source) for source in sources])
        token, mine = "+".join(tokens), versions.current(self.spark, self.path(name))
        if not (self.changed_only and versions.WHOLE in mine and mine[versions.WHOLE].source == token):
            tables.write_model(model(*rows), self.warehouse, name, token)


def _token(parts: Iterable[versions.Part]) -> str:
    return hashlib.sha256(" ".join(sorted(part.version for part in parts)).encode()).hexdigest()


def build_models(spark: SparkSession, warehouse: str, changed_only: bool = False) -> None:
    """Build all models from the raw tables, staging before marts.

    Staging is written once and read by the marts. Author statistics are summed
    from tables with one row per day and author, of which closed months are
    summed up once. With `changed_only`, only days whose raw day was replaced
    since they were built are read and built again, whatever their number, and
    only months and statistics that these are part of.
    """
    build = _Builder(spark, warehouse, changed_only)
    _together(
        spark,
        lambda: build.days("stg_stories", "raw_stories", RAW["stories"], staging.stg_stories),
        lambda: build.days("stg_articles", "raw_articles", RAW["articles"], staging.stg_articles),
    )
    stories, articles = tables.layout("stg_stories"), tables.layout("stg_articles")
    _together(
        spark,
        lambda: build.days("top_stories", "stg_stories", stories, marts.top_stories),
        lambda: build.days("author_days", "stg_stories", stories, marts.author_days, gather=True),
        lambda: build.days("article_author_days", "stg_articles", articles, marts.article_author_days, gather=True),
        lambda: build.days("article_tag_days", "stg_articles", articles, marts.article_tag_days, gather=True),
    )
    _together(
        spark,
        lambda: build.months("author_days", marts.author_months),
        lambda: build.months("article_author_days", marts.article_author_months),
        lambda: build.months("article_tag_days", marts.article_tag_months),
    )
    _together(
        spark,
        lambda: build.whole("author_stats", marts.author_stats_of_days, "author_days"),
        lambda: build.whole("article_author_stats", marts.article_author_stats_of_days, "article_author_days", "article_tag_days"),
    )


def check_models(spark: SparkSession, warehouse: str, unchecked_only: bool = False) -> tuple[DataFrame | None, dict[str, versions.Part]]:
    """The results of all column checks on the built tables, and which versions of their parts were checked.

    With `unchecked_only`, parts that passed before are left out; None if all did.
    """
    passed = versions.current(spark, f"{warehouse}/_checked") if unchecked_only else {}
    models, checked = {}, {}
    for name in MODELS:
        fresh = {}
        for part, of in versions.current(spark, f"{warehouse}/{name}").items():
            key = f"{name}/{part}"
            if passed.get(key) != versions.Part(of.version, False):
                fresh[part] = checked[key] = versions.Part(of.version, False)
        if fresh:
            models[name] = versions.read(spark, f"{warehouse}/{name}", tables.layout(name), fresh)
    return (run_checks(models, [check for check in CHECKS if check.model in models]) if models else None), checked


def run_daily(
    spark: SparkSession, landing: str, warehouse: str, day: str | None = None, incremental: bool = True
) -> dict[str, int]:
    """Load one landed day of both feeds, build the models and check them.

    Without `day`, each feed's newest landed day is loaded. Returns the loaded
    row counts. `incremental` rebuilds what any raw day that changed since its
    models were built can change, be it loaded by this run or by others;
    without it, all history is rebuilt. A failing check raises after the tables
    were built and leaves them in place; parts that failed are checked again by
    the next run, parts that passed only after they changed.
    """
    pin(spark)
    days = {feed: day or land.latest_day(spark, landing, feed) for feed in FEEDS}
    loaded = {feed: tables.load_day(spark, landing, warehouse, feed, days[feed]) for feed in FEEDS}
    build_models(spark, warehouse, incremental)
    results, checked = check_models(spark, warehouse, incremental)
    if results is not None:
        gate(results)
        versions.switch(spark, f"{warehouse}/_checked", checked, whole=not incremental)
    return loaded


def _together(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Submit independent Spark jobs at once, so one fills the cores that another's last tasks leave idle; pool and job group go along."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for submitted in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            submitted.result()
