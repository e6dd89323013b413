"""Run queries next to their SQL and compare columns, types and values.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def warehouse(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = Path(f"{sf_dir}/{name}.parquet")
        if path.exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path / '*.parquet' if path.is_dir() else path}'")
    return db


def differences(frame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark frame and a SQL result, columns matched by name."""
    names = sorted(frame.columns)
    ours = Counter(tuple(row) for row in frame.select(*[f"`{n}`" for n in names]).collect())
    described = {name: kind for name, kind, *_ in db.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(described) != names:
        return [f"columns {names} vs {sorted(described)}"]
    types = {f.name: _TYPES[f.dataType.simpleString()] for f in frame.schema.fields}
    found = [f"{n}: {types[n]} vs {described[n]}" for n in names if types[n] != described[n]]
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = Counter(db.execute(f"SELECT {quoted} FROM ({sql})").fetchall())
    missing, extra = theirs - ours, ours - theirs
    if missing or extra:
        found.append(
            f"{ours.total()} vs {theirs.total()} rows; missing {list(missing)[:3]}; extra {list(extra)[:3]}"
        )
    return found


def main(sf_dir: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from feedmart.session import build_session

    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = warehouse(sf_dir), 0
    for name, query in queries().items():
        if only and name not in only:
            continue
        started = time.time()
        frame = query(spark, sf_dir)
        found = differences(frame, db, oracle_sql()[name]) if name in oracle_sql() else ["no SQL"]
        bad += bool(found)
        print(f"{name:24} {time.time() - started:6.2f}s {frame.count():7} rows  {'; '.join(found) or 'equal'}", flush=True)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(args[0], args[1:]))
