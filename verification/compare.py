"""Run queries on Spark and their SQL on DuckDB and compare the results.

    python -m verification.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

DEFAULT_DATA = "/root/testdata/sf0.01"

# Names of the same type in Spark and in DuckDB.
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def local_session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("freightlake")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="freightlake-"))
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(
            f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')"
        )
    return connection


def _sort_key(row: tuple) -> tuple:
    return tuple((value is not None, str(type(value)), value) for value in row)


def compare(spark, connection, query, sql: str, sf_dir: str) -> list[str]:
    """Differences between the two results; none if they are equal."""
    frame = query(spark, sf_dir)
    names = sorted(frame.columns)
    got = [tuple(row) for row in frame.select(*[f"`{n}`" for n in names]).collect()]
    relation = connection.sql(sql)
    described = dict(zip(relation.columns, relation.types, strict=True))
    if sorted(described) != names:
        return [f"columns {names} against {sorted(described)}"]
    problems = []
    for field in frame.schema.fields:
        kind = field.dataType.simpleString()
        if TYPES.get(kind) != str(described[field.name]):
            problems.append(f"{field.name}: {kind} against {described[field.name]}")
    quoted = ", ".join(f'"{n}"' for n in names)
    want = relation.project(quoted).fetchall()
    if len(got) != len(want):
        problems.append(f"{len(got)} rows against {len(want)}")
    got.sort(key=_sort_key)
    want.sort(key=_sort_key)
    for mine, theirs in zip(got, want):
        if mine != theirs:
            differing = sum(a != b for a, b in zip(got, want))
            shown = [(n, a, b) for n, a, b in zip(names, mine, theirs) if a != b]
            problems.append(f"{differing} rows differ, first in {shown}")
            break
    return problems


def main(arguments: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from verification.queries import ORACLE, QUERIES

    sf_dir = arguments[0] if arguments else DEFAULT_DATA
    wanted = arguments[1:] or list(QUERIES)
    spark = local_session()
    connection = connect(sf_dir)
    failed = 0
    for name in wanted:
        start = time.perf_counter()
        try:
            if name in ORACLE:
                problems = compare(
                    spark, connection, QUERIES[name], ORACLE[name], sf_dir
                )
                note = f"{QUERIES[name](spark, sf_dir).count()} rows"
            else:
                note = f"{QUERIES[name](spark, sf_dir).count()} rows, no SQL"
                problems = []
        except Exception as error:  # noqa: BLE001 - reported, the next one runs
            problems, note = [f"{type(error).__name__}: {str(error)[:600]}"], "failed"
        failed += bool(problems)
        seconds = time.perf_counter() - start
        print(f"{'FAIL' if problems else 'ok  '} {name:32s} {seconds:6.2f}s {note}")
        for problem in problems:
            print(f"       {problem[:900]}")
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
