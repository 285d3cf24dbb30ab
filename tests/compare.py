"""Run the named queries against DuckDB: ``python tests/compare.py [sf_dir] [name …]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def rows(table, names: list[str]) -> list[tuple]:
    """Rows as comparable values, columns by name; whole floats count as integers."""

    def plain(value):
        if isinstance(value, float) and value.is_integer():
            return int(value)
        if hasattr(value, "replace") and hasattr(value, "tzinfo"):
            return value.replace(tzinfo=None)
        return value

    order = sorted(range(len(names)), key=names.__getitem__)
    keyed = [tuple(plain(row[i]) for i in order) for row in table]
    return sorted(keyed, key=lambda row: [(v is not None, str(v)) for v in row])


def compare(spark, connection, name: str, query, sql: str, sf_dir: str) -> str | None:
    """A description of the first difference, or None."""
    result = query(spark, sf_dir)
    got_names = result.columns
    got = rows(result.collect(), got_names)
    relation = connection.execute(sql)
    want_names = [d[0] for d in relation.description]
    want = rows(relation.fetchall(), want_names)
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} != {w}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from termloom.session import build_session

    arguments = sys.argv[1:]
    sf_dir = arguments.pop(0) if arguments else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = []
    for name, query in entry.queries().items():
        if arguments and name not in arguments:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, connection, name, query, oracles[name], sf_dir)
            else:
                problem = None if query(spark, sf_dir).count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        if problem:
            failed.append(name)
        print(f"{time.time() - start:6.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{len(failed)} failed: {failed}" if failed else "all equal")


if __name__ == "__main__":
    main()
