"""Runs registered queries next to their SQL in DuckDB and compares types and values.

As a script: `python tests/oracle.py SF_DIR [query ...]`.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float) and math.isnan(value):
        return (1, "nan")
    return (2, repr(value))


def _sorted_rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: [_key(v) for v in r])


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs first, or None."""
    expected = con.execute(sql)
    expected_names = [d[0] for d in expected.description]
    rows = expected.fetchall()
    if sorted(df.columns) != sorted(expected_names):
        return f"columns {sorted(set(df.columns) ^ set(expected_names))}"
    got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    want = _sorted_rows(expected_names, rows)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    names = sorted(df.columns)
    for g, w in zip(got, want):
        if [_key(v) for v in g] != [_key(v) for v in w]:
            return str([(n, a, b) for n, a, b in zip(names, g, w) if _key(a) != _key(b)][:4])
    return None


def type_difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[tuple]:
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    same = {
        "BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "TINYINT": "tinyint",
        "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string", "BOOLEAN": "boolean",
    }
    duck = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [(n, spark_types[n], t) for n, t in duck.items() if same.get(t) != spark_types.get(n)]


def main(sf_dir: str, only: list[str]) -> None:
    from conftest import make_session

    spark = make_session()
    con = connect(sf_dir)
    oracles = contract.oracle_sql()
    for name, run in contract.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        df = run(spark, sf_dir)
        if name in oracles:
            bad = difference(df, con, oracles[name])
            types = type_difference(df, con, oracles[name])
            outcome = f"{'ok' if not bad else bad} {types[:4] if types else ''}"
        else:
            outcome = f"{df.count()} rows (no SQL)"
        print(f"{name:28s} {time.time() - start:6.1f}s {outcome}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
