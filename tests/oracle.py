"""Side-by-side run of a Spark query and its SQL in DuckDB."""

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


# Column types that both engines print alike.
TYPES = {
    "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _sorted(rows: list[tuple], order: list[int]) -> list[tuple]:
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda r: tuple(map(repr, r)))


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same rows, otherwise what differs first."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    other = {c: (t, types[c]) for c, t in df.dtypes if TYPES.get(t, t) != types[c]}
    if other:
        return f"types differ: {other}"
    actual = [tuple(r) for r in df.collect()]
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    by_name = sorted(names)
    got = _sorted(actual, [df.columns.index(n) for n in by_name])
    want = _sorted(expected, [names.index(n) for n in by_name])
    bad = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    if bad:
        return f"{len(bad)} rows differ, e.g. {dict(zip(by_name, bad[0][0]))} != {bad[0][1]}"
    return None
