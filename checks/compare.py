"""Run the queries in Spark and their SQL in DuckDB and compare: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value: object) -> object:
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def rows_of(data: pa.Table) -> Counter:
    names = sorted(data.column_names)
    columns = [data.column(n).to_pylist() for n in names]
    return Counter(tuple(map(_cell, row)) for row in zip(*columns, strict=True))


def types_of(data: pa.Table) -> dict[str, str]:
    """Arrow types by column; strings of either width, and times of any unit, count as equal."""

    def plain(t: pa.DataType) -> str:
        if pa.types.is_large_string(t) or pa.types.is_string(t):
            return "string"
        return "timestamp" if pa.types.is_timestamp(t) else str(t)

    return {n: plain(data.schema.field(n).type) for n in sorted(data.column_names)}


def differences(got: pa.Table, want: pa.Table) -> list[str]:
    found = []
    if types_of(got) != types_of(want):
        found.append(f"schema {types_of(got)} != {types_of(want)}")
        if sorted(got.column_names) != sorted(want.column_names):
            return found
    left, right = rows_of(got), rows_of(want)
    if left != right:
        found.append(f"{got.num_rows} and {want.num_rows} rows, only Spark {list((left - right).items())[:3]}")
        found.append(f"only SQL {list((right - left).items())[:3]}")
    return found


def main() -> None:
    from checks import games, tables  # noqa: F401
    from checks.registry import QUERIES, SQL
    from questlake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toArrow()
            spent = time.time() - start
            if name in SQL:
                found = differences(got, con.sql(SQL[name]).to_arrow_table())
            else:
                found = [] if got.num_rows else ["no rows"]
        except Exception as error:  # noqa: BLE001
            found, spent, got = [str(error)[:1500]], time.time() - start, None
        bad += bool(found)
        print(f"{name:28} {spent:6.2f}s {got.num_rows if got else 0:8} {'; '.join(found) or 'ok'}", flush=True)
    print(f"{bad} differ")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
