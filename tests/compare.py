"""Spark result against DuckDB on the same parquet files."""

from __future__ import annotations

import ast
import datetime as dt
import decimal
import glob
import os

import duckdb


def connection(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal:{value}"
    if isinstance(value, float):
        return "nan" if value != value else repr(value)
    if isinstance(value, int):
        return repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return str(value)


def rows_of(table) -> tuple[list[str], list]:
    names = sorted(table.column_names)
    columns = [[_plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, sorted(map(repr, zip(*columns)))


def type_notes(spark_df, con, sql: str) -> str:
    """Columns whose Arrow types differ between the two results."""
    got, want = spark_df.toArrow().schema, con.sql(sql).to_arrow_table().schema
    return ", ".join(f"{n} {got.field(n).type}/{want.field(n).type}" for n in got.names if got.field(n).type != want.field(n).type)


def differences(spark_df, con, sql: str, show: int = 3) -> str | None:
    """None when names, row count and every value agree; else a description."""
    got_names, got = rows_of(spark_df.toArrow())
    want_names, want = rows_of(con.sql(sql).to_arrow_table())
    if got_names != want_names:
        return f"columns differ: spark {sorted(set(got_names) - set(want_names))}, sql {sorted(set(want_names) - set(got_names))}"
    if len(got) != len(want):
        return f"row counts differ: spark {len(got)}, sql {len(want)}"
    if got == want:
        return None
    extra, missing = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    columns = set()
    for a, b in zip(got, want):
        if a != b and len(got_names) > 12:
            columns |= {n for n, x, y in zip(got_names, ast.literal_eval(a), ast.literal_eval(b)) if x != y}
    if columns:
        return f"{len(extra)} rows differ of {len(got)} in about {sorted(columns)}"
    return f"{len(extra)} rows differ of {len(got)} {got_names}\n  spark {extra[:show]}\n  sql   {missing[:show]}"
