"""Runs named queries on Spark and in DuckDB and compares the rows exactly."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "events".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].astype(float)
        elif not pd.api.types.is_numeric_dtype(df[c]):
            df[c] = df[c].map(lambda v: None if v is None or v is pd.NaT or v != v else str(v))
    return df.sort_values(list(df.columns), ignore_index=True, na_position="first")


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    got, want = rows_of(got), rows_of(want)
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} != {list(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for c in got.columns:
        same = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{c}: {(~same).sum()} rows, first {got[c][at]!r} != {want[c][at]!r}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from citystream.session import build

    spark = build("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                            "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names or list(queries):
        began = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            took = time.time() - began
            want = con.execute(oracles[name]).df()
            verdict = differences(got, want)
        except Exception as error:  # report and go on with the next query
            took, got, verdict = time.time() - began, [], f"{type(error).__name__}: {str(error)[:600]}"
        failed += verdict is not None
        print(f"{'FAIL' if verdict else 'ok  '} {name:30s} {len(got):7d} rows {took:6.2f}s {verdict or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
