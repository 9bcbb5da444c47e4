"""Run queries against their SQL: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from checks.catalog import QUERIES
from checks.oracles import ORACLES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages"
DEFAULT_SF = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES.split():
        if Path(f"{sf_dir}/{table}.parquet").exists():
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def kinds(frame: pd.DataFrame) -> dict[str, str]:
    return {c: frame[c].dtype.kind for c in sorted(frame.columns)}


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    """Rows in a canonical order with exact text values."""
    columns = sorted(frame.columns)
    text = frame[columns].astype(object).where(frame[columns].notna(), None)
    text = text.map(lambda v: None if v is None else repr(float(v)) if isinstance(v, (int, float)) else str(v))
    return text.sort_values(columns, na_position="first").reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} rows != {len(sql_frame)}"
    a, b = ordered(spark_frame), ordered(sql_frame)
    unequal = (a.ne(b) & ~(a.isna() & b.isna())).any(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows differ, first:\n{a[unequal].head(2)}\n{b[unequal].head(2)}"
    return None


def check(spark, db, name: str, sf_dir: str) -> tuple[str | None, int]:
    got = QUERIES[name](spark, sf_dir).toPandas()
    return difference(got, db.sql(ORACLES[name]).df()), len(got)


def main(argv: list[str]) -> int:
    from perigee.session import build_session

    sf_dir = argv[0] if argv else DEFAULT_SF
    names = argv[1:] or list(QUERIES)
    conf = {"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    spark, db, failed = build_session("checks", conf), connect(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        began = time.perf_counter()
        try:
            problem, rows = check(spark, db, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={rows} {time.perf_counter() - began:.2f}s", flush=True)
        if problem:
            print(problem, flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
