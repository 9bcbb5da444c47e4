"""Insert-if-absent into a relational database through Spark's JDBC source."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.model import CREATED_AT, WINDOW_START, StatsTable
from perigee.operators.joins import first_per_key, insert_absent_rows


@dataclass(frozen=True)
class JdbcTarget:
    """Where to load. ``execute`` runs one SQL statement on the database, for example through a
    DB-API connection; with it, loads are atomic and typed tables get their primary key."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str = "org.postgresql.Driver"
    connections: int = 8
    execute: Callable[[str], None] | None = None

    @classmethod
    def postgres(cls, host: str, database: str, port: int = 5432, **rest) -> JdbcTarget:
        return cls(f"jdbc:postgresql://{host}:{port}/{database}", **rest)

    def options(self, table: str) -> dict[str, str]:
        given = {
            "url": self.url,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "numPartitions": str(self.connections),
        }
        return {k: v for k, v in given.items() if v is not None}

    def read_options(self, table: str, span: tuple[object, object] | None = None) -> dict[str, str]:
        """Options of a scan. With a ``span`` of window starts, the scan is cut into one range per
        connection; rows outside it fall to the first and last range. Without one it is one query."""
        options = self.options(table)
        if span is None:
            return options
        low, high = map(str, span)
        return options | {"partitionColumn": WINDOW_START, "lowerBound": low, "upperBound": high}


def _column_types(table: StatsTable) -> dict[str, str]:
    types = {e: f"VARCHAR({table.entity_width})" for e in table.entity}
    types |= {k: "TIMESTAMP" for k in table.key if k not in table.entity}
    types |= {m.name: m.sql_type.upper() for m in table.measures}
    return types | {CREATED_AT: "TIMESTAMP"}


def create_table_sql(table: StatsTable) -> str:
    columns = [
        f"{name} {kind}" + (" DEFAULT CURRENT_TIMESTAMP" if name == CREATED_AT else "")
        for name, kind in _column_types(table).items()
    ]
    key = f"PRIMARY KEY ({', '.join(table.key)})"
    return f"CREATE TABLE IF NOT EXISTS {table.name} ({', '.join([*columns, key])})"


def insert_absent_sql(table: StatsTable, staging: str) -> str:
    columns = ", ".join(_column_types(table))
    return (
        f"INSERT INTO {table.name} ({columns}) SELECT {columns} FROM {staging} "
        "ON CONFLICT DO NOTHING"
    )


def _write(df: DataFrame, table: StatsTable, target: JdbcTarget, name: str, mode: str) -> None:
    types = ", ".join(f"{c} {t}" for c, t in _column_types(table).items())
    writer = df.write.format("jdbc").options(**target.options(name))
    writer.option("createTableColumnTypes", types).mode(mode).save()


def _held_keys(batch: DataFrame, table: StatsTable, target: JdbcTarget) -> DataFrame:
    """Keys the database holds in the hours of the batch, read over several connections."""
    # As text, so that the session's zone applies here and in the scan, not that of this machine.
    ends = (end(WINDOW_START).cast("string") for end in (F.min, F.max))
    low, high = batch.agg(*ends).first()
    span = None if low is None else (low, high)
    reader = batch.sparkSession.read.format("jdbc")
    held = reader.options(**target.read_options(table.name, span)).load()  # fails if there is no such table
    if span is None:
        return held.select(*table.key).limit(0)
    bounds = (F.lit(t).cast("timestamp") for t in (low, high))
    return held.select(*table.key).where(F.col(WINDOW_START).between(*bounds))


def load_jdbc_insert_absent(df: DataFrame, table: StatsTable, target: JdbcTarget) -> None:
    """Insert the rows whose key the table lacks; existing rows are never changed.

    With ``target.execute``: executors write a staging table in parallel and the database merges
    it in one statement, so a retried task does no harm. Without it: keys already held are removed
    by an anti join and the rest is appended; that needs a single writer and a table that exists, made
    by ``create_table_sql``: with its primary key, a retried task that had already committed fails, and
    running the load again puts it right. Spark would make a table without a key, so it never does.
    """
    batch = df.select(*_column_types(table))
    if target.execute is None:
        fresh = insert_absent_rows(batch, _held_keys(batch, table, target), table.key)
        _write(fresh, table, target, table.name, "append")
        return
    staging = f"{table.name}_staging_{uuid.uuid4().hex[:12]}"
    target.execute(create_table_sql(table))
    try:
        _write(first_per_key(batch, table.key), table, target, staging, "overwrite")
        target.execute(insert_absent_sql(table, staging))
    finally:
        target.execute(f"DROP TABLE IF EXISTS {staging}")
