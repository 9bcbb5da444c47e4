from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from perigee.session import build_session, shared_folder  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "perigee-tests",
        {
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    shared_folder(session)
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    changed: dict[str, str | None] = {}

    def set_all(**options):
        for name, value in options.items():
            name = "spark.sql." + name.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, str(value))

    yield set_all
    for name, value in changed.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df) -> list[tuple]:
    """Rows as tuples in an order that does not depend on the engine."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan adaptive execution ended up with."""
    df.collect()
    return plan(df).split("\n+- == Initial Plan ==")[0]
