import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablecare.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tablecare-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g", "spark.ui.enabled": "false"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture()
def frame(spark):
    """Make a DataFrame from rows and a schema text."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture()
def rows():
    """The rows of a DataFrame as sorted tuples."""

    def read(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return read


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan after the query has run, as adaptive execution left it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
