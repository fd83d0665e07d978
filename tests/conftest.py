import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terrasse.settings import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-"),
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def small_runs(spark):
    """Treat every key with more than a handful of rows as hot."""
    spark.conf.set("spark.terrasse.runRows", "5")
    yield
    spark.conf.unset("spark.terrasse.runRows")


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
