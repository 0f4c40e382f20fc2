import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from citylake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "checkpoints"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def values(df, *columns):
    """Rows as a sorted list of tuples; NULLs come last."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def plan_of(df):
    """Physical plan before it has run."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()
