import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from portledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def one(spark):
    """Evaluate a function of Columns over a list of values, in order."""

    def run(rule, values, schema="v string"):
        rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, {schema}")
        return [tuple(r)[1:] if len(r) > 2 else r[1] for r in df.select("i", *rule(df)).orderBy("i").collect()]

    return run
