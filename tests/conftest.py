import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a column function over a list of values of one type."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
