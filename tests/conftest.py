import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillstat.session import local_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4, spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
        spark__sql__streaming__stateStore__providerClass=(
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"))
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate column expressions of a text column ``t`` on a list of texts."""
    from pyspark.sql import functions as F

    def run(expression, texts):
        rows = [(i, x) for i, x in enumerate(texts)]
        frame = spark.createDataFrame(rows, "i int, t string")
        return [r["x"] for r in frame.select("i", expression(F.col("t")).alias("x")).orderBy("i").collect()]
    return run
