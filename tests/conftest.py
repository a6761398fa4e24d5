import datetime as dt

import pytest

from scoreloom.session import build_session

AS_OF = dt.datetime(2024, 1, 31, 20, 0, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.checkpoint.dir": str(shared), "spark.sql.warehouse.dir": str(shared / "warehouse"),
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows(ddl, [tuple, ...]) -> DataFrame"""
    return lambda ddl, data: spark.createDataFrame(data, ddl)


@pytest.fixture
def evaluate(rows):
    """evaluate(column function, [value, ...]) -> results in order"""
    from pyspark.sql import functions as F

    def run(expression, values, kind="string"):
        df = rows(f"i int, x {kind}", list(enumerate(values)))
        return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]

    return run
