import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]


@pytest.fixture(scope="session")
def spark():
    from creascope.session import build_session
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate columns over a single row: ``one(columns..., name=value...)`` -> list of values."""
    from pyspark.sql import functions as F

    def evaluate(*columns, **values):
        row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
        return list(row.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())

    return evaluate
