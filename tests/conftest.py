import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparktab.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def blobs(spark):
    """Three well separated classes in two measures, with hash noise."""
    from pyspark.sql import functions as F

    from sparktab.functions.expressions import unit_hash

    y = (F.col("id") % 3).cast("int")
    noise = [unit_hash(s, F.col("id")) - 0.5 for s in ("a", "b")]
    df = spark.range(450).select(
        F.col("id").alias("key"), y.alias("y"), (F.col("id") % 2).cast("int").alias("side"),
        (F.when(y == 0, 0.0).when(y == 1, 3.0).otherwise(0.0) + noise[0]).alias("a"),
        (F.when(y == 0, 0.0).when(y == 1, 0.0).otherwise(3.0) + noise[1]).alias("b"),
    )
    return df.cache()
