from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hourgrid.session import build_session

    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def ts(spark):
    """Frame with TIMESTAMP_NTZ columns from rows of text and numbers."""
    from pyspark.sql import functions as F

    def make(rows, schema):
        names = [c.split()[0] for c in schema.split(", ")]
        kinds = [c.split()[1] for c in schema.split(", ")]
        plain = ", ".join(f"{n} {'string' if k == 'ntz' else k}" for n, k in zip(names, kinds))
        df = spark.createDataFrame(rows, plain)
        return df.select(*[F.col(n).cast("timestamp_ntz").alias(n) if k == "ntz" else F.col(n) for n, k in zip(names, kinds)])

    return make
