import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="gridlake-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def field(spark):
    """Build a field from (cell, time text, value) rows."""
    def make(rows, key="cell bigint"):
        df = spark.createDataFrame(rows, f"{key}, time string, value double")
        return df.withColumn("time", df["time"].cast("timestamp_ntz"))
    return make


def values(df, *keys):
    """{key or keys: value}, with times as ISO text."""
    out = {}
    for row in df.collect():
        k = tuple(v.isoformat() if hasattr(v, "isoformat") else v for v in (row[c] for c in keys))
        out[k[0] if len(k) == 1 else k] = row["value"]
    return out
