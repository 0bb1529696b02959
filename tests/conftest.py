import os
import sys
import tempfile
from datetime import date, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]").appName("tidemark-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def tiny_combined(spark):
    """30 dated positives every 10 days from 2013-01-01, 20 undated negatives."""
    rows = []
    for i in range(30):
        rows.append((f"p{i:03d}", 1, date(2013, 1, 1) + timedelta(days=10 * i), float(i), float(i % 7)))
    for i in range(20):
        rows.append((f"n{i:03d}", 0, None, float(100 + i), float(i % 5)))
    return spark.createDataFrame(rows, "sample_id STRING, label INT, sample_date DATE, x DOUBLE, y DOUBLE")
