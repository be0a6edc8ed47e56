import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("eventweir-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="eventweir-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def envelope_of(spark):
    """Envelopes of the given payload texts, in one topic or as (topic, text) pairs."""
    from datetime import datetime

    from eventweir.functions.envelope import ENVELOPE_SCHEMA

    def make(payloads, topic="t"):
        rows = []
        for i, p in enumerate(payloads):
            name, text = p if isinstance(p, tuple) else (topic, p)
            value = None if text is None else text.encode()
            rows.append((b"k%d" % i, value, name, 0, i, datetime(2024, 5, 1, 12, 0, i % 60), 0))
        return spark.createDataFrame(rows, ENVELOPE_SCHEMA)

    return make
