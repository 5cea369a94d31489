from __future__ import annotations

import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest
from hypothesis import HealthCheck, Phase, settings

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from adtrail.registry import LOG_SCHEMA  # noqa: E402


# Examples are Spark jobs: no time limit and no search for a smaller one.
settings.register_profile(
    "spark",
    deadline=None,
    phases=[Phase.explicit, Phase.generate],
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
settings.load_profile("spark")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("adtrail-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def log(spark):
    """A message log of payload texts, offsets counting up from ``first``."""

    def build(payloads, topic="ad_impressions", partition=0, first=0):
        at = datetime(2024, 5, 31, 12, tzinfo=timezone.utc)
        rows = [
            (None, None if p is None else bytearray(p, "utf-8"), topic, partition, first + n, at, 0)
            for n, p in enumerate(payloads)
        ]
        return spark.createDataFrame(rows, LOG_SCHEMA)

    return build
