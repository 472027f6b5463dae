import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from registry.base import ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Nothing may be broadcast: joins take the shuffled way."""
    spark.conf.set("quire.broadcast.maxBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("quire.broadcast.maxBytes")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
