import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(params=["broadcast", "shuffle"])
def side(request, spark):
    """Run a test with small sides broadcast, and with every side over the limit."""
    if request.param == "shuffle":
        spark.conf.set("motefield.broadcast.bytes", "0")
        spark.conf.set("motefield.hot.group.rows", "20")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    for c in ("motefield.broadcast.bytes", "motefield.hot.group.rows", "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.unset(c)
