import os
import sys
import tempfile
import time

import pytest

# Collected TIMESTAMP values become Python datetimes in the process's local
# zone; pin it (and the JVM's, started below) so expectations hold on any host.
os.environ["TZ"] = "UTC"
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from ordertide.session import apply_state_store

    warehouse = tempfile.mkdtemp(prefix="ordertide-wh-")
    spark = (SparkSession.builder.master("local[4]")
             .appName("ordertide-tests")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.warehouse.dir", warehouse)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    apply_state_store(spark)
    yield spark
    spark.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
