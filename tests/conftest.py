import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[*]").appName("recordcheck-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "6g")
               .config("spark.sql.debug.maxToStringFields", "100000")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.codegen.wholeStage", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="recordcheck-test-ckpt-"))
               .getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def party_small(spark):
    from recordcheck.sources.fixtures import party

    return party(spark, SMALL)
