import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("geoloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxMetadataStringLength", "100000")
        .config("spark.driver.memory", "4g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="geoloom-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="geoloom-checkpoint-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def jts(spark):
    """Reader of well-known text into the JVM's own geometry classes, as ground truth."""
    reader = spark._jvm.org.locationtech.jts.io.WKTReader()
    return lambda text: reader.read(text)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
