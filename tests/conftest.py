import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("velocube-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="velocube-test-ckpt-"))
    yield s
    s.stop()


def trips_df(spark, rows):
    """Hand-made trips: dicts with any subset of the trip columns."""
    from velocube import schemas
    full = [{f.name: r.get(f.name) for f in schemas.TRIPS.fields} for r in rows]
    return spark.createDataFrame(full, schemas.TRIPS)
