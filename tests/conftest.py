from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def make_spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="vitrine-test-")
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("vitrine-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.driver.memory", "4g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
    from vitrine.session import configure

    configure(spark)
    return spark


@pytest.fixture(scope="session")
def spark():
    s = make_spark()
    yield s
    s.stop()
