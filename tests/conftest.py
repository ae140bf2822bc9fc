import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sightline.session import configure

    session = configure(
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sightline-test-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def tables(spark):
    from catalog import load_all
    from catalog.registry import Tables

    load_all()
    return Tables(spark, SF)
