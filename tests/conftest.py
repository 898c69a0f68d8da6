from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from touchline.session import DEFAULT_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "4g")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="touchline-test-ckpt-"))
    ensure_checkpoint_dir(session)
    yield session


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="touchline-test-")
