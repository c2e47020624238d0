import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from rankforge.session import DEFAULT_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[*]").appName("rankforge-tests")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    s = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="rankforge-wh-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="rankforge-test-")
