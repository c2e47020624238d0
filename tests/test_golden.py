"""Golden check against a sample output of the class x feature join (C4):
87 rows, 12 columns, sorted by song. Point ``RANKFORGE_GOLDEN`` at that CSV
to run it; the file is only read as data."""

import os

import pytest
from pyspark.sql import functions as F

from rankforge.operators import enrich
from rankforge.schemas import FEATURES_8
from rankforge.sources import csv as src

GOLDEN = os.environ.get("RANKFORGE_GOLDEN", "")
COLUMNS = ["song", "artist", "class", "year", *FEATURES_8]

pytestmark = pytest.mark.skipif(not (GOLDEN and os.path.exists(GOLDEN)), reason="RANKFORGE_GOLDEN not set")


def _golden(spark):
    # all strings, as the reference's own join reads and writes them
    return src.read_csv_strict_rows(
        spark, GOLDEN, schema=src.T.StructType([src.T.StructField(c, src.T.StringType()) for c in COLUMNS])
    )


def test_golden_invariants(spark):
    g = _golden(spark)
    assert g.columns == COLUMNS and g.count() == 87
    assert g.select("song", "artist").distinct().count() == 87
    classes = {int(r["class"]) for r in g.select("class").distinct().collect()}
    assert classes <= set(range(10))


def test_join_features_rebuilds_golden(spark):
    g = _golden(spark)
    classified = g.select("song", "artist", "class")
    features = g.select(
        F.col("artist").alias("artist_name"), F.col("song").alias("title"), *COLUMNS[3:]
    )
    rebuilt = enrich.join_features(classified, features, sort=True)
    assert rebuilt.columns == COLUMNS
    assert [tuple(r) for r in rebuilt.collect()] == [tuple(r) for r in g.orderBy("song", "artist").collect()]
