"""Shards, resume and combine."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.operators.enrich import pending
from rankforge.operators.ordinal import with_chunk_id
from rankforge.sources.sinks import write_shards

# Fixed value: rows per shard.
SHARD_ROWS = 1000


def assign_shards(df: DataFrame, order_by: Sequence, size: int = SHARD_ROWS) -> DataFrame:
    """Shard i holds rows [size*i, size*(i+1)) of the given order."""
    return with_chunk_id(df, order_by, size, name="shard_id")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def finished_shards(spark: SparkSession, path: str) -> DataFrame:
    """(shard_id, run) of the stage's manifest: the shards whose output is
    complete, with or without rows. A manifest that cannot be read is an
    error."""
    if not _exists(spark, f"{path}.finished"):
        return spark.createDataFrame([], "shard_id bigint, run string")
    return spark.read.schema("shard_id bigint, run string").parquet(f"{path}.finished")


def run_sharded_stage(
    shards: DataFrame,
    stage: Callable[[DataFrame], DataFrame],
    out_path: str,
) -> DataFrame:
    """Run ``stage`` only on shards that are not finished. Each run has
    one folder, in which ``shard_id`` is a column and files have about Spark's
    advisory size: folders grow with the runs and files with the bytes, not
    with the number of shards. Then the run's shard ids go into the manifest
    beside it. Finished shards are not recomputed, also if they gave no rows;
    a folder whose run broke off before the manifest is never read.
    Returns the complete output (no rows at all: the stage's columns)."""
    spark = shards.sparkSession
    finished = finished_shards(spark, out_path)
    todo = pending(shards, finished.select("shard_id").distinct(), ["shard_id"])
    result = stage(todo)
    schema = T.StructType([*[f for f in result.schema.fields if f.name != "shard_id"], result.schema["shard_id"]])
    if finished.isEmpty() or not todo.isEmpty():
        run = uuid.uuid4().hex
        write_shards(result, f"{out_path}/{run}")
        todo.select("shard_id").distinct().select("shard_id", F.lit(run).alias("run")).write.mode("append").parquet(f"{out_path}.finished")
    return combine_shards(spark, out_path, schema)


def combine_shards(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """C13 combine: union of every finished shard (one scan of the folders of
    the runs that the manifest names)."""
    runs = [r["run"] for r in finished_shards(spark, path).select("run").distinct().collect()]  # one row a run
    reader = spark.read if schema is None else spark.read.schema(schema)
    if not runs:
        return spark.createDataFrame([], schema or T.StructType())
    return reader.parquet(*[f"{path}/{r}" for r in sorted(runs)])
