"""Incremental best rank (C1) over chart files that keep arriving.

The reference recomputes the chart table from scratch; with Structured
Streaming each new weekly file only updates the keys it touches:

* source: a folder of chart files (CSV as strings, or Parquet);
* state: one running ``min(rank)`` per (song, artist) in the state store
  (size = number of distinct songs, independent of the number of weeks);
* sink: ``update`` mode, every micro-batch appends its changed keys to a
  Parquet folder. Because ``min`` is idempotent and monotone, the current
  table is ``min(top_rank)`` per key over everything appended -- a restart
  that replays a batch cannot make the answer wrong.

Checkpoints and output live under the session's shared checkpoint folder
unless the caller names other shared paths.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.operators.chart import KEYS, best_rank, parse_chart
from rankforge.schemas import CHART_RAW
from rankforge.session import ensure_checkpoint_dir


_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def chart_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType = CHART_RAW,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming chart rows from a folder; CSV is read as strings and parsed."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        raw = reader.option("header", True).csv(path)
        return parse_chart(raw)
    return reader.format(fmt).load(path)


def best_rank_updates(chart: DataFrame, before=None, keys: Sequence[str] = KEYS) -> DataFrame:
    """The streaming aggregation: running best rank per key."""
    return best_rank(chart, before=before, keys=keys)


def run_best_rank(
    chart: DataFrame,
    out_path: str | None = None,
    checkpoint: str | None = None,
    before=None,
    keys: Sequence[str] = KEYS,
    available_now: bool = True,
    processing_time: str | None = None,
    use_rocksdb: bool = True,
):
    """Start (and with ``available_now`` run to completion) the incremental
    best-rank query. Returns (query, out_path)."""
    spark = chart.sparkSession
    if use_rocksdb and not spark.conf.get(_PROVIDER_KEY, None):
        # one state row per song: keep it off the JVM heap
        spark.conf.set(_PROVIDER_KEY, _ROCKSDB)
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/best_rank_stream-{uuid.uuid4().hex}"
    out_path = out_path or f"{base}/table"
    checkpoint = checkpoint or f"{base}/checkpoint"

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(out_path)

    writer = (
        best_rank_updates(chart, before, keys)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(append_batch)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query, out_path


def current_best_rank(spark: SparkSession, out_path: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """The table as of the last finished micro-batch."""
    return spark.read.parquet(out_path).groupBy(*keys).agg(F.min("top_rank").alias("top_rank"))
