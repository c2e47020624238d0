"""Sinks (S9-S11)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV folder with header, one part file per task."""
    df.write.mode(mode).option("header", True).csv(path)


def write_single_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV file, for export of small results only (everything goes
    through one task); keep large intermediates in Parquet."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by=None, mode: str = "overwrite") -> None:
    """Parquet sink; with ``partition_by`` and dynamic partition overwrite,
    rewriting a shard replaces only that shard's folder."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_shards(df: DataFrame, path: str) -> None:
    """Shards as rows of byte-sized files, ``shard_id`` a column. Spark
    merges small shards into a file and splits large ones around its advisory
    partition size; rows are sorted by shard, so a filter on ``shard_id``
    reads few row groups."""
    df.hint("rebalance", "shard_id").sortWithinPartitions("shard_id").write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, keys, buckets: int, mode: str = "overwrite") -> None:
    """A catalog table bucketed and sorted on its join keys. Later joins and
    aggregations on those keys (with a matching partition count) read it
    without shuffling it -- e.g. the feature table, joined on
    (song, artist) by several stages."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    (
        df.write.mode(mode)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .format("parquet")
        .saveAsTable(table)
    )
