"""CSV / text / Parquet scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.schemas import CHART_RAW


def _require_full_parsing(spark: SparkSession) -> None:
    # With CSV column pruning, DROPMALFORMED keeps malformed rows whenever a
    # query reads fewer columns than the file has.
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")


def read_csv_strict_rows(
    spark: SparkSession, path: str, schema: T.StructType = CHART_RAW, header: bool = True
) -> DataFrame:
    """Header CSV, fixed schema, malformed rows dropped (rows with the
    wrong field count or unparsable typed values)."""
    _require_full_parsing(spark)
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "DROPMALFORMED")
        .csv(path)
    )


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    header: bool = True,
    quote_escape: bool = False,
    infer: bool = False,
) -> DataFrame:
    """Header CSV with a declared schema (inference only on request:
    it costs a full extra pass). ``quote_escape`` undoubles ``""`` inside
    quoted fields."""
    reader = spark.read.option("header", header).option("mode", "FAILFAST")
    if quote_escape:
        reader = reader.option("quote", '"').option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_skip_long(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
) -> DataFrame:
    """Like a line reader that skips over-long lines: lines with more
    fields than the schema are dropped, short lines are kept null-filled.

    Reads with one extra overflow column and keeps rows where it is null.
    """
    _require_full_parsing(spark)
    wide = T.StructType(list(schema.fields) + [T.StructField("_rf_overflow", T.StringType())])
    df = (
        spark.read.schema(wide)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return df.where(F.col("_rf_overflow").isNull()).drop("_rf_overflow")


def read_many(
    spark: SparkSession,
    path: str,
    pattern: str | None = None,
    recursive: bool = False,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    **options,
) -> DataFrame:
    """Many files by glob (``prefix_*.csv``) or recursive lookup; one scan."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def read_feature_groups(
    spark: SparkSession, paths: Sequence[str]
) -> list[DataFrame]:
    """The three row-aligned feature groups (Parquet, keyed by
    ``file_id, row_idx``); combine them with ``row_aligned_concat``."""
    return [spark.read.parquet(p) for p in paths]


def read_lines(spark: SparkSession, path: str, line_col: str = "value") -> DataFrame:
    """Raw text lines with an input-order key: sorting by
    (file, block, row_in_task) gives the order a line-by-line reader sees.
    ``row_in_task`` grows by one per line inside a file split."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_in_task"),
        F.col("value").alias(line_col),
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables under a scale-factor folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
