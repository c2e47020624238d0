"""Column helpers shared by the text operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: space and U+0009..U+000D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.filter(F.split(text, BLANK_RUN), lambda w: w != "")


def carried(df: DataFrame, keep: list[str] | None = None, **cols: Column) -> DataFrame:
    """The input row (or the columns of it to keep) in one struct ``row``
    beside computed columns, so that no input column can clash with an
    operator's own names."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in (df.columns if keep is None else keep)]).alias("row"),
                     *[c.alias(name) for name, c in cols.items()])


def uncarried(df: DataFrame, **replaced: Column) -> DataFrame:
    """Back to the input's columns, in their order; some replaced."""
    names = df.schema["row"].dataType.names
    return df.select(*[replaced.get(n, F.col("row")[n]).alias(n) for n in names])
