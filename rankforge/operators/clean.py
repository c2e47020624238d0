"""Cleaning and dedupe: C6 C7 C10 C12 P8 P9."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions.lines import repair_line_struct


def repair_lines(
    lines: DataFrame,
    line_col: str = "value",
    keep: Sequence[str] = (),
    sep: str = ",",
) -> DataFrame:
    """Rebuild (song, artist, class) from raw chart lines split on every
    separator. Lines with fewer than 3 fields are dropped (count them with
    :func:`repair_report`). Row-local: no shuffle."""
    rebuilt = lines.select(*keep, repair_line_struct(line_col, sep).alias("_rf_r"))
    return rebuilt.where("_rf_r.ok").select(
        *keep, "_rf_r.song", "_rf_r.artist", "_rf_r.class"
    )


def repair_report(lines: DataFrame, line_col: str = "value", sep: str = ",") -> DataFrame:
    """How many lines were kept as-is (3 fields), rebuilt (>3) or dropped (<3)."""
    k = F.size(F.split(line_col, sep, -1))
    kind = F.when(k == 3, "kept").when(k > 3, "rebuilt").otherwise("dropped")
    return lines.groupBy(kind.alias("outcome")).agg(F.count(F.lit(1)).alias("lines"))


def explode_lines(
    texts: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] = (),
    line_col: str = "value",
) -> DataFrame:
    """Whole texts -> one row per line with its 1-based number. Each text is
    expanded inside the task that read it (no shuffle)."""
    return texts.select(
        *keep,
        F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("_rf_i", line_col),
    ).select(*keep, (F.col("_rf_i") + 1).cast("bigint").alias("line_no"), line_col)


def dedupe_first(
    df: DataFrame,
    keys: Sequence[str],
    ordinal: str,
) -> DataFrame:
    """Keep the first row (smallest ``ordinal``) of every key.

    Written as ``min_by`` in a group-by so that map tasks pre-aggregate: a key
    holding a third of all rows shrinks to one row per task before the
    shuffle, instead of being sorted in one task by a window.
    """
    others = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*others), F.col(ordinal)).alias("_rf_first")
    )
    return picked.select(*keys, *[F.col("_rf_first")[c].alias(c) for c in others]).select(
        *df.columns
    )


def dedupe_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Any one row per key (``dropDuplicates``)."""
    return df.dropDuplicates(list(keys))


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null -- or NaN, like pandas -- in any of ``cols``."""
    cols = list(cols or df.columns)
    cond = F.lit(True)
    types = dict(df.dtypes)
    for c in cols:
        ok = F.col(c).isNotNull()
        if types[c] in ("double", "float"):
            ok = ok & ~F.isnan(c)
        cond = cond & ok
    return df.where(cond)


def drop_unidentified(df: DataFrame, id_col: str = "track_id") -> DataFrame:
    """Drop rows whose id is the empty string; null ids stay, as in
    the pandas original (``!=`` alone would also drop nulls in SQL)."""
    return df.where(F.col(id_col).isNull() | (F.col(id_col) != F.lit("")))
