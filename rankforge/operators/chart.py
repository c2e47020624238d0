"""Chart preparation: parse, best rank, rank classes, default class, date
range (C1 C2 C5 P4-P7 F1 A1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions.scalar import rank_class

KEYS = ("song", "artist")
# Fixed value: class of songs that are not on the chart or ranked past 100.
DEFAULT_CLASS = 10


def parse_chart(raw: DataFrame, rank_col: str = "rank", date_col: str = "date") -> DataFrame:
    """String rank -> int, string date -> date; bad values become null
    (ANSI casts would raise, so ``try_cast`` is used)."""
    return raw.withColumn(rank_col, F.col(rank_col).try_cast("int")).withColumn(
        date_col, F.col(date_col).try_cast("date")
    )


def _as_date(before) -> F.Column:
    # "2023" -> 2023-01-01, like a string compared with a date column.
    return F.lit(str(before)).cast("date")


def best_rank(
    chart: DataFrame,
    before=None,
    keys: Sequence[str] = KEYS,
    rank_col: str = "rank",
    date_col: str = "date",
) -> DataFrame:
    """Best (minimum) rank per (song, artist) over rows dated before
    ``before`` (strict; null dates drop). ``min`` skips null ranks, so a key
    whose ranks are all null keeps ``top_rank`` null; null keys form a group.

    Plan: pushed-down date filter -> partial hash aggregate per map task ->
    one shuffle of at most one row per key and task -> final aggregate. A hot
    key is pre-aggregated map-side, so no task sees all of its rows.
    """
    df = chart
    if before is not None:
        df = df.where(F.col(date_col) < _as_date(before))
    return df.groupBy(*keys).agg(F.min(rank_col).alias("top_rank"))


def classify(
    best: DataFrame,
    width: int = 10,
    clamp: bool = False,
    sort: bool = True,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """``class = floor((top_rank - 1) / width)`` (bigint); columns
    song, artist, class. ``clamp=True`` caps the class at the default class
    (ranks over 100); ``sort`` orders by song, artist as the reference output
    does (a range exchange -- skip it when the consumer does not need order).
    """
    out = best.select(
        *keys,
        rank_class("top_rank", width, DEFAULT_CLASS if clamp else None).alias("class"),
    )
    return out.orderBy(*keys) if sort else out


def classify_with_default(
    features: DataFrame,
    classified: DataFrame,
    keys: Sequence[str] = KEYS,
    default_class: int = DEFAULT_CLASS,
) -> DataFrame:
    """Every feature row gets the class of its (song, artist) on the
    chart, or the default class when the song is not on the chart.

    ``classified`` is unique per key (it is an aggregate), so the left join
    never multiplies feature rows. AQE broadcasts it when it is small and
    falls back to a sort-merge join (with skew splitting) otherwise.
    """
    cls = classified.select(*keys, F.col("class").alias("_rf_class"))
    joined = features.join(cls, list(keys), "left")
    rest = [c for c in features.columns if c not in keys and c != "class"]
    return joined.select(
        *keys,
        F.coalesce("_rf_class", F.lit(default_class).cast("bigint")).alias("class"),
        *rest,
    )


def restrict_to_years_of(
    chart: DataFrame,
    reference: DataFrame,
    year_col: str = "year",
    date_col: str = "date",
) -> DataFrame:
    """Keep chart rows whose year lies in [min, max] of the reference
    table's known years (year 0 means unknown).

    One aggregate pass yields the two years; the filter is written as a date
    range (``lo-01-01 <= date < (hi+1)-01-01``) rather than ``year(date)``, so
    it reaches the Parquet scan as a pushed filter. No known year: no rows."""
    lo, hi = reference.where(F.col(year_col) > 0).agg(F.min(year_col), F.max(year_col)).first()
    if lo is None:
        return chart.where(F.lit(False))
    start = F.lit(f"{int(lo):04d}-01-01").cast("date")
    stop = F.lit(f"{int(hi) + 1:04d}-01-01").cast("date")
    return chart.where((F.col(date_col) >= start) & (F.col(date_col) < stop))
