"""Class balancing and seeded samples: C8 C14 C15 C16 W3 O3.

All samples are drawn in the seeded order ``md5('<seed>:<key>')`` (then the
key), so they are exact in size and reproducible across partitionings.
Only an exact candidate superset of each class's first n rows is ranked
(:func:`_candidates`); ranks come from :func:`with_ordinal`, which spreads
even a class holding most of the rows over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.functions.scalar import binary_relabel_expr, hash_order
from rankforge.operators.chart import DEFAULT_CLASS
from rankforge.operators.ordinal import with_ordinal


def _key_cols(keys: Sequence) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def sample_rank(
    df: DataFrame,
    keys: Sequence[str],
    seed: int = 0,
    group_by: Sequence[str] = (),
    name: str = "sample_rank",
) -> DataFrame:
    """Position of each row in the seeded sample order (per group)."""
    order = [hash_order(*keys, seed=seed).alias("_rf_h")] + _key_cols(keys)
    ranked = with_ordinal(
        df.withColumn("_rf_h", order[0]), ["_rf_h", *keys], group_by, name=name
    )
    return ranked.drop("_rf_h")


# Rows are counted per leading hex digits of their md5 sample order.
PREFIX_DIGITS = 4


def _number(spark, n) -> float:
    """A count given as a Column (scalar subquery) becomes one number."""
    if isinstance(n, Column):
        return spark.range(1).select(n.cast("double").alias("n")).first()["n"]
    return float(n)


def _candidates(df: DataFrame, n: float, keys: Sequence[str], seed: int, group_by: Sequence[str]) -> DataFrame:
    """Rows that can be among the first ``n`` of their group in the seeded
    order -- an exact superset, at every size: one aggregate pass counts the
    rows per (group, md5 prefix); a prefix is needed if fewer than ``n`` rows
    of its group come before it (65,536 prefixes a group at most). The needed
    prefixes' end joins back as one row per group, so only about ``n`` rows
    per group go on to the range shuffle and checkpoint.
    """
    groups = list(group_by)
    pre = df.withColumn("_rf_p", F.substring(hash_order(*keys, seed=seed), 1, PREFIX_DIGITS))
    counts = pre.groupBy(*groups, "_rf_p").agg(F.count(F.lit(1)).alias("_rf_c"))
    before = Window.partitionBy(*groups).orderBy("_rf_p").rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("_rf_b", F.coalesce(F.sum("_rf_c").over(before), F.lit(0))).where(F.col("_rf_b") < F.lit(n))
    names = [f"_rf_g{i}" for i in range(len(groups))]
    last = needed.groupBy(*[F.col(g).alias(a) for g, a in zip(groups, names)]).agg(F.max("_rf_p").alias("_rf_last"))
    if not groups:
        last = F.broadcast(last)  # one row
    on = F.col("_rf_p") <= F.col("_rf_last")
    for g, a in zip(groups, names):
        on = on & F.col(g).eqNullSafe(F.col(a))
    return pre.join(last, on, "left_semi").drop("_rf_p")


def seeded_sample_ranked(
    df: DataFrame, n, keys: Sequence[str], seed: int = 0, name: str = "sample_rank"
) -> DataFrame:
    """O3 with the rank kept: the first ``min(n, rows)`` rows of the seeded
    order and their 1-based position in it. ``n`` may be a Column (a scalar
    subquery such as a count); it is read as one number. Only the md5
    candidates of the first n rows are ranked."""
    num = _number(df.sparkSession, n)
    cand = _candidates(df, num, keys, seed, ())
    return sample_rank(cand, keys, seed, name=name).where(F.col(name) <= F.lit(num))


def seeded_sample(df: DataFrame, n, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """O3: exactly ``min(n, rows)`` rows without replacement."""
    return seeded_sample_ranked(df, n, keys, seed).drop("sample_rank")


def add_default_class_sample(
    chart_rows: DataFrame,
    source: DataFrame,
    title_col: str = "title",
    artist_col: str = "artist_name",
    keys: Sequence[str] | None = None,
    seed: int = 0,
    fraction_divisor: int = 10,
    count_header: bool = True,
    default_class: int = DEFAULT_CLASS,
) -> DataFrame:
    """Append ``floor(lines / 10)`` songs drawn from a source of unranked
    songs, with the default class. ``lines`` counts the chart rows plus the
    header line, as the line-based original did. Rows are built as columns,
    so titles with commas survive."""
    lines = chart_rows.select(
        (F.count(F.lit(1)) + F.lit(1 if count_header else 0)).alias("n")
    ).scalar()
    n = F.floor(lines / F.lit(fraction_divisor))
    picked = seeded_sample(source, n, list(keys or [title_col, artist_col]), seed)
    extra = picked.select(
        F.col(title_col).alias("song"),
        F.col(artist_col).alias("artist"),
        F.lit(default_class).cast(chart_rows.schema["class"].dataType).alias("class"),
    )
    return chart_rows.select("song", "artist", "class").unionByName(extra)


def exact_sample_per_class(
    df: DataFrame,
    n,
    keys: Sequence[str],
    label_col: str = "class",
    labels: Sequence | None = None,
    seed: int = 0,
) -> DataFrame:
    """Per class, the first ``n`` rows of the seeded order (all rows of a
    smaller class). ``labels`` limits sampling to those classes; the others
    pass through whole."""
    num = _number(df.sparkSession, n)
    if labels is None:
        cand = _candidates(df, num, keys, seed, [label_col])
        ranked = sample_rank(cand, keys, seed, group_by=[label_col])
        return ranked.where(F.col("sample_rank") <= F.lit(num)).drop("sample_rank")
    chosen = F.col(label_col).isin(list(labels))
    cand = _candidates(df.where(chosen), num, keys, seed, [label_col])
    sampled = sample_rank(cand, keys, seed, group_by=[label_col])
    sampled = sampled.where(F.col("sample_rank") <= F.lit(num)).drop("sample_rank")
    rest = df.where(~chosen | F.col(label_col).isNull())
    return rest.unionByName(sampled)


def cap_classes(
    df: DataFrame,
    labels: Sequence,
    n: int,
    keys: Sequence[str],
    label_col: str = "class",
    seed: int = 0,
) -> DataFrame:
    """C14: for each listed label whose count is greater than ``n``, keep an
    exact seeded sample of ``n`` rows; other labels and smaller classes are
    untouched. (Sampled rows come last in the reference's file; row order is
    not part of a DataFrame.)"""
    return exact_sample_per_class(df, n, keys, label_col, labels, seed)


def binary_relabel(df: DataFrame, label_col: str = "class", positive=DEFAULT_CLASS) -> DataFrame:
    """Positive label -> 1, everything else (null included) -> 0."""
    return df.withColumn(label_col, binary_relabel_expr(label_col, positive))


def class_counts(df: DataFrame, label_col: str = "class") -> DataFrame:
    """A3: rows per label (partial + final hash aggregate)."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def equalize_classes(
    df: DataFrame,
    keys: Sequence[str],
    label_col: str = "class",
    seed: int = 0,
    mode: str = "both",
) -> DataFrame:
    """Cut classes to the smallest class size (A4).

    ``mode="both"`` (default) cuts every class, so the result is balanced.
    ``mode="reference"`` keeps the original's quirk: only class 0 is cut,
    class 1 stays whole.
    """
    smallest = class_counts(df, label_col).select(F.min("n")).scalar()
    if mode == "both":
        return exact_sample_per_class(df, smallest, keys, label_col, seed=seed)
    if mode == "reference":
        return exact_sample_per_class(df, smallest, keys, label_col, labels=[0], seed=seed)
    raise ValueError(f"unknown mode {mode!r}")
