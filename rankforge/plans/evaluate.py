"""Evaluation and reports as DataFrames: E1-E10, A5-A8, O2, O4.

Scores are aggregates over (label, prediction) pairs: one partial + final
aggregate with at most (#labels x #labels) groups, so they scale with the
number of prediction rows and never collect them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# A wide matrix has one column per label; beyond this use the long form.
MAX_MATRIX_LABELS = 1000


def confusion_counts(pred: DataFrame, label_col: str = "class", pred_col: str = "prediction") -> DataFrame:
    """Rows per (actual, predicted)."""
    return pred.groupBy(
        F.col(label_col).alias("actual"), F.col(pred_col).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(
    pred: DataFrame,
    label_col: str = "class",
    pred_col: str = "prediction",
    labels: Sequence | None = None,
) -> DataFrame:
    """rows = actual label, one column per predicted label (ascending),
    zeros filled. As with the metric the original plots, only labels seen
    as *actual* become columns; predictions of other labels are dropped.
    The label list is the distinct actual labels (a handful of values)."""
    counts = confusion_counts(pred, label_col, pred_col)
    if labels is None:
        # bounded driver read: at most MAX_MATRIX_LABELS + 1 values
        got = pred.select(label_col).distinct().orderBy(label_col).limit(MAX_MATRIX_LABELS + 1).collect()
        if len(got) > MAX_MATRIX_LABELS:
            raise ValueError(
                f"more than {MAX_MATRIX_LABELS} labels: use confusion_counts (long form)"
            )
        labels = [r[0] for r in got]
    wide = (
        counts.groupBy("actual")
        .pivot("predicted", list(labels))
        .agg(F.first("n"))
        .fillna(0)
    )
    return wide.where(F.col("actual").isin(list(labels)))


def _per_label(pred: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """Per actual label: support w, predicted count np, true positives tp."""
    pairs = pred.select(
        F.col(label_col).cast("double").alias("y"), F.col(pred_col).cast("double").alias("p")
    )
    stacked = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("y").alias("lbl"), F.lit(1).alias("w"), F.lit(0).alias("np"),
                         (F.col("y") == F.col("p")).cast("int").alias("tp")),
                F.struct(F.col("p").alias("lbl"), F.lit(0).alias("w"), F.lit(1).alias("np"),
                         F.lit(0).alias("tp")),
            )
        ).alias("s")
    ).select("s.*")
    return stacked.groupBy("lbl").agg(
        F.sum("w").alias("w"), F.sum("np").alias("np"), F.sum("tp").alias("tp")
    ).where(F.col("w") > 0)


def weighted_f1(pred: DataFrame, label_col: str = "class", pred_col: str = "prediction") -> DataFrame:
    """Support-weighted F1 over the actual labels (the definition of the
    multiclass evaluator's ``f1``): per label f = 2 tp / (w + np)."""
    per = _per_label(pred, label_col, pred_col)
    f = F.when(F.col("tp") > 0, 2.0 * F.col("tp") / (F.col("w") + F.col("np"))).otherwise(0.0)
    return per.agg((F.sum(F.col("w") * f) / F.sum("w")).alias("weighted_f1"))


def accuracy(pred: DataFrame, label_col: str = "class", pred_col: str = "prediction") -> DataFrame:
    """Accuracy (= micro F1 for single-label prediction)."""
    hit = (F.col(label_col).cast("double") == F.col(pred_col).cast("double")).cast("double")
    return pred.agg(F.avg(hit).alias("accuracy"))


def sorted_labels(df: DataFrame, label_col: str = "class") -> DataFrame:
    """O2: distinct labels in ascending order."""
    return df.select(label_col).distinct().orderBy(label_col)


def distinct_label_count(df: DataFrame, label_col: str = "class") -> DataFrame:
    """A5."""
    return df.agg(F.countDistinct(label_col).alias("n_labels"))


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("cols", F.lit(len(df.columns)))


def class_histogram(
    df: DataFrame,
    col: str = "class",
    bins: int | None = None,
    dataset: str | None = None,
) -> DataFrame:
    """Counts per bin. ``bins=None``: one row per value of ``col`` (the
    class labels). Otherwise ``bins`` equal-width bins over [min, max], last
    bin closed on the right. Bounds are scalar subqueries."""
    if bins is None:
        out = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    else:
        # one aggregate pass; the two bounds become literals
        lo_v, hi_v = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
        lo, hi = F.lit(lo_v).cast("double"), F.lit(hi_v).cast("double")
        width = (hi - lo) / F.lit(bins)
        b = F.when(width == 0, F.lit(0)).otherwise(
            F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1))
        )
        counts = (
            df.where(F.col(col).isNotNull())
            .groupBy(b.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        # every bin has a row, empty ones with 0; no values at all: no bins
        every = df.sparkSession.range(bins if lo_v is not None else 0).select(F.col("id").cast("int").alias("bin"))
        out = every.join(counts, "bin", "left").select(
            "bin", F.coalesce("n", F.lit(0)).alias("n"), (lo + F.col("bin") * width).alias("lower")
        )
    if dataset is not None:
        out = out.select(F.lit(dataset).alias("dataset"), *out.columns)
    return out


def distribution_report(tables: dict[str, DataFrame], col: str = "class") -> DataFrame:
    """Class histogram of several datasets, stacked with a dataset tag."""
    parts = [class_histogram(df, col, dataset=name) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mark_best(scores: DataFrame, by: str = "val", order: str = "ordinal", group_by: Sequence[str] = ()) -> DataFrame:
    """Flag the row with the highest ``by`` score; ties go to the
    first (smallest ordinal). A sweep table has one row per parameter value,
    so this window is small."""
    w = Window.partitionBy(*group_by).orderBy(F.col(by).desc(), F.col(order).asc())
    return scores.withColumn("is_best", F.row_number().over(w) == 1)


def best_row(scores: DataFrame, by: str = "val", order: str = "ordinal") -> DataFrame:
    """E5: the selected row of a sweep."""
    return scores.orderBy(F.col(by).desc(), F.col(order).asc()).limit(1)


def compare_families(sweeps: dict[str, DataFrame]) -> DataFrame:
    """Sweep tables of several model families side by side (stacked)."""
    parts = [
        df.select(F.lit(name).alias("family"), *[c for c in df.columns if c != "family"])
        for name, df in sweeps.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
