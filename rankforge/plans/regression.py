"""Regression on the exact rank: metrics as aggregates, and a sweep."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions.scalar import rank_class
from rankforge.plans.models import materialize_split, scaler


def regression_metrics(predictions: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """(n, rmse, mae, r2) of the rows with both values, in one aggregate. r2 is
    null where the label does not vary."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    rows = predictions.where(y.isNotNull() & p.isNotNull())
    out = rows.groupBy(*by).agg(F.count("*").alias("n"), F.avg((y - p) * (y - p)).alias("_mse"), F.avg(F.abs(y - p)).alias("mae"), F.var_pop(y).alias("_var"))
    return out.select(*by, "n", F.sqrt("_mse").alias("rmse"), "mae", F.when(F.col("_var") > 0, 1 - F.col("_mse") / F.col("_var")).alias("r2"))


def rank_bucket_confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction", last: int = 10) -> DataFrame:
    """(class, prediction, n): rank classes of the true and the rounded
    predicted ranks. Predictions below 1 count as rank 1, ranks beyond the
    chart as the default class ``last``."""
    rank = F.greatest(F.round(F.col(prediction).cast("double")), F.lit(1.0))
    rows = predictions.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return rows.select(rank_class(F.col(label), clamp_to=last).alias("class"), rank_class(rank, clamp_to=last).alias("prediction")).groupBy(
        "class", "prediction").agg(F.count("*").alias("n"))


def regressor(family: str, features_col: str, label_col: str, **params):
    if family == "linear":
        return LinearRegression(featuresCol=features_col, labelCol=label_col, **params)
    if family == "rf":
        return RandomForestRegressor(featuresCol=features_col, labelCol=label_col, seed=0, **params)
    raise ValueError(f"unknown family {family!r}")


def rank_regression(family: str, param: str, values: Sequence, train: DataFrame, val: DataFrame, test: DataFrame, label: str = "label",
                    features: str = "features", fitted: list | None = None, **fixed) -> DataFrame:
    """One model per value of a parameter: rows (family, param, ordinal, value,
    split, n, rmse, mae, r2, fit_seconds, is_best); the best has the smallest
    validation RMSE, the first on ties."""
    splits = {n: materialize_split(d) for n, d in (("train", train), ("val", val), ("test", test))}
    out, rmse = [], []
    for i, v in enumerate(values):
        began = time.perf_counter()
        model = Pipeline(stages=[scaler(features, "scaled_features"), regressor(family, "scaled_features", label, **{**fixed, param: v})]).fit(splits["train"])
        took = time.perf_counter() - began
        if fitted is not None:
            fitted.append(model)
        tagged = [model.transform(d).select(F.lit(n).alias("split"), label, "prediction") for n, d in splits.items()]
        rows = regression_metrics(tagged[0].unionByName(tagged[1]).unionByName(tagged[2]), label, by=["split"]).collect()  # three rows
        rmse.append(next((r["rmse"] for r in rows if r["split"] == "val"), float("inf")))
        out += [(family, param, i, float(v), r["split"], r["n"], r["rmse"], r["mae"], r["r2"], took) for r in rows]
    best = rmse.index(min(rmse))
    return train.sparkSession.createDataFrame(
        [(*r, r[2] == best) for r in out],
        "family string, param string, ordinal int, value double, split string, n long, rmse double, mae double, r2 double, fit_seconds double, is_best boolean")
