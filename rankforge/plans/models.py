"""Features, estimators, sweeps and cross-validation on ``pyspark.ml``:
M1-M14, E4, E10.

Training is distributed by ``pyspark.ml`` (treeAggregate of gradients, tree
statistics per partition). The driver only holds fitted models and one
score per (parameter value, split), which become small result tables. Forests
that would be too large for the driver are :mod:`rankforge.plans.forest`'s.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.plans import forest
from rankforge.plans.evaluate import mark_best
from rankforge.session import ensure_checkpoint_dir

# Sweep lists of the original notebooks.
REG_PARAMS = [1e-5, 1e-4, 1e-3, 1e-2, 0.1, 1.0]
MAX_ITERS = [1, 5, 10, 20, 50, 100]
MAX_DEPTHS = [1, 5, 10, 20, 30]
NUM_TREES = [1, 5, 10, 20, 50, 100]
HIDDEN_WIDTHS = [1, 5, 10, 20, 50, 100]
LEARNING_RATES = [1e-5, 1e-4, 1e-3, 1e-2, 0.1, 1.0]
SVM_C = [0.01, 0.1, 1.0, 10.0, 100.0, 1000.0]
# Spark's tree depth limit.
MAX_TREE_DEPTH = 30
# M8's depths; the original's 50 and 100 are beyond Spark's limit.
BINARY_DEPTHS = [1, 5, 10, 20, MAX_TREE_DEPTH]


# ---------------------------------------------------------------- features

def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """M1: numeric columns -> one vector column (raises on null, so drop
    incomplete rows first)."""
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def array_features(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    """M1 for an array<float> column (e.g. embeddings): JVM-side conversion."""
    return df.withColumn(out, array_to_vector(F.col(col)))


def scaler(in_col: str = "features", out_col: str = "scaled_features") -> StandardScaler:
    """M2: unit standard deviation, no centring (the original's defaults)."""
    return StandardScaler(inputCol=in_col, outputCol=out_col, withStd=True, withMean=False)


def scale_features(
    df: DataFrame,
    in_col: str = "features",
    out_col: str = "scaled_features",
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """M2: fit the scaler on ``fit_on`` (default: ``df`` itself, as the
    original does before splitting) and transform ``df``."""
    model = scaler(in_col, out_col).fit(fit_on if fit_on is not None else df)
    return model.transform(df)


def vector_column_values(df: DataFrame, col: str, names: Sequence[str]) -> DataFrame:
    """Vector column back to named double columns."""
    arr = vector_to_array(F.col(col))
    return df.select(*[c for c in df.columns if c != col], *[arr[i].alias(n) for i, n in enumerate(names)])


def index_labels(df: DataFrame, label_col: str = "class", out: str = "label") -> DataFrame:
    """Labels -> 0..k-1 in ascending order (MLP needs contiguous labels).
    The label table has one row per distinct label."""
    labels = df.select(label_col).distinct().where(F.col(label_col).isNotNull())
    idx = labels.withColumn(out, (F.dense_rank().over(Window.orderBy(label_col)) - 1).cast("double"))
    return df.join(idx, label_col, "inner")


# ---------------------------------------------------------------- estimators

def estimator(family: str, features_col: str = "features", label_col: str = "class", **params):
    """M5-M10 by family name: lr, rf, mlp, svc (binary), ovr_svc; forest is
    rf without nodes in the driver."""
    if family == "lr":
        return LogisticRegression(featuresCol=features_col, labelCol=label_col, **params)
    if family in ("rf", "forest") and int(params.get("maxDepth", 0)) > MAX_TREE_DEPTH:
        raise ValueError(f"trees go to depth {MAX_TREE_DEPTH} at most")
    if family == "forest":
        return forest.Forest(featuresCol=features_col, labelCol=label_col, seed=0, **params)
    if family == "rf":
        # Kept node ids grow the same trees; without them every pass walks every row down each whole tree.
        return RandomForestClassifier(featuresCol=features_col, labelCol=label_col, seed=0, **{"cacheNodeIds": True, **params})
    if family == "mlp":
        return MultilayerPerceptronClassifier(featuresCol=features_col, labelCol=label_col, seed=0, **params)
    if family == "svc":
        return LinearSVC(featuresCol=features_col, labelCol=label_col, **params)
    if family == "ovr_svc":
        return OneVsRest(classifier=LinearSVC(**params), featuresCol=features_col, labelCol=label_col)
    raise ValueError(f"unknown family {family!r}")


def svc_reg_param(c: float, n_rows: int) -> float:
    """The soft-margin constant C as Spark's regParam, 1 / (C n)."""
    return 1.0 / (c * n_rows)


def mlp_layers(n_features: int, hidden: Sequence[int] | int, n_labels: int) -> list[int]:
    """M7: ``[d, m, k]`` or ``[d, h1, h2, k]``."""
    hidden = [hidden] if isinstance(hidden, int) else list(hidden)
    return [n_features, *hidden, n_labels]


# ---------------------------------------------------------------- scoring

def score(model, data: DataFrame, label_col: str = "class", metric: str = "f1") -> float:
    """E1-E3 via the multiclass evaluator (f1 = weighted F1, accuracy = micro F1)."""
    ev = MulticlassClassificationEvaluator(labelCol=label_col, predictionCol="prediction", metricName=metric)
    return float(ev.evaluate(model.transform(data)))


# Rows per partition of a training split. Iterative estimators run one Spark
# job per gradient evaluation; partitions far below this size only add task
# overhead, far above it leave executors idle.
TRAIN_ROWS_PER_PARTITION = 200_000
# A smaller split is still dealt over the session's cores, in parts of this
# many rows at least, so that no fit runs in one task while cores are idle.
SPREAD_ROWS = 5_000


def _forest_fits(family: str, parallelism: int) -> int:
    """Every partition of a forest's rows makes dense statistics of every node,
    so more partitions than a fit has cores to itself only add work. Half the
    fits of a sweep are shallow and end early."""
    return max(1, parallelism // 2) if family == "rf" else 1


# Nodes that pyspark.ml's forests of one sweep may have: it keeps them in the
# driver as objects with statistics, some 1 KB each.
DRIVER_NODES = 500_000


def _holder(family: str, train: DataFrame, fits: Sequence[dict], together: int) -> str:
    """The family, but ``forest`` for random forests (``fits``: their
    parameters) of which those that the driver holds ``together`` may have
    more than ``DRIVER_NODES`` nodes."""
    if family != "rf" or any(set(p) - {"maxDepth", "numTrees", "maxBins"} for p in fits):
        return family
    rows = train.count()
    nodes = sorted(int(p.get("numTrees", 20)) * min(2 ** (int(p.get("maxDepth", 5)) + 1) - 1, 2 * rows) for p in fits)
    return "forest" if sum(nodes[-together:]) > DRIVER_NODES else family


def materialize_split(df: DataFrame, rows_per_partition: int = TRAIN_ROWS_PER_PARTITION, fits: int = 1) -> DataFrame:
    """Prepare a split for many fits: checkpoint it to the shared checkpoint
    folder (every fit and score reads the same rows; an executor loss re-reads
    files instead of recomputing the lineage), then size its read partitions
    to the row count. Fewer partitions are merged without a shuffle; a split
    that lies in too few of them (a small file is one) is dealt anew, once.

    With several ``fits`` at a time each gets its share of the cores."""
    # checkpoint first: reading the partition count of a plan with shuffles
    # would run its stages an extra time under AQE
    ensure_checkpoint_dir(df.sparkSession)
    saved = df.checkpoint(eager=True)
    filled = [n for (n,) in saved.groupBy(F.spark_partition_id()).agg(F.count("*")).select("count(1)").collect()]  # a number a partition
    rows, cores = sum(filled), df.sparkSession.sparkContext.defaultParallelism
    wanted = max(1, math.ceil(rows / rows_per_partition), min(max(1, cores // fits), math.ceil(rows / SPREAD_ROWS)))
    if len(filled) < wanted:
        return saved.repartition(wanted).checkpoint(eager=True)
    # coalesce never raises the partition count, so this only merges
    return saved.coalesce(wanted)


def sweep(
    family: str,
    param_name: str,
    values: Sequence,
    train: DataFrame,
    val: DataFrame,
    test: DataFrame,
    make_params: Callable[[object], dict] | None = None,
    label_col: str = "class",
    features_col: str = "features",
    metric: str = "f1",
    parallelism: int = 4,
    scale: bool = False,
    fitted: list | None = None,
    **fixed,
) -> DataFrame:
    """M11 + E4 + E5 + E10: fit one model per value of one parameter (all
    others fixed), score each on train / val / test, flag the best by
    validation score (first on ties; test never selects).

    With ``scale`` the features go through the scaler, fitted on train. The
    fitted models are appended to the list ``fitted``, in value order.

    Returns a table (family, param, ordinal, value, train, val, test,
    fit_seconds, is_best). Fits run ``parallelism`` at a time as concurrent
    Spark jobs over the cached splits.
    """
    spark: SparkSession = train.sparkSession
    train = materialize_split(train, fits=_forest_fits(family, parallelism))
    val, test = (materialize_split(d) for d in (val, test))

    def params_of(v):
        return {**fixed, **(make_params(v) if make_params else {param_name: v})}

    kind = _holder(family, train, [params_of(v) for v in values], len(values))

    def fit_one(item):
        i, v = item
        params = params_of(v)
        est = estimator(kind, "scaled_features" if scale else features_col, label_col, **params)
        if scale:
            est = Pipeline(stages=[scaler(features_col, "scaled_features"), est])
        t0 = time.perf_counter()
        model = est.fit(train)
        fit_s = time.perf_counter() - t0
        return model, (
            family, param_name, i, float(v) if not isinstance(v, (list, tuple)) else float(v[0]),
            score(model, train, label_col, metric), score(model, val, label_col, metric),
            score(model, test, label_col, metric), fit_s,
        )

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        done = list(pool.map(fit_one, list(enumerate(values))))
    rows = [row for _, row in done]
    if fitted is not None:
        fitted += [model for model, _ in done]
    schema = T.StructType([
        T.StructField("family", T.StringType()), T.StructField("param", T.StringType()),
        T.StructField("ordinal", T.IntegerType()), T.StructField("value", T.DoubleType()),
        T.StructField("train", T.DoubleType()), T.StructField("val", T.DoubleType()),
        T.StructField("test", T.DoubleType()), T.StructField("fit_seconds", T.DoubleType()),
    ])
    return mark_best(spark.createDataFrame(rows, schema))


def best_predictions(fitted: Sequence, table: DataFrame, data: DataFrame) -> DataFrame:
    """Predictions on ``data`` of the sweep's selected model."""
    best = table.where("is_best").select("ordinal").first()[0]
    return fitted[best].transform(data)


def cross_validate(
    family: str,
    grid: dict[str, Sequence],
    train: DataFrame,
    test: DataFrame,
    label_col: str = "class",
    features_col: str = "features",
    scale: bool = True,
    folds: int = 3,
    parallelism: int = 4,
    seed: int = 0,
    **fixed,
):
    """Grid x k-fold cross-validation by F1 on the training split; the
    winner is refitted on the whole training split. With ``scale`` the
    scaler sits inside the pipeline, so each fold scales on its own
    training part (no leak). Returns (cv_model, grid table, test F1)."""
    train = materialize_split(train, fits=_forest_fits(family, parallelism))
    stages = []
    feat = features_col
    if scale:
        stages.append(scaler(features_col, "scaled_features"))
        feat = "scaled_features"
    points = [{**fixed, **dict(zip(grid, values))} for values in product(*grid.values())]
    est = estimator(_holder(family, train, points, parallelism), feat, label_col, **fixed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), list(values))
    maps = builder.build()
    ev = MulticlassClassificationEvaluator(labelCol=label_col, predictionCol="prediction", metricName="f1")
    cv = CrossValidator(
        estimator=Pipeline(stages=stages + [est]), estimatorParamMaps=maps,
        evaluator=ev, numFolds=folds, seed=seed, parallelism=parallelism,
    )
    model = cv.fit(train)
    rows = []
    for i, (pm, avg, std) in enumerate(zip(maps, model.avgMetrics, model.stdMetrics)):
        values = {p.name: float(v) if not isinstance(v, list) else float(v[1]) for p, v in pm.items()}
        rows.append((family, i, str(sorted(values.items())), float(avg), float(std)))
    spark = train.sparkSession
    table = spark.createDataFrame(
        rows, "family string, ordinal int, params string, avg_f1 double, std_f1 double"
    )
    table = mark_best(table, by="avg_f1")
    test_f1 = float(ev.evaluate(model.transform(test)))
    return model, table, test_f1


def explain_best(cv_model, names: Sequence[str]) -> list[str]:
    """The chosen value of each named parameter, as text."""
    best = cv_model.bestModel.stages[-1]
    return [best.explainParam(n) for n in names]


def best_params(cv_model, names: Sequence[str]) -> DataFrame:
    """M14 as rows (param, value, doc)."""
    best = cv_model.bestModel.stages[-1]
    rows = [(n, str(best.getOrDefault(best.getParam(n))), best.getParam(n).doc) for n in names]
    return SparkSession.active().createDataFrame(rows, "param string, value string, doc string")


def predict(model, data: DataFrame) -> DataFrame:
    """M13."""
    return model.transform(data)
