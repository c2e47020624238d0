"""Forests that do not lie in the driver."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from rankforge.plans import forest, models


def _table(n=600, width=5, classes=3, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 8, (n, width)).astype(np.uint8)
    return x, (x[:, 0] // 3 + (x[:, 1] > 5)).astype(np.int32) % classes


def _rows(spark, n=900):
    """Class by two of four features; some rows come twice."""
    v = [(F.hash(F.col("id") % (n - 50), F.lit(i)) % 1000).cast("double") for i in range(4)]
    df = spark.range(n).select("id", F.array(*v).alias("a"))
    df = df.withColumn("class", F.when(F.col("a")[0] > 0, 2.0).when(F.col("a")[2] > 300, 1.0).otherwise(0.0))
    df = models.array_features(df, "a").drop("a")
    return [df.where(f"id % 5 in ({k})") for k in ("0, 1, 2", "3", "4")]


def test_the_best_split_is_that_of_all_tried():
    x, y = _table()
    hist = np.zeros((1, 5, 8, 3))
    np.add.at(hist, (0, np.repeat(np.arange(5)[None], len(x), 0), x, y[:, None]), 1)

    def impurity(rows):
        p = np.bincount(y[rows], minlength=3) / max(1, rows.sum())
        return rows.sum() * (1 - (p * p).sum())

    tried = {(f, b): impurity(x[:, f] <= b) + impurity(x[:, f] > b) for f in range(5) for b in range(7)}
    f, b, gains = forest.best_splits(hist)
    assert gains[0] and tried[f[0], b[0]] == pytest.approx(min(tried.values()))
    pure = np.zeros((1, 2, 3, 2))
    pure[..., 0] = 4
    assert not forest.best_splits(pure)[2][0]


def test_a_packed_tree_votes_as_it_grew():
    x, y = _table()
    w = forest.bag(7, 0, np.arange(len(x)))
    for depth in (0, 2, 30):
        tree = forest.grow(x, y, w, 3, 8, 2, depth, forest.root_key(7, 0))
        at = np.zeros(len(x), int)
        for _ in range(depth):
            f = tree["feature"][at]
            at = np.where(f >= 0, tree["left"][at] + (x[np.arange(len(x)), np.maximum(f, 0)] > tree["cut"][at]), at)
        # each leaf counts the rows that reach it; siblings do not agree
        assert (np.array([np.bincount(y[at == n], w[at == n], 3) for n in np.flatnonzero(tree["feature"] < 0)]) == tree["counts"][tree["feature"] < 0]).all()
        inner = tree["left"][tree["feature"] >= 0]
        both = (tree["feature"][inner] < 0) & (tree["feature"][inner + 1] < 0)
        guess = tree["counts"].argmax(1)
        assert (guess[inner[both]] != guess[inner[both] + 1]).all()
        votes = np.zeros((len(x), 3), np.int64)
        forest.vote(forest.pack(tree), x, votes)
        share = tree["counts"][at] / tree["counts"][at].sum(1, keepdims=True)
        assert np.abs(votes / forest.SHARE - share).max() < 1e-9


def test_bags_are_poisson_and_differ_by_tree():
    ids = np.arange(200_000)
    a, b = forest.bag(0, 0, ids), forest.bag(0, 1, ids)
    assert abs(a.mean() - 1) < 0.02 and abs(a.var() - 1) < 0.03 and abs(np.corrcoef(a, b)[0, 1]) < 0.02
    assert (forest.bag(0, 0, ids[::-1])[::-1] == a).all()


def test_cuts_come_from_all_rows(spark):
    df = spark.range(0, 40_000, 1, 5).select(F.array(F.col("id").cast("double"), (F.col("id") == 39_999).cast("double"), F.lit(1.0), F.lit(float("nan"))).alias("a"))
    even, rare, constant, none = forest.thresholds(df, "a", 32)
    assert len(even) == 31 and np.abs(even / 40_000 - np.arange(1, 32) / 32).max() < 0.003
    assert list(rare) == [0.0] and len(constant) == 0 and len(none) == 0


def test_a_large_sweep_leaves_no_forest_in_the_driver(spark, monkeypatch):
    train, val, test = _rows(spark)
    before = {r.ordinal: r for r in models.sweep("rf", "maxDepth", [1, 5, 30], train, val, test, numTrees=5).collect()}
    monkeypatch.setattr(models, "DRIVER_NODES", 100)
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda *_: pytest.fail("its nodes lie in the driver"))
    fitted = []
    table = models.sweep("rf", "maxDepth", [1, 5, 30], train, val, test, numTrees=5, fitted=fitted)
    rows = {r.ordinal: r for r in table.collect()}
    assert [len(m.packed) for m in fitted] == [5, 5, 5] and {r.family for r in rows.values()} == {"rf"}
    assert all(abs(rows[i].test - before[i].test) < 0.15 for i in (1, 2)) and rows[2].train > 0.97
    got = models.best_predictions(fitted, table, test)
    assert got.count() == test.count() and set(test.columns) < set(got.columns)


def test_a_large_grid_leaves_no_forest_in_the_driver(spark, monkeypatch):
    train, _, test = _rows(spark)
    monkeypatch.setattr(models, "DRIVER_NODES", 100)
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda *_: pytest.fail("its nodes lie in the driver"))
    model, table, test_f1 = models.cross_validate("rf", {"maxDepth": [1, 10], "numTrees": [1, 4]}, train, test)
    assert table.count() == 4 and test_f1 > 0.9
    best = table.where("is_best").first().params
    assert [f"('{p}', {float(v)})" in best for p, v in ((r.param, r.value) for r in models.best_params(model, ["maxDepth", "numTrees"]).collect())] == [True, True]
    assert models.explain_best(model, ["maxDepth"])[0].startswith("maxDepth")


def test_wrong_rows_are_refused(spark):
    bad = models.array_features(spark.createDataFrame([(0.5, [1.0]), (1.0, [2.0])], "class double, a array<double>"), "a")
    with pytest.raises(Exception, match="whole numbers"):
        models.estimator("forest").fit(bad)
    with pytest.raises(ValueError, match="depth"):
        models.estimator("forest", maxDepth=31)


@pytest.mark.parametrize(("trees", "depth", "local"), [(3, 30, 2000), (1, 4, 2000), (2, 0, 100), (2, 3, 100)])
def test_rows_of_many_tasks_grow_the_same_forest(spark, monkeypatch, trees, depth, local):
    train, val, _ = _rows(spark)
    train, val = models.materialize_split(train.repartition(4, "id")), val.repartition(3, "id")
    est = models.estimator("forest", numTrees=trees, maxDepth=depth)
    whole = est.fit(train)
    monkeypatch.setattr(forest, "LOCAL_BYTES", local)
    monkeypatch.setattr(forest, "WAVE", 2)
    parted = est.fit(train)
    tops, parts = parted.parted
    assert whole.packed and len(tops) == trees and (depth == 0 or max(len(t.feature) for t in tops) > 1) and parts.count() >= trees
    want, got = ({r["id"]: r["prediction"] for r in m.transform(val).collect()} for m in (whole, parted))
    assert got == want and len(got) == val.count()
    assert parted.transform(val).columns == whole.transform(val).columns
