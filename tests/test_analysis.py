"""Neighbours, feature analysis, word counts, regression and boosting."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from rankforge.operators import neighbours, words
from rankforge.plans import analysis, boosting, features, regression
from rankforge.plans.evaluate import weighted_f1

SF = "/root/testdata/sf0.001"


# --- neighbours --------------------------------------------------------------

def _points(spark, n=600, width=3, copies=150, seed=1):
    dice = np.random.default_rng(seed)
    x = dice.normal(size=(n, width)).round(3)
    x[n - copies:] = x[0]  # one vector that many rows share
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(x)] + [(None, [0.0] * width), (n + 5, None)]
    return spark.createDataFrame(rows, "id long, v array<double>").select("id", neighbours.fixed_point(F.col("v")).alias("x")).repartition(6), np.round(x * 10_000)


def _nearest(x, ids, queries, k):
    out = {}
    for q in queries:
        d = ((x - x[q]) ** 2).sum(1)
        out[q] = [(ids[i], int(d[i])) for i in np.lexsort((ids, d)) if ids[i] != q][:k]
    return out


def _found(df):
    out = {}
    for r in df.orderBy("query", "nth").collect():
        out.setdefault(r["query"], []).append((r["id"], r["distance"]))
    return out


@pytest.mark.parametrize("block_bytes", [neighbours.BLOCK_BYTES, 300])
def test_exact_search(spark, block_bytes):
    table, x = _points(spark)
    queries = table.where("id % 20 = 0")
    want = _nearest(x, np.arange(len(x)), range(0, len(x), 20), 7)
    assert _found(neighbours.nearest_exact(queries, table, 7, block_bytes=block_bytes)) == want


def test_bucketed_search_has_recall_and_whole_answers(spark):
    table, x = _points(spark, n=4000, copies=1300)
    queries = table.where("id % 20 = 0")
    want = _nearest(x, np.arange(len(x)), range(0, len(x), 20), 5)
    got = _found(neighbours.nearest_bucketed(queries, table, 5))
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 5 * len(want)


def test_search_in_little(spark):
    table, _ = _points(spark, n=3, copies=0)
    none = table.where("false")
    for search in (neighbours.nearest_exact, neighbours.nearest_bucketed):
        assert {q: len(v) for q, v in _found(search(table, table, 5)).items()} == {0: 2, 1: 2, 2: 2}
        assert search(none, table, 5).count() == 0 and search(table, none, 5).count() == 0


@pytest.mark.parametrize("points", [neighbours.CELL_POINTS, 20])
def test_cells_pass_on_the_best_rows_only(spark, monkeypatch, points):
    monkeypatch.setattr(neighbours, "CELL_POINTS", points)
    dice = np.random.default_rng(3)
    x = dice.integers(0, 12, size=(500, 2)).astype(float)
    held = spark.createDataFrame([(int(i % 3), p.tolist(), [1000 + i, 2000 + i]) for i, p in enumerate(x)], "cell long, x array<double>, ids array<long>")
    asked = spark.createDataFrame([(q, [float(q % 12), 5.0], c) for q in (1003, 1004, 7) for c in (0, 1, 9)], "query long, qx array<double>, cell long")
    got = neighbours._cell_candidates(asked.repartition(3), held.repartition(4), 2, 4)
    found = {}
    for r in got.collect():
        found.setdefault((r["query"], (r["id"] % 1000) % 3), []).append((r["distance"], r["id"]))
    assert set(found) == {(q, c) for q in (1003, 1004, 7) for c in (0, 1)}
    for (q, c), rows in found.items():
        want = sorted((int(((x[i] - [q % 12, 5.0]) ** 2).sum()), j) for i in range(c, 500, 3) for j in (1000 + i, 2000 + i) if j != q)[:4]
        assert sorted(rows)[:4] == want
        assert len(rows) == 4 if points > 500 else 4 < len(rows) <= 4 * 12
    plan = got._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Generate explode(ids" not in plan


def test_bucketed_search_keeps_repeated_ids(spark):
    rows = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [1.0, 0.0]), *[(i, [float(i), 3.0]) for i in range(3, 40)]]
    table = spark.createDataFrame(rows, "id long, x array<double>")
    asked = spark.createDataFrame([(100, [0.0, 0.0])], "id long, x array<double>")
    for search in (neighbours.nearest_exact, neighbours.nearest_bucketed):
        assert _found(search(asked, table, 3)) == {100: [(1, 0), (1, 0), (2, 1)]}


def test_knn_classes_break_ties_by_the_smaller_class(spark):
    train = spark.createDataFrame([(1, 0.0, 3), (2, 0.1, 2), (3, 0.2, 2), (4, 0.3, 3), (5, 9.0, None)], "id long, f double, class int")
    asked = spark.createDataFrame([(10, 0.0), (11, 9.0)], "id long, f double")
    got = {r["query"]: tuple(r)[1:] for r in neighbours.knn_predict(train, asked, 4, "id", ["f"], "class").collect()}
    assert got == {10: (2, 2, 1), 11: (2, 2, 5)} or got == {10: (2, 2, 1), 11: (2, 2, 4)}


def test_impute_similar(spark):
    rows = [(i, float(i // 10), float(i % 3), float(i // 10) * 100 if i % 10 else None, "k") for i in range(100)]
    rows += [(200, None, 1.0, None, "x"), (201, 2.0, float("nan"), 5.0, "x"), (202, 3.0, 1.0, float("nan"), "x")]
    df = spark.createDataFrame(rows, "id long, a double, b double, t double, similar_to string")
    got = {r["id"]: r for r in neighbours.impute_similar(df, "id", ["a", "b"], ["t"], 3, scales=[1.0, 1000.0]).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["t"] == i // 10 * 100 and got[i]["similar_to"] == "k" for i in range(100))
    assert [j // 10 for j in got[50]["similar"]["t"]] == [5, 5, 5] and got[11]["similar"]["t"] is None
    assert got[200]["t"] is None and got[201]["t"] == 5.0 and got[202]["t"] == 300.0


def test_recall_of_imputation_on_the_table(spark):
    got = {r["record_id"]: r["similar"] for r in analysis.q_impute_similar(spark, SF).collect()}
    rows = analysis.song_records(spark, SF).select("record_id", "duration", "energy", "danceability", "song_hotttnesss").collect()
    x = np.array([tuple(r)[1:4] for r in rows])
    x, ids = np.round(x / x.std(0) * 10_000), np.array([r[0] for r in rows])
    has = np.array([r[4] is not None for r in rows])
    assert sorted(got) == sorted(ids[~has].tolist())
    hits = 0
    for i in np.flatnonzero(~has):
        d = ((x[has] - x[i]) ** 2).sum(1)
        hits += len(set(ids[has][np.lexsort((ids[has], d))[:5]].tolist()) & set(got[ids[i]]))
    assert hits >= 0.9 * 5 * len(got)


# --- features ----------------------------------------------------------------

def _mixed(spark):
    dice = random.Random(3)
    rows = [(i, dice.gauss(0, 1), None if i % 7 == 0 else dice.gauss(5, 2), float("nan") if i % 5 == 0 else dice.random(), 1.0) for i in range(400)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, same double").repartition(5), rows


def test_correlation_leaves_null_pairs_out(spark):
    df, rows = _mixed(spark)
    names = ["a", "b", "c", "same"]
    got = {(r["a"], r["b"]): r for r in features.correlation(features.moments(df, names)).collect()}
    for i, j in ((0, 1), (0, 2), (1, 2)):
        pairs = np.array([(r[i + 1], r[j + 1]) for r in rows if r[i + 1] is not None and r[j + 1] is not None and not math.isnan(r[i + 1] + r[j + 1])])
        r = got[names[i], names[j]]
        assert r["n"] == len(pairs) and r["pearson"] == pytest.approx(np.corrcoef(pairs.T)[0, 1])
    assert got["a", "same"]["pearson"] is None
    assert features.correlation(features.moments(df.where("false"), names)).count() == 0


def test_both_moments_agree_and_pca_reconstructs(spark):
    dice = np.random.default_rng(4)
    x = dice.normal(size=(500, 4)) @ dice.normal(size=(4, 4)) + 100
    names = ["p", "q", "r", "s"]
    df = spark.createDataFrame([([float(v) for v in r],) for r in x] + [(None,)], "v array<double>").repartition(4)
    wide = df.where("v is not null").select(*[F.col("v")[i].alias(n) for i, n in enumerate(names)])
    one, two = (sorted(map(tuple, m.collect())) for m in (features.array_moments(df, "v", names), features.moments(wide, names)))
    assert [r[:3] for r in one] == [r[:3] for r in two]
    assert np.allclose([r[3:] for r in one], [r[3:] for r in two])
    values, vectors, mean = features.pca(features.array_moments(df, "v", names), names)
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1])
    scores = np.array([r["scores"] for r in features.project(df.where("v is not null"), "v", vectors[:2], mean).collect()])
    back = scores @ vectors[:2] + mean
    rows = np.array([r["v"] for r in df.where("v is not null").collect()])
    assert ((np.sort(((rows - back) ** 2).sum(1))).mean()) == pytest.approx(values[2:].sum())
    table = features.pca_variance(features.array_moments(df, "v", names), names).collect()
    assert table[-1]["cumulative"] == pytest.approx(1.0) and max(table[0]["loadings"], key=abs) > 0


def test_jaccard(spark):
    df, rows = _mixed(spark)
    cuts = features.quantile_cuts(df, ["a", "b"])
    for i, c in ((1, "a"), (2, "b")):
        values = sorted(r[i] for r in rows if r[i] is not None)
        assert cuts[c] == values[math.ceil(len(values) / 2) - 1]
    above = {c: {r[0] for r in rows if r[i] is not None and r[i] > cuts[c]} for i, c in ((1, "a"), (2, "b"))}
    got = features.jaccard(df, ["a", "b", "same"], {**cuts, "same": 1.0}).collect()
    both = next(r for r in got if (r["a"], r["b"]) == ("a", "b"))
    assert (both["n_both"], both["n_either"]) == (len(above["a"] & above["b"]), len(above["a"] | above["b"]))
    assert features.jaccard(df, ["c", "same"], {"c": 2.0, "same": 1.0}).first()["jaccard"] is None


def test_permutation_importance(spark):
    dice = random.Random(9)
    df = spark.createDataFrame([(i, *(x := (dice.random(), dice.random())), int(x[0] > 0.5)) for i in range(2000)], "id long, a double, b double, y int")
    donors = features.with_donors(df, "id", ["a"]).collect()
    assert sorted(r["donor"]["a"] for r in donors) == sorted(r["a"] for r in donors) and sum(r["donor"]["a"] != r["a"] for r in donors) > 1900
    out = features.permutation_importance(df, "id", ["a", "b"], "y", lambda d: d.withColumn("prediction", (F.col("a") > 0.5).cast("int")))
    got = {r["feature"]: r for r in out.collect()}
    assert got["a"]["base_accuracy"] == 1.0 and 0.4 < got["a"]["importance"] < 0.6 and got["b"]["importance"] == 0.0


# --- words -------------------------------------------------------------------

def test_word_counts_round_trip(spark):
    texts = [(1, "The cat, the CAT; a dog"), (2, None), (3, ""), (4, "... !!"), (5, "Ünï the dog 9"), (6, "zebra")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    vocab = words.vocabulary(df, size=4).cache()
    assert [tuple(r) for r in vocab.orderBy("word_index").collect()] == [("the", 1, 3), ("cat", 2, 2), ("dog", 3, 2), ("9", 4, 1)]
    sparse = words.count_words(df, "doc_id", vocab)
    assert sorted(map(tuple, sparse.collect())) == [
        (1, 6, 5, "1:2,2:2,3:1"), (2, 0, 0, ""), (3, 0, 0, ""), (4, 0, 0, ""), (5, 4, 3, "1:1,3:1,4:1"), (6, 1, 0, "")]
    back = words.read_counts(sparse, "doc_id", vocab)
    assert sorted(map(tuple, back.collect())) == [(1, "cat", 2, 2), (1, "dog", 3, 1), (1, "the", 1, 2), (5, "9", 4, 1), (5, "dog", 3, 1), (5, "the", 1, 1)]


def test_word_counts_without_a_row_per_word(spark):
    texts = [(1, "a b a"), (1, "b c"), (None, "a"), (None, "A-a z"), (2, None), (3, "é a\x00b\u2028c")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    vocab = words.vocabulary(df, size=3)
    assert [tuple(r) for r in vocab.orderBy("word_index").collect()] == [("a", 1, 6), ("b", 2, 2), ("b\u2028c", 3, 1)]
    # Rows that share an id, or have none, share their known words.
    got = sorted(map(tuple, words.count_words(df, "doc_id", vocab).collect()), key=str)
    ones = [r for r in got if r[0] == 1]
    assert [r[1] for r in ones] == [2, 3] and {r[3].split(",")[0] for r in ones} == {"1:2"}
    assert sorted(r[1] for r in got if r[0] is None) == [1, 3] and {r[3] for r in got if r[0] is None} == {"1:3"}
    assert (2, 0, 0, "") in got
    once = words.count_words(df.where("doc_id > 1"), "doc_id", vocab)
    for counted in (vocab, once):
        assert "Generate" not in counted._jdf.queryExecution().toString()


# --- regression and boosting -------------------------------------------------

def test_regression_metrics_equal_the_evaluator(spark):
    dice = random.Random(2)
    df = spark.createDataFrame([(float(dice.randint(1, 100)), dice.uniform(-5, 130)) for _ in range(300)], "label double, prediction double")
    got = regression.regression_metrics(df.unionByName(spark.createDataFrame([(None, 1.0)], df.schema))).first()
    for name in ("rmse", "mae", "r2"):
        assert got[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(df))
    assert regression.regression_metrics(df.where("label = 7")).first()["r2"] is None
    counts = regression.rank_bucket_confusion(df).collect()
    assert sum(r["n"] for r in counts) == 300 and max(r["prediction"] for r in counts) == 10 and min(r["prediction"] for r in counts) == 0


def test_boosting_learns_several_classes(spark):
    dice = random.Random(6)
    rows = []
    for i in range(1500):
        a, b = dice.random(), dice.random()
        rows.append((i, a, b, dice.random(), float([3, 7, 9][int(a > 0.4) + int(a > 0.4 and b > 0.6)])))
    df = spark.createDataFrame([*rows, (9999, 0.1, 0.1, 0.1, None)], "id long, a double, b double, c double, class double").repartition(5)
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0 and class is not null")
    fitted = []
    table = boosting.gbt_sweep(["a", "b", "c"], [1, 4], train, test, test, fitted=fitted, depth=2).collect()
    assert [r["value"] for r in table] == [1.0, 4.0] or sorted(r["value"] for r in table) == [1.0, 4.0]
    assert max(r["test"] for r in table) > 0.95
    model = fitted[0]
    assert model.classes == [3.0, 7.0, 9.0] and len(model.leaf) == 4
    again = boosting.fit(train.repartition(2), ["a", "b", "c"], "class", rounds=4, depth=2)
    assert (again.feature == model.feature).all() and np.allclose(again.leaf, model.leaf)
    x = np.array([r[1:4] for r in rows if r[0] % 3 == 0])
    bins = boosting._binned(model.cuts, x.ravel())
    best = np.array(model.classes)[boosting.scores(model, bins).argmax(1)]
    got = boosting.predict(model, test.orderBy("id").coalesce(1), ["a", "b", "c"], "class").collect()
    assert [r["prediction"] for r in got] == best.tolist()


def test_boosted_rounds_are_added_up_once(monkeypatch):
    dice = np.random.default_rng(4)
    model = boosting.Boosted([0.0, 1.0, 2.0], [[]] * 4, 3)
    model.feature, model.cut = dice.integers(-1, 4, (6, 3, 7)), dice.integers(0, 16, (6, 3, 7))
    model.leaf = dice.normal(size=(6, 3, 8))
    bins = dice.integers(0, 16, (200, 4))
    want, at = {0: np.zeros((200, 3))}, np.zeros((200, 3))
    for r in range(6):
        for k in range(3):
            for i, row in enumerate(bins):
                node = 0
                for level in range(3):
                    f, c = model.feature[r, k][(1 << level) - 1 + node], model.cut[r, k][(1 << level) - 1 + node]
                    node = 2 * node + int(f >= 0 and row[f] > c)
                at[i, k] += model.leaf[r, k][node]
        want[r + 1] = at.copy()
    assert all((boosting.scores(model, bins, r) == want[r]).all() for r in want)
    calls, nodes = [], boosting._nodes
    monkeypatch.setattr(boosting, "_nodes", lambda *a: calls.append(1) or nodes(*a))
    staged = [(r, s.T.copy()) for r, s in boosting._staged(model, boosting._columns(bins), [1, 4, 6])]
    assert len(calls) == 6 * 3 and all((s == want[r]).all() for r, s in staged)


def test_sweep_scores_equal_the_evaluator(spark):
    rows = [(1, 0.0, 0.0), (1, 0.0, 1.0), (1, 1.0, 1.0), (1, None, 1.0), (4, 0.0, 2.0), (4, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "rounds int, class double, prediction double")
    got = boosting._f1_by_rounds(df)
    assert got == {r: pytest.approx(weighted_f1(df.where(F.col("rounds") == r)).first()[0]) for r in (1, 4)}
