import random

from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from rankforge.plans import evaluate


def _pred(spark, n=400, seed=3):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        y = float(rnd.choice([0, 1, 2, 5]))
        p = y if rnd.random() < 0.6 else float(rnd.choice([0, 1, 2, 7]))  # 7 never actual
        rows.append((y, p))
    return spark.createDataFrame(rows, "class double, prediction double")


def test_weighted_f1_matches_evaluator(spark):
    pred = _pred(spark)
    ours = evaluate.weighted_f1(pred).collect()[0][0]
    ref = MulticlassClassificationEvaluator(labelCol="class", metricName="f1").evaluate(pred)
    assert abs(ours - ref) < 1e-12


def test_accuracy_equals_micro_f1(spark):
    pred = _pred(spark)
    acc = evaluate.accuracy(pred).collect()[0][0]
    ref = MulticlassClassificationEvaluator(labelCol="class", metricName="accuracy").evaluate(pred)
    assert abs(acc - ref) < 1e-12


def test_confusion_matrix_drops_prediction_only_labels(spark):
    pred = spark.createDataFrame(
        [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 7.0), (2.0, 0.0)], "class double, prediction double"
    )
    m = evaluate.confusion_matrix(pred)
    assert m.columns == ["actual", "0.0", "1.0", "2.0"]
    rows = {r.actual: tuple(r)[1:] for r in m.collect()}
    assert rows == {0.0: (1, 1, 0), 1.0: (0, 1, 0), 2.0: (1, 0, 0)}
    long = {(r.actual, r.predicted): r.n for r in evaluate.confusion_counts(pred).collect()}
    assert long[(1.0, 7.0)] == 1


def test_mark_best_first_on_ties(spark):
    scores = spark.createDataFrame(
        [(0, 0.5), (1, 0.8), (2, 0.8), (3, 0.1)], "ordinal int, val double"
    )
    best = [r.ordinal for r in evaluate.mark_best(scores).where("is_best").collect()]
    assert best == [1]


def test_histogram_equal_width(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "v double")
    h = {r.bin: r.n for r in evaluate.class_histogram(df, "v", bins=5).collect()}
    assert h == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}  # last bin closed on the right
    by_class = {r.v: r.n for r in evaluate.class_histogram(df, "v").collect()}
    assert by_class[10.0] == 1


def test_shape_labels_and_distinct_count(spark):
    df = spark.createDataFrame([(3, "a"), (1, "b"), (3, "c"), (10, "d")], "class int, song string")
    assert [tuple(r) for r in evaluate.shape(df).collect()] == [(4, 2)]
    assert [r["class"] for r in evaluate.sorted_labels(df).collect()] == [1, 3, 10]
    assert evaluate.distinct_label_count(df).collect()[0].n_labels == 3


def test_compare_families_replaces_the_sweeps_own_family_column(spark):
    a = spark.createDataFrame([("x", 0, 0.5)], "family string, ordinal int, val double")
    b = spark.createDataFrame([(1, 0.7)], "ordinal int, val double")
    got = evaluate.compare_families({"lr": a, "rf": b})
    assert got.columns == ["family", "ordinal", "val"]
    assert sorted(map(tuple, got.collect())) == [("lr", 0, 0.5), ("rf", 1, 0.7)]
