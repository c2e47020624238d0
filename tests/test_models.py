"""Model tests are rows-only plus shape and repeatability (the embeddings
carry no label signal worth asserting on)."""

from pyspark.sql import functions as F

from rankforge.operators import split
from rankforge.plans import models

SF = "/root/testdata/sf0.001"


def _data(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    vec = models.array_features(
        e.select("vec_id", F.col("label").cast("double").alias("class"), "embedding"), "embedding"
    ).drop("embedding")
    return split.exact_split(vec, ["vec_id"])


def test_sweep_table_shape_and_selection(spark):
    train, val, test = _data(spark)
    t = models.sweep("lr", "maxIter", [1, 5], train, val, test)
    rows = t.orderBy("ordinal").collect()
    assert [r.value for r in rows] == [1.0, 5.0]
    assert sum(r.is_best for r in rows) == 1
    assert all(0.0 <= r.val <= 1.0 and r.fit_seconds >= 0 for r in rows)
    best = max(rows, key=lambda r: (r.val, -r.ordinal))
    assert best.is_best


def test_rf_depth_is_checked_and_repeatable(spark):
    train, val, test = _data(spark)
    a = models.sweep("rf", "maxDepth", [30], train, val, test, numTrees=3).collect()[0]
    b = models.sweep("rf", "maxDepth", [30], train, val, test, numTrees=3).collect()[0]
    assert (a.train, a.val, a.test) == (b.train, b.val, b.test)


def test_mlp_needs_indexed_labels(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "class double")
    idx = {r["class"]: r.label for r in models.index_labels(df).collect()}
    assert idx == {0.0: 0.0, 1.0: 1.0, 10.0: 2.0}


def test_cross_validate_rows(spark):
    train, _, test = _data(spark)
    model, table, test_f1 = models.cross_validate("lr", {"regParam": [0.01, 0.1]}, train, test, maxIter=5)
    assert table.count() == 2 and table.where("is_best").count() == 1
    assert 0.0 <= test_f1 <= 1.0
    text = models.explain_best(model, ["regParam"])
    assert text[0].startswith("regParam")
    chosen = models.best_params(model, ["regParam", "maxIter"]).collect()
    assert [(r["param"], float(r["value"])) for r in chosen] == [("regParam", model.bestModel.stages[-1].getRegParam()), ("maxIter", 5.0)]
    pred = models.predict(model, test).select("prediction").distinct().collect()
    assert all(0 <= r.prediction <= 9 for r in pred)


def test_registered_cv_grids_are_whole():
    from rankforge.plans.catalogue import CV_GRIDS

    assert CV_GRIDS["lr"] == {"regParam": models.REG_PARAMS, "maxIter": models.MAX_ITERS}
    assert CV_GRIDS["rf"] == {"maxDepth": [1, 5, 10, 20, 30], "numTrees": models.NUM_TREES}
    assert [x[1] for x in CV_GRIDS["mlp"]["layers"]] == models.HIDDEN_WIDTHS and CV_GRIDS["mlp"]["maxIter"] == models.MAX_ITERS


def test_cross_validate_over_layers(spark):
    train, _, test = _data(spark)
    d, k = len(train.first()["features"]), int(train.agg({"class": "max"}).first()[0]) + 1
    grid = {"layers": [models.mlp_layers(d, h, k) for h in (1, 3)], "maxIter": [1, 2]}
    _, table, _ = models.cross_validate("mlp", grid, train, test)
    assert sorted(r.params for r in table.collect()) == sorted(str([("layers", float(h)), ("maxIter", float(m))]) for h in (1, 3) for m in (1, 2))


def test_best_predictions_are_those_of_the_selected_model(spark):
    train, val, test = _data(spark)
    fitted = []
    table = models.sweep("lr", "maxIter", [1, 20], train, val, test, fitted=fitted)
    best = table.where("is_best").first()["ordinal"]
    got = models.best_predictions(fitted, table, test).select("prediction").collect()
    assert got == fitted[best].transform(test).select("prediction").collect() and len(fitted) == 2


def test_one_against_the_rest(spark):
    train, _, test = _data(spark)
    model = models.estimator("ovr_svc", maxIter=2).fit(train)
    assert model.transform(test).count() == test.count()


def test_a_small_split_is_dealt_over_the_cores(spark):
    df = spark.range(12_000).coalesce(1)
    saved = models.materialize_split(df)
    filled = saved.groupBy(F.spark_partition_id()).count().collect()
    assert len(filled) == min(3, spark.sparkContext.defaultParallelism) and saved.count() == 12_000
    assert models.materialize_split(spark.range(100).repartition(4)).select(F.spark_partition_id()).distinct().count() == 1


def test_forests_keep_node_ids(spark):
    assert models.estimator("rf").getCacheNodeIds() and not models.estimator("rf", cacheNodeIds=False).getCacheNodeIds()


def test_forest_fits_share_the_cores(spark, monkeypatch):
    """A forest's rows lie in as many partitions as one of the fits has cores;
    other families' in as many as there are cores."""
    cores = spark.sparkContext.defaultParallelism
    train, val, test = _data(spark)
    monkeypatch.setattr(models, "SPREAD_ROWS", 1)
    assert models.materialize_split(train).rdd.getNumPartitions() == min(cores, train.count())
    seen, estimator = {}, models.estimator

    def watched(family, *args, **params):
        est = estimator(family, *args, **params)
        fit = est.fit
        monkeypatch.setattr(est, "fit", lambda d: seen.update({family: d.rdd.getNumPartitions()}) or fit(d))
        return est

    monkeypatch.setattr(models, "estimator", watched)
    models.sweep("rf", "maxDepth", [1], train, val, test, numTrees=2, parallelism=4)
    models.sweep("lr", "maxIter", [1], train, val, test, parallelism=4)
    assert seen == {"rf": max(1, cores // 2), "lr": min(cores, train.count())}


def test_sweeps_of_the_confusion_matrices_overlap(spark, monkeypatch):
    from threading import Barrier

    from rankforge.plans import catalogue

    together = Barrier(4)

    class Zero:
        def transform(self, data):
            return data.withColumn("prediction", F.lit(0.0))

    def sweep(family, param, values, train, val, test, fitted, **options):
        together.wait(timeout=60)
        fitted += [Zero() for _ in values]
        return spark.createDataFrame([(0, True)], "ordinal int, is_best boolean")

    monkeypatch.setattr(models, "sweep", sweep)
    rows = catalogue.q_sweep_confusion(spark, SF).collect()
    assert {r["family"] for r in rows} == {"lr", "rf", "mlp", "binary_rf"}
    assert sum(r["predicted_0"] for r in rows if r["family"] == "rf") == _data(spark)[2].count()
    assert all(r["predicted_1"] == 0 for r in rows)
