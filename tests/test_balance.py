from pyspark.sql import functions as F

from rankforge.operators import balance


def _labelled(spark, sizes):
    rows = [(f"s{c}_{i}", "a", c) for c, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "song string, artist string, class int")


def _counts(df):
    return {r["class"]: r["n"] for r in balance.class_counts(df).collect()}


def test_cap_classes_only_listed_and_only_above_n(spark):
    df = _labelled(spark, {0: 50, 10: 31, 5: 10, 3: 40, 7: 30})
    out = balance.cap_classes(df, labels=[0, 10, 7], n=30, keys=["song", "artist"])
    assert _counts(out) == {0: 30, 10: 30, 5: 10, 3: 40, 7: 30}
    # sample rows come from their class and are unique
    assert out.count() == out.dropDuplicates(["song"]).count()
    again = balance.cap_classes(df, labels=[0, 10, 7], n=30, keys=["song", "artist"])
    assert sorted(r.song for r in out.collect()) == sorted(r.song for r in again.collect())


def test_binary_relabel_null_is_zero(spark):
    df = spark.createDataFrame([(10,), (3,), (None,)], "class int")
    assert [r["class"] for r in balance.binary_relabel(df).collect()] == [1, 0, 0]


def test_equalize_modes(spark):
    df = _labelled(spark, {0: 20, 1: 35})
    assert _counts(balance.equalize_classes(df, ["song", "artist"])) == {0: 20, 1: 20}
    # reference quirk: only class 0 is cut, class 1 stays whole
    assert _counts(balance.equalize_classes(df, ["song", "artist"], mode="reference")) == {0: 20, 1: 35}


def test_add_default_class_sample_size(spark):
    chart_rows = spark.createDataFrame([(f"s{i}", "a", 1) for i in range(39)], "song string, artist string, class bigint")
    source = spark.createDataFrame([(f"t{i}", "b") for i in range(100)], "title string, artist_name string")
    out = balance.add_default_class_sample(chart_rows, source)
    # (39 rows + header) / 10 = 4
    assert out.where(F.col("class") == 10).count() == 4 and out.count() == 43
    small = spark.createDataFrame([("t0", "b")], "title string, artist_name string")
    assert balance.add_default_class_sample(chart_rows, small).count() == 40  # asks 4, only 1 exists


def test_seeded_sample_independent_of_partitioning(spark):
    df = spark.range(0, 500).selectExpr("CAST(id AS STRING) AS k")
    a = {r.k for r in balance.seeded_sample(df.repartition(3), 50, ["k"]).collect()}
    b = {r.k for r in balance.seeded_sample(df.repartition(7), 50, ["k"]).collect()}
    assert a == b and len(a) == 50


def test_candidates_are_an_exact_superset(spark):
    df = _labelled(spark, {0: 400, 1: 250, 2: 30})
    got = balance.exact_sample_per_class(df, 200, ["song", "artist"])
    assert _counts(got) == {0: 200, 1: 200, 2: 30}
    some = balance._candidates(df, 20, ["song", "artist"], 0, ["class"])
    assert all(20 <= n < 60 for n in _counts(some).values())
    ranked = balance.sample_rank(df, ["song", "artist"], 0, ["class"]).where("sample_rank <= 20")
    assert {r.song for r in ranked.collect()} <= {r.song for r in some.collect()}


