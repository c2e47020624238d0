import datetime as dt

from pyspark.sql import functions as F

from rankforge.operators import chart
from rankforge.schemas import CHART_RAW


def _raw(spark, rows):
    return spark.createDataFrame(rows, CHART_RAW)


def test_parse_bad_values_become_null(spark):
    raw = _raw(spark, [("2020-01-04", "NA", "a", "x"), (None, "3", "a", "x"), ("bad", "7", "b", "y")])
    out = chart.parse_chart(raw).collect()
    assert [r["rank"] for r in out] == [None, 3, 7]
    assert [r["date"] for r in out] == [dt.date(2020, 1, 4), None, None]


def test_best_rank_strict_bound_nulls_and_keys(spark):
    raw = _raw(spark, [
        ("2022-12-31", "10", "s1", "a"),
        ("2023-01-01", "1", "s1", "a"),     # on the bound: dropped
        ("2022-06-01", "101", "s1", "a"),
        ("2022-06-01", "NA", "s2", "a"),    # only null ranks -> null top_rank
        (None, "1", "s3", "a"),             # null date drops
        ("2022-06-01", "11", "s1", "A"),    # keys are case-sensitive
        ("2022-06-01", "5", None, "a"),     # null key forms a group
    ])
    best = chart.best_rank(chart.parse_chart(raw), before="2023")
    got = {(r.song, r.artist): r.top_rank for r in best.collect()}
    assert got == {("s1", "a"): 10, ("s2", "a"): None, ("s1", "A"): 11, (None, "a"): 5}


def test_classify_buckets_and_order(spark):
    best = spark.createDataFrame(
        [("b", "x", 5), ("a", "x", 73), ("c", "x", 1), ("d", "x", 10), ("e", "x", 11),
         ("f", "x", 100), ("g", "x", 101), ("h", "x", 111), ("i", "x", None)],
        "song string, artist string, top_rank int",
    )
    out = chart.classify(best).collect()
    assert [r.song for r in out] == list("abcdefghi")
    assert {r.song: r["class"] for r in out} == {
        "a": 7, "b": 0, "c": 0, "d": 0, "e": 1, "f": 9, "g": 10, "h": 11, "i": None
    }
    assert dict(chart.classify(best).dtypes)["class"] == "bigint"
    clamped = {r.song: r["class"] for r in chart.classify(best, clamp=True).collect()}
    assert clamped["h"] == 10 and clamped["f"] == 9


def test_classify_with_default(spark):
    feats = spark.createDataFrame(
        [("s1", "a", 1.0), ("s2", "a", 2.0), ("s1", "b", 3.0)], "song string, artist string, energy double"
    )
    cls = spark.createDataFrame([("s1", "a", 3), ("zz", "a", 1)], "song string, artist string, class bigint")
    out = chart.classify_with_default(feats, cls)
    assert out.columns == ["song", "artist", "class", "energy"]
    assert sorted((r.song, r.artist, r["class"]) for r in out.collect()) == [
        ("s1", "a", 3), ("s1", "b", 10), ("s2", "a", 10)
    ]


def test_restrict_to_years_ignores_unknown_year(spark):
    c = spark.createDataFrame(
        [(dt.date(y, 5, 1), 1, "s", "a") for y in (1990, 1995, 2000, 2005)],
        "date date, rank int, song string, artist string",
    )
    ref = spark.createDataFrame([(0,), (1995,), (2000,)], "year int")
    years = sorted(r.date.year for r in chart.restrict_to_years_of(c, ref).collect())
    assert years == [1995, 2000]


def test_best_rank_plan_pushes_date_filter(spark, tmpdir_path):
    path = f"{tmpdir_path}/chart"
    spark.createDataFrame(
        [(dt.date(2020, 1, 1), 3, "s", "a")], "date date, rank int, song string, artist string"
    ).write.parquet(path)
    plan = chart.best_rank(spark.read.parquet(path), before="2021")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(date), LessThan(date,2021-01-01)]" in plan
    assert F is not None


def test_year_range_reaches_the_scan(spark, tmpdir_path):
    path = f"{tmpdir_path}/chart_years"
    spark.createDataFrame(
        [(dt.date(y, 3, 1), 1, "s", "a") for y in (1990, 1996, 2003)],
        "date date, rank int, song string, artist string",
    ).write.parquet(path)
    ref = spark.createDataFrame([(0,), (1995,), (1999,)], "year int")
    out = chart.restrict_to_years_of(spark.read.parquet(path), ref)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,1995-01-01)" in plan and "LessThan(date,2000-01-01)" in plan
    assert [r.date.year for r in out.collect()] == [1996]
