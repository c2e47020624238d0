import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.operators import shards
from rankforge.sources import csv as src
from rankforge.sources import sinks


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_dropmalformed_drops_short_and_long_lines(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "chart.csv")
    _write(p, "date,rank,song,artist\n2020-01-04,1,a,x\n2020-01-04,2,b\n2020-01-04,3,c,y,extra\n2020-01-04,NA,d,z\n")
    df = src.read_csv_strict_rows(spark, p)
    assert df.count() == 2
    assert sorted(r.song for r in df.select("song").collect()) == ["a", "d"]


def test_skip_long_keeps_short_lines(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "clean.csv")
    _write(p, 'song,artist,class\n"Hello, Goodbye",The Beatles,4\nx,y,1,2\nshort,z\n')
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("song", "artist", "class")])
    rows = src.read_csv_skip_long(spark, p, schema).collect()
    assert [(r.song, r.artist, r["class"]) for r in rows] == [
        ("Hello, Goodbye", "The Beatles", "4"), ("short", "z", None)
    ]


def test_read_many_glob_and_typed(spark, tmpdir_path):
    for i in range(3):
        _write(os.path.join(tmpdir_path, f"part_{i}.csv"), f"a,b\n{i},x{i}\n")
    _write(os.path.join(tmpdir_path, "other.csv"), "a,b\n9,y\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    df = src.read_many(spark, tmpdir_path, pattern="part_*.csv", schema=schema, header=True)
    assert sorted(r.a for r in df.collect()) == [0, 1, 2]


def test_sharded_stage_resumes(spark, tmpdir_path):
    rows = spark.range(0, 2500).selectExpr("CAST(id AS STRING) AS song", "'a' AS artist")
    sharded = shards.assign_shards(rows, ["song"], size=1000)
    sizes = {r.shard_id: r["count"] for r in sharded.groupBy("shard_id").count().collect()}
    assert sizes == {0: 1000, 1: 1000, 2: 500}
    out = os.path.join(tmpdir_path, "stage")
    calls = []

    def stage(df):
        calls.append(1)
        return df.withColumn("done", F.lit(True))

    first = shards.run_sharded_stage(sharded.where("shard_id = 0"), stage, out)
    assert first.count() == 1000
    full = shards.run_sharded_stage(sharded, stage, out)
    assert full.count() == 2500 and full.select("song").distinct().count() == 2500


def test_sharded_stage_resumes_after_empty_shards(spark, tmpdir_path):
    rows = spark.range(5).selectExpr("id", "CAST(id % 2 AS BIGINT) AS shard_id")
    for keep, n in (("shard_id = 1", 2), ("false", 0)):
        out, seen = os.path.join(tmpdir_path, f"stage{n}"), []

        def stage(df, keep=keep, seen=seen):
            seen.append(sorted(r.shard_id for r in df.select("shard_id").distinct().collect()))
            return df.where(keep)

        assert shards.run_sharded_stage(rows, stage, out).count() == n
        assert shards.run_sharded_stage(rows, stage, out).count() == n
        assert seen == [[0, 1], []]


def test_csv_sinks_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([("a, b", 1)], "song string, class int")
    sinks.write_single_csv(df, os.path.join(tmpdir_path, "one"))
    files = [f for f in os.listdir(os.path.join(tmpdir_path, "one")) if f.endswith(".csv")]
    assert len(files) == 1
    back = src.read_csv_typed(spark, os.path.join(tmpdir_path, "one"), schema=df.schema)
    assert [tuple(r) for r in back.collect()] == [("a, b", 1)]


def test_read_lines_keeps_file_order(spark, tmpdir_path):
    from rankforge.operators.ordinal import with_ordinal

    d = os.path.join(tmpdir_path, "raw")
    os.makedirs(d)
    _write(os.path.join(d, "a.csv"), "".join(f"a{i},x,1\n" for i in range(50)))
    _write(os.path.join(d, "b.csv"), "".join(f"b{i},y,2\n" for i in range(30)))
    lines = src.read_lines(spark, d)
    ranked = with_ordinal(lines, ["file", "block", "row_in_task"])
    got = [r.value.split(",")[0] for r in ranked.orderBy("ordinal").collect()]
    assert got == [f"a{i}" for i in range(50)] + [f"b{i}" for i in range(30)]


def test_bucketed_feature_table_is_not_shuffled(spark):
    from rankforge.operators import chart, enrich

    feats = spark.range(0, 2000).selectExpr(
        "CAST(id % 500 AS STRING) AS title", "CAST(id % 3 AS STRING) AS artist_name", "CAST(id AS INT) AS year"
    )
    sinks.write_bucketed(feats, "features_bucketed", ["title", "artist_name"], 8)
    chart_rows = spark.range(0, 3000).selectExpr(
        "CAST(id % 700 AS STRING) AS song", "CAST(id % 3 AS STRING) AS artist", "CAST(id % 90 + 1 AS INT) AS rank"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich.join_features(
            chart.classify(chart.best_rank(chart_rows), sort=False), spark.table("features_bucketed")
        )
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one exchange: the chart aggregate; the bucketed side is read in place
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_inferred_and_quote_escaped_csv(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "feat.csv")
    _write(p, 'song,artist,class,energy\n"He said ""hi""",A,3,0.5\nB,C,10,1.25\n')
    inferred = src.read_csv_typed(spark, p, infer=True, quote_escape=True)
    types = dict(inferred.dtypes)
    assert types["class"] == "int" and types["energy"] == "double"
    assert sorted(r.song for r in inferred.collect()) == ["B", 'He said "hi"']


def test_scale_conf_sizes_partitions():
    from rankforge.session import scale_conf

    big = scale_conf(100 * 10**12)
    assert int(big["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert scale_conf(10**6)["spark.sql.shuffle.partitions"] == "200"


def test_a_run_that_broke_off_is_not_read(spark, tmpdir_path):
    rows = spark.range(0, 5000).selectExpr("id", "id DIV 100 AS shard_id")
    out = os.path.join(tmpdir_path, "stage")
    shards.run_sharded_stage(rows.where("shard_id < 20"), lambda d: d, out)
    rows.write.parquet(os.path.join(out, "brokenoff"))
    full = shards.run_sharded_stage(rows, lambda d: d, out)
    assert full.count() == 5000 == full.distinct().count()
    assert shards.combine_shards(spark, out).count() == 5000
    before = sorted(os.listdir(out))
    assert shards.run_sharded_stage(rows, lambda d: d, out).count() == 5000
    assert sorted(os.listdir(out)) == before  # nothing to do, nothing written
    assert len(before) == 3  # a folder for each run, not for each of 50 shards
    assert shards.combine_shards(spark, out + "-none").count() == 0


def test_write_shards_keeps_the_shard_as_a_column(spark, tmpdir_path):
    rows = spark.range(0, 3000).selectExpr("id", "id DIV 10 AS shard_id")
    out = os.path.join(tmpdir_path, "shards")
    sinks.write_shards(rows, out)
    assert spark.read.parquet(out).where("shard_id = 7").count() == 10
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) < 30


def test_feature_groups_from_files(spark, tmpdir_path):
    paths = [os.path.join(tmpdir_path, n) for n in ("a", "b")]
    spark.createDataFrame([("f", 1, 0.5), ("f", 2, 0.6)], "file_id string, row_idx int, x double").write.parquet(paths[0])
    spark.createDataFrame([("f", 1, "t")], "file_id string, row_idx int, y string").write.parquet(paths[1])
    from rankforge.operators import enrich

    joined = enrich.row_aligned_concat(src.read_feature_groups(spark, paths), keep=["x", "y"])
    assert [tuple(r) for r in joined.collect()] == [(0.5, "t")]


def test_dedupe_any_keeps_one_row_per_key(spark):
    from rankforge.operators import clean

    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    got = clean.dedupe_any(df, ["k"]).collect()
    assert sorted(str(r.k) for r in got) == ["1", "2", "None"]
