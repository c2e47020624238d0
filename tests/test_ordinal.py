import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from rankforge.operators.ordinal import with_chunk_id, with_ordinal


def test_global_ordinal_matches_row_number(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.randint(0, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v int").repartition(5)
    brute = df.withColumn("expect", F.row_number().over(Window.orderBy("v", "id")))
    for parts in (None, 5):  # window path (small input) and range path with 5 partitions
        got = with_ordinal(df, ["v", "id"], num_partitions=parts)
        bad = got.join(brute, ["id", "v"]).where("ordinal <> expect").count()
        assert bad == 0 and got.count() == 3000
        assert sorted(r.ordinal for r in got.collect()) == list(range(1, 3001))


def test_grouped_ordinal_with_hot_group(spark):
    # a third of all rows share one group
    df = spark.range(0, 9000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 7 AS STRING) END AS g",
        "md5(CAST(id AS STRING)) AS h",
    )
    got = with_ordinal(df, ["h", "id"], group_by=["g"], num_partitions=6)
    brute = df.withColumn("expect", F.row_number().over(Window.partitionBy("g").orderBy("h", "id")))
    assert got.join(brute, ["id", "g", "h"]).where("ordinal <> expect").count() == 0


def test_null_group_and_chunks(spark):
    df = spark.createDataFrame([(i, None if i < 3 else "a") for i in range(7)], "id long, g string")
    got = {r.id: r.ordinal for r in with_ordinal(df, ["id"], ["g"]).collect()}
    assert got == {0: 1, 1: 2, 2: 3, 3: 1, 4: 2, 5: 3, 6: 4}
    chunks = {r.id: r.chunk_id for r in with_chunk_id(spark.range(0, 2501), ["id"], 1000).collect()}
    assert chunks[0] == 0 and chunks[999] == 0 and chunks[1000] == 1 and chunks[2500] == 2


def test_offsets_are_not_forced_to_broadcast(spark):
    from rankforge.operators import ordinal

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(0, 2000).selectExpr("id", "CAST(id % 3 AS STRING) AS g")
        for groups in ((), ("g",)):
            got = ordinal.with_ordinal(df, ["id"], group_by=groups, num_partitions=4)
            got.count()
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastExchange" not in plan
            w = Window.partitionBy(*groups).orderBy("id") if groups else Window.orderBy("id")
            brute = df.withColumn("expect", F.row_number().over(w))
            assert got.join(brute, ["id", "g"]).where("ordinal <> expect").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
