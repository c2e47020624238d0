import json

from pyspark.sql import functions as F

from rankforge import functions as rf


def test_scalar_functions(spark):
    df = spark.createDataFrame(
        [('Hey \\"Jude\\"', "The Beatles", 73, json.dumps({"tracks": {"items": [{"id": "t1", "popularity": 5}]}}))],
        "song string, artist string, rank int, resp string",
    )
    r = df.select(
        rf.clean_name("song").alias("clean"),
        rf.quote(F.lit("a,b")).alias("quoted"),
        rf.to_csv_line("song", "artist", quoted=True).alias("csv_q"),
        rf.to_csv_line(F.lit("a"), F.lit(1)).alias("csv"),
        rf.fielded_query("artist", "song").alias("q1"),
        rf.free_text_query("song", "artist").alias("q2"),
        rf.normalize_text(F.lit("  Hey -- JUDE!! ")).alias("norm"),
        rf.first_hit_field("resp", "id").alias("hit"),
        rf.rank_class("rank").alias("cls"),
        rf.rank_class(F.lit(111)).alias("cls111"),
        rf.rank_class(F.lit(111), clamp_to=10).alias("cls_clamped"),
        rf.binary_relabel_expr(F.lit(10)).alias("pos"),
        rf.hash_bucket(F.lit("x"), buckets=100).alias("bucket"),
    ).collect()[0]
    assert r.clean == "Hey Jude"
    assert r.quoted == '"a,b"'
    assert r.csv_q.startswith('"') and r.csv_q.endswith(",The Beatles")  # quoted: it holds quotes
    assert r.csv == "a,1"
    assert r.q1 == 'artist:The Beatles track:Hey \\"Jude\\"'
    assert r.q2 == 'Hey \\"Jude\\" The Beatles'
    assert r.norm == "hey jude"
    assert r.hit == "t1"
    assert (r.cls, r.cls111, r.cls_clamped, r.pos) == (7, 11, 10, 1)
    assert 0 <= r.bucket < 100


def test_queries_are_null_when_a_part_is_null(spark):
    df = spark.createDataFrame([(None, "x")], "song string, artist string")
    r = df.select(rf.free_text_query("song", "artist").alias("q")).collect()[0]
    assert r.q is None


def test_repair_line_struct_field_counts(spark):
    df = spark.createDataFrame([("a,b,c",), ("a,b",), ("",), ("w,x,y,z",)], "v string")
    rows = df.select(rf.repair_line_struct("v").alias("r")).select("r.*").collect()
    assert [(r.n_fields, r.ok) for r in rows] == [(3, True), (2, False), (1, False), (4, True)]
    assert rows[3].song == '"w,x"' and rows[3].artist == "y" and rows[3]["class"] == "z"
