import json
import re

from rankforge.operators import enrich
from rankforge.schemas import SEARCH_RESPONSE


def test_fallback_lookup_tiers(spark):
    songs = spark.createDataFrame(
        [("Hello", "Adele", 1), ("Yesterday", "The Beatles", 2), ("Nothing", "Nobody", 3), ("Two", "Hits", 4)],
        "song string, artist string, class bigint",
    )
    cat = spark.createDataFrame(
        [
            ("id1", "Adele", "Hello", 50),            # fielded hit
            ("id9", "adele", "hello!", 99),           # more popular, free-text only: tier 1 still wins
            ("id2", "the beatles", "yesterday", 70),  # only a free-text hit
            ("id3", "Hits", "Two", 10),               # two fielded hits: most popular wins
            ("id4", "Hits", "Two", 40),
        ],
        "id string, artist string, title string, popularity int",
    )
    want = {"Hello": ("id1", 50), "Yesterday": ("id2", 70), "Nothing": ("", 0), "Two": ("id4", 40)}
    got = {r.song: (r.track_id, r.popularity) for r in enrich.fallback_lookup(songs, cat).collect()}
    assert got == want


def test_fallback_lookup_keeps_scripts_apart(spark):
    songs = spark.createDataFrame([("東京", "嵐"), ("!!!", "???"), ("Élan", "Ô")], "song string, artist string")
    cat = spark.createDataFrame(
        [("a", "李", "上海", 9), ("b", "...", "---", 9), ("c", "ô", "élan", 3)],
        "id string, artist string, title string, popularity int",
    )
    got = {r.song: r.track_id for r in enrich.fallback_lookup(songs, cat).collect()}
    assert got == {"東京": "", "!!!": "", "Élan": "c"}


def test_join_features_fan_out_and_order(spark):
    cls = spark.createDataFrame([("s", "a", 1), ("t", "a", 2)], "song string, artist string, class bigint")
    feats = spark.createDataFrame(
        [("a", "s", 1990, 0.5), ("a", "s", 1991, 0.6), ("A", "t", 1992, 0.7)],
        "artist_name string, title string, year int, energy double",
    )
    out = enrich.join_features(cls, feats)
    assert out.columns == ["song", "artist", "class", "year", "energy"]
    assert sorted(r.year for r in out.collect()) == [1990, 1991]


def test_batch_enrich_drops_missing_and_keeps_both_ids(spark):
    ident = spark.createDataFrame(
        [(f"s{i:03d}", "a", 1, f"t{i}", 5) for i in range(250)],
        "song string, artist string, class bigint, track_id string, popularity int",
    )
    feats = spark.createDataFrame(
        [(f"t{i}", 0.1 * (i % 10), 1) for i in range(250) if i % 50 != 0],
        "id string, danceability double, key int",
    )
    out = enrich.batch_enrich(ident, feats, ["song"], feature_cols=["danceability", "key"])
    rows = out.collect()
    assert len(rows) == 245
    assert all(r.track_id == r.id for r in rows)
    batches = {r.song: r.batch_id for r in rows}
    assert batches["s001"] == 0 and batches["s199"] == 1 and batches["s249"] == 2
    # the last of several records wins
    twice = feats.selectExpr("*", "1 AS at").unionByName(spark.createDataFrame([("t1", 9.0, 3, 2)], "id string, danceability double, key int, at int"))
    again = enrich.batch_enrich(ident, twice, ["song"], feature_cols=["danceability", "key"], record_order="at").collect()
    assert len(again) == 245 and [r.danceability for r in again if r.id == "t1"] == [9.0]


def test_row_aligned_concat_missing_row(spark):
    a = spark.createDataFrame([("f", 1, 0.5), ("f", 2, 0.6)], "file_id string, row_idx int, x double")
    b = spark.createDataFrame([("f", 1, "t1")], "file_id string, row_idx int, title string")
    full = enrich.row_aligned_concat([a, b], keep=None, drop_null=False)
    assert full.count() == 2
    kept = enrich.row_aligned_concat([a, b], keep=["title", "x"])
    assert [tuple(r) for r in kept.collect()] == [("t1", 0.5)]


def test_pending_and_json_helpers(spark):
    work = spark.createDataFrame([(0,), (1,), (2,)], "shard_id long")
    done = spark.createDataFrame([(1,), (1,)], "shard_id long")
    assert sorted(r.shard_id for r in enrich.pending(work, done, ["shard_id"]).collect()) == [0, 2]
    resp = spark.createDataFrame(
        [(json.dumps({"tracks": {"items": [{"id": "x", "popularity": 3}, {"id": "y", "popularity": 9}]}}),),
         (json.dumps({"tracks": {"items": []}}),)],
        "r string",
    )
    got = [(r.hit_id, r.hit_popularity) for r in enrich.parse_search_response(resp, "r", SEARCH_RESPONSE).collect()]
    assert got == [("x", 3), (None, None)]
    recs = spark.createDataFrame([([{"id": "a", "v": 1.0}, None, {"id": "b", "v": 2.0}],)],
                                 "records array<struct<id:string,v:double>>")
    assert [r.id for r in enrich.flatten_feature_records(recs).collect()] == ["a", "b"]


def test_lookup_reads_the_songs_twice_and_the_catalogue_once(spark):
    from rankforge.plans.catalogue import QUERIES

    df = QUERIES["fallback_lookup"](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet", final)) <= 3


def test_lookup_of_nulls_and_ambiguous_texts(spark):
    songs = spark.createDataFrame(
        [(None, "x", 1), ("y", None, 2), ("z", "x track:y", 3), ("y track:z", "x", 4), ("z", "x track:y", 5)], "song string, artist string, class int")
    cat = spark.createDataFrame(
        [("a", "x track:y", "z", 1), ("b", "x", "y track:z", 2), ("c", None, "y", 9), ("d", "x", None, 9)], "id string, artist string, title string, popularity int")
    got = {r["class"]: r.track_id for r in enrich.fallback_lookup(songs, cat).collect()}
    assert got == {1: "", 2: "", 3: "a", 4: "b", 5: "a"}


def test_feature_responses_keep_their_order(spark):
    rows = [(0, '[{"id":"a","energy":1.0},null,{"id":"b","energy":2.0},{"id":"a","energy":3.0}]'), (1, '[{"id":"b","energy":0.5}]'), (2, "no json"), (3, None), (4, "[]")]
    df = spark.createDataFrame(rows, "batch int, response string")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("energy", T.DoubleType())])
    records = enrich.read_feature_responses(df, "response", schema, ["batch"])
    got = [((r.record_order.batch, r.record_order.place), r.id, r.energy) for r in records.collect() if r.id]
    assert sorted(got) == [((0, 0), "a", 1.0), ((0, 2), "b", 2.0), ((0, 3), "a", 3.0), ((1, 0), "b", 0.5)]
    last = {r.id: r.energy for r in enrich.latest_per_id(records.where("id is not null"), order_col="record_order").collect()}
    assert last == {"a": 3.0, "b": 0.5}
