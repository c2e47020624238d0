import os

from pyspark.sql import functions as F

from rankforge.operators import shards
from rankforge.plans import build


def _inputs(spark):
    lines = spark.createDataFrame(
        [(0, "song,artist,class"), (1, "Hello, Goodbye,The Beatles,4"), (2, 'Hey \\"Jude\\",The Beatles,3'),
         (3, "Hey Jude,The Beatles,0"), (4, "Unknown,Nobody,2"), (5, "x,y")],
        "ordinal long, value string",
    )
    unranked = spark.createDataFrame(
        [("Song %d" % i, "Band") for i in range(30)], "title string, artist_name string"
    )
    catalogue = spark.createDataFrame(
        [("tA", "The Beatles", "Hello, Goodbye", 80), ("tC", "the beatles", "hello goodbye", 95), ("tB", "The Beatles", "Hey Jude", 90)]
        + [("s%d" % i, "Band", "Song %d" % i, 10) for i in range(30)],
        "id string, artist string, title string, popularity int",
    )
    audio = spark.createDataFrame(
        [(i, 0.5, 0.5, 1, -5.0, 1, 0.1, 0.1, 0.1, 0.1, 0.1, 120.0, 200000, 4)
         for i in ["tA", "tB"] + ["s%d" % i for i in range(30) if i != 3]],
        "id string, danceability double, energy double, key int, loudness double, mode int, "
        "speechiness double, acousticness double, instrumentalness double, liveness double, "
        "valence double, tempo double, duration_ms int, time_signature int",
    )
    return lines, unranked, catalogue, audio


def test_build_enriched_chain(spark):
    out = build.build_enriched(*_inputs(spark), cap_n=3000)
    rows = {(r.song, r.artist): r for r in out.collect()}
    # first row per key wins (class 3 before 0); the 2-field line is dropped
    assert rows[("Hey Jude", "The Beatles")]["class"] == 3
    assert rows[("Hello, Goodbye", "The Beatles")].track_id == "tA"
    assert ("Unknown", "Nobody") not in rows  # no catalogue hit -> dropped
    # (5 chart rows + header) / 10 = 0 default-class rows
    assert out.where(F.col("class") == 10).count() == 0


def test_build_enriched_resumes_from_shards(spark, tmpdir_path):
    work = os.path.join(tmpdir_path, "work")
    first = build.build_enriched(*_inputs(spark), work_dir=work)
    again = build.build_enriched(*_inputs(spark), work_dir=work)
    assert sorted(map(tuple, first.drop("batch_id").collect())) == sorted(
        map(tuple, again.drop("batch_id").collect())
    )
    # One folder for the only run, named by the manifest; shard_id is a column.
    runs = {r["run"] for r in shards.finished_shards(spark, os.path.join(work, "enriched")).collect()}
    assert runs == set(os.listdir(os.path.join(work, "enriched"))) and len(runs) == 1
    assert shards.combine_shards(spark, os.path.join(work, "enriched")).where("shard_id = 0").count() > 0


def test_sharded_build_equals_the_unsharded_one(spark, tmpdir_path):
    plain = build.build_enriched(*_inputs(spark))
    sharded = build.build_enriched(*_inputs(spark), work_dir=os.path.join(tmpdir_path, "w"), shard_rows=2)
    assert sorted(map(repr, plain.drop("batch_id").collect())) == sorted(map(repr, sharded.drop("batch_id").collect()))


def test_dedupe_scope_shard_keeps_copies_across_shards(spark):
    lines, unranked, catalogue, audio = _inputs(spark)
    # two copies of the same song, lines 2 and 3; shards of 2 rows separate them
    glob = build.build_enriched(lines, unranked, catalogue, audio, dedupe_scope="global", shard_rows=2)
    per = build.build_enriched(lines, unranked, catalogue, audio, dedupe_scope="shard", shard_rows=2)
    key = ("Hey Jude", "The Beatles")
    assert sum(1 for r in glob.collect() if (r.song, r.artist) == key) == 1
    assert sum(1 for r in per.collect() if (r.song, r.artist) == key) == 2
