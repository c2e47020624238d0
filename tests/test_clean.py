import math

from rankforge.operators import clean


def _lines(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, value string")


def test_repair_lines_rules(spark):
    lines = _lines(spark, [
        'song,artist,class',              # header goes through like any line
        'Hey \\"Jude\\",The Beatles,3',   # 3 fields: strip \ and "
        'Hello, Goodbye,The Beatles,4',   # 4 fields: song rebuilt and quoted
        'a,b,c,Art "X",5',                # 5 fields
        'only,two',                       # 2 fields: dropped
        'one',                            # 1 field: dropped
    ])
    got = {r.n: (r.song, r.artist, r["class"]) for r in clean.repair_lines(lines, keep=["n"]).collect()}
    assert got == {
        0: ("song", "artist", "class"),
        1: ("Hey Jude", "The Beatles", "3"),
        2: ('"Hello, Goodbye"', "The Beatles", "4"),
        3: ('"a,b,c"', "Art X", "5"),
    }
    report = {r.outcome: r.lines for r in clean.repair_report(lines).collect()}
    assert report == {"kept": 2, "rebuilt": 2, "dropped": 2}


def test_explode_lines_whole_text(spark):
    texts = spark.createDataFrame([(1, "a,b,c\nx\n\nd,e,f,g")], "doc_id long, text string")
    rows = clean.explode_lines(texts, keep=["doc_id"]).collect()
    assert [(r.line_no, r.value) for r in rows] == [(1, "a,b,c"), (2, "x"), (3, ""), (4, "d,e,f,g")]


def test_dedupe_first_keeps_smallest_ordinal(spark):
    df = spark.createDataFrame(
        [("s", "a", 5, "late"), ("s", "a", 1, "early"), ("s", "b", 3, "only"), ("t", "a", 2, "x")],
        "song string, artist string, ord int, payload string",
    )
    out = clean.dedupe_first(df, ["song", "artist"], "ord")
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [
        ("s", "a", 1, "early"), ("s", "b", 3, "only"), ("t", "a", 2, "x")
    ]
    # idempotent
    assert sorted(map(tuple, clean.dedupe_first(out, ["song", "artist"], "ord").collect())) == sorted(
        map(tuple, out.collect())
    )


def test_dedupe_first_hot_key(spark):
    df = spark.range(0, 30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS song",
        "'a' AS artist", "30000 - id AS ord",
    )
    got = {r.song: r.ord for r in clean.dedupe_first(df, ["song", "artist"], "ord").collect()}
    assert got["hot"] == 3  # smallest ord among ids divisible by 3 is 30000 - 29997
    assert len(got) == 20001


def test_drop_incomplete_drops_nan_and_null(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a"), (2, float("nan"), "b"), (3, None, "c"), (4, 2.0, None)],
        "id int, x double, s string",
    )
    assert [r.id for r in clean.drop_incomplete(df).collect()] == [1]
    assert [r.id for r in clean.drop_incomplete(df, ["id", "s"]).collect()] == [1, 2, 3]
    assert math.isnan(clean.drop_incomplete(df, ["s"]).collect()[1].x)


def test_drop_unidentified_keeps_null(spark):
    df = spark.createDataFrame([("a", "id1"), ("b", ""), ("c", None)], "song string, track_id string")
    assert sorted(r.song for r in clean.drop_unidentified(df).collect()) == ["a", "c"]
