from rankforge.operators import split


def test_exact_split_sizes_and_cover(spark):
    for n in (15, 87, 500):
        df = spark.range(0, n).withColumnRenamed("id", "k")
        tr, va, te = split.exact_split(df, ["k"])
        exp = split.exact_split_sizes(n)
        assert (tr.count(), va.count(), te.count()) == exp
        ids = [r.k for d in (tr, va, te) for r in d.collect()]
        assert sorted(ids) == list(range(n))
    # n_test = ceil(0.2 n), n_val = ceil(0.25 (n - n_test)), float arithmetic
    assert split.exact_split_sizes(15) == (9, 3, 3)
    assert split.exact_split_sizes(87) == (51, 18, 18)


def test_hash_split_stable_and_disjoint(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    parts = split.hash_split(df.repartition(3), ["k"])
    parts2 = split.hash_split(df.repartition(5), ["k"])
    sets = [{r.k for r in p.collect()} for p in parts]
    sets2 = [{r.k for r in p.collect()} for p in parts2]
    assert sets == sets2
    assert sum(len(s) for s in sets) == 2000 and len(set().union(*sets)) == 2000
    assert 1000 < len(sets[0]) < 1400


def test_random_split_covers(spark):
    df = spark.range(0, 1000)
    parts = split.random_split(df)
    assert sum(p.count() for p in parts) == 1000


def test_exact_split_band_fallback_is_exact(spark, monkeypatch):
    df = spark.range(0, 700).withColumnRenamed("id", "k")
    want = {r.k: r.split for r in split.exact_split_label(df, ["k"]).collect()}
    monkeypatch.setattr(split, "BAND_SIGMAS", 0.0)
    monkeypatch.setattr(split, "BAND_SLACK", 0)
    got = {r.k: r.split for r in split.exact_split_label(df, ["k"]).collect()}
    assert got == want
    sizes = {s: list(got.values()).count(s) for s in ("train", "val", "test")}
    assert (sizes["train"], sizes["val"], sizes["test"]) == split.exact_split_sizes(700)


def test_hash_split_small_and_odd_weights(spark):
    df = spark.range(100000)
    sizes = [d.count() for d in split.hash_split(df, ["id"], (0.998, 0.001, 0.001))]
    assert sum(sizes) == 100000 and all(60 <= n <= 140 for n in sizes[1:])
    thirds = [d.count() for d in split.hash_split(df, ["id"], (1, 1, 1))]
    assert sum(thirds) == 100000 and all(abs(n - 100000 / 3) < 600 for n in thirds)
