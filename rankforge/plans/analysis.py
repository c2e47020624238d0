"""Queries of the feature analysis, neighbour, word-count, regression and
boosting operators, with their DuckDB SQL.

Songs here are all rows of ``orders`` (:func:`song_records`): a record id, the
song, its best rank on the chart, and eight features of which two have gaps.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.functions.scalar import rank_class
from rankforge.operators import clean, neighbours, words
from rankforge.operators import split as splits
from rankforge.plans import boosting, features, models, regression
from rankforge.plans import standins as si
from rankforge.schemas import FEATURES_8
from rankforge.session import ensure_checkpoint_dir
from rankforge.sources.csv import read_table


def song_records(spark: SparkSession, sf: str) -> DataFrame:
    """record_id, song, artist, top_rank, class and FEATURES_8; loudness lacks
    in each 31st record, song_hotttnesss in each 20th."""
    o, key = read_table(spark, sf, "orders"), F.col("o_orderkey")
    price = F.col("o_totalprice")
    best = si.chart(spark, sf).groupBy("song", "artist").agg(F.min("rank").alias("top_rank"))
    records = o.select(
        key.alias("record_id"), F.col("o_custkey").cast("string").alias("song"), F.col("o_orderpriority").alias("artist"),
        (F.pmod(key * 7919, F.lit(1000)) / F.lit(1000.0)).alias("danceability"), (price / F.lit(1000.0)).alias("duration"),
        (F.dayofyear("o_orderdate") / F.lit(366.0)).alias("energy"), (key % 12).cast("int").alias("key"),
        F.when(key % 31 != 0, -(F.col("o_custkey") % 100) / F.lit(10.0)).alias("loudness"),
        F.when(key % 20 != 0, price / F.lit(600000.0) + F.dayofyear("o_orderdate") / F.lit(3660.0)).alias("song_hotttnesss"),
        (F.lit(60.0) + price / F.lit(5000.0) + key % 7).alias("tempo"), (key % 5 + 1).cast("int").alias("time_signature"))
    return records.join(best, ["song", "artist"]).select(
        "record_id", "song", "artist", "top_rank", rank_class("top_rank", clamp_to=10).alias("class"), *FEATURES_8)


RECORDS_SQL = """best AS (
  SELECT CAST(o_custkey AS VARCHAR) AS song, o_orderpriority AS artist, min(CAST(floor(o_totalprice / 4500.0) + 1 AS INTEGER)) AS top_rank
  FROM orders GROUP BY ALL),
records AS (
  SELECT o_orderkey AS record_id, song, artist, top_rank, least(CAST(floor((top_rank - 1) / 10) AS BIGINT), 10) AS class,
         (o_orderkey * 7919) % 1000 / 1000.0::DOUBLE AS danceability, o_totalprice / 1000.0 AS duration,
         dayofyear(o_orderdate) / 366.0::DOUBLE AS energy, CAST(o_orderkey % 12 AS INTEGER) AS key,
         CASE WHEN o_orderkey % 31 <> 0 THEN -(o_custkey % 100) / 10.0::DOUBLE END AS loudness,
         CASE WHEN o_orderkey % 20 <> 0 THEN o_totalprice / 600000.0 + dayofyear(o_orderdate) / 3660.0::DOUBLE END AS song_hotttnesss,
         60.0 + o_totalprice / 5000.0 + o_orderkey % 7 AS tempo, CAST(o_orderkey % 5 + 1 AS INTEGER) AS time_signature
  FROM orders JOIN best ON song = CAST(o_custkey AS VARCHAR) AND artist = o_orderpriority)"""


# ---------------------------------------------------------------- features

def q_feature_correlation(spark, sf):
    out = features.correlation(features.moments(song_records(spark, sf), FEATURES_8))
    return out.select("a", "b", "n", (F.round("pearson", 6) + 0.0).alias("pearson"))  # no negative zero


_CORRELATION = f"WITH {RECORDS_SQL}\n" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, round(corr({b}, {a}), 6) + 0.0 AS pearson FROM records"
    for a, b in combinations(FEATURES_8, 2))

_DIMENSIONS = [f"e{i:02d}" for i in range(64)]


def _vector_moments(spark, sf):
    return features.array_moments(read_table(spark, sf, "embeddings"), "embedding", _DIMENSIONS)


def q_pca_variance(spark, sf):
    return features.pca_variance(_vector_moments(spark, sf), _DIMENSIONS).drop("loadings")


def q_pca_trace(spark, sf):
    """The components' variances add up to the columns' variances, their
    squares to the squares of the covariance matrix."""
    out = features.pca_variance(_vector_moments(spark, sf), _DIMENSIONS)
    return out.agg(F.count("*").alias("components"), F.round(F.sum("variance"), 6).alias("trace"),
                   F.round(F.sum(F.col("variance") * F.col("variance")), 6).alias("squares"),
                   F.round(F.sum(F.aggregate("loadings", F.lit(0.0), lambda s, x: s + x * x)), 6).alias("lengths"))


_PCA_TRACE = "WITH cov AS (" + " UNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, covar_pop(embedding[{i + 1}]::DOUBLE, embedding[{j + 1}]::DOUBLE) AS c FROM embeddings"
    for i in range(64) for j in range(i, 64)) + """)
SELECT count(*) FILTER (i = j) AS components, round(sum(c) FILTER (i = j), 6) AS trace,
       round(sum(CASE WHEN i = j THEN c * c ELSE 2 * c * c END), 6) AS squares, round(64.0::DOUBLE, 6) AS lengths FROM cov"""


def q_feature_jaccard(spark, sf):
    out = features.jaccard(song_records(spark, sf), FEATURES_8)
    return out.select("a", "b", "n_both", "n_either", F.round("jaccard", 6).alias("jaccard"))


_CUTS = ", ".join(f"(SELECT {c} FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS p, count(*) OVER () AS n FROM records WHERE {c} IS NOT NULL) "
                  f"WHERE p = greatest(1, ceil(n * 0.5))) AS {c}" for c in FEATURES_8)
_JACCARD = f"WITH {RECORDS_SQL},\ncuts AS (SELECT {_CUTS}),\nflags AS (SELECT " + ", ".join(
    f"coalesce(r.{c} > c.{c}, false) AS {c}" for c in FEATURES_8) + " FROM records r, cuts c)\n" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, count(*) FILTER ({a} AND {b}) AS n_both, count(*) FILTER ({a} OR {b}) AS n_either, "
    f"round(count(*) FILTER ({a} AND {b}) / count(*) FILTER ({a} OR {b}), 6) AS jaccard FROM flags" for a, b in combinations(FEATURES_8, 2))


def _described(spark, sf):
    """Labelled documents with two features of their texts."""
    docs = read_table(spark, sf, "documents").select("doc_id", F.length("text").alias("n_chars"), F.size(F.split("text", "\n")).alias("n_lines"))
    return read_table(spark, sf, "labels").select("doc_id", "quality").join(docs, "doc_id")


def q_importance_of_rule(spark, sf):
    """Permutation importance of a fixed rule: good if 400 characters or more,
    at most 120 of them a line."""
    rule = ((F.col("n_chars") >= 400) & (F.col("n_chars") <= 120 * F.col("n_lines"))).cast("int")
    out = features.permutation_importance(_described(spark, sf), "doc_id", ["n_chars", "n_lines"], "quality", lambda d: d.withColumn("prediction", rule))
    return out.select("feature", *[F.round(c, 6).alias(c) for c in ("base_accuracy", "permuted_accuracy", "importance")])


_IMPORTANCE = """WITH rows AS (
  SELECT doc_id, quality, length(text) AS c, len(string_split(text, chr(10))) AS l FROM labels JOIN documents USING (doc_id)
), own AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS p FROM rows),
donor AS (SELECT c AS dc, l AS dl, row_number() OVER (ORDER BY md5('0:' || doc_id::VARCHAR), doc_id) AS p FROM rows),
hits AS (
  SELECT avg(((c >= 400 AND c <= 120 * l)::INT = quality)::INT) AS base, avg(((dc >= 400 AND dc <= 120 * l)::INT = quality)::INT) AS hc,
         avg(((c >= 400 AND c <= 120 * dl)::INT = quality)::INT) AS hl FROM own JOIN donor USING (p))
SELECT 'n_chars' AS feature, round(base, 6) AS base_accuracy, round(hc, 6) AS permuted_accuracy, round(base - hc, 6) AS importance FROM hits
UNION ALL SELECT 'n_lines', round(base, 6), round(hl, 6), round(base - hl, 6) FROM hits"""


def _complete(spark, sf):
    """Song records without gaps, their features as a vector too."""
    whole = clean.drop_incomplete(song_records(spark, sf), FEATURES_8).withColumns(
        {"class": F.col("class").cast("double"), "label": F.col("top_rank").cast("double")})
    return models.assemble(whole, FEATURES_8)


def q_feature_importance(spark, sf):
    """Permutation importance on the test split of a logistic regression and a
    forest over the eight features, beside the forest's own."""
    train, _, test = splits.exact_split(_complete(spark, sf), ["record_id"])
    train = models.materialize_split(train)
    out = None
    for family, params in (("lr", {"maxIter": 50}), ("rf", {"maxDepth": 10, "numTrees": 20})):
        model = models.estimator(family, **params).fit(train)
        own = model.featureImportances.toArray().tolist() if family == "rf" else [None] * len(FEATURES_8)
        names = spark.createDataFrame(list(zip(FEATURES_8, own)), "feature string, own_importance double")
        rows = features.permutation_importance(test, "record_id", FEATURES_8, "class", lambda d, m=model: m.transform(models.assemble(d, FEATURES_8)))
        rows = rows.join(names, "feature").select(F.lit(family).alias("family"), *rows.columns, "own_importance")
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------- neighbours

K = 5


def q_knn_predict(spark, sf):
    """The label of each 20th vector from its 5 nearest other vectors."""
    e = read_table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("class"), "embedding")
    asked = e.where(F.col("id") % 20 == 0)
    out = neighbours.knn_predict(e, asked, K, "id", "embedding", "class")
    return asked.join(out, asked["id"] == out["query"]).select(F.col("id").alias("vec_id"), "class", "prediction", "votes", "nearest")


_KNN = f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: round(x::DOUBLE * 10000.0::DOUBLE)) AS x FROM embeddings),
near AS (
  SELECT q, qc, vec_id, label, row_number() OVER (PARTITION BY q ORDER BY d, vec_id) AS nth FROM (
    SELECT a.vec_id AS q, a.label AS qc, b.vec_id, b.label,
           list_sum(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i]))) AS d
    FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id) QUALIFY nth <= {K}),
votes AS (SELECT q, qc, label, count(*) AS votes FROM near GROUP BY ALL)
SELECT q AS vec_id, qc AS class, label AS prediction, votes, (SELECT n.vec_id FROM near n WHERE n.q = votes.q AND nth = 1) AS nearest
FROM votes QUALIFY row_number() OVER (PARTITION BY q ORDER BY votes DESC, label) = 1"""


def q_impute_similar(spark, sf):
    """song_hotttnesss of each 20th record from the 5 records most alike in
    length, energy and danceability."""
    ensure_checkpoint_dir(spark)
    out = neighbours.impute_similar(song_records(spark, sf), "record_id", ["duration", "energy", "danceability"], ["song_hotttnesss"], K)
    return out.where("record_id % 20 = 0").select("record_id", F.round("song_hotttnesss", 6).alias("song_hotttnesss"),
                                                  F.col("similar.song_hotttnesss").alias("similar"))


# ---------------------------------------------------------------- words

WORDS = 5000


def q_word_vocabulary(spark, sf):
    return words.vocabulary(read_table(spark, sf, "documents"), size=WORDS)


def q_word_counts(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return words.count_words(docs, "doc_id", words.vocabulary(docs, size=WORDS))


_WORDS = rf"""WITH said AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
), vocab AS (
  SELECT word, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS word_index, n
  FROM (SELECT word, count(*) AS n FROM said GROUP BY word) QUALIFY word_index <= {WORDS})
"""
_WORD_COUNTS = _WORDS + """, per AS (SELECT doc_id, word_index, count(*) AS n FROM said JOIN vocab v USING (word) GROUP BY ALL),
sparse AS (SELECT doc_id, sum(n)::BIGINT AS k, string_agg(word_index || ':' || n, ',' ORDER BY word_index) AS c FROM per GROUP BY doc_id),
total AS (SELECT doc_id, count(*) AS t FROM said GROUP BY doc_id)
SELECT doc_id, coalesce(t, 0) AS n_words, coalesce(k, 0) AS n_known, coalesce(c, '') AS counts
FROM documents LEFT JOIN total USING (doc_id) LEFT JOIN sparse USING (doc_id)"""


# ---------------------------------------------------------------- regression

def _rule_ranks(spark, sf):
    """A rule for a song's best rank: that of the record's own length."""
    return song_records(spark, sf).select(F.col("top_rank").alias("label"), (F.lit(1.0) + F.col("duration") / F.lit(5.0)).alias("prediction"))


def q_regression_metrics(spark, sf):
    return regression.regression_metrics(_rule_ranks(spark, sf)).select("n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


def q_rank_bucket_confusion(spark, sf):
    return regression.rank_bucket_confusion(_rule_ranks(spark, sf))


_RULE = f"WITH {RECORDS_SQL}, rule AS (SELECT top_rank AS y, 1.0 + duration / 5.0 AS p FROM records)\n"
_METRICS = _RULE + """SELECT count(*) AS n, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae,
       round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2 FROM rule"""
_BUCKETS = _RULE + """SELECT least(CAST(floor((y - 1) / 10) AS BIGINT), 10) AS class,
       least(CAST(floor((greatest(round(p), 1) - 1) / 10) AS BIGINT), 10) AS prediction, count(*) AS n FROM rule GROUP BY ALL"""


def q_rank_regression(spark, sf):
    """Linear regression of the exact rank on the eight features."""
    return regression.rank_regression("linear", "regParam", models.REG_PARAMS, *splits.exact_split(_complete(spark, sf), ["record_id"]))


def q_gbt_sweep(spark, sf):
    """Boosting of all 11 rank classes; the sweep is over the rounds."""
    return boosting.gbt_sweep(FEATURES_8, models.MAX_ITERS[:4], *splits.exact_split(_complete(spark, sf).drop("features"), ["record_id"]))


QUERIES = {
    "feature_correlation": q_feature_correlation, "pca_variance": q_pca_variance, "pca_trace": q_pca_trace, "feature_jaccard": q_feature_jaccard,
    "importance_of_rule": q_importance_of_rule, "feature_importance": q_feature_importance, "knn_predict": q_knn_predict,
    "impute_similar": q_impute_similar, "word_vocabulary": q_word_vocabulary, "word_counts": q_word_counts,
    "regression_metrics": q_regression_metrics, "rank_bucket_confusion": q_rank_bucket_confusion, "rank_regression": q_rank_regression,
    "gbt_sweep": q_gbt_sweep,
}

ORACLE = {
    "feature_correlation": _CORRELATION, "pca_trace": _PCA_TRACE, "feature_jaccard": _JACCARD, "importance_of_rule": _IMPORTANCE, "knn_predict": _KNN,
    "word_vocabulary": _WORDS + "SELECT word, word_index, n FROM vocab", "word_counts": _WORD_COUNTS, "regression_metrics": _METRICS,
    "rank_bucket_confusion": _BUCKETS,
}
