"""Query catalogue: every operator of SURVEY §2 as a query over the driver's
tables (via the stand-ins), plus an equivalent DuckDB SQL oracle.

Each query takes (spark, sf_dir) and returns a DataFrame; column names and
types match the oracle's. Dates are returned as ``yyyy-MM-dd`` text and
derived doubles that come out of aggregates are rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.functions.scalar import binary_relabel_expr, clean_name, json_field, to_csv_line
from rankforge.operators.ordinal import with_ordinal
from rankforge.operators import balance, chart, clean, enrich, shards, split
from rankforge.plans import analysis, build, evaluate, files, models
from rankforge.plans import standins as si
from rankforge import streaming as stream
from rankforge.session import ensure_checkpoint_dir
from rankforge.sources.csv import read_table

Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------- building blocks

def _best(spark, sf):
    return chart.best_rank(si.chart(spark, sf), before=si.CHART_BEFORE)


def _classified(spark, sf, sort=False):
    return chart.classify(_best(spark, sf), sort=sort)


def _features_as_songs(spark, sf):
    return si.features_a(spark, sf).withColumnsRenamed({"title": "song", "artist_name": "artist"})


def _lookup(spark, sf):
    return enrich.fallback_lookup(_classified(spark, sf), si.catalogue(spark, sf))


def _identified(spark, sf):
    return clean.drop_unidentified(_lookup(spark, sf))


def _left_default(spark, sf):
    return chart.classify_with_default(_features_as_songs(spark, sf), _classified(spark, sf))


def _argmax_prediction(spark, sf):
    """A rule-made prediction: index of the largest embedding value, modulo
    the 10 labels, against the true label."""
    e = read_table(spark, sf, "embeddings")
    return e.select(
        "vec_id",
        F.col("label").alias("class"),
        ((F.array_position("embedding", F.array_max("embedding")) - 1) % 10).alias("prediction"),
    )


# --------------------------------------------------------------- chart

def q_best_rank(spark, sf):
    return _best(spark, sf)


def q_classify_rankings(spark, sf):
    return _classified(spark, sf, sort=True)


def q_class_histogram(spark, sf):
    return evaluate.class_histogram(_classified(spark, sf))


def q_class_histogram_bins(spark, sf):
    """A6 as plotted: 11 equal-width bins over [min, max] of the classes."""
    return evaluate.class_histogram(_classified(spark, sf), "class", bins=11)


def q_classified_join(spark, sf):
    return enrich.join_features(_classified(spark, sf), si.features_a(spark, sf))


def q_classified_left_default(spark, sf):
    return _left_default(spark, sf)


def q_date_range_filter(spark, sf):
    restricted = chart.restrict_to_years_of(si.chart(spark, sf), si.features_a(spark, sf))
    return chart.best_rank(restricted)


def q_best_rank_stream(spark, sf):
    """C1 through Structured Streaming: the orders file is the chart inbox;
    the stream runs to completion (availableNow) and the result table is
    read back. Same answer as ``best_rank``."""
    orders = read_table(spark, sf, "orders")
    inbox = (
        spark.readStream.schema(orders.schema)
        .option("pathGlobFilter", "orders.parquet")
        .parquet(sf.rstrip("/"))
    )
    _, out = stream.run_best_rank(si.chart_from_orders(inbox), before=si.CHART_BEFORE)
    return stream.current_best_rank(spark, out)


# --------------------------------------------------------------- lookup and enrich

def q_fallback_lookup(spark, sf):
    return _lookup(spark, sf)


def q_drop_unidentified(spark, sf):
    return _identified(spark, sf)


def q_batch_enrich(spark, sf):
    return enrich.batch_enrich(
        _identified(spark, sf), si.audio_features(spark, sf), order_by=["song", "artist"]
    )


def q_row_aligned_concat(spark, sf):
    return enrich.row_aligned_concat(si.feature_groups(spark, sf))


def q_json_field(spark, sf):
    ev = read_table(spark, sf, "events")
    return ev.select("event_id", json_field("props", "$.k", "int").alias("k"))


# --------------------------------------------------------------- cleaning

def q_clean_text(spark, sf):
    d = read_table(spark, sf, "documents")
    cleaned = clean_name("text")
    return d.select(
        "doc_id",
        F.md5(cleaned).alias("text_md5"),
        F.length(cleaned).cast("bigint").alias("clean_chars"),
    )


def q_repair_lines(spark, sf):
    d = read_table(spark, sf, "documents")
    lines = clean.explode_lines(d, "text", keep=["doc_id"])
    return clean.repair_lines(lines, keep=["doc_id", "line_no"])


def q_dedupe_first(spark, sf):
    first = clean.dedupe_first(si.chart(spark, sf), ["song", "artist"], "ordinal")
    return first.select(
        "song", "artist", "ordinal", "rank", F.date_format("date", "yyyy-MM-dd").alias("date")
    )


def q_shard_assign(spark, sf):
    return shards.assign_shards(_classified(spark, sf), ["song", "artist"])


def q_resume_anti_join(spark, sf):
    return enrich.pending(_classified(spark, sf), _identified(spark, sf), ["song", "artist"])


def _raw_chart_lines(spark, sf):
    """Chart lines as text (header + one CSV line per classified song, in
    song order): the input of the line-based pipeline, derived from the
    stand-in chart."""
    cls = _classified(spark, sf)
    lines = with_ordinal(
        cls.select("song", "artist", to_csv_line("song", "artist", "class").alias("value")),
        ["song", "artist"],
    ).select(F.col("ordinal").cast("long").alias("ordinal"), "value")
    header = lines.limit(1).select(F.lit(0).cast("long").alias("ordinal"), F.lit("song,artist,class").alias("value"))
    return header.unionByName(lines)


def q_build_enriched(spark, sf):
    """C17 end to end on the stand-ins (cap of 300 per listed class)."""
    return build.build_enriched(
        _raw_chart_lines(spark, sf), si.unranked(spark, sf), si.catalogue(spark, sf),
        si.audio_features(spark, sf), cap_n=CAP_N,
    )


# --------------------------------------------------------------- balancing

CAP_LABELS = [0, 10]
CAP_N = 300


def q_cap_classes(spark, sf):
    return balance.cap_classes(_classified(spark, sf), CAP_LABELS, CAP_N, keys=["song", "artist"])


def q_binary_relabel(spark, sf):
    return balance.binary_relabel(_left_default(spark, sf))


def q_equalize_classes(spark, sf):
    binary = balance.binary_relabel(_classified(spark, sf))
    return balance.equalize_classes(binary, keys=["song", "artist"])


def q_add_default_class_sample(spark, sf):
    return balance.add_default_class_sample(
        _classified(spark, sf), si.unranked(spark, sf), keys=["title", "artist_name"]
    )


def q_class_distribution(spark, sf):
    ensure_checkpoint_dir(spark)
    classified = _classified(spark, sf).checkpoint()  # three datasets are made of it
    return evaluate.distribution_report({
        "classified": classified,
        "with_default": chart.classify_with_default(_features_as_songs(spark, sf), classified),
        "capped": balance.cap_classes(classified, CAP_LABELS, CAP_N, keys=["song", "artist"]),
    })


# --------------------------------------------------------------- splits and scaling

def q_hash_split(spark, sf):
    e = read_table(spark, sf, "embeddings").select("vec_id", "label")
    return e.withColumn("split", split.hash_split_label(["vec_id"]))


def q_random_split_sizes(spark, sf):
    """M3 as in the original (``randomSplit``, seed 0): rows per split. The
    members depend on the input partitioning, so only sizes are reported."""
    e = read_table(spark, sf, "embeddings").select("vec_id", "label")
    parts = split.random_split(e)
    tagged = [p.select(F.lit(n).alias("split")) for n, p in zip(split.SPLIT_NAMES, parts)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t)
    return out.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def q_exact_split(spark, sf):
    e = read_table(spark, sf, "embeddings").select("vec_id", "label")
    return split.exact_split_label(e, ["vec_id"])


def q_scale_features(spark, sf):
    p = read_table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("size"),
        "p_retailprice", F.lit(1.0).alias("const")
    )
    names = ["s_size", "s_price", "s_const"]
    v = models.assemble(p, ["size", "p_retailprice", "const"])
    scaled = models.scale_features(v)
    out = models.vector_column_values(scaled.select("p_partkey", "scaled_features"), "scaled_features", names)
    return out.select("p_partkey", *[F.round(n, 6).alias(n) for n in names])


# --------------------------------------------------------------- evaluation

def q_confusion_matrix(spark, sf):
    return evaluate.confusion_counts(_argmax_prediction(spark, sf))


def q_weighted_f1(spark, sf):
    f1 = evaluate.weighted_f1(_argmax_prediction(spark, sf))
    return f1.select(F.round("weighted_f1", 6).alias("weighted_f1"))


def q_accuracy_micro_f1(spark, sf):
    acc = evaluate.accuracy(_argmax_prediction(spark, sf))
    return acc.select(F.round("accuracy", 6).alias("accuracy"))


# Thresholds of the rule sweep (document length -> quality).
RULE_THRESHOLDS = [250, 500, 1000, 2000, 4000, 8000]


def q_sweep_select(spark, sf):
    """O4/E4/E5 on a rule 'model': quality = 1 when a document is longer than
    a threshold; accuracy per split; best by validation, first on ties."""
    lab = read_table(spark, sf, "labels")
    doc = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    data = lab.join(doc, "doc_id").withColumn("split", split.hash_split_label(["doc_id"]))
    th = F.array(*[F.lit(t) for t in RULE_THRESHOLDS])
    per = data.select("quality", "n_chars", "split", F.posexplode(th).alias("ordinal", "threshold"))
    hit = ((F.col("n_chars") > F.col("threshold")).cast("int") == F.col("quality")).cast("double")
    scores = (
        per.groupBy("ordinal", "threshold")
        .pivot("split", list(split.SPLIT_NAMES))
        .agg(F.avg(hit))
    )
    best = evaluate.mark_best(scores, by="val", order="ordinal")
    return best.select(
        "ordinal", "threshold",
        *[F.round(c, 6).alias(c) for c in split.SPLIT_NAMES],
        "is_best",
    )


# --------------------------------------------------------------- models (rows only)

def _vectors(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return models.array_features(
        e.select("vec_id", F.col("label").cast("double").alias("class"), "embedding"), "embedding"
    ).drop("embedding")


def _widths(spark, sf) -> tuple[int, int]:
    """Input and output width of a network: values of a vector, distinct
    classes (A5)."""
    e = read_table(spark, sf, "embeddings")
    return e.agg(F.max(F.size("embedding"))).first()[0], evaluate.distinct_label_count(e, "label").first()[0]


def _splits(spark, sf, df=None):
    df = df if df is not None else _vectors(spark, sf)
    return split.exact_split(df, ["vec_id"])


def q_lr_sweep(spark, sf):
    train, val, test = _splits(spark, sf)
    return models.sweep("lr", "regParam", models.REG_PARAMS, train, val, test)


def q_rf_sweep(spark, sf):
    train, val, test = _splits(spark, sf)
    return models.sweep("rf", "maxDepth", models.MAX_DEPTHS, train, val, test)


def q_mlp_sweep(spark, sf):
    vec = models.index_labels(_vectors(spark, sf), "class", "label").drop("class")
    vec = vec.withColumnRenamed("label", "class")
    train, val, test = _splits(spark, sf, vec)
    d, k = _widths(spark, sf)
    return models.sweep(
        "mlp", "layers", models.HIDDEN_WIDTHS, train, val, test,
        make_params=lambda h: {"layers": models.mlp_layers(d, h, k)}, scale=True,
    )


def q_svc_sweep(spark, sf):
    """M10 on the binary variant (C15 + C16)."""
    train, val, test = _splits(spark, sf, _binary_vectors(spark, sf))
    n = train.count()  # one number: C -> regParam = 1 / (C n)
    return models.sweep(
        "svc", "C", models.SVM_C, train, val, test,
        make_params=lambda c: {"regParam": models.svc_reg_param(c, n)},
        parallelism=len(models.SVM_C), metric="accuracy", scale=True,
    )


def q_lr_iter_sweep(spark, sf):
    train, val, test = _splits(spark, sf)
    return models.sweep("lr", "maxIter", models.MAX_ITERS, train, val, test, scale=True)


def q_rf_trees_sweep(spark, sf):
    train, val, test = _splits(spark, sf)
    return models.sweep("rf", "numTrees", models.NUM_TREES, train, val, test)


def q_mlp_iter_sweep(spark, sf):
    """M7 iteration sweep with two hidden layers of 20."""
    d, k = _widths(spark, sf)
    train, val, test = _splits(spark, sf)
    return models.sweep(
        "mlp", "maxIter", models.MAX_ITERS, train, val, test,
        layers=models.mlp_layers(d, [20, 20], k), scale=True,
    )


def q_svc_iter_sweep(spark, sf):
    vec = _binary_vectors(spark, sf)
    train, val, test = _splits(spark, sf, vec)
    return models.sweep("svc", "maxIter", models.MAX_ITERS, train, val, test, metric="accuracy", scale=True)


def _binary_vectors(spark, sf):
    """C15 + C16 on the vectors: the stand-in's last class (9) plays the
    default class; class 0 is cut to the smaller class."""
    vec = _vectors(spark, sf).withColumn("class", binary_relabel_expr("class", 9).cast("double"))
    return balance.equalize_classes(vec, keys=["vec_id"])


def q_binary_rf_sweep(spark, sf):
    """M8: depth sweep on the binary data (up to Spark's depth of 30)."""
    train, val, test = _splits(spark, sf, _binary_vectors(spark, sf))
    return models.sweep("rf", "maxDepth", models.BINARY_DEPTHS, train, val, test, metric="accuracy")


def q_binary_rf_trees_sweep(spark, sf):
    """M8: tree-count sweep on the binary data."""
    train, val, test = _splits(spark, sf, _binary_vectors(spark, sf))
    return models.sweep("rf", "numTrees", models.NUM_TREES, train, val, test, metric="accuracy")


def q_binary_mlp_width_sweep(spark, sf):
    """M9: hidden-width sweep on the binary data (one hidden layer)."""
    d, _ = _widths(spark, sf)
    train, val, test = _splits(spark, sf, _binary_vectors(spark, sf))
    return models.sweep(
        "mlp", "layers", models.HIDDEN_WIDTHS, train, val, test,
        make_params=lambda h: {"layers": models.mlp_layers(d, h, 2)}, metric="accuracy", scale=True,
    )


def q_binary_mlp_rate_sweep(spark, sf):
    """M9: learning-rate sweep, gradient descent with that step size."""
    d, _ = _widths(spark, sf)
    train, val, test = _splits(spark, sf, _binary_vectors(spark, sf))
    return models.sweep(
        "mlp", "stepSize", models.LEARNING_RATES, train, val, test,
        solver="gd", layers=models.mlp_layers(d, 100, 2), metric="accuracy", scale=True,
    )


# The reference's whole grids (tree depths up to Spark's 30).
CV_GRIDS = {
    "lr": {"regParam": models.REG_PARAMS, "maxIter": models.MAX_ITERS},
    "rf": {"maxDepth": models.MAX_DEPTHS, "numTrees": models.NUM_TREES},
    # The data give the input and output widths.
    "mlp": {"layers": [(None, h, None) for h in models.HIDDEN_WIDTHS], "maxIter": models.MAX_ITERS},
}
CV_PARALLELISM = 8


def _cv(family, spark, sf):
    train, _, test = _splits(spark, sf)
    grid = dict(CV_GRIDS[family])
    if family == "mlp":
        d, k = _widths(spark, sf)
        grid["layers"] = [models.mlp_layers(d, h, k) for _, h, _ in grid["layers"]]
    _, table, test_f1 = models.cross_validate(family, grid, train, test, parallelism=CV_PARALLELISM)
    return table.withColumn("test_f1_of_best", F.when(F.col("is_best"), F.lit(test_f1)))


def q_lr_cv(spark, sf):
    return _cv("lr", spark, sf)


def q_rf_cv(spark, sf):
    return _cv("rf", spark, sf)


def q_mlp_cv(spark, sf):
    return _cv("mlp", spark, sf)


def q_cv_confusion(spark, sf):
    """Confusion counts of the LR cross-validation winner on test."""
    train, _, test = _splits(spark, sf)
    model, _, _ = models.cross_validate("lr", CV_GRIDS["lr"], train, test, parallelism=CV_PARALLELISM)
    return evaluate.confusion_counts(models.predict(model, test))


def q_sweep_confusion(spark, sf):
    """Confusion matrices on test of the model that each sweep selects:
    LR, RF, MLP on all classes, RF on the binary data."""
    d, k = _widths(spark, sf)
    ensure_checkpoint_dir(spark)  # one folder for all threads

    def counted(name, family, values, data, options):
        train, val, test = _splits(spark, sf, data)
        fitted: list = []
        table = models.sweep(family, *values, train, val, test, fitted=fitted, parallelism=1, **options)
        return evaluate.confusion_counts(models.best_predictions(fitted, table, test)).select(F.lit(name).alias("family"), "*")

    sweeps = (
        ("lr", "lr", ("regParam", models.REG_PARAMS), None, {}),
        ("rf", "rf", ("maxDepth", models.MAX_DEPTHS), None, {}),
        ("mlp", "mlp", ("layers", models.HIDDEN_WIDTHS), None, {"make_params": lambda h: {"layers": models.mlp_layers(d, h, k)}, "scale": True}),
        ("binary_rf", "rf", ("maxDepth", models.BINARY_DEPTHS), _binary_vectors(spark, sf), {"metric": "accuracy"}),
    )
    # The sweeps do not depend on each other; the short jobs of one use the cores that another leaves idle.
    # One fit of each at a time is as many as a sweep alone has, in the driver's memory too.
    with ThreadPoolExecutor(max_workers=len(sweeps)) as pool:
        out = reduce(DataFrame.unionByName, pool.map(lambda s: counted(*s), sweeps))
    return out.groupBy("family", "actual").pivot("predicted", [float(c) for c in range(k)]).agg(F.sum("n")).na.fill(0).withColumnsRenamed(
        {f"{float(c)}": f"predicted_{c}" for c in range(k)})


def q_family_comparison(spark, sf):
    """LR regParam sweep vs RF depth sweep, stacked."""
    train, val, test = _splits(spark, sf)
    lr = models.sweep("lr", "regParam", models.REG_PARAMS, train, val, test)
    rf = models.sweep("rf", "maxDepth", models.MAX_DEPTHS, train, val, test)
    return evaluate.compare_families({"lr": lr, "rf": rf})


QUERIES: dict[str, Query] = {
    "best_rank": q_best_rank,
    "best_rank_stream": q_best_rank_stream,
    "classify_rankings": q_classify_rankings,
    "class_histogram": q_class_histogram,
    "class_histogram_bins": q_class_histogram_bins,
    "classified_join": q_classified_join,
    "classified_left_default": q_classified_left_default,
    "date_range_filter": q_date_range_filter,
    "fallback_lookup": q_fallback_lookup,
    "json_field": q_json_field,
    "drop_unidentified": q_drop_unidentified,
    "batch_enrich": q_batch_enrich,
    "row_aligned_concat": q_row_aligned_concat,
    "clean_text": q_clean_text,
    "repair_lines": q_repair_lines,
    "dedupe_first": q_dedupe_first,
    "shard_assign": q_shard_assign,
    "resume_anti_join": q_resume_anti_join,
    "cap_classes": q_cap_classes,
    "build_enriched": q_build_enriched,
    "binary_relabel": q_binary_relabel,
    "equalize_classes": q_equalize_classes,
    "add_default_class_sample": q_add_default_class_sample,
    "class_distribution": q_class_distribution,
    "hash_split": q_hash_split,
    "exact_split": q_exact_split,
    "random_split_sizes": q_random_split_sizes,
    "scale_features": q_scale_features,
    "confusion_matrix": q_confusion_matrix,
    "weighted_f1": q_weighted_f1,
    "accuracy_micro_f1": q_accuracy_micro_f1,
    "sweep_select": q_sweep_select,
    "lr_sweep": q_lr_sweep,
    "rf_sweep": q_rf_sweep,
    "mlp_sweep": q_mlp_sweep,
    "svc_sweep": q_svc_sweep,
    "lr_iter_sweep": q_lr_iter_sweep,
    "rf_trees_sweep": q_rf_trees_sweep,
    "mlp_iter_sweep": q_mlp_iter_sweep,
    "svc_iter_sweep": q_svc_iter_sweep,
    "binary_rf_sweep": q_binary_rf_sweep,
    "binary_rf_trees_sweep": q_binary_rf_trees_sweep,
    "binary_mlp_width_sweep": q_binary_mlp_width_sweep,
    "binary_mlp_rate_sweep": q_binary_mlp_rate_sweep,
    "lr_cv": q_lr_cv,
    "rf_cv": q_rf_cv,
    "mlp_cv": q_mlp_cv,
    "cv_confusion": q_cv_confusion,
    "sweep_confusion": q_sweep_confusion,
    "family_comparison": q_family_comparison,
}

QUERIES |= analysis.QUERIES | files.QUERIES
