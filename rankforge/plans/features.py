"""Which features matter: pairwise correlation, principal components, Jaccard
scores and permutation importance."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.functions.scalar import hash_order
from rankforge.operators.ordinal import with_ordinal


# ---------------------------------------------------------------- moments

def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, n, mean_a, mean_b, var_a, var_b, cov) of every pair of columns
    (each with itself too), over the rows in which both have a value (null and
    NaN are none): one aggregate in which a task sends one row a pair."""
    value = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)]
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"v{i}").alias("x"), F.col(f"v{j}").alias("y"))
                      for i in range(len(columns)) for j in range(i, len(columns))])
    rows = df.select(*value).select(F.explode(pairs).alias("p")).select("p.*")
    sums = rows.groupBy("i", "j").agg(F.regr_count("y", "x").alias("n"), F.regr_avgx("y", "x").alias("mean_a"), F.regr_avgy("y", "x").alias("mean_b"),
                                      *[f("y", "x").alias(c) for f, c in ((F.regr_sxx, "sa"), (F.regr_syy, "sb"), (F.regr_sxy, "sab"))])
    name = F.array(*[F.lit(c) for c in columns])
    return sums.select(F.get(name, F.col("i")).alias("a"), F.get(name, F.col("j")).alias("b"), "n", "mean_a", "mean_b",
                       *[(F.col(c) / F.nullif(F.col("n"), F.lit(0))).alias(v) for c, v in (("sa", "var_a"), ("sb", "var_b"), ("sab", "cov"))])


def array_moments(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """:func:`moments` of an array column with ``len(names)`` values a row (no
    nulls in it): each task adds up one Gram matrix, which Spark adds up.
    Sums are taken about the first rows' mean, so they stay small."""
    width = len(names)
    origin = np.array(df.where(F.col(column).isNotNull()).limit(1000).agg(*[F.avg(F.get(column, F.lit(i))) for i in range(width)]).first(), float)
    origin = np.nan_to_num(origin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, gram = 0, np.zeros(width), np.zeros((width, width))
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width) - origin
            n, total, gram = n + len(x), total + x.sum(0), gram + x.T @ x
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i, j, np.full(len(i), n), total[i], total[j], gram[i, i], gram[j, j], gram[i, j])],
                                         names=["i", "j", "n", "si", "sj", "sii", "sjj", "sij"])

    parts = df.where(F.col(column).isNotNull()).select(column).mapInArrow(
        run, "i long, j long, n long, si double, sj double, sii double, sjj double, sij double")
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sj", "sii", "sjj", "sij")]).where("n > 0")
    name, mean = F.array(*[F.lit(c) for c in names]), F.array(*[F.lit(float(v)) for v in origin])

    def at(values: Column, index: str) -> Column:
        return F.get(values, F.col(index).cast("int"))

    ma, mb = F.col("si") / F.col("n"), F.col("sj") / F.col("n")
    return sums.select(at(name, "i").alias("a"), at(name, "j").alias("b"), "n", (ma + at(mean, "i")).alias("mean_a"), (mb + at(mean, "j")).alias("mean_b"),
                       (F.col("sii") / F.col("n") - ma * ma).alias("var_a"), (F.col("sjj") / F.col("n") - mb * mb).alias("var_b"),
                       (F.col("sij") / F.col("n") - ma * mb).alias("cov"))


def correlation(of_pairs: DataFrame) -> DataFrame:
    """(a, b, n, pearson) of the pairs of different columns; null where one of
    them does not vary, or with no common row."""
    root = F.sqrt(F.col("var_a") * F.col("var_b"))
    return of_pairs.where(F.col("a") != F.col("b")).select("a", "b", "n", F.when(root > 0, F.col("cov") / root).alias("pearson"))


# ---------------------------------------------------------------- components

def pca(of_pairs: DataFrame, names: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(variances in descending order, components as rows, means) from the
    moments of all pairs. The matrix (names x names) is the only thing that
    reaches the driver. A component's largest loading is positive, the first
    of equal ones."""
    place = {c: i for i, c in enumerate(names)}
    cov, mean = np.zeros((len(names), len(names))), np.zeros(len(names))
    for r in of_pairs.select("a", "b", "cov", "mean_a").collect():
        i, j = place[r["a"]], place[r["b"]]
        cov[i, j] = cov[j, i] = r["cov"] or 0.0
        if i == j:
            mean[i] = r["mean_a"] or 0.0
    values, vectors = np.linalg.eigh(cov)
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1].T
    peak = np.abs(np.round(vectors, 9)).argmax(1)
    return values, vectors * np.where(vectors[np.arange(len(vectors)), peak] < 0, -1.0, 1.0)[:, None], mean


def pca_variance(of_pairs: DataFrame, names: Sequence[str]) -> DataFrame:
    """(component, variance, ratio, cumulative, loadings)."""
    values, vectors, _ = pca(of_pairs, names)
    total = values.sum() or 1.0
    rows = [(k + 1, float(v), float(v / total), float(values[:k + 1].sum() / total), [float(x) for x in w]) for k, (v, w) in enumerate(zip(values, vectors))]
    return of_pairs.sparkSession.createDataFrame(rows, "component int, variance double, ratio double, cumulative double, loadings array<double>")


def project(df: DataFrame, column: str, components: np.ndarray, mean: np.ndarray, out: str = "scores") -> DataFrame:
    """The rows' coordinates along some components, JVM-side."""
    centred = F.zip_with(F.col(column), F.array(*[F.lit(float(m)) for m in mean]), lambda v, m: v.cast("double") - m)

    def along(w: np.ndarray) -> Column:
        weights = F.array(*[F.lit(float(x)) for x in w])
        return F.aggregate(F.zip_with(centred, weights, lambda v, x: v * x), F.lit(0.0), lambda s, v: s + v)

    return df.withColumn(out, F.array(*[along(w) for w in components]))


# ---------------------------------------------------------------- Jaccard

def quantile_cuts(df: DataFrame, columns: Sequence[str], q: float = 0.5) -> dict[str, float]:
    """The value at position ceil(q n) of each column, nulls and NaN left out.
    All columns are ranked at once by the distributed ordinal; one value a
    column reaches the driver."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("v")) for c in columns]))
    long = df.select(pairs.alias("p")).select("p.c", "p.v").where("v is not null")
    ranked = with_ordinal(long, ["v"], ["c"], name="nth")
    wanted = long.groupBy("c").agg(F.greatest(F.lit(1), F.ceil(F.count("*") * F.lit(q))).alias("nth"))
    return {r["c"]: r["v"] for r in ranked.join(wanted, ["c", "nth"]).select("c", "v").collect()}


def jaccard(df: DataFrame, columns: Sequence[str], cuts: dict[str, float] | None = None, q: float = 0.5) -> DataFrame:
    """(a, b, n_both, n_either, jaccard) of the row sets in which a feature
    lies above its cut (default: its median). A row becomes one bit mask, rows
    with equal masks one count, and the pairs are read off the masks. Null and
    NaN lie above nothing; null score where neither feature ever does."""
    if len(columns) > 62:
        raise ValueError("a mask holds 62 features")
    cuts = quantile_cuts(df, columns, q) if cuts is None else cuts
    bits = [F.when(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) > F.lit(cuts[c]), F.lit(1 << i)).otherwise(0).cast("long")
            if c in cuts else F.lit(0).cast("long") for i, c in enumerate(columns)]
    masks = df.select(sum(bits[1:], bits[0]).alias("mask")).groupBy("mask").agg(F.count("*").alias("n"))
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(1 << i | 1 << j).cast("long").alias("m"))
                      for (i, a), (j, b) in combinations(enumerate(columns), 2)])
    met = masks.select("n", "mask", F.explode(pairs).alias("p")).select("n", "p.a", "p.b", "p.m", F.col("mask").bitwiseAND(F.col("p.m")).alias("hit"))
    out = met.groupBy("a", "b").agg(F.sum(F.when(F.col("hit") == F.col("m"), F.col("n")).otherwise(0)).alias("n_both"),
                                    F.sum(F.when(F.col("hit") != 0, F.col("n")).otherwise(0)).alias("n_either"))
    return out.withColumn("jaccard", F.when(F.col("n_either") > 0, F.col("n_both") / F.col("n_either")))


# ---------------------------------------------------------------- importance

def with_donors(df: DataFrame, id_col: str, columns: Sequence[str], seed: int = 0) -> DataFrame:
    """Each row with the ``columns`` of another one as ``donor``: the rows in
    id order meet the rows in seeded hash order at equal positions, so every
    row gives its values once. Ids are unique."""
    by_id = with_ordinal(df, [id_col], name="_position")
    donors = df.select(F.struct(*columns).alias("donor"), hash_order(id_col, seed=seed).alias("_h"), F.col(id_col).alias("_i"))
    donors = with_ordinal(donors, ["_h", "_i"], name="_position").select("_position", "donor")
    return by_id.join(donors, "_position").drop("_position")


def permutation_importance(df: DataFrame, id_col: str, features: Sequence[str], label: str, predict: Callable[[DataFrame], DataFrame],
                           seed: int = 0) -> DataFrame:
    """(feature, base_accuracy, permuted_accuracy, importance): how much
    accuracy a fitted model loses when one feature comes from another row.
    ``predict`` adds ``prediction`` to rows with the features; it sees each
    row once as it is and once a feature, in one pass."""
    mixed = with_donors(df.select(id_col, label, *features), id_col, features, seed)
    variants = F.array(F.lit(None).cast("string"), *[F.lit(f) for f in features])
    rows = mixed.select(label, F.explode(variants).alias("_permuted"), "donor", *features)
    rows = rows.select(F.col(label).alias("_label"), "_permuted",
                       *[F.when(F.col("_permuted") == f, F.col("donor")[f]).otherwise(F.col(f)).alias(f) for f in features])
    hits = predict(rows).groupBy("_permuted").agg(F.avg((F.col("prediction").cast("double") == F.col("_label").cast("double")).cast("double")).alias("accuracy"))
    base = hits.where("_permuted is null").select(F.col("accuracy").alias("base_accuracy"))
    return hits.where("_permuted is not null").crossJoin(F.broadcast(base)).select(
        F.col("_permuted").alias("feature"), "base_accuracy", F.col("accuracy").alias("permuted_accuracy"),
        (F.col("base_accuracy") - F.col("accuracy")).alias("importance"))
