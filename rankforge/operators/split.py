"""Train / validation / test splits: M3 (random and stable-hash) and M4 (exact)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.functions.scalar import hash_bucket, hash_order
from rankforge.operators.ordinal import with_ordinal

# The 60 / 20 / 20 split and its seed.
DEFAULT_WEIGHTS = (0.6, 0.2, 0.2)
SPLIT_NAMES = ("train", "val", "test")
# Hashes of 32 bits in one of 100 buckets, at most.
BUCKET_WIDTH = -(-(2**32) // 100)


def random_split(df: DataFrame, weights=DEFAULT_WEIGHTS, seed: int = 0) -> list[DataFrame]:
    """M3 as in the original: ``randomSplit`` (approximate sizes; rows depend
    on the partitioning of the input)."""
    return df.randomSplit(list(weights), seed=seed)


def hash_split_label(keys: Sequence[str], weights=DEFAULT_WEIGHTS, seed: int = 0, names=SPLIT_NAMES):
    """Stable split label from ``md5`` of the key: bucket 0..99, and within a
    bucket the rest of the 32-bit hash, against the cumulative weights.
    Row-local, reproducible on any partitioning."""
    h = hash_bucket(*keys, seed=seed, buckets=2**32)
    b = F.pmod(h, F.lit(100)) * BUCKET_WIDTH + F.floor(h / 100)
    cuts = []
    acc = 0.0
    for w in weights[:-1]:
        acc += w / sum(weights)
        cuts.append(round(acc * 100 * BUCKET_WIDTH))
    expr = None
    for name, cut in zip(names, cuts):
        expr = F.when(b < cut, F.lit(name)) if expr is None else expr.when(b < cut, F.lit(name))
    return expr.otherwise(F.lit(names[len(cuts)]))


def hash_split(df: DataFrame, keys: Sequence[str], weights=DEFAULT_WEIGHTS, seed: int = 0) -> list[DataFrame]:
    """M3, stable form: three filters on :func:`hash_split_label`."""
    labelled = df.withColumn("_rf_split", hash_split_label(keys, weights, seed))
    return [
        labelled.where(F.col("_rf_split") == n).drop("_rf_split")
        for n in SPLIT_NAMES[: len(weights)]
    ]


def exact_split_sizes(n: int, test_size: float = 0.2, val_size: float = 0.25) -> tuple[int, int, int]:
    """M4 sizes: ``n_test = ceil(0.2 n)``, ``n_val = ceil(0.25 (n - n_test))``."""
    n_test = math.ceil(test_size * n)
    n_val = math.ceil(val_size * (n - n_test))
    return n - n_test - n_val, n_val, n_test


# Band around an expected cut: +-(BAND_SIGMAS * sqrt(k) + BAND_SLACK) rows.
BAND_SIGMAS = 4.0
BAND_SLACK = 100


def _tuple_le(cols: Sequence[F.Column], values: Sequence, types: Sequence[str]) -> F.Column:
    """Lexicographic ``(c1, c2, ...) <= (v1, v2, ...)`` against literals."""
    out = F.lit(True)
    for c, v, t in reversed(list(zip(cols, values, types))):
        lit = F.lit(v).cast(t)
        out = (c < lit) | ((c == lit) & out)
    return out


def rank_cuts(pre: DataFrame, ks: Sequence[int], n: int, keys: Sequence[str]) -> list[tuple | None]:
    """The (hash, key...) tuples at 1-based ranks ``ks`` of the seeded order
    (``None`` for rank 0). ``pre`` carries ``_rf_h`` (md5 hex).

    Exact distributed selection: hashes are uniform, so the k-th smallest
    lies near prefix k/n. One aggregate pass counts, for every cut, the rows
    below a narrow prefix band and inside it; only the bands (~sqrt(k) rows)
    are ranked, with the distributed ordinal. A band that misses its cut (a
    many-sigma event) widens to every row. The driver receives one row of
    counts and one tuple per cut.
    """
    p = F.substring("_rf_h", 1, 8)
    bands = []
    for k in ks:
        d = (BAND_SIGMAS * math.sqrt(k) + BAND_SLACK) / max(n, 1)
        f = k / max(n, 1)
        lo = f"{int(max(0.0, f - d) * 4294967295.0):08x}"
        hi = f"{int(min(1.0, f + d) * 4294967295.0):08x}"
        bands.append((lo, hi))
    aggs = []
    for i, (lo, hi) in enumerate(bands):
        aggs.append(F.count(F.when(p < lo, 1)).alias(f"b{i}"))
        aggs.append(F.count(F.when(p.between(lo, hi), 1)).alias(f"i{i}"))
    counts = pre.agg(*aggs).collect()[0] if bands else None
    cuts: list[tuple | None] = []
    for i, k in enumerate(ks):
        if k <= 0:
            cuts.append(None)
            continue
        lo, hi = bands[i]
        below, inside = counts[f"b{i}"], counts[f"i{i}"]
        if not (below < k <= below + inside):
            lo, hi, below = "00000000", "ffffffff", 0
        band = pre.where(p.between(lo, hi)).select("_rf_h", *keys)
        ranked = with_ordinal(band, ["_rf_h", *keys], name="_rf_r")
        row = ranked.where(F.col("_rf_r") == k - below).select("_rf_h", *keys).collect()
        if not row:
            raise ValueError(f"no row at rank {k}: the keys are null or not unique")
        cuts.append(tuple(row[0]))
    return cuts


def exact_split_label(
    df: DataFrame,
    keys: Sequence[str],
    seed: int = 0,
    test_size: float = 0.2,
    val_size: float = 0.25,
    name: str = "split",
) -> DataFrame:
    """M4: exact-size split: rows ranked in the seeded order; the first
    ``ceil(0.2 n)`` are test, the next ``ceil(0.25 (n - n_test))`` are
    validation, the rest train.

    Only the two cut tuples are computed (:func:`rank_cuts`); each row is then
    labelled by comparing its own (hash, key) with them -- no shuffle or
    checkpoint of the data itself, whatever its size."""
    pre = df.withColumn("_rf_h", hash_order(*keys, seed=seed))
    n = pre.count()
    _, n_val, n_test = exact_split_sizes(n, test_size, val_size)
    cut_test, cut_val = rank_cuts(pre, [n_test, n_test + n_val], n, keys)
    types = dict(pre.dtypes)
    cols = [F.col("_rf_h")] + [F.col(k) for k in keys]
    tys = [types["_rf_h"]] + [types[k] for k in keys]

    def within(cut):
        return F.lit(False) if cut is None else F.coalesce(_tuple_le(cols, cut, tys), F.lit(False))

    label = (
        F.when(within(cut_test), F.lit("test"))
        .when(within(cut_val), F.lit("val"))
        .otherwise(F.lit("train"))
    )
    return pre.withColumn(name, label).drop("_rf_h")


def exact_split(df: DataFrame, keys: Sequence[str], seed: int = 0, **kw) -> list[DataFrame]:
    """M4 as three DataFrames (train, val, test)."""
    labelled = exact_split_label(df, keys, seed, name="_rf_split", **kw)
    return [
        labelled.where(F.col("_rf_split") == n).drop("_rf_split") for n in SPLIT_NAMES
    ]
