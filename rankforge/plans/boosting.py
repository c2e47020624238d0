"""Gradient-boosted trees over several classes at once.

``pyspark.ml`` boosts two classes only. Here each round grows one small tree a
class on the softmax residuals of all of them. The table is binned once and
checkpointed. A level of all the round's trees takes one pass: every task adds
its rows' gradients up per (class, node, feature, bin), Spark adds the tasks
up, and the driver, which sees these sums only (classes x nodes x features x
bins at most), picks the splits. Rows hold no state: a pass computes their
scores from the trees so far, so a lost task is simply run again.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.plans.evaluate import mark_best
from rankforge.plans.models import materialize_split

#: Shrinkage of a leaf's sum of second derivatives; the least of it a child has.
SMOOTH, LEAST = 1.0, 1e-3


@dataclass
class Boosted:
    """``feature`` and ``cut`` of each inner node (feature -1: all go left),
    ``leaf`` values; arrays of rounds x classes x nodes."""

    classes: list[float]
    cuts: list[list[float]]
    depth: int
    feature: np.ndarray = field(default=None)
    cut: np.ndarray = field(default=None)
    leaf: np.ndarray = field(default=None)

    def __post_init__(self):
        shape = (0, len(self.classes), (1 << self.depth) - 1)
        self.feature, self.cut = np.zeros(shape, int), np.zeros(shape, int)
        self.leaf = np.zeros((0, len(self.classes), 1 << self.depth))


def _columns(bins: np.ndarray) -> np.ndarray:
    """Rows x features as one array a feature."""
    return np.ascontiguousarray(bins.T.astype(np.uint8))


def _nodes(feature: np.ndarray, cut: np.ndarray, columns: np.ndarray, levels: int) -> np.ndarray:
    """Of each row, the place among the nodes of a level of one tree: each
    node's cut is held against its feature's whole column."""
    node = np.zeros(columns.shape[1], np.uint8 if levels <= 8 else np.int64)
    for level in range(levels):
        right = np.zeros(len(node), bool)
        for n in range(1 << level):
            at = (1 << level) - 1 + n
            if feature[at] >= 0:
                beyond = columns[feature[at]] > cut[at]
                right |= beyond if level == 0 else beyond & (node == n)
        node = 2 * node + right
    return node


def _staged(model: Boosted, columns: np.ndarray, stages: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(r, scores after r rounds: classes x rows) of rising ``stages``; each
    round is added up once, into one array."""
    out, done = np.zeros((len(model.classes), columns.shape[1])), 0
    for stage in stages:
        for r in range(done, min(stage, len(model.leaf))):
            for k in range(len(model.classes)):
                out[k] += model.leaf[r, k][_nodes(model.feature[r, k], model.cut[r, k], columns, model.depth)]
        done = max(done, min(stage, len(model.leaf)))
        yield stage, out


def scores(model: Boosted, bins: np.ndarray, rounds: int | None = None) -> np.ndarray:
    return next(_staged(model, _columns(bins), [len(model.leaf) if rounds is None else rounds]))[1].T


def _binned(cuts: list[list[float]], flat: np.ndarray) -> np.ndarray:
    x = flat.reshape(-1, len(cuts))
    return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)


def quantile_bins(train: DataFrame, features: Sequence[str], n_bins: int = 16) -> list[list[float]]:
    """Cuts between bins: approximate quantiles of the training rows."""
    found = train.approxQuantile(list(features), [i / n_bins for i in range(1, n_bins)], 0.001)
    return [sorted(set(c)) for c in found]


def _bin_table(df: DataFrame, features: Sequence[str], label: str, cuts: list[list[float]], classes: list[float]) -> DataFrame:
    """(y, bins): the class's place (null: not among the classes)."""
    place = F.create_map(*[F.lit(v) for i, c in enumerate(classes) for v in (float(c), i)])
    rows = df.select(F.try_element_at(place, F.col(label).cast("double")).cast("int").alias("y"),
                     F.array(*[F.col(f).cast("double") for f in features]).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = _binned(cuts, b.column("x").flatten().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array([r.tobytes() for r in bins.astype(np.uint8)], pa.binary())], names=["y", "bins"])

    return materialize_split(rows.mapInArrow(run, "y int, bins binary"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width).astype(int)


def _level_sums(table: DataFrame, model: Boosted, grown: tuple[np.ndarray, np.ndarray], level: int, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the first and second derivatives, by class, node, feature, bin."""
    width, n_classes, nodes = len(model.cuts), len(model.classes), 1 << level
    shape = (n_classes, nodes, width, n_bins)
    shared = table.sparkSession.sparkContext.broadcast((model, grown))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far, (feature, cut) = shared.value
        g, h = np.zeros((n_classes, nodes * width * n_bins)), np.zeros((n_classes, nodes * width * n_bins))
        for b in batches:
            bins, y = _matrix(b.column("bins"), width), b.column("y").to_numpy(zero_copy_only=False).astype(int)
            columns, places = _columns(bins), bins + np.arange(width) * n_bins
            s = scores(so_far, bins)
            p = np.exp(s - s.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            for k in range(n_classes):
                node = _nodes(feature[k], cut[k], columns, level).astype(np.int64)
                cell = (node[:, None] * (width * n_bins) + places).ravel()
                g[k] += np.bincount(cell, np.repeat(p[:, k] - (y == k), width), g.shape[1])
                h[k] += np.bincount(cell, np.repeat(p[:, k] * (1 - p[:, k]), width), h.shape[1])
        g, h = g.ravel(), h.ravel()
        met = np.flatnonzero(h)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(g[met]), pa.array(h[met])], names=["cell", "g", "h"])

    sums = table.where("y is not null").mapInArrow(run, "cell long, g double, h double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    got = sums.toArrow()  # at most one row a cell
    g, h = np.zeros(int(np.prod(shape))), np.zeros(int(np.prod(shape)))
    at = got.column("cell").to_numpy()
    g[at], h[at] = got.column("g").to_numpy(), got.column("h").to_numpy()
    return np.round(g, 9).reshape(shape), np.round(h, 9).reshape(shape)


def fit(train: DataFrame, features: Sequence[str], label: str, *, rounds: int, depth: int = 3, rate: float = 0.3, n_bins: int = 16) -> Boosted:
    """Boost ``rounds`` times on rows without null features; null labels are
    left out. Of equal splits the one of the first feature and bin is taken."""
    classes = [float(r[0]) for r in train.select(label).where(F.col(label).isNotNull()).distinct().orderBy(label).collect()]  # one row a class
    model = Boosted(classes, quantile_bins(train, features, n_bins), depth)
    table = _bin_table(train, features, label, model.cuts, classes)
    n_classes = len(classes)
    for _ in range(rounds):
        feature, cut = np.full((n_classes, (1 << depth) - 1), -1), np.zeros((n_classes, (1 << depth) - 1), int)
        leaf = np.zeros((n_classes, 1 << depth))
        for level in range(depth):
            g, h = _level_sums(table, model, (feature, cut), level, n_bins)
            gl, hl = np.cumsum(g, axis=3), np.cumsum(h, axis=3)
            gt, ht = gl[..., :1, -1:], hl[..., :1, -1:]  # a node's totals, the same by every feature
            gain = gl ** 2 / (hl + SMOOTH) + (gt - gl) ** 2 / (ht - hl + SMOOTH) - gt ** 2 / (ht + SMOOTH)
            gain[(hl < LEAST) | (ht - hl < LEAST)] = 0.0
            flat = np.round(gain, 9).reshape(n_classes, 1 << level, -1)
            best = flat.argmax(2)
            for k in range(n_classes):
                for node in range(1 << level):
                    at, f, c = (1 << level) - 1 + node, best[k, node] // n_bins, best[k, node] % n_bins
                    left, right = (gt[k, node, 0, 0], ht[k, node, 0, 0]), (0.0, 0.0)
                    if flat[k, node, best[k, node]] > 0:
                        feature[k, at], cut[k, at] = f, c
                        left = gl[k, node, f, c], hl[k, node, f, c]
                        right = gt[k, node, 0, 0] - left[0], ht[k, node, 0, 0] - left[1]
                    if level == depth - 1:
                        leaf[k, 2 * node], leaf[k, 2 * node + 1] = (-rate * a / (b + SMOOTH) for a, b in (left, right))
        model.feature, model.cut = np.concatenate([model.feature, feature[None]]), np.concatenate([model.cut, cut[None]])
        model.leaf = np.concatenate([model.leaf, leaf[None]])
    return model


def predict(model: Boosted, df: DataFrame, features: Sequence[str], label: str, rounds: Sequence[int] | None = None) -> DataFrame:
    """(label, rounds, prediction) of each row after each number of rounds."""
    stages = sorted(rounds or [len(model.leaf)])
    rows = df.select(F.col(label).cast("double").alias("class"), F.array(*[F.col(f).cast("double") for f in features]).alias("x"))
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array(m.classes)
        for b in batches:
            bins = _binned(m.cuts, b.column("x").flatten().to_numpy(zero_copy_only=False))
            for r, s in _staged(m, _columns(bins), stages):
                best = names[s.argmax(0)] if len(bins) else np.zeros(0)
                yield pa.RecordBatch.from_arrays([b.column("class"), pa.array(np.full(len(bins), r, np.int32)), pa.array(best, pa.float64())],
                                                 names=["class", "rounds", "prediction"])

    return rows.mapInArrow(run, "class double, rounds int, prediction double")


def _f1_by_rounds(predicted: DataFrame) -> dict[int, float]:
    """Weighted F1 after each number of rounds, as :func:`weighted_f1`, from
    one pass; the driver gets a row per (rounds, class, prediction)."""
    found: dict[int, list] = {}
    for r, y, p, n in predicted.groupBy("rounds", "class", "prediction").count().orderBy("rounds", "class", "prediction").collect():
        found.setdefault(r, []).append((y, p, n))
    out = {}
    for r, cells in found.items():
        rows, said, hits = Counter(), Counter(), Counter()
        for y, p, n in cells:
            rows[y] += n
            said[p] += n
            hits[y] += n if y == p else 0
        out[r] = sum(w * 2.0 * hits[y] / (w + said[y]) for y, w in rows.items() if hits[y]) / rows.total()
    return out


def gbt_sweep(features: Sequence[str], rounds: Sequence[int], train: DataFrame, val: DataFrame, test: DataFrame, label: str = "class",
              fitted: list | None = None, **params) -> DataFrame:
    """The sweep table over the number of rounds, from one run: the model of
    r rounds is the first r of the longest. Scores are weighted F1
    (:func:`rankforge.plans.evaluate.weighted_f1`); each split is read once."""
    splits = {n: materialize_split(d) for n, d in (("train", train), ("val", val), ("test", test))}
    began = time.perf_counter()
    model = fit(splits["train"], features, label, rounds=max(rounds), **params)
    took = time.perf_counter() - began
    if fitted is not None:
        fitted.append(model)
    rows = []
    found = {n: _f1_by_rounds(predict(model, d, features, label, rounds)) for n, d in splits.items()}
    for i, r in enumerate(rounds):
        f1 = [found[n].get(r, 0.0) for n in splits]
        rows.append(("gbt", "rounds", i, float(r), *f1, took * r / max(rounds)))
    return mark_best(train.sparkSession.createDataFrame(
        rows, "family string, param string, ordinal int, value double, train double, val double, test double, fit_seconds double"))
