"""Random forests that do not lie in the driver.

``pyspark.ml`` keeps every node of a forest, with its statistics, as objects in
the driver and sends dense statistics of every open node at every level. Here
rows become one byte a feature, a tree is grown where its rows are, by one
task, and a finished node takes about two bytes.

A forest is what ``RandomForestClassifier`` defines: Poisson bootstrap, square
root of the features a node (all of them for a single tree), at most
``maxBins`` bins a feature, Gini gain, leaves of equal prediction merged,
votes by the leaves' class shares. Draws are keyed by seed, tree, row id and
node, so the number of tasks changes nothing.

Rows of up to ``LOCAL_BYTES`` go whole to the tasks, one tree each. Of more
rows, the top levels grow from sums that every task adds up over its rows,
until a node's rows fit into a task; they then meet there (a *part*).
"""

from __future__ import annotations

import io
import math
import threading
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.session import ensure_checkpoint_dir

# Statistics (nodes x features x bins x classes) that are held at a time.
CELLS = 1 << 18
# Binned rows, and finished trees, that one task (and the driver) may hold.
LOCAL_BYTES = 64 << 20
# Trees whose rows are shuffled at a time.
WAVE = 8
# Fits whose rows lie whole with the tasks at a time. They pass through the
# driver in one thread: each other would keep as much memory for itself.
_WHOLE, _PASSING = threading.BoundedSemaphore(2), ThreadPoolExecutor(1)


# ---------------------------------------------------------------- draws

def mix(x: np.ndarray, y) -> np.ndarray:
    """splitmix64 of two keys: equal keys always draw the same 64 bits."""
    with np.errstate(over="ignore"):
        z = np.asarray(x, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(y, np.uint64) + np.uint64(0x632BE59BD9B4E019)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


# P(Poisson(1) <= i); beyond 17 below 1e-15
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(18)])


def bag(seed: int, tree: int, ids: np.ndarray) -> np.ndarray:
    """How often each row is drawn into a tree's bootstrap sample."""
    key = mix(mix(np.uint64(seed % 2**64), 2 * tree + 1), 0)
    return np.searchsorted(_POISSON, (mix(key, ids) >> np.uint64(11)) * 2.0**-53, side="right").astype(np.int64)


def root_key(seed: int, tree: int) -> np.ndarray:
    return mix(mix(np.uint64(seed % 2**64), 2 * tree), 1)


def node_features(keys: np.ndarray, width: int, k: int) -> np.ndarray:
    """The ``k`` features that each node tries, ascending."""
    if k >= width:
        return np.broadcast_to(np.arange(width), (len(keys), width))
    return np.sort(np.argpartition(mix(keys[:, None], np.arange(width)), k - 1, axis=1)[:, :k], axis=1)


# ---------------------------------------------------------------- growth

def best_splits(hist: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature place, bin, whether it gains) of the best split of each node by
    Gini from counts (nodes, features, bins, classes): rows up to the bin go
    left. The first of equal ones."""
    nodes, k, bins, _ = hist.shape
    left = np.cumsum(hist, axis=2)
    total = left[:, 0, -1]
    sq = np.einsum("njbc,njbc->njb", left, left)
    cross = np.einsum("njbc,nc->njb", left, total)
    nl, n = left.sum(3), total.sum(1)[:, None, None]
    whole = (total * total).sum(1)[:, None, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        score = sq / nl + (whole - 2 * cross + sq) / (n - nl)
    score[(nl == 0) | (nl == n)] = -1
    flat = score.reshape(nodes, -1)
    at = flat.argmax(1)
    gains = flat[np.arange(nodes), at] > (whole / n)[:, 0, 0] * (1 + 1e-12)
    return at // bins, at % bins, gains


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, classes: int, bins: int, k: int, depth: int, key: np.ndarray) -> dict[str, np.ndarray]:
    """A tree of at most ``depth`` levels below its root over binned rows
    ``x`` (rows, features) that count ``w`` times. Nodes lie level by level:
    ``feature`` (-1 a leaf), ``cut``, ``left`` (the right child follows it),
    ``counts`` of the classes. Leaves of equal prediction are merged."""
    rows = np.flatnonzero(w)
    y, w = y.astype(np.int64), w.astype(float)
    node, keys, base = np.zeros(len(rows), np.int64), np.atleast_1d(key), 0
    levels: list[tuple] = []
    for level in range(depth + 1):
        n = len(keys)
        counts = np.bincount(node * classes + y[rows], w[rows], n * classes).reshape(n, classes)
        feature, cut = np.full(n, -1), np.zeros(n, np.int64)
        if level < depth:
            mixed = np.flatnonzero((counts > 0).sum(1) > 1)
            starts = np.searchsorted(node, np.arange(n + 1))  # rows lie in node order
            step = max(1, CELLS // (k * bins * classes))
            for some in (mixed[i:i + step] for i in range(0, len(mixed), step)):
                place = np.full(some[-1] - some[0] + 1, -1)
                place[some - some[0]] = np.arange(len(some))
                mine = slice(starts[some[0]], starts[some[-1] + 1])
                at = place[node[mine] - some[0]]
                r, at = rows[mine][at >= 0], at[at >= 0]
                tried = node_features(keys[some], x.shape[1], k)
                hist, weight, code = np.empty((len(some), tried.shape[1], bins, classes)), w[r], at * (bins * classes) + y[r]
                for j in range(tried.shape[1]):
                    hist[:, j] = np.bincount(code + x[r, tried[at, j]].astype(np.int64) * classes, weight, len(some) * bins * classes).reshape(-1, bins, classes)
                j, b, gains = best_splits(hist)
                some, j, b = some[gains], j[gains], b[gains]
                feature[some], cut[some] = tried[gains][np.arange(len(some)), j], b
        split = feature >= 0
        rank = np.cumsum(split) - 1
        levels.append((feature, cut, np.where(split, base + n + 2 * rank, -1), counts))
        if not split.any():
            break
        stay = split[node]
        rows, node = rows[stay], node[stay]
        child = 2 * rank[node] + (x[rows, feature[node]] > cut[node])
        order = np.argsort(child, kind="stable")
        rows, node, base = rows[order], child[order], base + n
        keys = mix(np.repeat(keys[split], 2), np.tile([1, 2], split.sum()) + 1000003)
    tree = dict(zip(("feature", "cut", "left", "counts"), map(np.concatenate, zip(*levels))))
    return merge_equal_leaves(tree, [len(lv[0]) for lv in levels])


def merge_equal_leaves(tree: dict[str, np.ndarray], sizes: list[int]) -> dict[str, np.ndarray]:
    """Inner nodes whose children are leaves of one prediction become leaves,
    from the last level up; nodes that no row reaches any more are dropped."""
    feature, left, guess = tree["feature"], tree["left"], tree["counts"].argmax(1)
    ends = np.cumsum(sizes)
    for a, b in reversed(list(zip(ends - sizes, ends))):
        inner = a + np.flatnonzero(feature[a:b] >= 0)
        lo = left[inner]
        same = inner[(feature[lo] < 0) & (feature[lo + 1] < 0) & (guess[lo] == guess[lo + 1])]
        guess[same], feature[same] = guess[left[same]], -1
    kept = np.zeros(len(feature), bool)
    kept[0] = True
    for a, b in zip(ends - sizes, ends):
        inner = a + np.flatnonzero((feature[a:b] >= 0) & kept[a:b])
        kept[left[inner]] = kept[left[inner] + 1] = True
    place = np.cumsum(kept) - 1
    out = {name: tree[name][kept] for name in tree}
    out["left"] = np.where(out["feature"] >= 0, place[out["left"]], -1)
    return out


# ---------------------------------------------------------------- nodes as bytes

def _least(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def pack(tree: dict[str, np.ndarray]) -> bytes:
    """A tree as bytes: a feature a node (0 a leaf), a cut an inner node, a
    class a leaf (0: several classes, whose counts follow). Children follow
    from the order of the nodes."""
    inner, counts = tree["feature"] >= 0, tree["counts"][tree["feature"] < 0]
    several = (counts > 0).sum(1) != 1
    out = io.BytesIO()
    np.savez(out, feature=_least(tree["feature"] + 1), cut=_least(tree["cut"][inner]), label=_least(np.where(several, 0, counts.argmax(1) + 1)),
             counts=_least(counts[several].astype(np.int64)))
    return out.getvalue()


# Votes are whole multiples of this share, so their sums depend on no order.
SHARE = 1 << 40


def vote(data: bytes, x: np.ndarray, votes: np.ndarray) -> None:
    """Add a packed tree's class shares of binned rows to their ``votes``."""
    with np.load(io.BytesIO(data)) as t:
        feature, cuts, label, counts = (t[n] for n in ("feature", "cut", "label", "counts"))
    inner = feature > 0
    before = np.cumsum(inner, dtype=np.int32)
    cut = np.zeros(len(feature), np.uint8)
    cut[inner] = cuts
    at, active = np.zeros(len(x), np.int32), np.arange(len(x)) if inner[0] else np.arange(0)
    while len(active):
        n = at[active]
        n = 2 * before[n] - 1 + (x[active, feature[n].astype(np.int64) - 1] > cut[n])  # the children of the i-th inner node are 2i - 1 and 2i
        at[active] = n
        active = active[inner[n]]
    leaf = at - before[at]
    kind = label[leaf].astype(np.int64)
    pure = np.flatnonzero(kind)
    votes[pure, kind[pure] - 1] += SHARE
    if len(pure) < len(x):
        rest, nth = np.flatnonzero(kind == 0), np.cumsum(label == 0) - 1
        share = counts / counts.sum(1, keepdims=True, dtype=float)
        votes[rest] += np.rint(share * SHARE).astype(np.int64)[nth[leaf[rest]]]


# ---------------------------------------------------------------- rows as bytes

# Values that stand for a feature's rows in a task, with the rows each stands for.
SKETCH = 1024


def condense(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and their weights; of more than ``SKETCH``
    those at evenly spaced ranks, with even weights."""
    values, place = np.unique(values, return_inverse=True)
    weights = np.bincount(place, weights, len(values))
    if len(values) <= SKETCH:
        return values, weights
    total = weights.sum()
    at = np.searchsorted(np.cumsum(weights), (np.arange(SKETCH) + 0.5) / SKETCH * total)
    return values[np.minimum(at, len(values) - 1)], np.full(SKETCH, total / SKETCH)


def cut_points(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """The values that part a feature's rows into at most ``bins`` bins of about
    equal size; each value its own bin where there are few."""
    order = np.argsort(values)
    distinct = np.unique(values)
    if len(distinct) <= bins:
        return distinct[:-1]
    ranks = np.cumsum(weights[order])
    return np.unique(values[order][np.searchsorted(ranks, np.arange(1, bins) / bins * ranks[-1])])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows x features of an array column."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    if column.null_count or len(values) != len(column) * width:
        raise ValueError(f"a row without all of its {width} features")
    return values.reshape(-1, width)


def thresholds(data: DataFrame, features: str, bins: int) -> list[np.ndarray]:
    """:func:`cut_points` of each feature over all rows, within about 1 / SKETCH
    of them: each task sends ``SKETCH`` values a feature at most."""
    width, doubles = data.select(F.size(features)).first()[0], pa.list_(pa.float64())

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(width)]
        for b in batches:
            x = matrix(b.column(0), width)
            for f, parts in enumerate(held):
                v = x[~np.isnan(x[:, f]), f]
                parts.append(condense(v, np.ones(len(v))))
                if len(parts) > 32:
                    parts[:] = [condense(*map(np.concatenate, zip(*parts)))]
        for f, parts in enumerate(held):
            if parts:
                v, n = condense(*map(np.concatenate, zip(*parts)))
                yield pa.RecordBatch.from_pydict({"f": pa.array([f], pa.int32()), "v": pa.array([v], doubles), "n": pa.array([n], doubles)})

    def cut(key: tuple, table: pa.Table) -> pa.Table:
        v, n = (np.concatenate([c.flatten().to_numpy() for c in table.column(name).chunks]) for name in ("v", "n"))
        return pa.table({"f": pa.array([key[0].as_py()], pa.int32()), "cuts": pa.array([cut_points(v, n, bins)], doubles)})

    sums = data.select(features).mapInArrow(sketched, "f int, v array<double>, n array<double>").groupBy("f")
    found = {r["f"]: np.array(r["cuts"], float) for r in sums.applyInArrow(cut, "f int, cuts array<double>").collect()}
    return [found[f] for f in range(width)]


def to_bins(column: pa.Array, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Rows x features: the bin of each value (those up to cut i lie in the
    bins up to i, NaN in the last)."""
    values = matrix(column, len(cuts))
    return np.stack([np.searchsorted(c, values[:, f]) for f, c in enumerate(cuts)], 1).astype(np.uint8)


def binned(data: DataFrame, features: str, label: str, cuts: Sequence[np.ndarray]) -> DataFrame:
    """(ids, y, x): blocks of rows as bytes; 8 an id, 4 a label, 1 a feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False)
            if not (np.isfinite(y) & (y >= 0) & (y == np.floor(y))).all():
                raise ValueError("labels must be the whole numbers 0, 1, ...")
            blobs = b.column(0).to_numpy(), y.astype(np.int32), to_bins(b.column(2), cuts)
            yield pa.RecordBatch.from_pydict({n: pa.array([a.tobytes()], pa.binary()) for n, a in zip(("ids", "y", "x"), blobs)})

    rows = data.select(F.monotonically_increasing_id(), F.col(label).cast("double"), F.col(features))
    return rows.mapInArrow(run, "ids binary, y binary, x binary")


def _arrays(block, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, y, x = block
    return np.frombuffer(ids, np.int64), np.frombuffer(y, np.int32), np.frombuffer(x, np.uint8).reshape(-1, width)


# ---------------------------------------------------------------- estimator

class _ForestParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    maxDepth = Param(Params._dummy(), "maxDepth", "Maximum depth of the tree. (>= 0)", TypeConverters.toInt)
    numTrees = Param(Params._dummy(), "numTrees", "Number of trees to train (>= 1).", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "Max number of bins of a feature (2 to 256).", TypeConverters.toInt)


class Forest(Estimator, _ForestParams):
    """See the module; parameters and defaults are ``RandomForestClassifier``'s."""

    def __init__(self, featuresCol: str = "features", labelCol: str = "label", seed: int = 0, maxDepth: int = 5, numTrees: int = 20, maxBins: int = 32):
        super().__init__()
        self._setDefault(maxDepth=5, numTrees=20, maxBins=32)
        self._set(featuresCol=featuresCol, labelCol=labelCol, seed=seed, maxDepth=maxDepth, numTrees=numTrees, maxBins=maxBins)

    def _fit(self, dataset: DataFrame) -> ForestModel:
        label, trees, depth, seed, bins = (self.getOrDefault(p) for p in (self.labelCol, self.numTrees, self.maxDepth, self.seed, self.maxBins))
        data = dataset.select(F.col(label), vector_to_array(self.getFeaturesCol()).alias("_x"))
        cuts = thresholds(data, "_x", bins)
        blocks, width, k = binned(data, "_x", label, cuts), len(cuts), len(cuts) if trees == 1 else math.ceil(math.sqrt(len(cuts)))
        grown = {"seed": seed, "bins": bins, "k": k, "depth": depth}
        if data.count() * width <= LOCAL_BYTES:
            classes, packed = grow_whole(blocks, width, trees, **grown)
            return self._copyValues(ForestModel(cuts, classes, packed))
        classes = int(data.agg(F.max(F.col(label).cast("double"))).first()[0]) + 1
        return self._copyValues(ForestModel(cuts, classes, parted=grow_parted(blocks, width, classes, trees, **grown)))


def grow_whole(blocks: DataFrame, width: int, trees: int, seed: int, bins: int, k: int, depth: int) -> tuple[int, list[bytes]]:
    """Number of classes and packed trees, each grown by one task over all rows."""
    def passed() -> tuple[int, Broadcast]:
        ids, y, x = (np.concatenate(a) for a in zip(*[_arrays(b, width) for b in blocks.collect()]))
        return int(y.max()) + 1, blocks.sparkSession.sparkContext.broadcast((ids, y, x))  # it lies in a file

    with _WHOLE:
        classes, table = _PASSING.submit(passed).result()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, y, x = table.value
            for t in (t for b in batches for t in b.column(0).to_pylist()):
                data = pack(grow(x, y, bag(seed, t, ids), classes, bins, k, depth, root_key(seed, t)))
                yield pa.RecordBatch.from_pydict({"tree": [t], "data": pa.array([data], pa.binary())})

        packed = blocks.sparkSession.range(0, trees, 1, trees).mapInArrow(run, "tree long, data binary").collect()
        table.destroy()
    return classes, [bytes(r["data"]) for r in sorted(packed)]


# ---------------------------------------------------------------- more rows than a task holds

Node = tuple[int, int]  # a tree and a node of its top
_PART = "tree long, node long, leaf boolean, guess int, data binary"


class Top:
    """The nodes of a tree that are grown from sums; the driver holds these."""

    def __init__(self, key: np.ndarray):
        self.feature, self.cut, self.left, self.level, self.key = [-1], [0], [-1], [0], [key]
        self.counts: list = [None]

    def split(self, node: int, feature: int, cut: int, *counts: np.ndarray) -> list[int]:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
        for side, c in enumerate(counts):
            for name, v in (("feature", -1), ("cut", 0), ("left", -1), ("counts", c), ("level", self.level[node] + 1), ("key", mix(self.key[node], side + 1 + 1000003))):
                getattr(self, name).append(v)
        return [self.left[node], self.left[node] + 1]

    def merge(self, guesses: dict[int, int | None], node: int = 0) -> int | None:
        """:func:`merge_equal_leaves`; ``guesses``: the prediction of each part
        that is one leaf, None of the others."""
        if self.feature[node] < 0:
            return guesses[node] if node in guesses else int(self.counts[node].argmax())
        a, b = (self.merge(guesses, self.left[node] + i) for i in (0, 1))
        if a is None or a != b:
            return None
        self.feature[node] = -1
        guesses.pop(node, None)
        return a

    def nodes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature), np.array(self.cut), np.array(self.left)


def descend(nodes: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    """The node of a top without children that each row comes to."""
    feature, cut, left = nodes
    at, active = np.zeros(len(x), np.int64), np.arange(len(x) if feature[0] >= 0 else 0)
    while len(active):
        n = at[active]
        at[active] = n = left[n] + (x[active, feature[n]] > cut[n])
        active = active[feature[n] >= 0]
    return at


def _blobs(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: pa.array([v.tobytes()], pa.binary()) if isinstance(v, np.ndarray) else pa.array([v], pa.int64()) for n, v in values.items()})


def grow_parted(blocks: DataFrame, width: int, classes: int, trees: int, seed: int, bins: int, k: int, depth: int) -> tuple[list[Top], DataFrame]:
    """The tops of the trees, and their parts in the checkpoint folder. The
    trees are those of :func:`grow_whole`."""
    ensure_checkpoint_dir(blocks.sparkSession)
    blocks = blocks.checkpoint(eager=True)
    most_rows, most_nodes = max(1, LOCAL_BYTES // (width + 16)), max(1, LOCAL_BYTES // (8 * k * bins * classes))
    tops = [Top(root_key(seed, t)) for t in range(trees)]
    saved = []
    for wave in (range(t, min(t + WAVE, trees)) for t in range(0, trees, WAVE)):
        still, parts = [(t, 0) for t in wave], {}
        while still:
            now, still = still[:most_nodes], still[most_nodes:]
            for r in _best_of(blocks, tops, now, width, classes, seed, bins, k):
                top, counts = tops[r["tree"]], [np.array(r["below"]), np.array(r["above"])]
                top.counts[r["node"]] = sum(counts)
                if r["feature"] < 0 or top.level[r["node"]] == depth:
                    continue
                for child, c in zip(top.split(r["node"], r["feature"], r["cut"], *counts), counts):
                    if top.level[child] < depth and (c > 0).sum() > 1:
                        if c.sum() > most_rows:
                            still.append((r["tree"], child))
                        else:
                            parts[r["tree"], child] = (top.key[child], depth - top.level[child])
        grown = _grow_parts(blocks, tops, parts, width, classes, seed, bins, k).checkpoint(eager=True)
        guesses: dict[int, dict] = {t: {} for t in wave}
        for r in grown.select("tree", "node", "leaf", "guess").collect():
            guesses[r["tree"]][r["node"]] = r["guess"] if r["leaf"] else None
        leaves = []
        for t in wave:
            tops[t].merge(guesses[t])
            for n in (n for n, f in enumerate(tops[t].feature) if f < 0 and n not in guesses[t]):
                alone = {"feature": np.array([-1]), "cut": np.array([0]), "counts": tops[t].counts[n][None]}
                leaves.append((t, n, True, int(tops[t].counts[n].argmax()), bytearray(pack(alone))))
        saved += [grown, *([blocks.sparkSession.createDataFrame(leaves, _PART)] if leaves else [])]
    out = saved[0]
    for more in saved[1:]:
        out = out.unionByName(more)
    return tops, out.select("tree", "node", "data")


def _best_of(blocks: DataFrame, tops: list[Top], now: list[Node], width: int, classes: int, seed: int, bins: int, k: int) -> list:
    """The best split of each of the nodes: every task adds its rows up, Spark
    adds the tasks up, the driver gets one row a node."""
    tried: dict[int, dict] = {}
    for t, n in now:
        tried.setdefault(t, {})[n] = node_features(np.atleast_1d(tops[t].key[n]), width, k)[0]
    nodes = {t: tops[t].nodes() for t in tried}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[Node, np.ndarray] = {}
        for ids, y, x in (_arrays(block, width) for b in batches for block in zip(*(c.to_pylist() for c in b.columns))):
            for t, of_tree in tried.items():
                w, at = bag(seed, t, ids), descend(nodes[t], x)
                for n, features in of_tree.items():
                    r = np.flatnonzero((at == n) & (w > 0))
                    hist = [np.bincount(x[r, f].astype(np.int64) * classes + y[r], w[r], bins * classes) for f in features]
                    held[t, n] = held.get((t, n), 0) + np.stack(hist)
        for (t, n), hist in held.items():
            yield _blobs(tree=t, node=n, hist=hist)

    def best(key: tuple, table: pa.Table) -> pa.Table:
        t, n = (v.as_py() for v in key)
        hist = sum(np.frombuffer(h) for h in table.column("hist").to_pylist()).reshape(1, -1, bins, classes)
        j, b, gains = (v[0] for v in best_splits(hist))
        below, above = hist[0, j, :b + 1].sum(0), hist[0, j, b + 1:].sum(0)
        return pa.table({"tree": [t], "node": [n], "feature": [int(tried[t][n][j]) if gains else -1], "cut": [int(b)], "below": [below.tolist()], "above": [above.tolist()]})

    found = blocks.mapInArrow(sums, "tree long, node long, hist binary").groupBy("tree", "node")
    return found.applyInArrow(best, "tree long, node long, feature long, cut long, below array<double>, above array<double>").collect()


def _grow_parts(blocks: DataFrame, tops: list[Top], parts: dict, width: int, classes: int, seed: int, bins: int, k: int) -> DataFrame:
    """The parts, each grown where its rows meet."""
    nodes = {t: tops[t].nodes() for t, _ in parts}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, y, x in (_arrays(block, width) for b in batches for block in zip(*(c.to_pylist() for c in b.columns))):
            for t in nodes:
                w, at = bag(seed, t, ids), descend(nodes[t], x)
                for n in (n for n in np.unique(at[w > 0]).tolist() if (t, n) in parts):
                    r = (at == n) & (w > 0)
                    yield _blobs(tree=t, node=n, y=y[r], w=w[r], x=x[r])

    def grown(key: tuple, table: pa.Table) -> pa.Table:
        t, n = (v.as_py() for v in key)
        y, w, x = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("y", np.int32), ("w", np.int64), ("x", np.uint8)))
        root, levels = parts[t, n]
        tree = grow(x.reshape(-1, width), y, w, classes, bins, k, levels, root)
        return pa.table({"tree": [t], "node": [n], "leaf": [len(tree["feature"]) == 1], "guess": pa.array([int(tree["counts"][0].argmax())], pa.int32()),
                         "data": pa.array([pack(tree)], pa.binary())})

    return blocks.mapInArrow(dealt, "tree long, node long, y binary, w binary, x binary").groupBy("tree", "node").applyInArrow(grown, _PART)


def predict_parted(data: DataFrame, features: str, out: str, cuts: list[np.ndarray], classes: int, tops: list[Top], parts: DataFrame) -> DataFrame:
    """Rows meet the parts that they come to, one a tree; their votes are added
    up by row. A part that more rows come to than a task holds is met by them
    in several tasks."""
    row, width, nodes = "_forest_row", len(cuts), [t.nodes() for t in tops]
    ensure_checkpoint_dir(data.sparkSession)
    data = data.withColumn(row, F.monotonically_increasing_id()).checkpoint(eager=True)  # else row ids may differ when computed again
    pieces: dict[Node, int] = {}

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, x = b.column(0).to_numpy(), to_bins(b.column(1), cuts)
            for t, top in enumerate(nodes):
                at = descend(top, x)
                for n in np.unique(at).tolist():
                    r = at == n
                    yield _blobs(tree=t, node=n, piece=int(mix(ids[r][0], 0) % np.uint64(pieces.get((t, n), 1))), ids=ids[r], x=x[r])

    def voted(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, x = (np.frombuffer(b"".join(left.column(c).to_pylist()), kind) for c, kind in (("ids", np.int64), ("x", np.uint8)))
        votes = np.zeros((len(ids), classes), np.int64)
        if len(ids):
            vote(right.column("data")[0].as_py(), x.reshape(-1, width), votes)
        r, c = np.nonzero(votes)
        return pa.table({row: ids[r], "c": c, "share": votes[r, c]})

    def rows() -> DataFrame:
        return data.select(row, features).mapInArrow(routed, "tree long, node long, piece long, ids binary, x binary")

    sizes = rows().groupBy("tree", "node").agg(F.sum(F.length("x")).alias("size")).where(F.col("size") > LOCAL_BYTES).collect()
    pieces.update({(r["tree"], r["node"]): -(-r["size"] // LOCAL_BYTES) for r in sizes})
    many = data.sparkSession.createDataFrame([(*key, n) for key, n in pieces.items()], "tree long, node long, pieces long")
    copies = parts.join(many, ["tree", "node"], "left").select("tree", "node", "data", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)).alias("piece"))
    keys = ["tree", "node", "piece"]
    votes = rows().groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(voted, f"{row} long, c long, share long")
    total = votes.groupBy(row, "c").agg(F.sum("share").alias("share"))
    best = total.groupBy(row).agg((-F.max(F.struct("share", (-F.col("c")).alias("least")))["least"]).cast("double").alias(out))
    return data.join(best, row).drop(row)


class ForestModel(Model, _ForestParams):
    """``packed`` trees, or tops and parts, over bins cut at ``cuts``."""

    def __init__(self, cuts: list[np.ndarray], classes: int, packed: list[bytes] | None = None, parted: tuple[list[Top], DataFrame] | None = None):
        super().__init__()
        self._setDefault(maxDepth=5, numTrees=20, maxBins=32)
        self.cuts, self.classes, self.packed, self.parted = cuts, classes, packed, parted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.parted:
            wide = dataset.withColumn("_forest_x", vector_to_array(self.getFeaturesCol()))
            return predict_parted(wide, "_forest_x", self.getPredictionCol(), self.cuts, self.classes, *self.parted).drop("_forest_x")
        cuts, classes, trees = self.cuts, self.classes, dataset.sparkSession.sparkContext.broadcast(self.packed)

        @F.arrow_udf("double")
        def predicted(features: pa.Array) -> pa.Array:
            x = to_bins(features, cuts)
            votes = np.zeros((len(x), classes), np.int64)
            for tree in trees.value:
                vote(tree, x, votes)
            return pa.array(votes.argmax(1).astype(float))

        return dataset.withColumn(self.getPredictionCol(), predicted(vector_to_array(self.getFeaturesCol())))
