"""Toxicity by maximal scoring segments.

Fit, on at most ``FIT_ROWS`` labelled documents of each class (those with the
smallest hash of their id; equal texts once): the documents of each class that
have a token are counted, and for its heads of 4, 6 and 8 bytes the counts of
their tokens are summed, ``KNOWN`` at most from each token, so that a head
stands for many forms and not for one frequent word. A weight is the log-odds between the classes under a Dirichlet
prior proportional to its overall frequency (and half a document for each
class), pulled towards zero by ``ERRORS`` standard errors and ``MARGIN``
(classes differ a little in everything, languages above all). A token scores the
weight of the largest size among itself and its heads that ``KNOWN`` documents
have, so unseen forms of a known stem count too. All other tokens cost
``DRIFT``, so the expected score of clean text is negative. Seven tenths of the fit rows give
the weights, the rest the calibration.

Search: the linear-time scan of Ruzzo and Tompa finds all maximal scoring
segments of the text's tokens. Scores follow the extreme-value law of Karlin
and Altschul: with lambda the positive root of E[exp(lambda * score)] = 1 over
clean tokens, and K from the number of segments in clean texts, a segment of
score S in n tokens has an expected count of K * n * exp(-lambda * S).

Aggregate: a logistic model on the sum of lambda * S, the best segment's
-log expected count, and log n, fitted with the classes' true weights, gives
the document's score; ``segments`` are the significant ones (expected count
under ``SIGNIFICANT``), as (first token, end token, score).

Defined cases: a null or empty text scores as one without tokens; labels that
are null are ignored; a document with both labels counts as toxic; with one
class or none among the labels, or among those of
the calibration (the split goes by a hash of the text, not by class), the score is 0 for every text. Only the text is
scored: id, language, source and labels are not inputs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import carried, whole_text

FIT_ROWS, MEMO, KNOWN = 10_000, 400_000, 3
PRIOR, ERRORS, MARGIN, DRIFT, SIGNIFICANT, HEADS = 1000.0, 2.5, 0.5, 0.1, 0.05, (8, 6, 4)
_TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+")


def tokens(text: bytes) -> list[bytes]:
    return _TOKEN.findall(text.lower())


def keys(token: bytes) -> list[bytes]:
    """The token itself (closed by a blank) and its heads, longest first."""
    return [token + b" ", *(token[:n] for n in HEADS if len(token) >= n)]


def maximal_segments(positions: list[int], scores: list[float], n: int, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score) of n tokens, of which
    those at ``positions`` have ``scores`` (not zero) and all others cost
    ``drift``. Linear: each kept segment is merged at most once."""
    kept: list[list] = []  # [begin, end, left sum, right sum, previous kept with a smaller left sum]
    total, last = 0.0, -1
    for p, s in zip(positions, scores):
        total -= drift * (p - last - 1)
        last = p
        left, total = total, total + s
        if s <= 0:
            continue
        seg = [p, p + 1, left, total, -1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= seg[2]:
                j = kept[j][4]
            seg[4] = j
            if j < 0 or kept[j][3] >= seg[3]:
                kept.append(seg)
                break
            seg = [kept[j][0], seg[1], kept[j][2], seg[3], -1]
            del kept[j:]
    return [(a, b, r - lft) for a, b, lft, r, _ in kept]


class Model:
    """Weights, the extreme-value law and the logistic model."""

    def __init__(self, weights: dict[bytes, float]):
        self.weights, self.lam, self.k, self.beta = weights, 1.0, 1.0, None
        self.memo: dict[bytes, float] = {}

    def weight(self, token: bytes) -> float:
        return max((self.weights.get(k, 0.0) for k in keys(token)), key=abs)

    def segments(self, text: bytes) -> tuple[list[tuple[int, int, float]], int]:
        ts, memo = tokens(text), self.memo
        if len(memo) > MEMO:
            memo.clear()
        for t in set(ts).difference(memo):
            memo[t] = self.weight(t)
        positions, scores = [], []
        for i, s in enumerate(map(memo.__getitem__, ts)):
            if s:
                positions.append(i)
                scores.append(s - DRIFT)
        return maximal_segments(positions, scores, len(ts), DRIFT), len(ts)

    def features(self, n_segments: int, total: float, best: float, n: int) -> list[float]:
        size = math.log1p(n)
        if not n_segments:
            return [1.0, 0.0, 0.0, size]
        return [1.0, self.lam * total, self.lam * best - math.log(self.k * n), size]

    def expected(self, score: float, n: int) -> float:
        return self.k * n * math.exp(-min(700.0, self.lam * score))

    def score(self, segments: list, n: int) -> float:
        if self.beta is None:
            return 0.0
        scores = [s for _, _, s in segments]
        x = float(np.dot(self.beta, self.features(len(scores), sum(scores), max(scores, default=0.0), n)))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))


def _log_odds(counts: list[tuple[bytes, int, int]], n1: int, n0: int) -> dict[bytes, float]:
    """Shrunken log-odds of the (key, in toxic, in clean) counts; all keys'
    counts sum to n1 and n0."""
    if not counts:
        return {}
    y1, y0 = (np.array([c[k] for c in counts], float) for k in (1, 2))
    prior = 0.5 + PRIOR * (y1 + y0) / (n1 + n0)
    odds = np.log((y1 + prior) / (n1 + PRIOR - y1 - prior)) - np.log((y0 + prior) / (n0 + PRIOR - y0 - prior))
    error = ERRORS * np.sqrt(1 / (y1 + prior) + 1 / (y0 + prior))
    shrunk = np.sign(odds) * np.maximum(0, np.abs(odds) - error - MARGIN)
    return {c[0]: float(w) for c, w in zip(counts, shrunk)}


def _lambda(scores: np.ndarray, share: np.ndarray) -> float:
    """Positive root of sum(share * exp(lambda * score)) = 1."""
    if not (scores > 0).any():
        return 1.0
    low, high = 0.0, 1.0
    value = lambda x: float((share * np.exp(np.minimum(700, x * scores))).sum())
    while value(high) < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 1 else (low, mid)
    return max(high, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Newton's method with step halving and a ridge penalty, on columns of
    unit size (the first is the constant)."""
    size = np.maximum(np.sqrt((x ** 2).mean(axis=0)), 1e-9)
    x = x / size
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6

    def loss(b: np.ndarray) -> float:
        return float((weight * (np.logaddexp(0, x @ b) - y * (x @ b))).sum() + (penalty * b * b).sum() / 2)

    beta = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        gradient = x.T @ (weight * (p - y)) + penalty * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step, t = np.linalg.solve(hessian, gradient), 1.0
        while loss(beta - t * step) > loss(beta) and t > 1e-6:
            t /= 2
        beta = beta - t * step
        if np.abs(t * step).max() < 1e-8:
            break
    return beta / size


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        fit_rows: int = FIT_ROWS) -> Model:
    """``labels`` has the rows to learn from, and no others."""
    truth = labels.select(F.col(f"`{doc_id}`").alias("i"), F.col(f"`{label}`").alias("y")).where("i is not null and y is not null").groupBy("i").agg(
        F.max((F.col("y") > 0).cast("int")).alias("y")).checkpoint()
    sizes = {r["y"]: r["count"] for r in truth.groupBy("y").count().collect()}
    model = Model({})
    if sizes.keys() != {0, 1}:
        return model
    order = F.xxhash64("i", F.lit(11))
    chosen = truth.where("y = 1").orderBy(order).limit(fit_rows).unionByName(truth.where("y = 0").orderBy(order).limit(fit_rows))
    rows = docs.select(F.col(f"`{doc_id}`").alias("i"), whole_text(f"`{text}`").cast("binary").alias("x")).join(
        F.broadcast(chosen), "i").groupBy("x").agg(F.max("y").alias("y")).withColumn(
        "first", F.pmod(F.xxhash64("x", F.lit(13)), F.lit(10)) < 7).checkpoint()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}
        for b in batches:
            for t, y in zip(b.column("x"), b.column("y").to_pylist()):
                for key in set(tokens(t.as_py())):
                    c = seen.get(key)
                    if c is None:
                        c = seen[key] = [0, 0]
                    c[1 - y] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array([c[0] for c in seen.values()], pa.int64()),
             pa.array([c[1] for c in seen.values()], pa.int64())], names=["w", "y1", "y0"])

    # Of 2 * fit_rows documents at most; rarer keys weigh nothing but in the sums.
    counted = rows.where("first").select("x", "y").mapInArrow(count, "w binary, y1 long, y0 long").groupBy("w").agg(
        F.sum("y1").alias("y1"), F.sum("y0").alias("y0")).checkpoint()
    head = F.explode(F.array(*[F.when(F.octet_length("w") >= n, F.substring("w", 1, n)) for n in HEADS]))
    few = [F.least(F.col(y), F.lit(KNOWN)).alias(y) for y in ("y1", "y0")]
    heads = counted.select(head.alias("k"), *few).where("k is not null").groupBy("k").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))
    both = counted.select(F.concat("w", F.lit(b" ")).alias("k"), "y1", "y0").unionByName(heads)
    n1, n0 = both.agg(F.coalesce(F.sum("y1"), F.lit(0)), F.coalesce(F.sum("y0"), F.lit(0))).first()
    often = sorted((bytes(r["k"]), r["y1"], r["y0"]) for r in both.where(F.col("y1") + F.col("y0") >= KNOWN).collect())
    model.weights = _log_odds(often, n1, n0)
    whole = [c for c in often if c[0].endswith(b" ")]
    clean = sum(c[2] for c in whole)
    if not clean:
        return model
    held = [(model.weight(w[:-1]) - DRIFT, y0 / clean) for w, _, y0 in whole]
    model.lam = _lambda(np.array([s for s, _ in held]), np.array([p for _, p in held]))

    def summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, y in zip(b.column("x"), b.column("y").to_pylist()):
                found, n = model.segments(t.as_py())
                out.append((y, n, len(found), sum(s for _, _, s in found), max([0.0, *(s for _, _, s in found)])))
            cols = list(zip(*out)) or [[]] * 5
            types = (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["y", "n", "m", "total", "best"])

    got = rows.where("not first").select("x", "y").mapInArrow(summarize, "y int, n long, m long, total double, best double").collect()
    if {r["y"] for r in got} != {0, 1}:
        return model
    in_clean = [r for r in got if r["y"] == 0]
    # Every maximal segment of a clean text has a score above 0: their number is K * n there.
    model.k = max(1, sum(r["m"] for r in in_clean)) / max(1, sum(r["n"] for r in in_clean))
    x = np.array([model.features(r["m"], r["total"], r["best"], max(1, r["n"])) for r in got])
    y = np.array([r["y"] for r in got], float)
    weight = np.where(y == 1, *(sizes[c] / min(sizes[c], fit_rows) for c in (1, 0)))
    model.beta = _logistic(x, y, weight)
    return model


def score(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` with ``score``, ``n_segments``
    and the significant ``segments``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = carried(docs, keep, x=whole_text(f"`{text}`").cast("binary"))
    segment = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("segments", T.ArrayType(segment))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for b in batches:
            scores, found = [], []
            for t in b.column("x"):
                segs, n = m.segments(t.as_py())
                scores.append(m.score(segs, max(1, n)))
                found.append([{"begin": a, "end": e, "score": s} for a, e, s in segs if m.expected(s, n) < SIGNIFICANT])
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(scores, pa.float64()), pa.array(found, kind)], names=["row", "score", "segments"])

    return rows.mapInArrow(run, schema)
