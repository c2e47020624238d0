"""Benchmark decontamination as a prefix-filtered set join.

A benchmark item gives windows of ``window`` consecutive words (one shorter
window if it has fewer words). A document contains a window only if it
contains every word of it, so the necessary prefix of a containment of 1 is
one word, and the rarest is the best: words are ordered by their number of
occurrences in all documents (ties by the word). The windows are indexed by
their rarest word and its place. A document's word that is some window's
rarest gives a candidate; length and position bounds say where the window
would begin and end; its words are then compared one by one.

The benchmark is a stated query set. It is taken in blocks of at most
``block_windows`` windows; one block's index (under about 100 MB) is broadcast
at a time, and every block meets all documents. Documents are never shuffled.

Defined cases: a null text, and an item without words, has no words and no
windows; items with one id are one item, in the result too; equal windows of
several items count for each; an item id that is null names no item, but its
windows still mark words; an empty benchmark marks nothing.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import carried, whole_text

WINDOW, BLOCK_WINDOWS = 10, 200_000
#: After A-Z is lower-cased: digits, a-z and all that is not ASCII.
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def word_list(text: bytes) -> list[bytes]:
    return _WORDS.findall(text.lower())


def item_windows(words: list[bytes], window: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i:i + window]) for i in range(max(1, len(words) - window + 1))]


def _item_rows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items, wins = [], []
            for item, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = list(dict.fromkeys(item_windows(word_list(t), window)))
                items += [item] * len(got)
                wins += [b" ".join(w) for w in got]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(wins, pa.binary())], names=["item", "win"])

    return benchmark.select(F.col(f"`{item_id}`").cast("string"), whole_text(f"`{text}`").cast("binary")).mapInArrow(
        run, "item string, win binary").groupBy("win").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _frequencies(docs: DataFrame, text: str, vocabulary) -> DataFrame:
    """Occurrences of the vocabulary's words in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = vocabulary.value, Counter()
        for b in batches:
            for t in b.column(0):
                total.update(filter(known.__contains__, word_list(t.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    return docs.select(whole_text(f"`{text}`").cast("binary")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _index(windows: list[tuple[tuple[bytes, ...], tuple]], counts: dict[bytes, int]) -> dict:
    """Rarest word -> [(its place, window, items)]."""
    index = defaultdict(list)
    for win, items in windows:
        at = min(range(len(win)), key=lambda i: (counts.get(win[i], 0), win[i], i))
        index[win[at]].append((at, win, items))
    return dict(index)


def _match(words: list[bytes], index: dict) -> tuple[np.ndarray, set]:
    """Flags of the words inside a window's occurrence; the items found."""
    hit, items = np.zeros(len(words), bool), set()
    rare = index.keys() & set(words)
    if rare:
        for p, w in enumerate(words):
            if w in rare:
                for at, win, found in index[w]:
                    a = p - at
                    if a >= 0 and a + len(win) <= len(words) and tuple(words[a:a + len(win)]) == win:
                        hit[a:a + len(win)] = True
                        items.update(found)
    return hit, items


def mark(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS,
         keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` (of the columns to ``keep``) with ``n_words``, ``n_hit``
    and ``items`` (ids as strings, sorted)."""
    spark = docs.sparkSession
    items = _item_rows(benchmark, item_id, item_text, window).orderBy("win").checkpoint()
    n_blocks = max(1, -(-items.count() // block_windows))
    blocks = items.withColumn("block", F.pmod(F.xxhash64("win"), F.lit(n_blocks))) if n_blocks > 1 else items.withColumn("block", F.lit(0).cast("long"))
    rows = carried(docs, keep, x=whole_text(f"`{text}`").cast("binary"), spans=F.lit(None).cast("binary"), items=F.array().cast("array<string>"))
    for k in range(n_blocks):
        windows = [(tuple(bytes(r["win"]).split(b" ")), tuple(r["items"])) for r in blocks.where(F.col("block") == k).collect()]
        vocabulary = spark.sparkContext.broadcast(frozenset(w for win, _ in windows for w in win))
        counts = {bytes(r["word"]): r["n"] for r in _frequencies(docs, text, vocabulary).collect()} if windows else {}
        index = spark.sparkContext.broadcast(_index(windows, counts))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hits, found = [], []
                for t, spans, items in zip(b.column("x"), b.column("spans").to_pylist(), b.column("items").to_pylist()):
                    hit, more = _match(word_list(t.as_py()), index.value)
                    if spans is not None:
                        hit |= np.unpackbits(np.frombuffer(spans, np.uint8), count=len(hit)).astype(bool)
                    hits.append(hit)
                    found.append(sorted(more.union(items)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("row"), b.column("x"), pa.array([np.packbits(h).tobytes() for h in hits], pa.binary()),
                     pa.array(found, pa.list_(pa.string())), pa.array([len(h) for h in hits], pa.int64()),
                     pa.array([int(h.sum()) for h in hits], pa.int64())],
                    names=["row", "x", "spans", "items", "n_words", "n_hit"])

        schema = T.StructType([*rows.schema.fields[:4], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType())])
        rows = rows.select("row", "x", "spans", "items").mapInArrow(run, schema)
        if k + 1 < n_blocks:
            rows = rows.checkpoint()
    return rows.select("row", "n_words", "n_hit", "items")
