"""Exact line dedup with keep bitmaps.

Each line with enough characters becomes a row (key hash, document, position).
The rows are range-partitioned on (hash, document) and sorted by position
below that, so a line that stands in a third of all documents is spread over
many partitions. One pass over each sorted partition streams the runs of equal
hashes: it holds back the rows of a run only until ``min_docs`` documents are
seen, then lets them through. A partition cannot know the size of its first
and last run, which may go on next door; it reports their document counts (two
rows a partition at most), the counts are added up, and the rows held back of
those runs (fewer than ``min_docs`` documents each) follow the sum. The
surviving rows are grouped per document into a zlib-compressed bitmap, one bit
a line, 1 = keep. Texts never enter the shuffle of the lines.

Defined cases: a document is a distinct (id, text) pair; rows that repeat it
count once and share its bitmap. Null ids are ordinary ids. A null or empty
text is one empty line. A key is the line without ASCII white space at its
ends, A-Z lower-cased; keys shorter than ``min_chars`` code points always
stay. Keys are compared by a 96-bit hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import BLANKS, ascii_lower, carried, whole_text

DROPPED, PENDING, EDGE = 0, 1, 2


class _Run:
    """The run of equal hashes that the stream is in."""

    def __init__(self, key: tuple[int, int], first: bool):
        self.key, self.first, self.docs, self.last_doc, self.held = key, first, 0, None, []


def _runs_over(min_docs: int, schema: pa.Schema):
    """Streams sorted (h1, h2, doc, ...) rows; see the module's text."""

    def tagged(rows: pa.RecordBatch, kind: int) -> pa.RecordBatch:
        n = len(rows)
        cols = {"kind": pa.array(np.full(n, kind, np.int32)), "docs": pa.nulls(n, pa.int64())}
        return pa.RecordBatch.from_arrays(
            [cols[f.name] if f.name in cols else rows.column(f.name).cast(f.type) for f in schema], schema=schema)

    def edge(run: _Run) -> pa.RecordBatch:
        cols = {"kind": EDGE, "docs": run.docs, "h1": run.key[0], "h2": run.key[1]}
        return pa.RecordBatch.from_arrays([pa.array([cols.get(f.name)], f.type) for f in schema], schema=schema)

    def grow(run: _Run, rows: pa.RecordBatch, docs: int, last_doc: int) -> list[pa.RecordBatch]:
        run.docs, run.last_doc = run.docs + docs, last_doc
        if run.docs < min_docs:
            run.held.append(rows)
            return []
        out, run.held = [tagged(r, DROPPED) for r in [*run.held, rows]], []
        return out

    def close(run: _Run, last: bool) -> list[pa.RecordBatch]:
        if not (run.first or last):
            return []
        return [*[tagged(r, PENDING) for r in run.held], edge(run)]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: _Run | None = None
        for rows in batches:
            n = len(rows)
            if not n:
                continue
            h1, h2, doc = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "doc"))
            new_key = np.ones(n, bool)
            new_key[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            new_doc = new_key.copy()
            new_doc[1:] |= doc[1:] != doc[:-1]
            goes_on = run is not None and run.key == (h1[0], h2[0])
            if goes_on:
                new_doc[0] = doc[0] != run.last_doc
            begin = np.flatnonzero(new_key)
            end = np.append(begin[1:], n)
            docs = np.add.reduceat(new_doc.astype(np.int64), begin)
            lo = 0
            if goes_on:
                yield from grow(run, rows.slice(0, end[0]), int(docs[0]), doc[end[0] - 1])
                lo = 1
            if lo < len(begin):
                if run is not None:
                    yield from close(run, last=False)
                elif len(begin) > 1:  # the partition's first run ends in this batch
                    run = _Run((h1[0], h2[0]), first=True)
                    yield from grow(run, rows.slice(0, end[0]), int(docs[0]), doc[end[0] - 1])
                    yield from close(run, last=False)
                    lo = 1
                whole = docs[lo:-1] >= min_docs  # runs that begin and end here
                if whole.any():
                    kept = np.zeros(n + 1, np.int64)
                    np.add.at(kept, begin[lo:-1][whole], 1)
                    np.add.at(kept, end[lo:-1][whole], -1)
                    yield tagged(rows.filter(pa.array(np.cumsum(kept[:n]) > 0)), DROPPED)
                b = begin[-1]
                run = _Run((h1[b], h2[b]), first=run is None)
                yield from grow(run, rows.slice(b), int(docs[-1]), doc[-1])
        if run is not None:
            yield from close(run, last=True)

    return stream


def _bitmap(n_lines: int, dropped: np.ndarray) -> bytes:
    keep = np.ones(n_lines, np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    """The keep flags of a document's lines."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


@F.pandas_udf(T.BinaryType())
def _pack(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    return pd.Series([_bitmap(n, np.asarray(d)) for n, d in zip(n_lines, dropped)], dtype=object)


@F.pandas_udf(T.StringType())
def _kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    out = []
    for t, b in zip(text, bitmap):
        if t is None or b is None:
            out.append(None)
            continue
        lines = t.split("\n")
        out.append("\n".join(x for x, keep in zip(lines, unpack(b, len(lines))) if keep))
    return pd.Series(out, dtype=object)


def keep_bitmaps(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                 min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``d`` (the id), ``t`` (hash of the text), ``n_lines``, ``n_dropped``,
    ``bitmap`` for each document that loses a line; all others keep all."""
    lines = docs.select(F.col(f"`{doc_id}`").alias("d"), whole_text(f"`{text}`").alias("x")).select(
        "d", F.xxhash64("x").alias("t"), F.split("x", "\n").alias("l"))
    lines = lines.select("d", "t", F.size("l").alias("n"), F.posexplode("l").alias("pos", "line"))
    key = ascii_lower(F.btrim("line", F.lit(BLANKS)))
    lines = lines.select("d", "t", "n", "pos", key.alias("key")).where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.hash("key").alias("h2"), F.xxhash64("d", "t").alias("doc"), "d", "t", "n", "pos")
    # Equal (hash, document) rows never part, so no document counts twice.
    sorted_lines = lines.repartitionByRange("h1", "h2", "d", "t").sortWithinPartitions("h1", "h2", "d", "t", "pos")
    out = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("docs", T.LongType()),
                        *[f for f in lines.schema.fields if f.name != "doc"]])
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    found = sorted_lines.mapInArrow(_runs_over(min_docs, to_arrow_schema(out)), out).checkpoint()
    over = found.where(F.col("kind") == EDGE).groupBy("h1", "h2").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    pending = found.where(F.col("kind") == PENDING).join(over.select("h1", "h2"), ["h1", "h2"], "left_semi")
    columns = ["d", "t", "n", "pos"]
    dropped = found.where(F.col("kind") == DROPPED).select(*columns).unionByName(pending.select(*columns))
    per_doc = dropped.groupBy("d", "t", "n").agg(F.collect_set("pos").alias("pos"))
    return per_doc.select("d", "t", F.col("n").cast("long").alias("n_lines"),
                          F.size("pos").cast("long").alias("n_dropped"), _pack("n", "pos").alias("bitmap"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` (struct ``row`` of the columns to ``keep``) with ``n_lines``, ``n_dropped``,
    ``kept_text`` (never null)."""
    rows = carried(docs, keep, _d=F.col(f"`{doc_id}`"), _x=whole_text(f"`{text}`")).withColumn("_t", F.xxhash64("_x"))
    on = F.col("_d").eqNullSafe(F.col("d")) & (F.col("_t") == F.col("t"))
    joined = rows.join(bitmaps.select("d", "t", "n_dropped", "bitmap"), on, "left")
    lost = F.col("bitmap").isNotNull()
    kept = _kept(F.when(lost, F.col("_x")), F.col("bitmap"))
    return joined.select(
        "row", F.size(F.split("_x", "\n")).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(lost, F.coalesce(kept, F.lit(""))).otherwise(F.col("_x")).alias("kept_text"),
    )
