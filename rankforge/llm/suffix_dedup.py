"""Dedup of repeated byte strings with suffix arrays.

A byte goes if some ``length`` = 50 bytes around it also start in a document
with a smaller id. Strings are judged on the input.

0. Of equal texts, those with larger ids than the smallest go whole; only the
   one with the smallest id is looked at below.
1. Anchors: every window of 50 bytes has one anchor, the 24-byte gram of
   smallest hash in it (the leftmost of equal ones). Equal windows have equal
   anchors at the same places, so only windows of an anchor that two documents
   share can repeat. An anchor's context is the bytes of its windows; both are
   known by 64-bit hashes. One pass over the texts makes all anchors (hashes,
   document, place; no text). Those that two documents of a slice of texts share
   are marked in that pass and dealt freely; only one of them goes to the task of
   its hash, to tell it, so that a frequent anchor spreads over many tasks. There
   anchors of one document alone are left out.
2. Contexts: equal contexts are one, with the smallest id that has it. In
   documents with a larger id all of it repeats. Only where an anchor has
   several contexts are their bytes looked up, once each.
3. Suffix arrays: an anchor's contexts are trimmed to what agrees with another
   one from the anchor to the left and to the right; the different remainders
   of 50 bytes or more are put side by side and
   their suffixes sorted by linear grouping construction: groups of equal
   Lyndon prefixes are processed in descending order; the previous-smaller
   pointers of a group's suffixes name the suffixes whose Lyndon prefix the
   group extends, which are split off their groups by the number of copies;
   then one pass emits each group's order. Neighbours that agree in 50 bytes
   are one string; its smallest id marks the rest.
4. The marks go back to their documents, and the marked bytes go.

What one step hands to the next is a table in the shared folder, so that
Spark can delete the shuffle files of the steps before.

Defined cases: a null or empty text has no bytes; texts shorter than 50 bytes
keep all; documents with one id are one document, neither smaller; a null id
counts as larger than all others; ids are integers.
"""

from __future__ import annotations

import os
import posixpath
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.session import ensure_checkpoint_dir

from .text import carried, whole_text

LENGTH, GRAM = 50, 24
#: Text bytes of a slice; tasks that free or frequent rows of one key are dealt to;
#: rows of one document held back until another document has the anchor.
SLICE, SALTS, HELD = 4 << 20, 1024, 100_000
JOINED = 16 << 10
#: A key with more than this many rows, and more than this share of them, is frequent.
FREQUENT_ROWS, FREQUENT_SHARE = 10_000, 1000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_DEAL = 4095  # the bits of the deal in a place, from bit 48 on; all set for -1
_REVERSED = 0xFF0F  # the same bits of a place whose bytes are reversed
_OF_TEXT = np.int64(0x2545F4914F6CDD1D)
_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def suffix_array(s: Sequence[int]) -> list[int]:
    """Starts of the suffixes of ``s`` in ascending order."""
    n = len(s)
    done, prev, group = bytearray(n), [-1] * n, [0] * n
    letters: dict[int, list[int]] = {}
    for i, c in enumerate(s):
        letters.setdefault(c, []).append(i)
    members, below = [], []  # of a group: its suffixes; the next lower group
    top = -1
    for c in sorted(letters):
        for i in letters[c]:
            group[i] = len(members)
        members.append(letters[c])
        below.append(top)
        top = len(members) - 1
    above = [*range(1, len(members)), -1] if members else []
    descending = []
    while top >= 0:
        g, top = top, below[top]
        if top >= 0:
            above[top] = -1
        own = sorted(i for i in members[g] if group[i] == g)
        if not own:
            continue
        descending.append(own)
        for i in own:
            done[i] = 1
        copies: dict[int, int] = {}
        for i in own:
            p = i - 1
            while p >= 0 and done[p]:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                copies[p] = copies.get(p, 0) + 1
        # More copies of the group's word behind p make a larger suffix.
        by_count: dict[int, list[int]] = {}
        for p, k in copies.items():
            by_count.setdefault(k, []).append(p)
        for k in sorted(by_count, reverse=True):
            new: dict[int, int] = {}
            for p in by_count[k]:
                h = group[p]
                m = new.get(h)
                if m is None:  # right above what is left of h
                    m = new[h] = len(members)
                    members.append([])
                    below.append(h)
                    up = above[h]
                    above.append(up)
                    above[h] = m
                    if up >= 0:
                        below[up] = m
                    else:
                        top = m
                members[m].append(p)
                group[p] = m
    slot, at = [0] * len(members), 1
    for own in reversed(descending):
        slot[group[own[0]]] = at
        at += len(own)
    order, placed = [n] + [-1] * n, bytearray(n)
    for k in range(n + 1):
        j = order[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[slot[g]] = j
            slot[g] += 1
            placed[j] = 1
            j = prev[j]
    return order[1:]


def _slide(x: np.ndarray, width: int, f) -> np.ndarray:
    n = 1
    while 2 * n <= width:
        x, n = f(x[:-n], x[n:]), 2 * n
    return x if n == width else f(x[:len(x) - (width - n)], x[width - n:])


def _joined_anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    joined, sizes = b"".join(texts), np.fromiter(map(len, texts), np.int64, len(texts))
    if len(joined) < LENGTH:
        return (np.zeros(len(texts), np.int64), *(np.zeros(0, np.int64),) * 5)
    h, n = np.frombuffer(joined, np.uint8).astype(np.uint64) + np.uint64(1), 1
    for step in _STEPS:
        h = h[:-n] * np.uint64(step) + h[n:]
        h ^= h >> np.uint64(29)
        n *= 2
    h = h[:n - GRAM] * np.uint64(_STEPS[0]) + h[GRAM - n:]  # two overlapping halves
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    low = np.uint64(0xFFFFFFFF)
    ranked = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    place = (_slide(ranked, LENGTH - GRAM + 1, np.minimum) & low).astype(np.int64)  # of each window's anchor
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[:len(place)]
    windows = np.flatnonzero(np.arange(LENGTH, len(joined) + 1) <= ends[owner])  # those within one text
    place = place[windows]
    runs = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else windows
    first, last, at = windows[runs], windows[np.append(runs[1:], len(windows)) - 1] if len(runs) else runs, place[runs]
    # Two grams from the left and two up to the right end cover a context.
    end = last + LENGTH
    k = ((at - first) << 8 | (last - first)).astype(np.uint64)
    for gram in (first, first + GRAM, end - 2 * GRAM, end - GRAM):
        k = (k ^ h[gram]) * np.uint64(_STEPS[1])
        k ^= k >> np.uint64(31)
    owner = owner[first]
    begin = (ends - sizes)[owner]
    return np.bincount(owner, minlength=len(texts)), h[at].view(np.int64), k.view(np.int64), at - begin, first - begin, last - begin


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """The number of anchors of each text; of each anchor, text by text: its
    hash, its context's hash, its place, the starts of the first and the last of
    its windows. Short texts are worked on together, ``JOINED`` bytes at a time."""
    parts, lo, size = [], 0, 0
    for hi, t in enumerate(texts, 1):
        size += len(t)
        if size >= JOINED or hi == len(texts):
            parts.append(_joined_anchors(texts[lo:hi]))
            lo, size = hi, 0
    return tuple(np.concatenate(c) for c in zip(*parts))


def _agreement(words: list[bytes]) -> list[int]:
    """The longest common prefix of each word with another one."""
    out = [0] * len(words)
    order = sorted(range(len(words)), key=words.__getitem__)
    for i, j in zip(order, order[1:]):
        n = min(len(words[i]), len(words[j]))
        differ = int.from_bytes(words[i][:n], "big") ^ int.from_bytes(words[j][:n], "big")
        n -= (differ.bit_length() + 7) // 8
        out[i], out[j] = max(out[i], n), max(out[j], n)
    return out


def _marks(pieces: list[tuple[bytes, int]]) -> list[list[int]]:
    """Starts of the windows in each (text, smallest id) that a piece with a smaller id has."""
    text, owner = [], []
    for k, (c, _) in enumerate(pieces):
        text += [*c, 256]
        owner += [k] * (len(c) + 1)
    begin = np.cumsum([0] + [len(c) + 1 for c, _ in pieces]).tolist()
    out: list[list[int]] = [[] for _ in pieces]
    run: list[tuple[int, int]] = []
    last = None

    def close() -> None:
        if len(run) > 1:
            first = min(pieces[k][1] for k, _ in run)
            for k, o in run:
                if pieces[k][1] > first:
                    out[k].append(o)

    for i in suffix_array(text):
        k = owner[i]
        o = i - begin[k]
        window = pieces[k][0][o:o + LENGTH]
        if len(window) < LENGTH:
            continue
        if window != last:
            close()
            run, last = [], window
        run.append((k, o))
    close()
    return out


def _solved(contexts: list[tuple[int, bytes, int]]) -> list[list[int]]:
    """For each (place of the anchor, context, smallest id) of one anchor the
    starts of the windows that a smaller id has."""
    left = _agreement([c[:off][::-1] for off, c, _ in contexts])
    right = _agreement([c[off + GRAM:] for off, c, _ in contexts])
    pieces: dict[bytes, int] = {}
    cut = []
    for (off, c, first), a, b in zip(contexts, left, right):
        piece = c[off - a:off + GRAM + b]
        cut.append(piece if len(piece) >= LENGTH else None)
        if len(piece) >= LENGTH:
            pieces[piece] = min(first, pieces.get(piece, first))
    # A piece alone repeats in all its contexts and needs no order.
    found = dict(zip(pieces, _marks(list(pieces.items())))) if len(pieces) > 1 else dict.fromkeys(pieces, [])
    out = []
    for (off, _, first), a, piece in zip(contexts, left, cut):
        if piece is None:
            out.append([])
        else:
            starts = range(len(piece) - LENGTH + 1) if first > pieces[piece] else sorted(found[piece])
            out.append([off - a + o for o in starts])
    return out


def _slices(b: pa.RecordBatch, name: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``SLICE`` bytes of ``name`` each, of one row at least."""
    parts = np.cumsum(pc.binary_length(b.column(name)).to_numpy().astype(np.int64)) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(b)]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield b.slice(lo, hi - lo)


def _starts(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1]))


def _dealt(h: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Of each anchor of a slice: 0 if one document has it; else -1 for the
    first of these and a positive number for the others."""
    order = np.argsort(h)
    start = _starts(h[order])
    docs = d[order]
    shared = np.minimum.reduceat(docs, start) != np.maximum.reduceat(docs, start)
    out = np.zeros(len(h), np.int32)
    members = order[np.repeat(shared, np.diff(start, append=len(h)))]
    out[members] = 1 + (d[members] + members) % SALTS
    out[order[start[shared]]] = -1
    return out


def _only_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order of ``h`` those whose ``h`` has several documents ``d``
    or is dealt; also those of a single document beyond ``HELD``."""

    def out(b: pa.RecordBatch) -> pa.RecordBatch:
        place = b.column("place").to_numpy().byteswap() & ((1 << 48) - 1)
        return pa.RecordBatch.from_arrays(
            [*[b.column(c) for c in ("h", "k", "d", "o")], pa.array(place >> 5, pa.int32()), pa.array(place & 31, pa.int32())],
            names=["h", "k", "d", "o", "a", "last"])

    key = doc = None  # of the last run; doc is None where it is known to be shared
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not len(b):
            continue
        h, d, place = (b.column(c).to_numpy() for c in ("h", "d", "place"))
        start = _starts(h)
        low, high = np.minimum.reduceat(d, start), np.maximum.reduceat(d, start)
        shared = (low != high) | np.logical_or.reduceat((place & _REVERSED) != 0, start)
        if h[0] == key:
            shared[0] |= doc is None or doc != low[0]
        if held and (h[0] != key or shared[0] or len(start) > 1):
            if h[0] == key and shared[0]:
                yield from map(out, held)
            held = []
        take = np.repeat(shared, np.diff(start, append=len(h)))
        if h[-1] != key or shared[-1]:
            key, doc = h[-1], None if shared[-1] else low[-1]
        if not shared[-1]:
            held.append(b.slice(start[-1]))
            if sum(map(len, held)) > HELD:
                yield from map(out, held)
                held = []
        yield out(b.filter(pa.array(take)))


def _seen(docs: DataFrame) -> DataFrame:
    """(h, k, d, o, a, last) of the anchors that several documents have: the
    hashes of the anchor and its context, document id and which of its texts,
    start of the first window, the number of windows less one. On the way the
    last two and the deal are one number, its bytes reversed to put those that
    differ from row to row beside the hashes: these rows are most of what is moved."""
    names = ["o", "d", "place", "h", "k"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b, "x"):
                n, h, k, _, first, last = anchors(part.column("x").to_pylist())
                if not len(h):
                    continue
                o, d = (np.repeat(part.column(c).to_numpy(), n) for c in ("o", "d"))
                place = first << 5 | (last - first) | (_dealt(h, d).astype(np.int64) & _DEAL) << 48
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (o, d, place.byteswap(), h, k)], names=names)

    schema = ", ".join(f"{c} long" for c in names)
    deal = F.col("place").bitwiseAND(_REVERSED)
    to_tell = F.when(deal == _REVERSED, 0).otherwise(deal)
    dealt = docs.select("o", "d", "x").mapInArrow(run, schema).repartition("h", to_tell).sortWithinPartitions("h")
    return dealt.mapInArrow(_only_shared, "h long, k long, d long, o long, a int, last int")


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, k, d, off, c) for the anchors ``h`` wanted of each document ``d``:
    the hashes of the anchor and its context, document id, the anchor's place in
    the context, the context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _slices(b, "x"):
                texts, sets = part.column("x").to_pylist(), part.column("wanted")
                n, h, k, at, first, last = anchors(texts)
                owner = np.repeat(np.arange(len(texts)), n)
                of_set = np.repeat(np.arange(len(texts)), pc.list_value_length(sets).to_numpy())
                # A chance hit would look up one context more, which changes nothing.
                mine = np.isin(h + owner * _OF_TEXT, sets.flatten().to_numpy() + of_set * _OF_TEXT)
                owner, h, k, at, first, last = (c[mine] for c in (owner, h, k, at, first, last))
                c = [texts[o][i:j] for o, i, j in zip(owner.tolist(), first.tolist(), (last + LENGTH).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(k), pa.array(part.column("d").to_numpy()[owner]), pa.array(at - first, pa.int32()), pa.array(c, pa.binary())],
                    names=["h", "k", "d", "off", "c"])

    sets = wanted.groupBy("d").agg(F.collect_set("h").alias("wanted"))
    return docs.join(sets, "d").select("d", "x", "wanted").mapInArrow(run, "h long, k long, d long, off int, c binary")


def _join_one(many: DataFrame, one: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """``many`` joined to ``one``, which has a row for each key; ``counts`` has
    the number ``n`` of its rows in ``many``. The rows of a frequent key, of which
    there are at most ``FREQUENT_SHARE``, are dealt by ``d`` over ``SALTS`` tasks."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = F.broadcast(counts.where(F.col("n") > max(FREQUENT_ROWS, total // FREQUENT_SHARE)).select(*keys, F.lit(SALTS).alias("salts")))
    dealt = many.join(frequent, keys, "left").withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.abs(F.hash("d") % SALTS))).drop("salts")
    salts = F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)
    copied = one.join(frequent, keys, "left").withColumn("salt", F.explode(salts)).drop("salts")
    return dealt.join(copied, [*keys, "salt"]).drop("salt")


def _context_marks(contexts: DataFrame) -> DataFrame:
    """(h, k, off, c, d) -> (h, k, marks): one row per context that has any."""

    def solved(h: int | None, rows: dict[int, tuple[int, bytes, int]]) -> list[tuple]:
        if len(rows) < 2:
            return []
        return [(h, k, m) for k, m in zip(rows, _solved(list(rows.values()))) if m]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) or [()] * 3
            types = (pa.int64(), pa.int64(), pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=["h", "k", "marks"])

        key, rows = None, {}
        for b in batches:
            out = []
            for h, k, off, c, d in zip(*(b.column(x).to_pylist() for x in ("h", "k", "off", "c", "d"))):
                if h != key:
                    out += solved(key, rows)
                    key, rows = h, {}
                rows[k] = (off, c, min(d, rows[k][2]) if k in rows else d)
            yield batch(out)
        yield batch(solved(key, rows))

    return contexts.repartition("h").sortWithinPartitions("h").mapInArrow(run, "h long, k long, marks array<int>")


def _written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table in the shared folder. What was shuffled to make it is
    not needed again; Spark deletes those files when the write ends."""
    spark, schema = df.sparkSession, df.schema
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(schema).parquet(path)


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` with ``n_bytes``,
    ``n_removed``, ``n_spans`` and ``kept`` (binary)."""
    order = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit((1 << 63) - 1))
    rows = carried(docs, keep, d=order, x=whole_text(f"`{text}`").cast("binary")).withColumn("t", F.xxhash64("x"))
    path = posixpath.join(ensure_checkpoint_dir(docs.sparkSession), f"repeats-{os.urandom(8).hex()}")
    long_enough = rows.where(F.octet_length("x") >= LENGTH).select("d", "t", "x", F.xxhash64(F.lit(23), "x").alias("u"))
    ids = long_enough.select("d", "t", "u", F.octet_length("x").alias("size"))
    smallest = _written(ids.groupBy("t", "u").agg(F.min("d").alias("d"), F.count("*").alias("n")), f"{path}-texts")
    # 0 for an id's only text, so that the many rows of anchors need no text hash.
    of_id = smallest.groupBy("d").agg(F.count("*").alias("texts"))
    own = smallest.join(of_id, "d").select("d", "t", "u", F.when(F.col("texts") > 1, F.col("t")).otherwise(0).alias("o"))
    distinct = _written(long_enough.join(own, ["d", "t", "u"]).select("o", "d", "x"), f"{path}-distinct")
    seen = _written(_seen(distinct), f"{path}-seen")
    known = _written(seen.groupBy("h", "k").agg(F.min("d").alias("d"), F.count("*").alias("n")), f"{path}-known")
    several = known.groupBy("h").count().where("count > 1")
    # An id's other texts and copies may come along: their contexts are known too.
    looked_up = _contexts(long_enough, known.join(several, "h", "left_semi"))
    marks = _written(_context_marks(looked_up), f"{path}-marks")
    # All windows of a context repeat in later documents; in the first one, those marked.
    first = known.select("h", "k", F.col("d").alias("first")).join(marks, ["h", "k"], "left")
    judged = _join_one(seen, first, known, ["h", "k"]).select(
        "d", "o", "a", F.when(F.col("d") > F.col("first"), F.sequence(F.lit(0), "last")).otherwise(F.col("marks")).alias("m"))
    # As (first, last) window starts: whole contexts are one run.
    runs = judged.where("size(m) > 0").select("d", "o", F.when(
        F.col("m")[F.size("m") - 1] - F.col("m")[0] == F.size("m") - 1,
        F.array(F.struct((F.col("a") + F.col("m")[0]).alias("lo"), (F.col("a") + F.col("m")[F.size("m") - 1]).alias("hi")))).otherwise(
        F.transform("m", lambda o: F.struct((F.col("a") + o).alias("lo"), (F.col("a") + o).alias("hi")))).alias("m"))
    in_texts = runs.groupBy("d", "o").agg(F.flatten(F.collect_list("m")).alias("starts")).join(own, ["d", "o"]).select("d", "t", "starts")
    copies = _join_one(ids, smallest.select("t", "u", F.col("d").alias("first")), smallest, ["t", "u"]).where("d > first").groupBy("d", "t").agg(
        F.array(F.struct(F.lit(0).alias("lo"), (F.max("size") - LENGTH).alias("hi"))).alias("starts"))
    starts = _written(in_texts.unionByName(copies), f"{path}-starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, removed, spans, kept = [], [], [], []
            for t, s in zip(b.column("x"), b.column("starts")):
                data = np.frombuffer(t.as_py(), np.uint8)
                step = np.zeros(len(data) + 1, np.int64)
                if s.is_valid:
                    np.add.at(step, s.values.field("lo").to_numpy(), 1)
                    np.add.at(step, s.values.field("hi").to_numpy() + LENGTH, -1)
                gone = np.cumsum(step[:-1]) > 0
                sizes.append(len(data))
                removed.append(int(gone.sum()))
                spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                kept.append(data[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), *[pa.array(c, pa.int64()) for c in (sizes, removed, spans)], pa.array(kept, pa.binary())],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = T.StructType([rows.schema["row"], *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")], T.StructField("kept", T.BinaryType())])
    return rows.join(starts, ["d", "t"], "left").select("row", "x", "starts").mapInArrow(run, schema)
