"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct pre-tokens of a slice of the corpus are laid out in one array of
byte ids. An inverted index maps each rank that some adjacent pair would merge
to, to the places of such pairs. The ranks are replayed in ascending order
over all pre-tokens at once: each place of the rank is merged from left to
right, only its two neighbour pairs are looked up again, and the new pairs are
added to the index. If a merge makes a pair of a lower rank, that rank is
replayed first, so the result is what merging each pre-token by itself gives.

A task gathers texts until ``SLICE_BYTES``, replays the pre-tokens that its
cache does not hold, and writes the ids of each text; the cache of a worker
outlives its tasks and is emptied when it holds ``CACHE_TOKENS``. So a task's memory is bounded by its
longest text, no pre-token is shuffled, and a lost task is simply run again.
The rank file is read by each worker from the installed tokenizer folder.

Defined cases: a null or empty text has no ids and decodes to no bytes; a
pre-token that is itself a rank is one id; bytes that are not valid UTF-8 are
read as U+FFFD.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import carried, whole_text

SLICE_BYTES, CACHE_TOKENS = 4 << 20, 400_000


@functools.cache
def load(path: str) -> tuple[dict[bytes, int], list[bytes], dict, np.ndarray, np.ndarray]:
    """Ranks, the bytes of each id, the merges: (left, right) -> id, the id of
    each byte and of each pair of bytes (-1: none)."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    vocab = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        vocab[rank] = token
    single = np.array([ranks[bytes([b])] for b in range(256)])
    pairs = np.full((256, 256), -1)
    for token, rank in ranks.items():
        if len(token) == 2:
            pairs[token[0], token[1]] = rank
    return ranks, vocab, {}, single, pairs


def replay(pretokens: list[bytes], ranks: dict[bytes, int], vocab: list[bytes], merges: dict,
           single: np.ndarray, pairs: np.ndarray) -> list[bytes]:
    """Ids of each pre-token (none of them empty), as little-endian uint32.

    ``merges`` remembers (left id, right id) -> merged id or -1 across calls;
    its size is bounded by the pairs that the corpus shows, and it is emptied by
    the caller with the cache."""
    if not pretokens:
        return []
    data = np.frombuffer(b"".join(pretokens), np.uint8)
    sizes = np.array([len(p) for p in pretokens])
    at = np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)  # one -1 after each, pairs never cross it
    n = len(data) + len(sizes)
    laid, first = np.full(n, -1), np.full(n, -1)
    laid[at] = single[data]
    inside = at[1:] == at[:-1] + 1
    first[at[:-1][inside]] = pairs[data[:-1], data[1:]][inside]
    order = np.argsort(first, kind="stable")
    order = order[np.searchsorted(first[order], 0):]
    found, starts = np.unique(first[order], return_index=True)
    index = {r: places.tolist() for r, places in zip(found.tolist(), np.split(order, starts[1:]))}
    ids, rank_at = laid.tolist(), first.tolist()  # rank_at: of the pair that starts there
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # ids[-1] is the last -1
    heap = list(index)
    heapq.heapify(heap)
    while heap:
        r = heapq.heappop(heap)
        places = index.pop(r, None)
        if places is None:
            continue
        places.sort()
        for k, i in enumerate(places):
            if rank_at[i] != r:
                continue
            j = after[i]
            after[i] = right = after[j]
            before[right] = i
            ids[i], ids[j], rank_at[j] = r, -2, -1
            left, lower = before[i], False
            for place, a, b in ((left, ids[left], r), (i, r, ids[right])):
                if a < 0 or b < 0:
                    rank_at[place] = -1
                    continue
                new = merges.get((a, b))
                if new is None:
                    new = merges[a, b] = ranks.get(vocab[a] + vocab[b], -1)
                rank_at[place] = new
                if new >= 0:
                    if new in index:
                        index[new].append(place)
                    else:
                        index[new] = [place]
                        if new != r:
                            heapq.heappush(heap, new)
                    lower = lower or new <= r
            if lower:
                rest = index.setdefault(r, [])
                rest += places[k + 1:]
                heapq.heappush(heap, r)
                break
    laid = np.array(ids)
    left = laid >= 0
    packed = laid[left].astype("<u4").tobytes()
    ends = (4 * np.cumsum(left)[np.cumsum(sizes + 1) - 1]).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends)]


@functools.cache
def encoder(path: str, pattern: str):
    """texts (bytes) -> ids of each, as uint32 arrays; keeps a cache of
    pre-tokens with their ids as bytes."""
    import regex

    ranks, vocab, merges, single, pairs = load(path)
    split, cache = regex.compile(pattern).findall, {}

    def encode(texts: list[bytes]) -> list[np.ndarray]:
        if len(cache) > CACHE_TOKENS:
            cache.clear()
        if len(merges) > CACHE_TOKENS:
            merges.clear()
        tokens = [split(t.decode("utf-8", "replace")) for t in texts]
        rest = []
        for w in {w for ws in tokens for w in ws if w not in cache}:
            rank = ranks.get(w.encode())
            if rank is None:
                rest.append(w)
            else:
                cache[w] = rank.to_bytes(4, "little")
        cache.update(zip(rest, replay([w.encode() for w in rest], ranks, vocab, merges, single, pairs)))
        return [np.frombuffer(b"".join(map(cache.__getitem__, ws)), "<u4") for ws in tokens]

    return encode


def decode(ids: np.ndarray, path: str) -> bytes:
    vocab = load(path)[1]
    return b"".join(map(vocab.__getitem__, ids.tolist()))


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t.as_buffer() or b"")
        if size >= SLICE_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_texts(docs: DataFrame, path: str, pattern: str, *, text: str = "text",
                 keep: list[str] | None = None, keep_ids: bool = False) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` (of the columns to ``keep``) with ``n_tokens``,
    ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``token_ids``."""
    rows = carried(docs, keep, x=whole_text(f"`{text}`").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern)
        for b in batches:
            for lo, hi in _slices(b.column("x")):
                part = b.slice(lo, hi - lo)
                ids = encode(part.column("x").to_pylist())
                cols = [part.column("row"), pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids]),
                        pa.array([hashlib.sha256(decode(i, path)).hexdigest() for i in ids])]
                names = ["row", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    cols.append(pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    fields = [rows.schema["row"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    if keep_ids:
        fields.append(T.StructField("token_ids", T.ArrayType(T.IntegerType())))
    return rows.mapInArrow(run, T.StructType(fields))
