"""BPE encoding and decoding with content-defined chunks encoded once.

Texts are cut where a rolling hash of the last 32 bytes says so, so equal
passages are cut alike wherever they stand. A first pass counts the chunks'
128-bit hashes; those found twice or more are marked in a bit filter of a
fixed size, which is broadcast. The second pass cuts again: a text without a
marked chunk is encoded where it is read and goes no further; of the others
the rest is encoded in place and the marked chunks are only referred to. Each
marked chunk is encoded once in all, its ids are joined to the references
(a hot chunk is a skewed join side, which Spark splits), and each document's
parts meet in order. The filter may mark a chunk that stands alone, or, when
full, all of them: that costs time, never a result.

A cut may fall inside a word. Each part brings its outer ``EDGE`` words with
their ids; a join is repaired by encoding the words around it anew, from one
word on either side, until the outermost words on both sides get exactly the
ids that their parts gave them. A part with too few words waits for its
neighbours and is encoded with them.

Words end at ASCII white space, which this kind of tokenizer drops, and after
an East Asian comma or stop before an ideograph (U+5000 to U+8FFF), where its
pattern always parts. So a word's ids never depend on its neighbours, and a
worker keeps the ids of words that it has seen, at most ``CACHE_BYTES``.

Defined cases: a null or empty text has no ids and decodes to the empty text;
bytes that are not valid UTF-8 are read as U+FFFD; repeated rows are rows of
their own; columns of the input may have any names. A text without a word's
end is one part and is encoded whole, in one task.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import posixpath
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.session import ensure_checkpoint_dir

from .text import carried, whole_text
from .token_count import _tokenizer

#: Chunks have MIN_CHUNK + 2^CUT_BITS bytes on average and MAX_CHUNK at most.
CUT_BITS, MIN_CHUNK, MAX_CHUNK = 9, 128, 1 << 16
FILTER_BITS, EDGE, SLICE_BYTES, CACHE_BYTES = 24, 3, 4 << 20, 64 << 20
_GEAR = np.random.default_rng(13).integers(0, 1 << 32, 256, dtype=np.uint32)
_STOP = re.compile(rb"(?<=\xe3\x80[\x81\x82]|\xef\xbc[\x81\x8c\x9a\x9b\x9f])(?=[\xe5-\xe8])")
_BLANK = b" \t\n\x0b\x0c\r"


def _cut_places(data: np.ndarray) -> np.ndarray:
    """Places where a chunk may begin. The hash reaches back 32 bytes, less
    than a chunk's least size, so texts can be hashed one after another."""
    h = _GEAR[data]
    for s in (1, 2, 4, 8, 16):
        moved = h.copy()
        moved[s:] += h[:-s] << np.uint32(s)
        h = moved
    places = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    places = places[places < len(data)]
    return places[data[places] & 0xC0 != 0x80]


def _chunks(text: bytes, places: list[int], base: int) -> list[bytes]:
    out, last = [], 0
    for p in [*(p - base for p in places), len(text)]:
        while p - last > MAX_CHUNK:
            at = last + MAX_CHUNK
            while text[at] & 0xC0 == 0x80:
                at -= 1
            out.append(text[last:at])
            last = at
        if p - last >= MIN_CHUNK or (p == len(text) and p > last):
            out.append(text[last:p])
            last = p
    return out


def cut(texts: list[bytes]) -> list[list[bytes]]:
    """The chunks of each text."""
    joined = b"".join(texts)
    if not joined:
        return [[] for _ in texts]
    places = _cut_places(np.frombuffer(joined, np.uint8))
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    lo, hi = np.searchsorted(places, begins, "right"), np.searchsorted(places, ends, "left")
    flat = places.tolist()
    return [_chunks(t, flat[a:b], base) for t, a, b, base in zip(texts, lo.tolist(), hi.tolist(), begins.tolist())]


def words(text: bytes) -> list[bytes]:
    found = text.split()  # at ASCII white space
    if b"\xe3\x80" in text or b"\xef\xbc" in text:
        return [x for w in found for x in _STOP.split(w)]
    return found


def _parted(left: bytes, right: bytes) -> bool:
    """Whether a word ends between the two."""
    return left[-1] in _BLANK or right[0] in _BLANK or bool(_STOP.search(left[-3:] + right[:1]))


@functools.cache
def width(path: str) -> str:
    """The type that an id is packed as."""
    return "<u2" if _tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4"


@functools.cache
def encoder(path: str):
    """words -> the ids of each, packed."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    first = rules["pre_tokenizer"].get("pretokenizers", [{}])[0]
    pattern = first.get("pattern", {}).get("Regex", "")
    if first.get("behavior") != "Removed" or not first.get("invert") or r"[^\s\p{L}\p{N}]+" not in pattern:
        raise ValueError(f"{path}: white space must part words and be dropped")
    tokenizer, kind, cache, held = _tokenizer(path), width(path), {}, 0

    def encode(ws: list[bytes]) -> list[bytes]:
        nonlocal held
        missing = list({w for w in ws if w not in cache})
        if missing:
            if held > CACHE_BYTES:
                cache.clear()
                held, missing = 0, list(set(ws))
            for lo in range(0, len(missing), 4096):
                part = missing[lo:lo + 4096]
                got = tokenizer.encode_batch([w.decode() for w in part], add_special_tokens=False)
                ids = [np.array(e.ids, kind).tobytes() for e in got]
                cache.update(zip(part, ids))
                held += sum(map(len, part)) + sum(map(len, ids)) + 100 * len(part)
        return [cache[w] for w in ws]

    return encode


_SIZES = struct.Struct(f"<{2 * EDGE + 2}IBB")


def record(text: bytes, path: str) -> bytes:
    """A part as bytes. A short one is a 0 and its text. Else, after a 1: the
    sizes of the ids of its outer words, of the outer words and of the text's
    two ends, then these ends, the outer words, and all ids."""
    ws = words(text)
    if len(ws) <= 2 * EDGE:
        return b"\0" + text
    ids = encoder(path)(ws)
    head, tail, first, last = b" ".join(ws[:EDGE]), b" ".join(ws[-EDGE:]), text[:1], text[-3:]
    sizes = _SIZES.pack(*map(len, ids[:EDGE] + ids[-EDGE:]), len(head), len(tail), len(first), len(last))
    return b"".join([b"\1", sizes, first, last, head, tail, *ids])


def _unpacked(part: bytes) -> dict:
    *edges, n_head, n_tail, n_first, n_last = _SIZES.unpack_from(part, 1)
    at = 1 + _SIZES.size

    def taken(n: int) -> bytes:
        nonlocal at
        at += n
        return part[at - n:at]

    out = {"first": taken(n_first), "last": taken(n_last), "head": taken(n_head).split(b" "), "tail": taken(n_tail).split(b" ")}
    out["head_ids"] = [taken(n) for n in edges[:EDGE]]
    out["ids"] = taken(len(part) - at - sum(edges[EDGE:]))
    out["tail_ids"] = [taken(n) for n in edges[EDGE:]]
    return out


def _repaired(left: dict, middle: bytes, right: dict, path: str) -> list[bytes]:
    """The ids of ``left``'s tail, the short parts between, ``right``'s head."""
    encode = encoder(path)
    ahead, behind = (not _parted(a, b) for a, b in ((left["last"], middle or right["first"]), (middle or left["last"], right["first"])))
    for n in range(1, EDGE + 1):
        ws, vs = left["tail"][-n:], right["head"][:n]
        window = b" ".join(ws) + (b"" if ahead else b" ") + middle + (b"" if behind or not middle else b" ") + b" ".join(vs)
        ids = encode(words(window))
        # The outermost words, each by itself, must be as their parts have them.
        if n > 1 or not (ahead or behind):
            if ids[0] == left["tail_ids"][-n] and ids[-1] == right["head_ids"][n - 1]:
                return [*left["tail_ids"][:-n], *ids, *right["head_ids"][n:]]
    raise RuntimeError("a join does not agree; words of this tokenizer depend on their neighbours")


def assemble(parts: list[bytes], path: str) -> bytes:
    """The packed ids of a text from its parts in order."""
    out: list[bytes] = []
    left, middle = None, b""
    for part in parts:
        if part[0] == 0:
            middle += part[1:]
            continue
        p = _unpacked(part)
        if left is None:  # the text begins here, or before some short parts
            lead = middle + (b"" if not middle or not _parted(middle, p["first"]) else b" ")
            out += encoder(path)(words(lead + b" ".join(p["head"])))
        else:
            out += _repaired(left, middle, p, path)
        out.append(p["ids"])
        left, middle = p, b""
    if left is None:
        out += encoder(path)(words(middle))
    else:
        glue = b"" if not middle or not _parted(left["last"], middle) else b" "
        out += encoder(path)(words(b" ".join(left["tail"]) + glue + middle))
    return b"".join(out)


def _hashes(chunks: list[list[bytes]]) -> np.ndarray:
    digests = b"".join(xxhash.xxh3_128_digest(c) for cs in chunks for c in cs)
    return np.frombuffer(digests, "<i8").reshape(-1, 2)


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, valid UTF-8 texts) of about SLICE_BYTES."""
    first, size, held = 0, 0, []
    for i, t in enumerate(texts):
        held.append(t.as_py().decode("utf-8", "replace").encode())
        size += len(held[-1])
        if size >= SLICE_BYTES:
            yield first, held
            first, size, held = i + 1, 0, []
    if held:
        yield first, held


def _shared(rows: DataFrame) -> DataFrame:
    """(h1, h2) of the chunks found twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in _slices(b.column("x")):
                h, n = np.unique(_hashes(cut(texts)), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(n, pa.int64())], names=["h1", "h2", "n"])

    return rows.select("x").mapInArrow(run, "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("n")).where("n > 1")


def _filter(shared: DataFrame) -> np.ndarray:
    """Four bits of each hash in one bit field of 2^FILTER_BITS; what reaches
    the driver is that field, at most."""
    low = F.lit((1 << FILTER_BITS) - 1)
    places = [F.shiftrightunsigned(h, s).bitwiseAND(low) for h in ("h1", "h2") for s in (0, 32)]
    bits = shared.select(F.explode(F.array(*places)).alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("m"))
    got = bits.toArrow()
    field = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    field[got.column("w").to_numpy()] = got.column("m").to_numpy()
    return field.view(np.uint64)


def _marked(h: np.ndarray, field: np.ndarray) -> np.ndarray:
    u, low = h.view(np.uint64), np.uint64(64 * len(field) - 1)
    out = np.ones(len(u), bool)
    for k in (0, 1):
        for s in (0, 32):
            p = (u[:, k] >> np.uint64(s)) & low
            out &= (field[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return out


def _parts(rows: DataFrame, field, path: str) -> DataFrame:
    """(k, pos, row, h1, h2, text, rec, ids): a text's whole ids where no
    chunk is marked, else its parts: records, or hashes of marked chunks (with
    the chunk, once in a slice). ``row`` stands in a text's first part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for b in batches:
            keys = b.column("k").to_pylist()
            for lo, texts in _slices(b.column("x")):
                chunks = cut(texts)
                h = _hashes(chunks)
                hit = _marked(h, field.value)
                flags, pairs = hit.tolist(), h.tolist()
                out: list[tuple] = []  # row of the batch or None, k, pos, h1, h2, text, rec, ids
                seen, at = set(), 0
                for i, (text, cs) in enumerate(zip(texts, chunks), lo):
                    mine = flags[at:at + len(cs)]
                    if not any(mine):
                        out.append((i, keys[i], 0, None, None, None, None, b"".join(encode(words(text)))))
                        at += len(cs)
                        continue
                    pos, rest = 0, b""
                    for c, marked, (h1, h2) in zip(cs, mine, pairs[at:at + len(cs)]):
                        if not marked:
                            rest += c
                            continue
                        if rest:
                            out.append((i if not pos else None, keys[i], pos, None, None, None, record(rest, path), None))
                            pos, rest = pos + 1, b""
                        out.append((i if not pos else None, keys[i], pos, h1, h2, None if (h1, h2) in seen else c, None, None))
                        seen.add((h1, h2))
                        pos += 1
                    if rest:
                        out.append((None, keys[i], pos, None, None, None, record(rest, path), None))
                    at += len(cs)
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").take(pa.array(cols[0], pa.int64())),
                     *[pa.array(c, t) for c, t in zip(cols[1:], (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))]],
                    names=["row", "k", "pos", "h1", "h2", "text", "rec", "ids"])

    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), *T._parse_datatype_string(
        "k long, pos int, h1 long, h2 long, text binary, rec binary, ids binary").fields])
    return rows.mapInArrow(run, schema)


def _encoded(chunks: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            recs = pa.array([record(t, path) for t in b.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("h1"), b.column("h2"), recs], names=["h1", "h2", "rec"])

    return chunks.mapInArrow(run, "h1 long, h2 long, rec binary")


def _finished(parts: DataFrame, path: str, keep_ids: bool) -> DataFrame:
    """(row, ids or parts) -> the result's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for b in batches:
            packed = [i if i is not None else assemble(p, path) for i, p in zip(b.column("ids").to_pylist(), b.column("parts").to_pylist())]
            ids = [np.frombuffer(p, width(path)).astype("<u4") for p in packed]
            decoded = [hashlib.sha256(tokenizer.decode(i.tolist(), skip_special_tokens=False).encode()).hexdigest() for i in ids]
            cols = [b.column("row"), pa.array([len(i) for i in ids], pa.int64()), pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids]), pa.array(decoded)]
            names = ["row", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols.append(pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    fields = [parts.schema["row"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    if keep_ids:
        fields.append(T.StructField("token_ids", T.ArrayType(T.IntegerType())))
    return parts.select("row", "ids", "parts").mapInArrow(run, T.StructType(fields))


def encode_texts(docs: DataFrame, path: str, *, text: str = "text", keep: list[str] | None = None, keep_ids: bool = False) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` (of the columns to ``keep``)
    with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for,
    ``token_ids``. Two tables ``chunks-*`` are written to the shared folder."""
    spark = docs.sparkSession
    rows = carried(docs, keep, x=whole_text(f"`{text}`").cast("binary"))
    field = spark.sparkContext.broadcast(_filter(_shared(rows)))
    base = posixpath.join(ensure_checkpoint_dir(spark), f"chunks-{os.urandom(8).hex()}")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{base}-{name}")
        return spark.read.schema(df.schema).parquet(f"{base}-{name}")

    parts = written(_parts(rows.withColumn("k", F.monotonically_increasing_id()), field, path), "parts")
    once = parts.where("text is not null").groupBy("h1", "h2").agg(F.first("text").alias("text"))
    encoded = written(_encoded(once, path), "ids")
    columns = ["k", "pos", "row", "rec"]
    looked_up = parts.where("h1 is not null").select("k", "pos", "row", "h1", "h2").join(encoded, ["h1", "h2"]).select(*columns)
    local = parts.where("rec is not null").select(*columns)
    of_text = looked_up.unionByName(local).groupBy("k").agg(F.sort_array(F.collect_list(F.struct("pos", "rec"))).alias("p"),
                                                            F.first("row", ignorenulls=True).alias("row"))
    joined = of_text.select("row", F.lit(None).cast("binary").alias("ids"), F.col("p.rec").alias("parts"))
    whole = parts.where("ids is not null").select("row", "ids", F.lit(None).cast(joined.schema["parts"].dataType).alias("parts"))
    return _finished(whole, path, keep_ids).unionByName(_finished(joined, path, keep_ids))
