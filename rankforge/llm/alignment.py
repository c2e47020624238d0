"""Alignment of two tokenizers' tokens over the same bytes, Arrow-native.

A slice of texts is encoded by both tokenizers: A's pre-tokens are looked up in
the worker's cache, which is emptied at ``CACHE_BYTES``, and those it lacks are
merged by the library. The ids are flattened, each
with its parent text's index; their byte lengths are summed up within each
text; and a token's end becomes the key ``parent * span + end``. A full outer
Acero hash join of the two end tables, sorted by key, has one row for each
smallest piece between two ends, which lies in one A token and one B token:
the next that ends. So its rows are the links, and those with an end on both
sides close the groups. Each slice counts its id pairs by ``Table.group_by``;
Spark adds the partial counts up.

The texts are encoded once: the links (as pair numbers ``a * n_b + b``) and
partial counts are written to a table in the shared folder. A second pass
looks the corpus-wide counts up: the ``HEAD`` most frequent pairs in a
broadcast of that size (17 bytes an entry), the links of other pairs by a
join after they are counted per document.

Defined cases: a null or empty text, or one that either tokenizer does not
give back byte by byte, has no tokens, all zeros and an empty
``groups_sha256``; bytes that are not valid UTF-8 are read as U+FFFD; repeated
rows count each; columns may have any names; a long text is one slice. Tasks
take rows in Arrow batches of about ``BATCH_BYTES``, whatever their number.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import posixpath
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.session import arrow_batches, ensure_checkpoint_dir

from .text import carried, whole_text

HEAD, SLICE_BYTES, SLICE_LINKS, BATCH_BYTES = 1 << 20, 1 << 19, 1 << 18, 4 << 20
#: Ids of pre-tokens that a worker keeps; an entry costs about ``ENTRY`` bytes and its characters.
CACHE_BYTES, ENTRY = 32 << 20, 250

#: The byte-level pattern on ASCII, but for control characters, and Latin up to U+017E.
_PLAIN = re.compile("[\\x09-\\x0D\\x20-\\x7E\u00a1-\u017e]*+")
_LETTER, _DIGIT = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017e", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_SPLIT = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^\\s{_LETTER}{_DIGIT}]+|\\s+(?!\\S)|\\s+")


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others, in order, for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


def _splits_plainly(conf: dict) -> bool:
    """Whether the byte-level pattern alone parts a text, so that each
    pre-token's ids are its own."""
    split = {k: v for k, v in (conf["pre_tokenizer"] or {}).items() if k != "trim_offsets"}
    return (split == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True} and conf["normalizer"] is None
            and conf["truncation"] is None and conf["padding"] is None and not conf["model"].get("dropout")
            and all(t["special"] for t in conf["added_tokens"]))


def _by_pretokens(tokenizer, char_of: dict[int, str]):
    """texts -> ids of each, by the pre-tokens that this worker has met. Texts
    of other scripts are split by the library."""
    library_split, merged = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
    known: dict[str, tuple[int, ...]] = {}
    held = 0

    def split(text: str) -> list[str]:
        return _SPLIT.findall(text) if _PLAIN.fullmatch(text) else [text[i:j] for _, (i, j) in library_split(text)]

    def encode(texts: list[str]) -> list[list[int]]:
        nonlocal held
        if held > CACHE_BYTES:
            known.clear()
            held = 0
        out = []
        for words in map(split, texts):
            for w in set(words).difference(known):
                known[w] = tuple([t.id for t in merged(w.encode().decode("latin-1").translate(char_of))])
                held += len(w) + ENTRY
            out.append(list(chain.from_iterable(map(known.__getitem__, words))))
        return out

    return encode


@functools.cache
def byte_level(path: str):
    """(texts -> ids of each, bytes of each id) of a byte-level BPE."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    with open(path, encoding="utf-8") as f:
        conf = json.load(f)
    special = {t["id"] for t in conf["added_tokens"]}
    at = _byte_of_char()
    vocab = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        vocab[i] = token.encode() if i in special else bytes(at[c] for c in token)
    if _splits_plainly(conf):
        return _by_pretokens(tokenizer, {b: c for c, b in at.items()}), vocab
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], vocab


@functools.cache
def pieces(path: str):
    """(texts -> ids of each, bytes of each id) of a piece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    vocab = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        vocab.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return lambda texts: model.encode(texts, num_threads=1), vocab


@functools.cache
def _arrays(vocab_of, path: str) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Bytes, byte lengths and decimal numbers of a vocabulary's ids."""
    vocab = vocab_of(path)[1]
    return pa.array(vocab, pa.binary()), pa.array([len(v) for v in vocab], pa.int64()), pa.array(map(str, range(len(vocab))), pa.string())


def _lists(ids: list[list[int]]) -> pa.ListArray:
    return pa.array(ids, pa.list_(pa.int32()))


def _ends(ids: pa.ListArray, lengths: pa.Array, span: int, name: str) -> pa.Table:
    """Each token with the key of its end: lists flattened, parent indices,
    cumulative sums that begin anew with each text."""
    flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids).cast(pa.int64())
    run = pc.cumulative_sum(lengths.take(flat)).to_numpy()
    begins = ids.offsets.to_numpy()[:-1]
    before = np.where(begins > 0, run[np.maximum(begins, 1) - 1] if len(run) else 0, 0)
    at = run - before[parent.to_numpy()]
    return pa.table({"key": pc.add(pc.multiply(parent, span), pa.array(at)), name: flat})


def _groups(ids: pa.ListArray, own: pa.Table, common: np.ndarray, numbers: pa.Array) -> pa.Array:
    """The ids of each group, as decimal numbers with commas."""
    bounds = np.concatenate([[0], np.searchsorted(own.column("key").to_numpy(), common, "right")])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), numbers.take(pc.list_flatten(ids))), ",")


def align(texts: list[str], a_path: str, b_path: str) -> tuple[dict[str, list | pa.Array], pa.Table]:
    """Per text the counts, the groups' hash and the links' pair numbers; the
    slice's partial counts of pairs."""
    (encode_a, _), (encode_b, vocab_b) = byte_level(a_path), pieces(b_path)
    (bytes_a, len_a, num_a), (bytes_b, len_b, num_b) = _arrays(byte_level, a_path), _arrays(pieces, b_path)
    spaced = [" " + t for t in texts]
    a, b = _lists(encode_a(spaced)), _lists(encode_b(texts))
    want = pa.array([s.encode() for s in spaced], pa.binary())

    def same(ids: pa.ListArray, vocab: pa.Array) -> pa.Array:
        return pc.equal(pc.binary_join(pa.ListArray.from_arrays(ids.offsets, vocab.take(pc.list_flatten(ids))), b""), want)

    good = pc.and_(pc.and_(same(a, bytes_a), same(b, bytes_b)), pa.array([t != "" for t in texts]))
    if not pc.all(good).as_py():
        a, b = (_lists([x if g else [] for x, g in zip(ids.to_pylist(), good.to_pylist())]) for ids in (a, b))
    span = max([2, *(len(w) + 2 for w in want.to_pylist())])
    ends_a, ends_b = _ends(a, len_a, span, "a"), _ends(b, len_b, span, "b")
    both = ends_a.join(ends_b, "key", join_type="full outer", use_threads=False).combine_chunks().sort_by("key")
    key, closes = both.column("key").to_numpy(), pc.and_(pc.is_valid(both.column("a")), pc.is_valid(both.column("b"))).to_numpy()
    link_a, link_b = (pc.fill_null_backward(both.column(c)).cast(pa.int64()) for c in ("a", "b"))
    pair = pc.add(pc.multiply(link_a, len(vocab_b)), link_b).combine_chunks()
    counts = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
    bounds = np.arange(len(texts) + 1) * span
    links = np.searchsorted(key, bounds, "right")
    common = key[closes]
    closed = np.searchsorted(common, bounds, "right")
    text = pc.binary_join_element_wise(_groups(a, ends_a, common, num_a), _groups(b, ends_b, common, num_b), "|")
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(closed, pa.int32()), text.slice(0, len(common))), ";")
    number = pa.ListArray.from_arrays(pa.array(links, pa.int32()), pair)
    return {"n_a": pc.list_value_length(a).cast(pa.int64()), "n_b": pc.list_value_length(b).cast(pa.int64()),
            "n_groups": pa.array(np.diff(closed), pa.int64()), "n_links": pa.array(np.diff(links), pa.int64()),
            "groups_sha256": pa.array([hashlib.sha256(t.as_py().encode()).hexdigest() if n else "" for t, n in zip(text, np.diff(closed).tolist())]),
            "pairs": number}, counts


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _aligned(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row for each text (``row``, ``k``, counts, hash, its links' pairs),
    and one for each slice's partial counts (``pairs``, ``ns``)."""

    kind = rows.schema["row"].dataType
    numbers = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("row", kind), T.StructField("k", T.LongType()), *[T.StructField(c, T.LongType()) for c in _COUNTS],
                           T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", numbers), T.StructField("ns", numbers)])
    longs = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo, size, held = 0, 0, []
            for i, t in enumerate(b.column("x")):
                held.append(t.as_py().decode("utf-8", "replace"))
                size += len(held[-1])
                if size < SLICE_BYTES and i + 1 < len(b):
                    continue
                cols, counts = align(held, a_path, b_path)
                n = len(held)
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(lo, n), b.column("k").slice(lo, n), *[cols[c] for c in (*_COUNTS, "groups_sha256", "pairs")], pa.nulls(n, longs)],
                    names=schema.names)
                pair, total = (counts.column(c).combine_chunks() for c in ("pair", "count_all"))
                one = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v.cast(pa.int64())) for v in (pair, total)]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, b.column("row").type), *[pa.nulls(1, pa.int64())] * 5, pa.nulls(1, pa.string()), *one], names=schema.names)
                lo, size, held = i + 1, 0, []

    return rows.mapInArrow(run, schema)


def _slices(links: pa.ListArray) -> Iterator[tuple[int, int]]:
    """Rows with about SLICE_LINKS links together."""
    ends = np.cumsum(pc.list_value_length(links).to_numpy())
    lo = 0
    while lo < len(links):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE_LINKS, "right")))
        yield lo, hi
        lo = hi


def _looked_up(docs: DataFrame, head) -> DataFrame:
    """``docs`` with count_sum and n_best over the links in the head, and the
    pairs of the other links."""
    kept = [c for c in docs.columns if c not in ("pairs", "ns")]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("count_sum", T.LongType()), T.StructField("n_best", T.LongType()),
                           T.StructField("rest", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = head.value  # ascending pairs: looked up in place, no hash table a slice
        for b in batches:
            for lo, hi in _slices(b.column("pairs")):
                part = b.slice(lo, hi - lo)
                links = part.column("pairs")
                flat, bounds = pc.list_flatten(links), np.concatenate([[0], np.cumsum(pc.list_value_length(links).to_numpy())]).astype(np.int64)
                at = np.minimum(np.searchsorted(pair, flat.to_numpy()), max(len(pair) - 1, 0))
                found = pair[at] == flat.to_numpy() if len(pair) else np.zeros(len(flat), bool)

                def summed(values: np.ndarray) -> pa.Array:
                    run = np.concatenate([[0], np.cumsum(np.where(found, values[at], 0) if len(values) else np.zeros(len(at), np.int64))])
                    return pa.array(run[bounds[1:]] - run[bounds[:-1]], pa.int64())

                rest = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(~found)])[bounds], pa.int32()), flat.filter(pa.array(~found)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], summed(n), summed(best), rest], names=schema.names)

    return docs.mapInArrow(run, schema)


def align_texts(docs: DataFrame, a_path: str, b_path: str, *, text: str = "text", keep: list[str] | None = None, head: int = HEAD) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` (of the columns to ``keep``)
    with n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Two
    tables ``links-*`` are written to the shared folder."""
    spark = docs.sparkSession
    rows = carried(docs, keep, x=whole_text(f"`{text}`").cast("binary")).withColumn("k", F.monotonically_increasing_id())
    base = posixpath.join(ensure_checkpoint_dir(spark), f"links-{os.urandom(8).hex()}")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{base}-{name}")
        return spark.read.schema(df.schema).parquet(f"{base}-{name}")

    with arrow_batches(spark, BATCH_BYTES):
        aligned = written(_aligned(rows, a_path, b_path), "aligned")
    n_b = len(pieces(b_path)[1])
    partial = aligned.where("ns is not null").select(F.explode(F.arrays_zip("pairs", "ns")).alias("p")).select("p.pairs", "p.ns")
    counts = partial.groupBy(F.col("pairs").alias("pair")).agg(F.sum("ns").alias("n")).withColumn("b", F.col("pair") % n_b).checkpoint()
    highest = counts.groupBy("b").agg(F.max("n").alias("top"))  # a row for each id of B at most
    counts = counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best"))
    top = counts.orderBy(F.desc("n"), "pair").limit(head).toArrow().sort_by("pair")
    known = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("pair", "n", "best")))
    with arrow_batches(spark, BATCH_BYTES):
        judged = written(_looked_up(aligned.where("ns is null"), known), "judged")
    rest = judged.where("size(rest) > 0")
    others = rest.select("k", F.explode("rest").alias("pair")).groupBy("k", "pair").agg(F.count("*").alias("m")).join(counts, "pair")
    more = others.groupBy("k").agg(F.sum(F.col("m") * F.col("n")).alias("more"), F.sum(F.col("m") * F.col("best")).alias("more_best"))
    out = ["row", *_COUNTS, "n_best", "count_sum", "groups_sha256"]
    added = rest.join(more, "k").withColumns({"count_sum": F.col("count_sum") + F.col("more"), "n_best": F.col("n_best") + F.col("more_best")})
    return judged.where("size(rest) = 0").select(*out).unionByName(added.select(*out))
