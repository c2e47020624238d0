"""SimHash near-dedup by multi-index hashing.

A text's fingerprint has 64 bits, taken by majority over the XXH64 (seed 42)
of its word shingles. Documents with one fingerprint are one node. Links join
nodes at ``max_bits`` = 2 or fewer differing bits. The fingerprint is cut into
two segments of 32 bits; of two fingerprints within 2 bits one segment differs
in at most 1. The table of a segment holds every fingerprint under the
segment's value; each fingerprint looks up its segment's Hamming ball of
radius 1 (33 values), fetches the matches and verifies the complete distance.

A segment value that more than ``HOT`` fingerprints share is a hot bucket: there
both sides add a second key, the values of the other segment's ball of radius
1 (two halves within 2 bits meet in one). So a lookup fetches at most ``HOT``
fingerprints in a plain bucket and 33 in a part of a hot one, whatever shares
the segment, and no link is lost. A fingerprint has at most 2,080 others within
2 bits, so links grow with the nodes, not with their pairs.

Defined cases: a null or blank text has no words and fingerprint zero, linked
like any other; fewer words than the shingle length make one shingle;
repeated rows are rows of one node; null ids never are a component's smallest
id unless it has no other (then the component is null); an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .text import whole_text

BITS, SEGMENTS, SEED = 64, 2, 42
#: Fingerprints of one segment value that are looked up without a second key.
HOT = 64
#: Shingles whose bits are unpacked at once (64 bytes each).
BLOCK = 1 << 16


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """The fingerprint as a signed 64-bit number."""
    from xxhash import xxh64_intdigest

    ws = text.lower().split()  # bytes: A-Z only, ASCII white space only
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= shingle_words:
        hashes = np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in ws])
        begins = [0, *(ends[: len(ws) - shingle_words]).tolist()]
        stops = (ends[shingle_words - 1:] - 1).tolist()
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins, stops)], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), BLOCK):
        counts += np.unpackbits(hashes[k:k + BLOCK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle_words: int = 3,
                 hashed: bool = False) -> DataFrame:
    """(doc_id, fp) for every row, if ``hashed`` with its ``text_hash``."""
    id_type = docs.schema[doc_id].dataType
    hashes = ["text_hash"] if hashed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t.as_py(), shingle_words) for t in b.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fps, *b.columns[2:]], names=["doc_id", "fp", *hashes])

    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("fp", T.LongType()),
                           *[T.StructField(h, T.StringType()) for h in hashes]])
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole_text(f"`{text}`").cast("binary"),
                       *[text_hash(f"`{text}`").alias(h) for h in hashes]).mapInArrow(run, schema)


def _ball(value: Column) -> Column:
    """A segment's value and the values that differ from it in one bit."""
    flips = F.transform(F.sequence(F.lit(0), F.lit(BITS // SEGMENTS - 1)),
                        lambda b: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))
    return F.concat(F.array(value), flips)


def fingerprint_links(nodes: DataFrame, hot: int = HOT) -> DataFrame:
    """Links (u, v), u > v, of all ``fp`` within 2 bits; some more than once."""
    width = BITS // SEGMENTS
    low = F.col("fp").bitwiseAND(F.lit((1 << width) - 1))
    high = F.shiftrightunsigned("fp", width)
    # The segment's number is its keys' bit above the value.
    halves = F.array(F.struct(low.alias("key"), high.alias("other")),
                     F.struct(high.bitwiseOR(F.lit(1 << width)).alias("key"), low.alias("other")))
    entries = nodes.select("fp", F.explode(halves).alias("half")).select("fp", "half.key", "half.other")
    probes = entries.select("fp", F.explode(_ball(F.col("key"))).alias("key"), "other")
    crowded = entries.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key", F.lit(True).alias("hot")).checkpoint()

    # Plain keys meet on the key alone, so both sides cross the network once;
    # only the rows of hot keys travel again, by their part.
    left, right = ((rows.join(crowded, "key", "left").select("key", "other", F.col("fp").alias(name), F.col("hot").isNotNull().alias("hot")))
                   for rows, name in ((probes, "u"), (entries, "v")))

    def parted(rows: DataFrame, name: str) -> DataFrame:
        return rows.where("hot").select("key", F.explode(_ball(F.col("other"))).alias("part"), name)

    found = left.where("not hot").join(right.where("not hot"), "key").select("u", "v")
    if not crowded.isEmpty():
        found = found.unionByName(parted(left, "u").join(parted(right, "v"), ["key", "part"]).select("u", "v"))
    return found.where("u > v").where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 2).select("u", "v")


def _rooted(nodes: DataFrame) -> DataFrame:
    """``nodes`` (fp, first) with the smallest fingerprint of their component, ``root``."""
    roots = components(fingerprint_links(nodes))
    return nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle_words: int = 3) -> DataFrame:
    """(doc_id, fp, component) for every row; the component is the smallest id
    reachable over links."""
    rows = fingerprints(docs, doc_id=doc_id, text=text, shingle_words=shingle_words).checkpoint()
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first")).checkpoint()
    rooted = _rooted(nodes)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    classes = rooted.join(smallest, "root").select(F.col("fp").alias("_fp"), "component").checkpoint()
    return rows.join(classes, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component")


def text_hash(text: str | Column) -> Column:
    """Tells rows of one id, or without one, apart by their texts."""
    return F.sha2(whole_text(text).cast("binary"), 256)


def first_of_groups(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle_words: int = 3) -> DataFrame:
    """(doc_id, text_hash) of one row of each near-duplicate group: the smallest
    id's (null only where the group has no other) and, of its texts in the
    group, the one with the smallest hash."""
    rows = fingerprints(docs, doc_id=doc_id, text=text, shingle_words=shingle_words, hashed=True)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    nodes = rows.groupBy("fp").agg(F.min(order).alias("first")).checkpoint()
    firsts = _rooted(nodes).groupBy("root").agg(F.min("first").alias("first"))
    return firsts.select("first.doc_id", "first.text_hash")
