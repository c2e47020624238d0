"""Sharding by sampled splitters (DataFrame functions only).

Records are ordered by (hash of the text, hash of the id), so equal texts lie
together. A size-weighted sample of keys (about ``samples_per_range`` for each
of ``shards * ranges_per_shard`` ranges, whatever the input's size) gives the
splitters, the quantiles of the sampled bytes; a splitter keeps the second
hash only where a text is so frequent that several splitters fall into it,
which subdivides that overfull range. Every record looks its range up in a
small broadcast table, ranges are numbered and their bytes summed, and inside
each range a running sum gives every record its exact byte offset. The copies
of a text lie in the shard that the middle of their bytes falls into, also if
splitters part them for sorting; only copies that together exceed a shard
(``bytes / shards``) are parted among shards, at the splitters. So a shard is
short or over by at most half of the group of copies at either of its borders:
about a range's bytes (a shard's 128th) where groups are small, up to half a
shard where one group nearly fills one, as in small tables. The slot is the
record's place in its shard.

Law: ``bytes``. Broadcast: the splitters (3,072 at most) in 4,096 buckets, the
ranges' totals (one row each) and the texts that splitters part (3,072 at most). A task sorts one range: the rows move once,
without their texts.

Defined cases: a null text is empty (8 bytes, checksum 0); rows that repeat
each other get slots of their own; null ids are ordinary ids; an empty table
gives an empty result; a document larger than a shard leaves its neighbours
short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .text import whole_text

SHARDS, RANGES_PER_SHARD, SAMPLES_PER_RANGE, ROW_BYTES = 24, 128, 8, 8
LEAST = -(1 << 63)
#: The top 12 bits of the first hash, as a signed number.
BUCKETS = 1 << 12


def _splitters(records: DataFrame, n_bytes: int, n_ranges: int, samples: int, seed: int) -> DataFrame:
    """(h, t) of the first record of each range but the first."""
    want = F.lit(float(samples)) * F.col("size") / n_bytes
    sample = records.where(F.rand(seed) < want).select("h", "t", F.greatest(F.col("size").cast("double"), F.lit(n_bytes / samples)).alias("w"))
    order = Window.orderBy("h", "t").rowsBetween(Window.unboundedPreceding, -1)
    placed = sample.select("h", "t", "w", F.coalesce(F.sum("w").over(order), F.lit(0.0)).alias("before"))
    total = Window.partitionBy()
    quantile = F.floor(F.col("before") * n_ranges / F.sum("w").over(total))
    cut = placed.select("h", "t", quantile.alias("q")).groupBy("q").agg(F.min(F.struct("h", "t")).alias("k")).where("q > 0")
    same = Window.partitionBy("h").orderBy("t")
    return cut.select("k.h", "k.t").select("h", F.when(F.row_number().over(same) == 1, LEAST).otherwise(F.col("t")).alias("t"))


def assign(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS,
           ranges_per_shard: int = RANGES_PER_SHARD, samples_per_range: int = SAMPLES_PER_RANGE, seed: int = 7) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row."""
    n_ranges = shards * ranges_per_shard
    rows = docs.select(F.col(f"`{doc_id}`").alias("d"), whole_text(f"`{text}`").alias("x"))
    records = rows.select(
        "d", (F.octet_length("x") + ROW_BYTES).cast("long").alias("size"), F.crc32(F.col("x").cast("binary")).alias("crc"),
        F.xxhash64("x").alias("h"), F.xxhash64("d", F.lit(seed)).alias("t")).checkpoint()
    n_bytes = max(1, records.agg(F.sum("size")).first()[0] or 0)
    cuts = _splitters(records, n_bytes, n_ranges, n_ranges * samples_per_range, seed).checkpoint()

    # Splitters at or before a record = those of lower buckets + those of its own.
    def bucket(h):
        return F.shiftright(h, 64 - 12).cast("int")

    own = cuts.groupBy(bucket(F.col("h")).alias("b")).agg(F.collect_list(F.struct("h", "t")).alias("own"))
    buckets = docs.sparkSession.range(-BUCKETS // 2, BUCKETS // 2, 1, 1).select(F.col("id").cast("int").alias("b")).join(own, "b", "left")
    size = F.coalesce(F.size("own"), F.lit(0))
    below = F.sum(size).over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    buckets = buckets.select("b", F.coalesce(below, F.lit(0)).alias("below"), F.coalesce("own", F.array()).alias("own"))
    inside = F.size(F.filter("own", lambda s: (s["h"] < F.col("h")) | ((s["h"] == F.col("h")) & (s["t"] <= F.col("t")))))
    ranged = records.join(F.broadcast(buckets), bucket(F.col("h")) == F.col("b")).select(
        "d", "size", "crc", "h", "t", (F.col("below") + inside).alias("r"))

    totals = ranged.groupBy("r").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    earlier = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("r", *[F.coalesce(F.sum(c).over(earlier), F.lit(0).cast("long")).alias(f"{c}_before") for c in ("bytes", "n")])
    in_range = Window.partitionBy("r").orderBy("h", "t", "d", "crc", "size")
    numbered = ranged.select(
        "d", "size", "crc", "h", "r", F.row_number().over(in_range).alias("k"),
        F.coalesce(F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")).alias("o"))
    copies = Window.partitionBy("r", "h")
    pieces = numbered.withColumn("piece", F.sum("size").over(copies)).withColumn("o", F.min("o").over(copies))
    # Texts with a splitter among their copies start at the one before them.
    parted = F.broadcast(cuts.where(F.col("t") != LEAST).select("h").distinct())
    groups = ranged.join(parted, "h").groupBy("h").agg(F.sum("size").alias("group"), F.min("r").alias("r"))
    groups = groups.where(F.col("group") * shards <= n_bytes).join(F.broadcast(offsets), "r").select("h", "group", F.col("bytes_before").alias("group_start"))
    start, held = F.coalesce("group_start", F.col("bytes_before") + F.col("o")), F.coalesce("group", "piece")
    middle = (2 * start + held).alias("middle")
    placed = pieces.join(F.broadcast(offsets), "r").join(F.broadcast(groups), "h", "left").select(
        "d", "size", "crc", (F.col("n_before") + F.col("k") - 1).alias("at"), middle).select(
        "d", "size", "crc", "at", F.expr(f"int(middle * {shards} div {2 * n_bytes})").alias("shard")).checkpoint()
    starts = placed.groupBy("shard").agg(F.min("at").alias("start"))
    return placed.join(F.broadcast(starts), "shard").select(
        F.col("d").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("at") - F.col("start")).alias("slot"))
