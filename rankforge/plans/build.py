"""C17: build the enriched, class-balanced dataset end to end, as one lazy
DataFrame chain (optionally with resumable, shard-partitioned checkpoints
after the two expensive stages).

    raw chart lines -> repair (C6) -> + default-class sample (C8)
      -> first row per (song, artist) in input order (C12)
      -> identify in the catalogue (C9) -> drop unidentified (C10)
      -> enrich with feature records in batches (C11) -> cap classes (C14)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.operators import balance, clean, enrich, shards
from rankforge.operators.chart import DEFAULT_CLASS
from rankforge.session import ensure_checkpoint_dir

# The cap applied at the end of the original build.
CAP_LABELS = (0, 10)
CAP_N = 3000
HEADER = ("song", "artist", "class")


def repaired_chart(raw_lines: DataFrame, ordinal: str = "ordinal", header: bool = True) -> DataFrame:
    """C6 on raw lines (``value`` + an input-order column); the header line
    is dropped after repair, classes become bigint (bad values null). Repair
    wraps fields with commas in quotes, which reading the line as CSV takes
    off again."""
    rows = clean.repair_lines(raw_lines, "value", keep=[ordinal])
    if header:
        is_header = (
            (F.col("song") == HEADER[0]) & (F.col("artist") == HEADER[1]) & (F.col("class") == HEADER[2])
        )
        rows = rows.where(~is_header)
    def unquoted(c: str):
        return F.when(F.col(c).rlike('(?s)^".*"$') & (F.length(c) > 1), F.expr(f"substring({c}, 2, length({c}) - 2)")).otherwise(F.col(c)).alias(c)

    return rows.select(
        ordinal, unquoted("song"), unquoted("artist"), F.col("class").try_cast("bigint").alias("class")
    )


def build_enriched(
    raw_lines: DataFrame,
    unranked: DataFrame,
    catalogue: DataFrame,
    audio: DataFrame,
    ordinal: str = "ordinal",
    header: bool = True,
    unranked_cols: Sequence[str] = ("title", "artist_name"),
    cap_labels: Sequence[int] = CAP_LABELS,
    cap_n: int = CAP_N,
    seed: int = 0,
    work_dir: str | None = None,
    dedupe_scope: str = "global",
    shard_rows: int = shards.SHARD_ROWS,
) -> DataFrame:
    """The whole chain. With ``work_dir`` (a shared folder) the identified
    and the enriched rows are written per 1,000-row shard; a rerun skips
    finished shards (S11/S12).

    ``dedupe_scope="global"`` keeps the first row of every (song, artist)
    overall; ``"shard"`` dedupes inside each 1,000-row shard of the input
    order, as the original did, so copies in different shards survive.
    """
    chart_rows = repaired_chart(raw_lines, ordinal, header)
    title, artist = unranked_cols

    # Class-10 sample, placed after every chart row in input order.
    lines = chart_rows.select(
        (F.count(F.lit(1)) + F.lit(1 if header else 0)).alias("n")
    ).scalar()
    picked = balance.seeded_sample_ranked(
        unranked, F.floor(lines / F.lit(10)), [title, artist], seed, name="_rf_s"
    )
    extra = picked.select(
        F.struct(F.lit(1).alias("part"), F.col("_rf_s").cast("long").alias("pos")).alias("_rf_ord"),
        F.col(title).alias("song"), F.col(artist).alias("artist"),
        F.lit(DEFAULT_CLASS).cast("bigint").alias("class"),
    )
    rows = chart_rows.select(
        F.struct(F.lit(0).alias("part"), F.col(ordinal).cast("long").alias("pos")).alias("_rf_ord"),
        "song", "artist", "class",
    ).unionByName(extra)

    # First row per key in input order (pre-aggregated map-side).
    if dedupe_scope == "global":
        deduped = clean.dedupe_first(rows, ["song", "artist"], "_rf_ord")
    elif dedupe_scope == "shard":
        in_shards = shards.assign_shards(rows, ["_rf_ord"], shard_rows).withColumnRenamed(
            "shard_id", "_rf_in_shard"
        )
        deduped = clean.dedupe_first(in_shards, ["_rf_in_shard", "song", "artist"], "_rf_ord").drop(
            "_rf_in_shard"
        )
    else:
        raise ValueError(f"unknown dedupe_scope {dedupe_scope!r}")

    def identify(df: DataFrame) -> DataFrame:
        return clean.drop_unidentified(enrich.fallback_lookup(df, catalogue))

    def enrich_stage(df: DataFrame) -> DataFrame:
        # batches restart in every shard, as when each shard was sent alone
        per = ["shard_id"] if "shard_id" in df.columns else []
        return enrich.batch_enrich(df, audio, order_by=["_rf_ord"], group_by=per)

    if work_dir:
        sharded = shards.assign_shards(deduped, ["_rf_ord"], shard_rows)
        identified = shards.run_sharded_stage(sharded, identify, f"{work_dir}/identified")
        enriched = shards.run_sharded_stage(identified, enrich_stage, f"{work_dir}/enriched").drop("shard_id")
    else:
        # Cut the lineage after the two expensive stages: the counting passes
        # that follow (batch numbering, class sizes, sample ranks) then read
        # files instead of recomputing lookup and enrichment.
        ensure_checkpoint_dir(raw_lines.sparkSession)
        identified = identify(deduped).checkpoint(eager=True)
        enriched = enrich_stage(identified).checkpoint(eager=True)

    capped = balance.cap_classes(enriched, cap_labels, cap_n, keys=["song", "artist"], seed=seed)
    return capped.drop("_rf_ord")
