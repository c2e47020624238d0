"""Joins and enrichment: C3 C4 C9 C11 J1-J7 F7-F9."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.scalar import fielded_query, free_text_query, normalize_text
from rankforge.operators.clean import drop_incomplete
from rankforge.operators.ordinal import with_chunk_id
from rankforge.schemas import AUDIO_FEATURE_COLUMNS, TRACK_FEATURE_COLUMNS


def row_aligned_concat(
    groups: Sequence[DataFrame],
    keys: Sequence[str] = ("file_id", "row_idx"),
    keep: Sequence[str] | None = TRACK_FEATURE_COLUMNS,
    drop_null: bool = True,
) -> DataFrame:
    """Column-wise concat of row-aligned tables (one per feature group)
    as full outer joins on the row key, keys coalesced; then the kept columns
    in order and P8 over them.

    When P8 follows, its null-rejecting filter lets Catalyst turn the outer
    joins into inner joins, so no null-padded rows are shuffled onward.
    """
    keys = list(keys)
    out = groups[0]
    for g in groups[1:]:
        out = out.join(g, keys, "full_outer")  # USING join coalesces the keys
    if keep is not None:
        out = out.select(*keep)
    return drop_incomplete(out, keep) if drop_null else out


def join_features(
    classified: DataFrame,
    features: DataFrame,
    rename: dict | None = None,
    keys: Sequence[str] = ("song", "artist"),
    sort: bool = False,
) -> DataFrame:
    """Classified songs ⋈ feature table on (song, artist); keys once,
    case-sensitive, null keys never match, duplicate feature rows fan out.
    Output: keys, class, the feature table's other columns.

    ``classified`` is unique per key, so output rows <= feature rows. AQE
    picks broadcast vs sort-merge from runtime sizes and splits skewed keys.
    """
    rename = {"title": "song", "artist_name": "artist"} if rename is None else rename
    feats = features.withColumnsRenamed(rename)
    out = classified.join(feats, list(keys), "inner")
    rest = [c for c in feats.columns if c not in keys]
    out = out.select(*keys, "class", *[c for c in rest if c != "class"])
    return out.orderBy(*keys) if sort else out


def top_hit(
    catalogue: DataFrame,
    match_key: Sequence,
    rank_by: Sequence,
    fields: Sequence[str] = ("id", "popularity"),
    key_names: Sequence[str] | None = None,
) -> DataFrame:
    """The first hit per match key: smallest ``rank_by`` tuple.

    A group-by with ``min_by``: map tasks keep one candidate per key, so a
    key with millions of catalogue entries costs one row per task.
    """
    key_cols = [F.col(k) if isinstance(k, str) else k for k in match_key]
    names = list(key_names or [f"_rf_k{i}" for i in range(len(key_cols))])
    keyed = catalogue.select(
        *[c.alias(n) for c, n in zip(key_cols, names)],
        F.struct(*fields).alias("_rf_hit"),
        F.struct(*[F.col(r) if isinstance(r, str) else r for r in rank_by]).alias("_rf_rank"),
    )
    return keyed.groupBy(*names).agg(F.min_by("_rf_hit", "_rf_rank").alias("hit"))


def fallback_lookup(
    songs: DataFrame,
    catalogue: DataFrame,
    song_col: str = "song",
    artist_col: str = "artist",
) -> DataFrame:
    """Identify songs in a catalogue (id, artist, title, popularity).

    Tier 1 -- fielded query: exact artist and title. Tier 2, only when tier 1
    has no hit -- free-text query ``"{title} {artist}"`` matched on its
    normalised text. Only the first hit of a query counts (most popular,
    then smallest id). No hit -> track_id ``''``, popularity 0. All input
    columns are kept and track_id, popularity appended.

    A match key is (tier, text, title): the fielded query text with the title
    it ends in (together they fix both fields), or the normalised free text. One
    pass explodes the catalogue into both keys of each entry and keeps the top
    hit per key (map-side first, so a key with very many entries costs a row a
    task); the songs' distinct pairs meet it on that partitioning, and a song's
    first tier with a hit wins. The songs are read twice, the catalogue once;
    no join fans out. A null field has no key of its tier, nor has a free text
    without letters or digits; such a song matches nothing there.
    """
    def keys(title: str, artist: str) -> Column:
        fielded = F.struct(F.lit(1).alias("tier"), fielded_query(artist, title).alias("text"), F.col(title).alias("title"))
        free = F.struct(F.lit(2).alias("tier"), normalize_text(free_text_query(title, artist)).alias("text"), F.lit("").alias("title"))
        return F.explode(F.filter(F.array(fielded, free), lambda k: k["text"].isNotNull()))

    names = ["tier", "text", "title"]
    rank_by = [(-F.col("popularity")).alias("p"), F.col("id").alias("i")]
    entries = catalogue.select("id", "popularity", keys("title", "artist").alias("k")).select("id", "popularity", "k.*")
    hits = top_hit(entries, names, rank_by, key_names=names)
    asked = songs.select(F.col(song_col).alias("_rf_s"), F.col(artist_col).alias("_rf_a")).distinct()
    asked = asked.select("_rf_s", "_rf_a", keys("_rf_s", "_rf_a").alias("k")).select("_rf_s", "_rf_a", "k.*")
    found = asked.join(hits, names).groupBy("_rf_s", "_rf_a").agg(F.min_by("hit", "tier").alias("_rf_hit"))
    joined = songs.join(found, (songs[song_col] == found["_rf_s"]) & (songs[artist_col] == found["_rf_a"]), "left")
    return joined.select(
        *[songs[c] for c in songs.columns],
        F.coalesce(F.col("_rf_hit")["id"], F.lit("")).alias("track_id"),
        F.coalesce(F.col("_rf_hit")["popularity"], F.lit(0)).cast("int").alias("popularity"),
    )


def latest_per_id(features: DataFrame, id_col: str = "id", order_col: str | None = None) -> DataFrame:
    """Defect 17: a feature table with repeated ids keeps one record per id so
    song rows do not fan out: the last one by ``order_col``, or without one the
    largest record (the same one on every run)."""
    others = [c for c in features.columns if c != id_col]
    record = F.struct(*others)
    last = F.max(record) if order_col is None else F.max_by(record, F.struct(F.col(order_col), record))
    picked = features.groupBy(id_col).agg(last.alias("_rf_last"))
    return picked.select(id_col, *[F.col("_rf_last")[c].alias(c) for c in others])


def batch_enrich(
    identified: DataFrame,
    features: DataFrame,
    order_by: Sequence,
    batch_size: int = 100,
    id_col: str = "track_id",
    feature_cols: Sequence[str] = AUDIO_FEATURE_COLUMNS,
    group_by: Sequence[str] = (),
    record_order: str | None = None,
) -> DataFrame:
    """C11: batches of ``batch_size`` rows in row order (W1), then an inner
    join with the feature records on ``track_id = id`` (J2). Ids without a
    feature record lose their rows; both ``track_id`` and ``id`` stay.

    The reference batches because its service takes 100 ids per call; here
    the batch id is kept as a column (the request unit) and the join does
    the fetch. Of records with one id the last by ``record_order`` stays.
    ``group_by`` restarts the batches per group (e.g. per shard).
    """
    batched = with_chunk_id(identified, order_by, batch_size, name="batch_id", group_by=group_by)
    extra = [record_order] if record_order and record_order not in feature_cols else []
    feats = latest_per_id(features.select("id", *feature_cols, *extra), order_col=record_order)
    out = batched.join(feats, batched[id_col] == feats["id"], "inner")
    return out.select(
        *[batched[c] for c in identified.columns], "batch_id", feats["id"],
        *[feats[c] for c in feature_cols],
    )


def flatten_feature_records(records: DataFrame, col: str = "records") -> DataFrame:
    """array of feature structs (null entries allowed) -> one row per
    non-null record, struct fields as columns."""
    return (
        records.select(F.explode(col).alias("_rf_rec"))
        .where(F.col("_rf_rec").isNotNull())
        .select("_rf_rec.*")
    )


def read_feature_responses(df: DataFrame, col: str, schema, order_by: Sequence[str], name: str = "record_order") -> DataFrame:
    """F9 from JSON: each response is an array of feature records, null for an
    id that the service does not know. One row per record that is none, with
    ``name``: a struct of ``order_by`` and the place in its response, so that
    "the last record of an id" is what a reader of the responses in order
    would keep. A response that is no such array has no records."""
    parsed = df.select(*order_by, F.posexplode(F.from_json(F.col(col), T.ArrayType(schema))).alias("_rf_at", "_rf_rec"))
    kept = parsed.where(F.col("_rf_rec").isNotNull())
    return kept.select(F.struct(*order_by, F.col("_rf_at").alias("place")).alias(name), "_rf_rec.*")


def parse_search_response(df: DataFrame, col: str, schema) -> DataFrame:
    """F8: JSON lookup response -> first item's id and popularity."""
    parsed = F.from_json(F.col(col), schema)
    first = F.try_element_at(parsed["tracks"]["items"], F.lit(1))
    return df.withColumn("hit_id", first["id"]).withColumn("hit_popularity", first["popularity"])


def pending(work: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``work`` whose key has no row in ``done``
    (left anti join): what a resumed run still has to compute."""
    return work.join(done.select(*keys), list(keys), "left_anti")
