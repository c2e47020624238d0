"""Queries that write a table to files in the shared folder and read it back
through each reader and sink, with their DuckDB SQL."""

from __future__ import annotations

import os
import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.functions.scalar import to_csv_line
from rankforge.operators import chart, clean, enrich, shards
from rankforge.operators.ordinal import with_ordinal
from rankforge.plans import build
from rankforge.plans import standins as si
from rankforge.schemas import CHART_RAW, TRACK_FEATURES_B
from rankforge.session import ensure_checkpoint_dir
from rankforge.sources import csv as src
from rankforge.sources import sinks
from rankforge.sources.csv import read_table


def _folder(spark: SparkSession, name: str) -> str:
    return posixpath.join(ensure_checkpoint_dir(spark), f"{name}-{os.urandom(8).hex()}")


def _chart_files(spark: SparkSession, sf: str) -> str:
    """The chart as CSV lines without header; of ten lines one lacks a field,
    one has one too many, one has the rank NA."""
    c, kind = si.chart(spark, sf), F.col("ordinal") % 10
    rank = F.when(kind == 2, F.lit("NA")).otherwise(F.col("rank").cast("string"))
    date = F.date_format("date", "yyyy-MM-dd")
    line = F.when(kind == 0, F.concat_ws(",", date, rank, "song")).when(kind == 1, F.concat_ws(",", date, rank, "song", "artist", F.lit("more"))).otherwise(
        F.concat_ws(",", date, rank, "song", "artist"))
    path = _folder(spark, "chart-lines")
    c.select(line.alias("value")).write.text(path)
    return path


def q_csv_strict_rows(spark, sf):
    """Rows with a wrong number of fields go; NA becomes null."""
    rows = src.read_csv_strict_rows(spark, _chart_files(spark, sf), CHART_RAW, header=False)
    parsed = chart.parse_chart(rows)
    return parsed.select("song", "artist", F.date_format("date", "yyyy-MM-dd").alias("date"), "rank")


def q_csv_skip_long(spark, sf):
    """Over-long lines go, short ones are filled with null."""
    rows = src.read_csv_skip_long(spark, _chart_files(spark, sf), CHART_RAW, header=False)
    return rows.select("date", "rank", "song", "artist")


def q_csv_typed(spark, sf):
    """A typed CSV with quotes and commas, read from a tree of
    folders."""
    c = read_table(spark, sf, "customer").select("c_custkey", F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("c_name"), "c_nationkey", "c_acctbal")
    path = _folder(spark, "customers")
    for part in (0, 1):
        c.where(F.col("c_custkey") % 2 == part).write.option("header", True).option("escape", '"').csv(f"{path}/half{part}")
    return src.read_many(spark, path, pattern="*.csv", recursive=True, schema=c.schema, header=True, quote='"', escape='"', mode="FAILFAST")


def q_feature_group_files(spark, sf):
    """The three feature groups as Parquet files, put together."""
    paths = [f"{_folder(spark, 'group')}" for _ in range(3)]
    for group, path in zip(si.feature_groups(spark, sf), paths):
        sinks.write_parquet(group, path)
    return enrich.row_aligned_concat(src.read_feature_groups(spark, paths))


def q_sharded_stage_files(spark, sf):
    """A stage that breaks off after a part of the shards and is
    taken up again; the combined output."""
    path = _folder(spark, "stage")
    songs = shards.assign_shards(chart.classify(chart.best_rank(si.chart(spark, sf), before=si.CHART_BEFORE)), ["song", "artist"]).checkpoint()

    def stage(df: DataFrame) -> DataFrame:
        return df.withColumn("quoted", to_csv_line("song", "artist", quoted=True))

    shards.run_sharded_stage(songs.where("shard_id % 3 = 0"), stage, path)
    shards.run_sharded_stage(songs, stage, path)
    return shards.combine_shards(spark, path)


def q_build_from_files(spark, sf):
    """From files to files: chart lines as text, read in order, through the
    whole chain (with its shards), to CSV, and read again."""
    lines = _raw_lines(spark, sf)
    path = _folder(spark, "build")
    lines.orderBy("ordinal").select("value").write.text(f"{path}/lines")
    read = with_ordinal(src.read_lines(spark, f"{path}/lines"), ["file", "block", "row_in_task"], name="place")
    out = build.build_enriched(read.select(F.col("place").alias("ordinal"), "value"), si.unranked(spark, sf), si.catalogue(spark, sf),
                               si.audio_features(spark, sf), cap_n=300)
    sinks.write_csv(out, f"{path}/enriched")
    return src.read_csv_typed(spark, f"{path}/enriched", schema=out.schema)


def _raw_lines(spark, sf) -> DataFrame:
    songs = chart.classify(chart.best_rank(si.chart(spark, sf), before=si.CHART_BEFORE))
    lines = with_ordinal(songs.select("song", "artist", to_csv_line("song", "artist", "class").alias("value")), ["song", "artist"])
    head = spark.createDataFrame([(0, "song,artist,class")], "ordinal long, value string")
    return head.unionByName(lines.select(F.col("ordinal").cast("long").alias("ordinal"), "value"))


def _responses(spark, sf) -> DataFrame:
    """The audio features as JSON responses of up to 100 records: every 13th
    id is unknown (a null record), every 17th comes again later in its
    response, with twice the energy."""
    audio = si.audio_features(spark, sf).withColumn("n", F.substring("id", 2, 20).cast("long"))
    record = F.struct(*[F.col(f.name) for f in TRACK_FEATURES_B])
    again = record.withField("energy", F.col("energy") * 2)
    found = F.when(F.col("n") % 13 != 0, record)
    rows = audio.select("n", F.explode(F.when(F.col("n") % 17 == 0, F.array(F.struct(F.lit(0).alias("t"), found.alias("r")), F.struct(F.lit(1).alias("t"), again.alias("r"))))
                                       .otherwise(F.array(F.struct(F.lit(0).alias("t"), found.alias("r"))))).alias("e"))
    batch = F.floor(F.col("n") / 100).alias("batch")
    listed = rows.groupBy(batch).agg(F.sort_array(F.collect_list(F.struct("e.t", "n", "e.r"))).alias("l"))
    return listed.select("batch", F.to_json(F.col("l.r"), {"ignoreNullFields": "false"}).alias("response"))


def q_json_batch_enrich(spark, sf):
    """F9 C11 from JSON: null records left out, the last record of an id."""
    features = enrich.read_feature_responses(_responses(spark, sf), "response", TRACK_FEATURES_B, ["batch"])
    songs = chart.classify(chart.best_rank(si.chart(spark, sf), before=si.CHART_BEFORE))
    identified = clean.drop_unidentified(enrich.fallback_lookup(songs, si.catalogue(spark, sf)))
    return enrich.batch_enrich(identified, features, order_by=["song", "artist"], record_order="record_order")


QUERIES = {
    "csv_strict_rows": q_csv_strict_rows, "csv_skip_long": q_csv_skip_long, "csv_typed": q_csv_typed, "feature_group_files": q_feature_group_files,
    "sharded_stage_files": q_sharded_stage_files, "build_from_files": q_build_from_files, "json_batch_enrich": q_json_batch_enrich,
}

_CHART = si.with_sql(si.CHART_SQL)
_SONGS = si.with_sql(si.CHART_SQL, si.BEST_SQL, si.CLASSIFIED_SQL)

ORACLE = {
    "csv_strict_rows": _CHART + """SELECT song, artist, strftime(date, '%Y-%m-%d') AS date, CASE WHEN ordinal % 10 <> 2 THEN rank END AS rank
FROM chart WHERE ordinal % 10 > 1""",
    "csv_skip_long": _CHART + """SELECT strftime(date, '%Y-%m-%d') AS date, CASE WHEN ordinal % 10 = 2 THEN 'NA' ELSE rank::VARCHAR END AS rank, song,
       CASE WHEN ordinal % 10 <> 0 THEN artist END AS artist FROM chart WHERE ordinal % 10 <> 1""",
    "csv_typed": """SELECT c_custkey, c_name || ', "' || c_mktsegment || '"' AS c_name, c_nationkey, c_acctbal FROM customer""",
    "sharded_stage_files": _SONGS + """SELECT song, artist, class, song || ',' || artist AS quoted,
       CAST(floor((row_number() OVER (ORDER BY song, artist) - 1) / 1000) AS BIGINT) AS shard_id FROM classified""",
    "json_batch_enrich": si.with_sql(si.CHART_SQL, si.BEST_SQL, si.CLASSIFIED_SQL, si.CATALOGUE_SQL, si.LOOKUP_SQL, si.AUDIO_SQL) + """
SELECT i.song, i.artist, i.class, i.track_id, i.popularity, CAST(floor((i.rn - 1) / 100) AS BIGINT) AS batch_id,
       a.* EXCLUDE (n) REPLACE (CASE WHEN n % 17 = 0 THEN 2 * energy ELSE energy END AS energy)
FROM (SELECT *, row_number() OVER (ORDER BY song, artist) AS rn FROM identified) i
JOIN (SELECT *, CAST(substr(id, 2) AS BIGINT) AS n FROM audio) a ON i.track_id = a.id
WHERE n % 13 <> 0 OR n % 17 = 0""",
}
