"""Stand-ins: the shared test tables mapped onto the chart domain.

The driver tables are TPC-H-like; each mapping below is written twice --
once with the DataFrame API (used by the queries) and once as a SQL CTE (used
by the DuckDB oracle) -- and both must stay in step.

* chart      = orders: song <- o_custkey, artist <- o_orderpriority,
               date <- o_orderdate, rank <- floor(o_totalprice / 4500) + 1
               (1..112, so ranks past 100 occur), input order <- o_orderkey.
* features   = orders (the feature table of C3/C4); records not in status F
               carry another title (with a comma, or in Cyrillic) that no
               chart song has; year 0 = unknown in January.
* catalogue  = orders (lookup target of C9); entries before 1998 carry another
               title; status F rows have the chart's artist spelling, other
               rows a lower-case spelling only the free-text tier finds.
* audio      = orders (feature records of C11); status P rows carry an id that
               no lookup gives.
* unranked   = customer (title <- c_name, artist <- c_mktsegment).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.sources.csv import read_table

# Fixed values of the stand-in queries.
CHART_BEFORE = "2000-01-01"
CATALOGUE_SINCE = "1998-01-01"


def _d(c):
    return F.col(c).cast("date")


def chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chart_from_orders(read_table(spark, sf_dir, "orders"))


def chart_from_orders(o: DataFrame) -> DataFrame:
    """The chart mapping on any orders frame (batch or streaming)."""
    return o.select(
        F.col("o_custkey").cast("string").alias("song"),
        F.col("o_orderpriority").alias("artist"),
        _d("o_orderdate").alias("date"),
        (F.floor(F.col("o_totalprice") / F.lit(4500.0)) + 1).cast("int").alias("rank"),
        F.col("o_orderkey").alias("ordinal"),
    )


def features_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    p = F.col("o_totalprice")
    title = F.col("o_custkey").cast("string")
    return o.select(
        F.col("o_orderpriority").alias("artist_name"),
        F.when(F.col("o_orderstatus") == "F", title).when(F.col("o_orderstatus") == "O", F.concat(title, F.lit(", live")))
        .otherwise(F.concat(F.lit("Песня "), title)).alias("title"),
        F.when(F.month("o_orderdate") == 1, F.lit(0))
        .otherwise(F.lit(1994) + F.col("o_custkey") % 4).cast("int").alias("year"),
        (p / F.lit(500000.0)).alias("danceability"),
        (p / F.lit(1000.0)).alias("duration"),
        F.lit(0.0).alias("energy"),
        (F.col("o_orderkey") % 12).cast("int").alias("key"),
        (-(p / F.lit(10000.0))).alias("loudness"),
        (p / F.lit(600000.0)).alias("song_hotttnesss"),
        (F.lit(60.0) + p / F.lit(5000.0)).alias("tempo"),
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("time_signature"),
    )


def feature_groups(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three row-aligned groups keyed by (file_id, row_idx); the metadata
    group has other row numbers for status P, the year group before 1996;
    energy is NaN for every 97th row."""
    o = read_table(spark, sf_dir, "orders")
    p = F.col("o_totalprice")
    key = [F.col("o_custkey").cast("string").alias("file_id"), F.col("o_orderkey").alias("row_idx")]
    analysis = o.select(
        *key,
        (p / F.lit(500000.0)).alias("danceability"),
        (p / F.lit(1000.0)).alias("duration"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit(float("nan"))).otherwise(F.lit(0.0)).alias("energy"),
        (F.col("o_orderkey") % 12).cast("int").alias("key"),
        (-(p / F.lit(10000.0))).alias("loudness"),
        (F.lit(60.0) + p / F.lit(5000.0)).alias("tempo"),
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("time_signature"),
    )
    def rekeyed(miss):
        return [key[0], F.when(miss, -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("row_idx")]

    metadata = o.select(
        *rekeyed(F.col("o_orderstatus") == "P"),
        F.col("o_orderpriority").alias("artist_name"),
        F.col("o_custkey").cast("string").alias("title"),
        (p / F.lit(600000.0)).alias("song_hotttnesss"),
    )
    musicbrainz = o.select(
        *rekeyed(_d("o_orderdate") < F.lit("1996-01-01").cast("date")), F.year("o_orderdate").cast("int").alias("year")
    )
    return [analysis, metadata, musicbrainz]


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    title = F.col("o_custkey").cast("string")
    return o.select(
        F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("id"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
        .otherwise(F.lower(F.replace(F.col("o_orderpriority"), F.lit("-"), F.lit(" "))))
        .alias("artist"),
        F.when(_d("o_orderdate") >= F.lit(CATALOGUE_SINCE).cast("date"), title).otherwise(F.concat(title, F.lit(" (старая)"))).alias("title"),
        F.floor(F.col("o_totalprice") / F.lit(5000.0)).cast("int").alias("popularity"),
    )


def audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    p = F.col("o_totalprice")
    return o.select(
        F.concat(F.when(F.col("o_orderstatus") == "P", F.lit("x")).otherwise(F.lit("t")), F.col("o_orderkey").cast("string")).alias("id"),
        (p / F.lit(500000.0)).alias("danceability"),
        (p / F.lit(700000.0)).alias("energy"),
        (F.col("o_orderkey") % 12).cast("int").alias("key"),
        (-(p / F.lit(10000.0))).alias("loudness"),
        (F.col("o_orderkey") % 2).cast("int").alias("mode"),
        (p / F.lit(900000.0)).alias("speechiness"),
        (p / F.lit(1100000.0)).alias("acousticness"),
        (p / F.lit(1300000.0)).alias("instrumentalness"),
        (p / F.lit(1700000.0)).alias("liveness"),
        (p / F.lit(1900000.0)).alias("valence"),
        (F.lit(60.0) + p / F.lit(5000.0)).alias("tempo"),
        F.floor(p).cast("int").alias("duration_ms"),
        (F.col("o_orderkey") % 5 + 1).cast("int").alias("time_signature"),
    )


def unranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_name").alias("title"), F.col("c_mktsegment").alias("artist_name"))


# ------------------------------------------------------------------ SQL side

CHART_SQL = """chart AS (
  SELECT CAST(o_custkey AS VARCHAR) AS song, o_orderpriority AS artist,
         CAST(o_orderdate AS DATE) AS date,
         CAST(floor(o_totalprice / 4500.0) + 1 AS INTEGER) AS rank,
         o_orderkey AS ordinal
  FROM orders)"""

FEATURES_A_SQL = """features_a AS (
  SELECT o_orderpriority AS artist_name,
         CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS VARCHAR) WHEN 'O' THEN o_custkey || ', live' ELSE 'Песня ' || o_custkey END AS title,
         CAST(CASE WHEN month(o_orderdate) = 1 THEN 0 ELSE 1994 + o_custkey % 4 END AS INTEGER) AS year,
         o_totalprice / 500000.0 AS danceability, o_totalprice / 1000.0 AS duration,
         CAST(0.0 AS DOUBLE) AS energy, CAST(o_orderkey % 12 AS INTEGER) AS key,
         -(o_totalprice / 10000.0) AS loudness, o_totalprice / 600000.0 AS song_hotttnesss,
         60.0 + o_totalprice / 5000.0 AS tempo, CAST(o_orderkey % 5 + 1 AS INTEGER) AS time_signature
  FROM orders)"""

BEST_SQL = """best AS (
  SELECT song, artist, min(rank) AS top_rank FROM chart
  WHERE date < DATE '2000-01-01' GROUP BY song, artist)"""

CLASSIFIED_SQL = """classified AS (
  SELECT song, artist, CAST(floor((top_rank - 1) / 10) AS BIGINT) AS class FROM best)"""

CATALOGUE_SQL = """cat AS (
  SELECT 't' || CAST(o_orderkey AS VARCHAR) AS id,
         CASE WHEN o_orderstatus = 'F' THEN o_orderpriority
              ELSE lower(replace(o_orderpriority, '-', ' ')) END AS artist,
         CASE WHEN CAST(o_orderdate AS DATE) >= DATE '1998-01-01' THEN CAST(o_custkey AS VARCHAR) ELSE o_custkey || ' (старая)' END AS title,
         CAST(floor(o_totalprice / 5000.0) AS INTEGER) AS popularity
  FROM orders)"""

def lookup_sql(songs: str = "classified", extra_cols: str = "") -> str:
    """t1/t2 tiers, lookup and identified CTEs over a songs table."""
    return LOOKUP_SQL.replace("FROM classified s", f"FROM {songs} s").replace(
        "SELECT s.song, s.artist, s.class,", f"SELECT {extra_cols}s.song, s.artist, s.class,"
    )


LOOKUP_SQL = r"""t1 AS (
  SELECT title, artist, id, popularity FROM (
    SELECT *, row_number() OVER (PARTITION BY title, artist ORDER BY popularity DESC, id) AS rn
    FROM cat) WHERE rn = 1),
t2 AS (
  SELECT q, id, popularity FROM (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY popularity DESC, id) AS rn
    FROM (SELECT nullif(trim(regexp_replace(lower(title || ' ' || artist), '[^\p{L}\p{N}]+', ' ', 'g')), '') AS q,
                 id, popularity FROM cat)) WHERE rn = 1),
lookup AS (
  SELECT s.song, s.artist, s.class,
         COALESCE(t1.id, t2.id, '') AS track_id,
         CAST(COALESCE(t1.popularity, t2.popularity, 0) AS INTEGER) AS popularity
  FROM classified s
  LEFT JOIN t1 ON s.song = t1.title AND s.artist = t1.artist
  LEFT JOIN t2 ON trim(regexp_replace(lower(s.song || ' ' || s.artist), '[^\p{L}\p{N}]+', ' ', 'g')) = t2.q),
identified AS (
  SELECT * FROM lookup WHERE track_id IS NULL OR track_id <> '')"""

AUDIO_SQL = """audio AS (
  SELECT CASE o_orderstatus WHEN 'P' THEN 'x' ELSE 't' END || CAST(o_orderkey AS VARCHAR) AS id,
         o_totalprice / 500000.0 AS danceability, o_totalprice / 700000.0 AS energy,
         CAST(o_orderkey % 12 AS INTEGER) AS key, -(o_totalprice / 10000.0) AS loudness,
         CAST(o_orderkey % 2 AS INTEGER) AS mode, o_totalprice / 900000.0 AS speechiness,
         o_totalprice / 1100000.0 AS acousticness, o_totalprice / 1300000.0 AS instrumentalness,
         o_totalprice / 1700000.0 AS liveness, o_totalprice / 1900000.0 AS valence,
         60.0 + o_totalprice / 5000.0 AS tempo, CAST(floor(o_totalprice) AS INTEGER) AS duration_ms,
         CAST(o_orderkey % 5 + 1 AS INTEGER) AS time_signature
  FROM orders)"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
