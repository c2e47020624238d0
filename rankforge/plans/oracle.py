"""DuckDB SQL equivalents of the catalogue queries (the correctness oracle).

Written independently of the Spark code: windows (``row_number``) where the
Spark side uses group-by + ``min_by`` or the distributed ordinal.
"""

from __future__ import annotations

from rankforge.plans import analysis, files
from rankforge.plans.standins import (
    AUDIO_SQL,
    BEST_SQL,
    CATALOGUE_SQL,
    CHART_SQL,
    CLASSIFIED_SQL,
    FEATURES_A_SQL,
    LOOKUP_SQL,
    lookup_sql,
    with_sql,
)

_BASE = with_sql(CHART_SQL, BEST_SQL, CLASSIFIED_SQL)
_BASE_F = with_sql(CHART_SQL, BEST_SQL, CLASSIFIED_SQL, FEATURES_A_SQL)
_BASE_L = with_sql(CHART_SQL, BEST_SQL, CLASSIFIED_SQL, CATALOGUE_SQL, LOOKUP_SQL)

_FEATURE_COLS = (
    "f.year, f.danceability, f.duration, f.energy, f.key, f.loudness, "
    "f.song_hotttnesss, f.tempo, f.time_signature"
)

_LEFT_DEFAULT = f"""left_default AS (
  SELECT f.title AS song, f.artist_name AS artist, COALESCE(c.class, CAST(10 AS BIGINT)) AS class,
         {_FEATURE_COLS}
  FROM features_a f LEFT JOIN classified c ON f.title = c.song AND f.artist_name = c.artist)"""

_SAMPLE_ORDER = "md5(concat_ws(':', '0', song, artist)), song, artist"

_CAPPED = f"""capped AS (
  SELECT song, artist, class FROM classified WHERE class NOT IN (0, 10) OR class IS NULL
  UNION ALL
  SELECT song, artist, class FROM (
    SELECT *, row_number() OVER (PARTITION BY class ORDER BY {_SAMPLE_ORDER}) AS rn
    FROM classified WHERE class IN (0, 10)) WHERE rn <= 300)"""

_ARGMAX = """pred AS (
  SELECT vec_id, label AS class,
         CAST((list_position(embedding, list_max(embedding)) - 1) % 10 AS BIGINT) AS prediction
  FROM embeddings)"""

_HASH_SPLIT = (
    "CASE WHEN ('0x' || substr(md5(concat_ws(':', '0', CAST({k} AS VARCHAR))), 1, 8))::BIGINT % 100 < 60 "
    "THEN 'train' WHEN ('0x' || substr(md5(concat_ws(':', '0', CAST({k} AS VARCHAR))), 1, 8))::BIGINT % 100 < 80 "
    "THEN 'val' ELSE 'test' END"
)

_BUILD = with_sql(CHART_SQL, BEST_SQL, CLASSIFIED_SQL, CATALOGUE_SQL, AUDIO_SQL, """lines AS (
  SELECT row_number() OVER (ORDER BY song, artist) AS pos, song, artist, class FROM classified),
sample AS (
  SELECT c_name AS song, c_mktsegment AS artist, CAST(10 AS BIGINT) AS class,
         row_number() OVER (ORDER BY md5(concat_ws(':', '0', c_name, c_mktsegment)), c_name, c_mktsegment) AS pos
  FROM customer),
all_rows AS (
  SELECT 0 AS part, pos, song, artist, class FROM lines
  UNION ALL
  SELECT 1 AS part, pos, song, artist, class FROM sample
  WHERE pos <= (SELECT floor((count(*) + 1) / 10) FROM classified)),
deduped AS (
  SELECT part, pos, song, artist, class FROM (
    SELECT *, row_number() OVER (PARTITION BY song, artist ORDER BY part, pos) AS rn FROM all_rows)
  WHERE rn = 1)""", lookup_sql("deduped", "s.part, s.pos, "), """enriched AS (
  SELECT i.song, i.artist, i.class, i.track_id, i.popularity,
         CAST(floor((i.rn - 1) / 100) AS BIGINT) AS batch_id, a.*
  FROM (SELECT *, row_number() OVER (ORDER BY part, pos) AS rn FROM identified) i
  JOIN audio a ON i.track_id = a.id)""") + f"""
SELECT * FROM enriched WHERE class NOT IN (0, 10) OR class IS NULL
UNION ALL
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY class ORDER BY {_SAMPLE_ORDER}) AS rn
  FROM enriched WHERE class IN (0, 10)) WHERE rn <= 300"""

ORACLE: dict[str, str] = {
    "best_rank": _BASE + "SELECT song, artist, top_rank FROM best",
    "best_rank_stream": _BASE + "SELECT song, artist, top_rank FROM best",
    "classify_rankings": _BASE + "SELECT song, artist, class FROM classified ORDER BY song, artist",
    "class_histogram": _BASE + "SELECT class, count(*) AS n FROM classified GROUP BY class",
    "class_histogram_bins": _BASE + """,
b AS (SELECT CAST(min(class) AS DOUBLE) AS lo, CAST(max(class) AS DOUBLE) AS hi FROM classified),
w AS (SELECT lo, (hi - lo) / 11 AS width FROM b),
h AS (
  SELECT CAST(CASE WHEN w.width = 0 THEN 0 ELSE least(floor((c.class - w.lo) / w.width), 10) END AS INTEGER) AS bin
  FROM classified c, w WHERE c.class IS NOT NULL)
SELECT CAST(r.i AS INTEGER) AS bin, count(h.bin) AS n, w.lo + r.i * w.width AS lower
FROM w, range(11) r(i) LEFT JOIN h ON h.bin = r.i WHERE w.lo IS NOT NULL GROUP BY r.i, w.lo, w.width""",
    "classified_join": _BASE_F + f"""
SELECT c.song, c.artist, c.class, {_FEATURE_COLS}
FROM classified c JOIN features_a f ON c.song = f.title AND c.artist = f.artist_name""",
    "classified_left_default": with_sql(CHART_SQL, BEST_SQL, CLASSIFIED_SQL, FEATURES_A_SQL, _LEFT_DEFAULT)
    + "SELECT * FROM left_default",
    "date_range_filter": with_sql(CHART_SQL, FEATURES_A_SQL) + """
SELECT song, artist, min(rank) AS top_rank FROM chart
WHERE year(date) BETWEEN (SELECT min(year) FROM features_a WHERE year > 0)
                     AND (SELECT max(year) FROM features_a WHERE year > 0)
GROUP BY song, artist""",
    "fallback_lookup": _BASE_L + "SELECT * FROM lookup",
    "json_field": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "drop_unidentified": _BASE_L + "SELECT * FROM identified",
    "batch_enrich": with_sql(CHART_SQL, BEST_SQL, CLASSIFIED_SQL, CATALOGUE_SQL, LOOKUP_SQL, AUDIO_SQL) + """
SELECT i.song, i.artist, i.class, i.track_id, i.popularity,
       CAST(floor((i.rn - 1) / 100) AS BIGINT) AS batch_id, a.*
FROM (SELECT *, row_number() OVER (ORDER BY song, artist) AS rn FROM identified) i
JOIN audio a ON i.track_id = a.id""",
    "row_aligned_concat": """
WITH analysis AS (
  SELECT CAST(o_custkey AS VARCHAR) AS file_id, o_orderkey AS row_idx,
         o_totalprice / 500000.0 AS danceability, o_totalprice / 1000.0 AS duration,
         CASE WHEN o_orderkey % 97 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS energy,
         CAST(o_orderkey % 12 AS INTEGER) AS key, -(o_totalprice / 10000.0) AS loudness,
         60.0 + o_totalprice / 5000.0 AS tempo, CAST(o_orderkey % 5 + 1 AS INTEGER) AS time_signature
  FROM orders),
metadata AS (
  SELECT CAST(o_custkey AS VARCHAR) AS file_id, CASE WHEN o_orderstatus = 'P' THEN -1 - o_orderkey ELSE o_orderkey END AS row_idx,
         o_orderpriority AS artist_name, CAST(o_custkey AS VARCHAR) AS title,
         o_totalprice / 600000.0 AS song_hotttnesss
  FROM orders),
mb AS (
  SELECT CAST(o_custkey AS VARCHAR) AS file_id,
         CASE WHEN CAST(o_orderdate AS DATE) < DATE '1996-01-01' THEN -1 - o_orderkey ELSE o_orderkey END AS row_idx,
         CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders),
j AS (
  SELECT * FROM analysis FULL OUTER JOIN metadata USING (file_id, row_idx)
  FULL OUTER JOIN mb USING (file_id, row_idx))
SELECT artist_name, title, year, danceability, duration, energy, key, loudness,
       song_hotttnesss, tempo, time_signature
FROM j
WHERE artist_name IS NOT NULL AND title IS NOT NULL AND year IS NOT NULL
  AND danceability IS NOT NULL AND NOT isnan(danceability)
  AND duration IS NOT NULL AND NOT isnan(duration)
  AND energy IS NOT NULL AND NOT isnan(energy)
  AND key IS NOT NULL
  AND loudness IS NOT NULL AND NOT isnan(loudness)
  AND song_hotttnesss IS NOT NULL AND NOT isnan(song_hotttnesss)
  AND tempo IS NOT NULL AND NOT isnan(tempo)
  AND time_signature IS NOT NULL""",
    "clean_text": r"""
SELECT doc_id, md5(regexp_replace(text, '[\\"]', '', 'g')) AS text_md5,
       CAST(length(regexp_replace(text, '[\\"]', '', 'g')) AS BIGINT) AS clean_chars
FROM documents""",
    "repair_lines": r"""
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS line_no
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
f AS (SELECT doc_id, line_no, string_split(line, ',') AS p FROM lines)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no,
       CASE WHEN len(p) = 3 THEN regexp_replace(p[1], '[\\"]', '', 'g')
            ELSE '"' || regexp_replace(array_to_string(p[1:len(p) - 2], ','), '[\\"]', '', 'g') || '"'
       END AS song,
       regexp_replace(p[len(p) - 1], '[\\"]', '', 'g') AS artist,
       p[len(p)] AS class
FROM f WHERE len(p) >= 3""",
    "dedupe_first": with_sql(CHART_SQL) + """
SELECT song, artist, ordinal, rank, strftime(date, '%Y-%m-%d') AS date FROM (
  SELECT *, row_number() OVER (PARTITION BY song, artist ORDER BY ordinal) AS rn FROM chart)
WHERE rn = 1""",
    "shard_assign": _BASE + """
SELECT song, artist, class,
       CAST(floor((row_number() OVER (ORDER BY song, artist) - 1) / 1000) AS BIGINT) AS shard_id
FROM classified""",
    "resume_anti_join": _BASE_L + """
SELECT c.song, c.artist, c.class FROM classified c
WHERE NOT EXISTS (SELECT 1 FROM identified i WHERE i.song = c.song AND i.artist = c.artist)""",
    "cap_classes": with_sql(CHART_SQL, BEST_SQL, CLASSIFIED_SQL, _CAPPED) + "SELECT * FROM capped",
    "build_enriched": _BUILD,
    "binary_relabel": with_sql(CHART_SQL, BEST_SQL, CLASSIFIED_SQL, FEATURES_A_SQL, _LEFT_DEFAULT) + """
SELECT song, artist, CAST(CASE WHEN class = 10 THEN 1 ELSE 0 END AS INTEGER) AS class,
       year, danceability, duration, energy, key, loudness, song_hotttnesss, tempo, time_signature
FROM left_default""",
    "equalize_classes": _BASE + f""",
b AS (SELECT song, artist, CAST(CASE WHEN class = 10 THEN 1 ELSE 0 END AS INTEGER) AS class FROM classified),
m AS (SELECT min(n) AS n FROM (SELECT class, count(*) AS n FROM b GROUP BY class))
SELECT song, artist, class FROM (
  SELECT *, row_number() OVER (PARTITION BY class ORDER BY {_SAMPLE_ORDER}) AS rn FROM b)
WHERE rn <= (SELECT n FROM m)""",
    "add_default_class_sample": _BASE + """
SELECT song, artist, class FROM classified
UNION ALL
SELECT c_name AS song, c_mktsegment AS artist, CAST(10 AS BIGINT) AS class FROM (
  SELECT *, row_number() OVER (
    ORDER BY md5(concat_ws(':', '0', c_name, c_mktsegment)), c_name, c_mktsegment) AS rn
  FROM customer)
WHERE rn <= (SELECT floor((count(*) + 1) / 10) FROM classified)""",
    "class_distribution": with_sql(
        CHART_SQL, BEST_SQL, CLASSIFIED_SQL, FEATURES_A_SQL, _LEFT_DEFAULT, _CAPPED
    ) + """
SELECT 'classified' AS dataset, class, count(*) AS n FROM classified GROUP BY class
UNION ALL
SELECT 'with_default' AS dataset, class, count(*) AS n FROM left_default GROUP BY class
UNION ALL
SELECT 'capped' AS dataset, class, count(*) AS n FROM capped GROUP BY class""",
    "hash_split": f"SELECT vec_id, label, {_HASH_SPLIT.format(k='vec_id')} AS split FROM embeddings",
    "exact_split": """
WITH r AS (
  SELECT vec_id, label, row_number() OVER (
    ORDER BY md5(concat_ws(':', '0', CAST(vec_id AS VARCHAR))), vec_id) AS rn
  FROM embeddings),
c AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM embeddings),
s AS (SELECT ceil(CAST(0.2 AS DOUBLE) * n) AS nt,
             ceil(CAST(0.25 AS DOUBLE) * (n - ceil(CAST(0.2 AS DOUBLE) * n))) AS nv FROM c)
SELECT vec_id, label,
       CASE WHEN rn <= nt THEN 'test' WHEN rn <= nt + nv THEN 'val' ELSE 'train' END AS split
FROM r, s""",
    "scale_features": """
WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice, CAST(1.0 AS DOUBLE) AS const FROM part),
s AS (SELECT stddev_samp(size) AS sd1, stddev_samp(p_retailprice) AS sd2, stddev_samp(const) AS sd3 FROM p)
SELECT p_partkey,
       round(CASE WHEN sd1 = 0 THEN 0.0 ELSE size / sd1 END, 6) AS s_size,
       round(CASE WHEN sd2 = 0 THEN 0.0 ELSE p_retailprice / sd2 END, 6) AS s_price,
       round(CASE WHEN sd3 = 0 THEN 0.0 ELSE const / sd3 END, 6) AS s_const
FROM p, s""",
    "confusion_matrix": with_sql(_ARGMAX) + """
SELECT class AS actual, prediction AS predicted, count(*) AS n FROM pred GROUP BY class, prediction""",
    "weighted_f1": with_sql(_ARGMAX) + """,
a AS (SELECT CAST(class AS DOUBLE) AS lbl, count(*) AS w,
             sum(CASE WHEN class = prediction THEN 1 ELSE 0 END) AS tp FROM pred GROUP BY class),
b AS (SELECT CAST(prediction AS DOUBLE) AS lbl, count(*) AS np FROM pred GROUP BY prediction)
SELECT round(sum(w * CASE WHEN tp > 0 THEN 2.0 * tp / (w + COALESCE(np, 0)) ELSE 0.0 END) / sum(w), 6)
       AS weighted_f1
FROM a LEFT JOIN b USING (lbl)""",
    "accuracy_micro_f1": with_sql(_ARGMAX) + """
SELECT round(avg(CASE WHEN class = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pred""",
    "sweep_select": f"""
WITH d AS (
  SELECT l.quality, d.n_chars, {_HASH_SPLIT.format(k='l.doc_id')} AS split
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
t AS (SELECT * FROM (VALUES (0, 250), (1, 500), (2, 1000), (3, 2000), (4, 4000), (5, 8000)) AS v(ordinal, threshold)),
s AS (
  SELECT t.ordinal, t.threshold,
         avg(CASE WHEN d.split = 'train' THEN CASE WHEN CAST(d.n_chars > t.threshold AS INTEGER) = d.quality THEN 1.0 ELSE 0.0 END END) AS train,
         avg(CASE WHEN d.split = 'val' THEN CASE WHEN CAST(d.n_chars > t.threshold AS INTEGER) = d.quality THEN 1.0 ELSE 0.0 END END) AS val,
         avg(CASE WHEN d.split = 'test' THEN CASE WHEN CAST(d.n_chars > t.threshold AS INTEGER) = d.quality THEN 1.0 ELSE 0.0 END END) AS test
  FROM d, t GROUP BY t.ordinal, t.threshold)
SELECT CAST(ordinal AS INTEGER) AS ordinal, CAST(threshold AS INTEGER) AS threshold,
       round(train, 6) AS train, round(val, 6) AS val, round(test, 6) AS test,
       row_number() OVER (ORDER BY val DESC, ordinal ASC) = 1 AS is_best
FROM s""",
}

ORACLE |= analysis.ORACLE | files.ORACLE
ORACLE["feature_group_files"] = ORACLE["row_aligned_concat"]
ORACLE["build_from_files"] = ORACLE["build_enriched"]
