"""The registered queries of the text operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.session import ensure_checkpoint_dir

from . import (alignment, bpe, chunk_reuse, decontaminate, line_dedup, pii, prefix_trie, quality, sharding, simhash, suffix_dedup, token_count,
               toxicity)
from .text import table, whole_text


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return table(spark, sf_dir, "documents").select(*columns)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    out = toxicity.score(docs, model, keep=["doc_id"]).select("row.doc_id", "score", "segments")
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      F.size("segments").cast("long").alias("n_segments"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "lang", "text")
    features = quality.with_features(docs).drop("text").checkpoint()
    judged = quality.judge(features, quality.fit(features, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", *[F.col("quality")[c].alias(c) for c in
                                     ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")], "kept")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find(_documents(spark, sf_dir, "doc_id", "text"), keep=["doc_id"])
    return out.select("row.doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    out = bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id"])
    return out.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_documents(spark, sf_dir, "doc_id", "text"), keep=["doc_id"])
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign(_documents(spark, sf_dir, "doc_id", "text"), shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    out = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_documents(spark, sf_dir, "doc_id", "text"), shingle_words=3)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    bitmaps = line_dedup.keep_bitmaps(docs, min_docs=10, min_chars=1)
    out = line_dedup.apply_bitmaps(docs, bitmaps, keep=["doc_id"])
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    out = token_count.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
    return out.select("row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > token_count.LIMIT).alias("over_limit"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    out = alignment.align_texts(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
    return out.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return prefix_trie.build(table(spark, sf_dir, "conversations"), base_of=lambda c: c - F.pmod(c, F.lit(5)),
                             head_of=lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(9)), max_head=8)


def op13_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "doc_id", "text")
    out = chunk_reuse.encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
    return out.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_quality_rules, op3_pii, op4_byte_bpe, op5_suffix_dedup, op6_sharding, op7_decontamination, op8_simhash, op9_line_dedup,
    op10_token_count, op11_alignment, op12_prefix_trie, op13_chunk_reuse)}

_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: CRC-32 of a conversation id's decimal digits.
_CRC32 = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')]),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT FOR k IN range(8)]),
                             lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END)))"""

ORACLE = {
    "op12_prefix_trie": f"""
        WITH turns AS (
          SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST,
                                    sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS l
          FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), heads AS (SELECT c, l, {_CRC32} % 9 AS h FROM turns),
        rebuilt AS (
          SELECT o.c, list_concat(coalesce(b.l, [])[1:o.h], o.l[o.h + 1:]) AS s FROM heads o LEFT JOIN turns b ON b.c = o.c - ((o.c % 5) + 5) % 5
        ), paths AS (
          SELECT c, d, md5(s[1:d]::VARCHAR) AS k, md5(s[1:d - 1]::VARCHAR) AS up, strlen(s[d].t) AS bytes, d = len(s) AS at_end
          FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM rebuilt)
        ), nodes AS (
          SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * max(bytes) END AS saved, min(up) AS up,
                 sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (at_end), '')) AS ends_sha256
          FROM paths GROUP BY d, k
        ), kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
        counted AS (SELECT n.*, coalesce(kids.n, 0) AS n_children FROM nodes n LEFT JOIN kids USING (d, k)),
        below AS (
          SELECT p.d, p.k, sum(u.saved)::BIGINT AS saved_tokens, count(*) FILTER (u.n_children = 0) AS n_leaves
          FROM counted u JOIN paths p ON p.c = u.conv_id AND p.d <= u.d GROUP BY ALL
        )
        SELECT n.conv_id, n.d AS depth, CASE WHEN n.d > 0 THEN p.conv_id END AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
        FROM counted n JOIN below USING (d, k) LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = n.up
    """,
    "op9_line_dedup": f"""
        WITH lines AS (
          SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
        ), keyed AS (
          SELECT *, translate(trim(line, {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
        ), common AS (
          SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
        )
        SELECT doc_id, count(*) AS n_lines, count(c.k) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.k IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN common c USING (k) GROUP BY doc_id
    """,
    "op7_decontamination": """
        WITH items AS (
          SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
        ), docs AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
        ), windows AS (
          SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
          FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)
        ), starts AS (
          SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
        ), found AS (SELECT DISTINCT doc_id, s.n, i, item_id FROM starts s JOIN windows USING (n, win)),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
        got AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
                FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN got USING (doc_id)
    """,
}
