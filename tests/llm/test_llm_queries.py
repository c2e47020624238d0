"""The registered queries: SQL oracles, and the pipeline against its stages."""

import hashlib
import re

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from oracle_compare import compare, duck
from rankforge.llm import decontaminate, simhash
from rankforge.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    got = compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name])
    assert got["cols_match"] and got["hash_match"] and got["rows_spark"] == got["rows_oracle"] > 0


def test_registered_columns(spark):
    """Names, order and types as the queries' contract has them."""
    want = {
        "op1_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
        "op2_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
                             "base_failed boolean, kept boolean",
        "op3_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
        "op4_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        "op5_suffix_dedup": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
        "op6_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
        "op7_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
        "op8_simhash": "doc_id bigint, fingerprint string, component_id bigint",
        "op9_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
        "op10_token_count": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    }
    for name, columns in want.items():
        got = ", ".join(f"{c} {t}" for c, t in QUERIES[name](spark, SF).dtypes)
        assert got.startswith(columns), (name, got)


def test_suffix_dedup_query(spark):
    """Every document of the table against all its 50-byte strings."""
    docs = sorted((r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    first, want = {}, {}
    for d, b in docs:
        for k in range(len(b) - 49):
            first.setdefault(b[k:k + 50], d)
    for d, b in docs:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < d:
                gone[k:k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        want[d] = (len(b), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op5_suffix_dedup"](spark, SF).collect()}
    assert got == want and any(w[1] for w in want.values())


def test_pipeline_keeps_what_each_stage_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, name_of = docs.columns, dict(corpus_pipeline.STAGES)
    at = docs
    for name in ("quality_rules", "line_dedup", "simhash_dedup", "decontamination"):
        out = name_of[name](spark, at, SF).cache()
        assert out.columns == columns
        if name == "line_dedup":
            assert out.count() == at.count() and out.where("n_chars <> length(text)").count() == 0
        if name == "simhash_dedup":
            first = {r.component for r in simhash.near_duplicates(at).collect()}
            assert sorted(r.doc_id for r in out.collect()) == sorted(first)
        if name == "decontamination":
            marked = decontaminate.mark(at, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert out.count() == marked.where("n_hit = 0").count()
        at = out
    end = name_of["byte_bpe"](spark, at, SF)
    assert end.count() == at.count() and end.where("size(token_ids) <> n_tokens").count() == 0
    assert corpus_pipeline.run(spark, SF).count() == end.count()


def test_pipeline_stages_take_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, "s", 0), (1, "", None, "s", 0)], docs.schema)
    for rows in (docs.unionByName(odd), docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SF).count() <= rows.count()


def test_simhash_stage_keeps_one_row_per_group(spark):
    def text(k):
        return " ".join(f"{k}word{i}" for i in range(80))

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    # Three texts without an id (one twice); two texts of one id, each also under others.
    ids = [(None, "a"), (None, "b"), (None, "c"), (None, "c"), (5, "d"), (5, "e"), (2, "e"), (7, "d"), (8, "f"), (None, "f"), (9, "g"), (9, "h")]
    rows = spark.createDataFrame([(i, *[text(k) if f == "text" else None for f in docs.columns[1:]]) for i, k in ids], docs.schema)
    assert docs.columns[0] == "doc_id"
    out = dict(corpus_pipeline.STAGES)["simhash_dedup"](spark, rows.repartition(3), SF).select("doc_id", "text").collect()
    want = [(None, "a"), (None, "b"), (None, "c"), (5, "d"), (2, "e"), (8, "f"), (9, "g"), (9, "h")]
    assert sorted(map(repr, map(tuple, out))) == sorted(repr((i, text(k))) for i, k in want)


def test_quality_rules_take_any_column_names(spark):
    from rankforge.llm import quality

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    names = ("_n", "_t", "_h", "_s", "_w", "_l", "_stratum", "_cuts", "quality", "kept", "row", "s", "q", "of", "cuts", "a.b")
    odd = docs.select("*", *[F.lit("x").alias(n) for n in names])
    got, want = (quality.with_features(d) for d in (odd, docs))
    cuts = quality.fit(want, labels)
    assert got.columns == [*docs.columns, *[n for n in names if n != "quality"], "quality"]
    judged = quality.judge(got, quality.fit(got, labels))
    assert judged.columns == [c for c in got.columns if c != "kept"] + ["kept"]
    one, two = ({tuple(r) for r in d.select("doc_id", "kept", "quality.n_words").collect()} for d in (judged, quality.judge(want, cuts)))
    assert one == two and judged.where("q = 'x' and row = 'x'").count() == docs.count()
