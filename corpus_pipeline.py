"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, benchmark
decontamination, byte-level BPE encoding and decoding, over ``documents``.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's ``docs``. A stage judges the whole
of what its predecessor kept:

* ``quality_rules`` drops the documents that the rules reject;
* ``line_dedup`` takes the lines found in 10 or more of the documents out of
  every text (``n_chars`` follows the new text);
* ``simhash_dedup`` keeps one row of each near-duplicate group, the one with the
  smallest id (null ids last) and, of this id's texts there, the smallest text
  hash (and of rows that repeat both, one);
* ``decontamination`` drops the documents that hold a benchmark window;
* ``byte_bpe`` returns each document's token ids in place of its text.

Defined cases: a null text is an empty one, which the quality rules reject (they
keep 50 words or more); rows with a null id are judged, deduplicated and encoded
like others; a row that repeats another in every column is one near-duplicate
group with it, and of rows that share id and text but differ elsewhere the least
in the order of the columns stays; columns of ``documents`` may have any names;
an empty table passes every stage as an empty table.
"""

from __future__ import annotations

import os
import posixpath

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import bpe, decontaminate, line_dedup, quality, simhash
from rankforge.llm.text import carried, table, uncarried
from rankforge.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = carried(docs, doc_id=F.col("doc_id"), lang=F.col("lang"), text=F.col("text"))
    labels = table(spark, sf_dir, "labels")
    # Only labelled documents are measured for the fit.
    labelled = rows.select("doc_id", "lang", "text").join(labels.select("doc_id"), "doc_id", "left_semi")
    cuts = quality.fit(quality.with_features(labelled), labels)
    return uncarried(quality.judge(quality.with_features(rows), cuts).where("kept"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bitmaps = line_dedup.keep_bitmaps(docs, min_docs=10, min_chars=1)
    kept = line_dedup.apply_bitmaps(docs, bitmaps)
    n_chars = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return uncarried(kept, text=F.col("kept_text"), n_chars=n_chars)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # One key of id and text for the join and the grouping, so that the texts are shuffled once.
    def key(doc_id: str, of: Column) -> Column:
        return F.concat_ws(":", of, F.col(doc_id).cast("string"))

    first = simhash.first_of_groups(docs, shingle_words=3).select(key("doc_id", F.col("text_hash")).alias("_key"))
    rows = carried(docs, _key=key("doc_id", simhash.text_hash("text")))
    kept = rows.join(first, "_key", "left_semi")
    # A chosen row may be repeated with its id and text; the least one stays.
    one = kept.groupBy("_key").agg(F.min("row").alias("row"))
    return uncarried(one)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(docs, table(spark, sf_dir, "benchmark"))
    return uncarried(marked.where("n_hit = 0"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe.encode_texts(docs, path, public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"], keep_ids=True)
    return out.select("row.*", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256")


def _stage(f):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return f(spark, docs, sf_dir)

    return run


STAGES = [
    ("quality_rules", _stage(quality_rules)),
    ("line_dedup", _stage(dedup_lines)),
    ("simhash_dedup", _stage(simhash_dedup)),
    ("decontamination", _stage(decontamination)),
    ("byte_bpe", _stage(byte_bpe)),
]

#: Fitted thresholds, fingerprints and merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    base = posixpath.join(ensure_checkpoint_dir(spark), f"pipeline-{os.urandom(8).hex()}")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = posixpath.join(base, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
