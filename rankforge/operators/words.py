"""Word counts per text: a corpus vocabulary with ranks and the sparse
``index:count`` form that lyrics collections are published in."""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge.session import ensure_checkpoint_dir

#: Runs of anything but ASCII that is no letter or digit; A-Z lower-cased.
NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str | Column) -> Column:
    """The words of a text, in order; none of a null or empty one."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    lower = F.translate(t, string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lower, NOT_A_WORD), lambda w: w != "")


#: Every byte that parts words becomes a space, A-Z lower-cased; bytes of characters beyond ASCII stay.
_FOLDED = bytes(c + 32 if chr(c) in string.ascii_uppercase else c if c > 0x7F or chr(c).isalnum() else 0x20 for c in range(256))
#: Distinct words that a task holds before it sends its counts on.
HELD = 1 << 20


def _bytes_of(text: str) -> Column:
    return F.make_valid_utf8(F.coalesce(F.col(text), F.lit(""))).cast("binary")


def _said(text: pa.BinaryScalar) -> list[bytes]:
    """The words of a text (UTF-8), as :func:`words_of`."""
    return text.as_py().translate(_FOLDED).split()


def _task_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word of the task's texts with its count, once as a rule."""
    held: Counter[bytes] = Counter()

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    for b in batches:
        for t in b.column(0):
            held.update(_said(t))
            if len(held) > HELD:
                yield sent()
                held.clear()
    yield sent()


def vocabulary(df: DataFrame, text: str = "text", size: int = 5000) -> DataFrame:
    """(word, word_index, n): the ``size`` most frequent words of all texts,
    index 1 for the most frequent, equal counts in word order. A task sends
    each of its words once; only the ranked head leaves the aggregation."""
    single = df.select(_bytes_of(text)).mapInArrow(_task_counts, "word binary, n long")
    counts = single.groupBy(F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n"))
    head = counts.orderBy(F.desc("n"), "word").limit(size)  # at most ``size`` rows from here on
    return head.select("word", F.row_number().over(Window.orderBy(F.desc("n"), "word")).alias("word_index"), "n")


def _row_counts(df: DataFrame, id_col: str, text: str, index: dict[bytes, list[int]]) -> DataFrame:
    """(id, n_words, n_known, counts) of each row's own text."""
    shared = df.sparkSession.sparkContext.broadcast(index)
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("n_words", T.LongType(), False),
                           T.StructField("n_known", T.LongType(), False), T.StructField("counts", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        for b in batches:
            n_words, n_known, lines = [], [], []
            for t in b.column(1):
                said = _said(t)
                own: Counter[int] = Counter()
                for word, n in Counter(said).items():
                    for i in places.get(word, ()):
                        own[i] += n
                n_words.append(len(said))
                n_known.append(own.total())
                lines.append(",".join([f"{i}:{n}" for i, n in sorted(own.items())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_known, pa.int64()), pa.array(lines, pa.string())],
                                             names=schema.names)

    return df.select(id_col, _bytes_of(text)).mapInArrow(run, schema)


def count_words(df: DataFrame, id_col: str, vocab: DataFrame, text: str = "text") -> DataFrame:
    """Every row's id with ``n_words`` (all its words), ``n_known`` (those in
    the vocabulary) and ``counts``: ``index:count`` pairs, comma-joined, by
    index; empty where no word is known. The vocabulary is bounded by its size
    and is broadcast. A text is counted in the task that reads it. Rows that
    share an id (null too) share the known words of them all."""
    index: dict[bytes, list[int]] = {}
    ensure_checkpoint_dir(df.sparkSession)
    known = vocab.where("word is not null").select(F.col("word").cast("binary").alias("word"), "word_index").toArrow()
    for word, i in zip(known.column("word").to_pylist(), known.column("word_index").to_pylist()):
        index.setdefault(word, []).append(i)
    repeated = df.groupBy(F.col(id_col).alias("_id")).agg(F.count("*").alias("_n")).where("_n > 1").select("_id").checkpoint()
    if repeated.isEmpty():
        return _row_counts(df, id_col, text, index)
    match = F.col(id_col).eqNullSafe(F.col("_id"))
    single = _row_counts(df, id_col, text, index).join(repeated, match, "left_anti")
    rows = _row_counts(df.join(repeated, match, "left_semi"), id_col, text, index)
    known = read_counts(rows.select(F.col(id_col).alias("_id"), "counts"), "_id").groupBy("_id", "word_index").agg(F.sum("n").alias("n"))
    line = F.array_join(F.transform("c", lambda p: F.concat_ws(":", p["word_index"].cast("string"), p["n"].cast("string"))), ",")
    sparse = known.groupBy("_id").agg(F.sum("n").alias("k"), F.sort_array(F.collect_list(F.struct("word_index", "n"))).alias("c"))
    shared = rows.select(id_col, "n_words").join(sparse, match, "left").select(
        id_col, "n_words", F.coalesce("k", F.lit(0)).cast("long").alias("n_known"), F.coalesce(line, F.lit("")).alias("counts"))
    return single.unionByName(shared)


def read_counts(sparse: DataFrame, id_col: str, vocab: DataFrame | None = None, counts: str = "counts") -> DataFrame:
    """The reader of the sparse form: (id, word_index, n), with the word if a
    vocabulary is given. Raises on a pair that is not two whole numbers."""
    pairs = sparse.select(id_col, F.explode(F.filter(F.split(counts, ","), lambda p: p != "")).alias("_p")).withColumn("_p", F.split("_p", ":"))
    out = pairs.select(id_col, F.col("_p")[0].cast("int").alias("word_index"), F.col("_p")[1].cast("long").alias("n"))
    return out if vocab is None else out.join(F.broadcast(vocab.select("word", "word_index")), "word_index").select(id_col, "word", "word_index", "n")
