"""Token counts by a two-tier map-side lookup.

A first pass counts the pre-tokens of all texts, each task keeping at most
``TASK_TOP`` of its own (a lossy count with bounded memory), and the most
frequent ``FREQUENT`` of their sums are encoded once. Their lengths are
broadcast; pre-tokens of over ``LONGEST`` characters stay out, so the table has
at most ``FREQUENT`` * ``LONGEST`` characters. The second pass sums the lengths
of each text's pre-tokens; those that the table does not hold are encoded, a
batch at a time, and kept in the worker's cache. The cache outlives tasks and
is emptied when it holds ``CACHE_BYTES``. Which pre-tokens are frequent changes
the speed alone, never a count. No pre-token is shuffled but the bounded heads
of the first pass.

Every text is split before it is looked up, whatever its script: special
tokens' strings are one token each and part the text, as in the library; the
rest is normalised and split by the tokenizer's own normalizer and pattern. For
printable ASCII, ASCII white space and Latin letters up to U+017E, on which
these are plain (NFC changes nothing), lower case and the pattern in Python do
the same and are faster.

Defined cases: a null or empty text has no bytes and no tokens; repeated rows
are counted each; columns of the input may have any names; a pre-token of any
length is encoded whole, in one task; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import carried, whole_text

TASK_TOP, FREQUENT, LONGEST, LIMIT = 20_000, 65_536, 64, 2048
#: An entry costs about ``ENTRY`` bytes and its characters.
CACHE_BYTES, ENTRY = 64 << 20, 120


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _rules(path: str):
    """(parts a text at special strings, the pattern in Python, the texts it is right
    for, the library's normalizer and its split alone)."""
    import json

    import regex
    from tokenizers import Regex, pre_tokenizers

    with open(path, encoding="utf-8") as f:
        conf = json.load(f)
    pattern = next(p for p in conf["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
    plain = regex.compile(r"[\x09-\x0D\x20-\x7E¡-įı-ňŊ-ž]*+")
    special = "|".join(regex.escape(t["content"]) for t in conf["added_tokens"])
    return (regex.compile(f"({special})").split if special else lambda text: [text], regex.compile(pattern).findall, plain.fullmatch,
            _tokenizer(path).normalizer.normalize_str, pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str)


def pretokens(text: str, path: str) -> list[str]:
    """The pre-tokens of a text; special strings stand as they are."""
    parts, split, plain, normalize, library_split = _rules(path)
    out = []
    for k, part in enumerate(parts(text)):
        if k % 2:
            out.append(part)
        elif plain(part):
            out += split(part.lower())
        else:
            out += [w for w, _ in library_split(normalize(part))]
    return out


@functools.cache
def _worker_cache(path: str) -> tuple[dict[str, int], list[int]]:
    """Lengths that this worker knows, and the bytes they take."""
    return {}, [0]


def lengths(strings: list[str], path: str) -> list[int]:
    return [len(e.ids) for e in _tokenizer(path).encode_batch(strings, add_special_tokens=False)]


def _heads(docs: DataFrame, text: str, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                seen.update(w for w in pretokens(t.as_py().decode("utf-8", "replace"), path) if len(w) <= LONGEST)
                if len(seen) > 10 * TASK_TOP:
                    seen = Counter(dict(seen.most_common(TASK_TOP)))
        top = seen.most_common(TASK_TOP)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["w", "n"])

    return docs.select(whole_text(f"`{text}`").cast("binary")).mapInArrow(run, "w string, n long")


def frequent_lengths(docs: DataFrame, path: str, *, text: str = "text") -> dict[str, int]:
    top = _heads(docs, text, path).groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(FREQUENT).collect()
    words = [r["w"] for r in top]
    return dict(zip(words, lengths(words, path)))


def counter(path: str, frequent: dict[str, int]):
    """texts -> their numbers of tokens, by the frequent lengths and the worker's cache."""
    known, held = _worker_cache(path)
    known.update(frequent)

    def run(texts: list[bytes]) -> list[int]:
        split = [pretokens(t.decode("utf-8", "replace"), path) for t in texts]
        if held[0] > CACHE_BYTES:
            known.clear()
            known.update(frequent)
            held[0] = 0
        missing = list({w for ws in split for w in ws if w not in known})
        known.update(zip(missing, lengths(missing, path)))
        held[0] += sum(map(len, missing)) + ENTRY * len(missing)
        return [sum(map(known.__getitem__, ws)) for ws in split]

    return run


def count_tokens(docs: DataFrame, path: str, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` (of the columns to ``keep``)
    with ``n_bytes`` and ``n_tokens``."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text=text))
    rows = carried(docs, keep, x=whole_text(f"`{text}`").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, frequent.value)
        for b in batches:
            counts, sizes = [], []
            for lo in range(0, len(b), 256):
                texts = b.column("x").slice(lo, 256).to_pylist()
                counts += count(texts)
                sizes += map(len, texts)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                                             names=["row", "n_bytes", "n_tokens"])

    from pyspark.sql import types as T

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]))
