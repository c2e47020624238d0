"""Each text operator against a plain brute-force version on small rows that
hold nulls, empty and long texts, ties, repeated rows and clashing columns."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankforge.llm import bpe, components, decontaminate, line_dedup, pii, quality, sharding, simhash, suffix_dedup, token_count, toxicity

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, x string, d long, t long, kept string"
BLANK = " \t\n\x0b\x0c\r"
LINE = "This line stands in many documents, again and again and again."
PASSAGE = " ".join(f"word{i}" for i in range(60))


def _texts():
    out = [None, "", " ", "\n", "\n\n", "a", "Ünï cödé ✓ 東京", "x" * 70, "one two", "A b\tC\x0bd\x0ce\rf"]
    out += [f"{LINE}\nown {i}\n  {LINE.upper()} \nend {i}" for i in range(12)]
    out += [f"start{i} {PASSAGE} stop{i}" for i in range(4)] + [PASSAGE] * 3
    out += ["!! ".join(["SPAM|| it"] * 40), " ".join(["long"] * 30_000), "é" * 300 + "\n" + "é" * 300]
    out += ["mail a.b@c-d.example.com, call +1 (503) 555-8963 4524132264652876 or 55.194.11.52 / 999.1.1.1 and 4425414259157784"]
    return out


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    rows = [(i, t, "en" if i % 3 else None, "src0", len(t or ""), "r", "x", 1, 2, "k") for i, t in enumerate(texts)]
    return rows + [rows[11], rows[11], (None, LINE, "en", None, None, None, None, None, None, None), (None, None) + (None,) * 8]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _by_row(df, *cols):
    return sorted(tuple(repr(r[c]) for c in cols) for r in df.collect())


# --- quality -----------------------------------------------------------------

def _base(text):
    ws = [w for w in re.split(f"[{BLANK}]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(BLANK)]
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 3)}
    failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def test_quality_base_counts(spark, docs, rows, empty):
    got = quality.with_features(docs).select("doc_id", "quality.*")
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert _by_row(got, "doc_id", *cols) == sorted(tuple(map(repr, (r[0], *_base(r[1])))) for r in rows)
    assert quality.with_features(empty).count() == 0


def test_binomial_bound_is_exact(spark):
    cases = [(0, .01, .05), (10, .01, .05), (200, .02, .01), (5000, .005, .003)]
    df = spark.createDataFrame(cases, "n long, a double, delta double")
    for n, a, delta in cases:
        got = df.where((F.col("n") == n)).select(quality.most_false_rejections(F.col("n"), a, F.col("delta"))).first()[0]
        cdf, best = 0.0, -1
        for k in range(n):
            cdf += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(a) + (n - k) * math.log1p(-a))
            if cdf > delta:
                break
            best = k
        assert got == best


def test_quality_cuts_hold_their_limit(spark):
    clean, junk = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}||" for i in range(60))
    docs = spark.createDataFrame([(i, junk if i % 4 == 0 else clean, "EN") for i in range(8000)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, None if i % 7 == 6 else int(i % 4 != 0)) for i in range(8000)] + [(1, 1), (None, 0)], "doc_id long, quality int")
    features = quality.with_features(docs)
    cuts = quality.fit(features, labels)
    kept = {r[0]: r[1] for r in quality.judge(features, cuts).select("doc_id", "kept").collect()}
    assert all(kept[i] == (i % 4 != 0) for i in range(8000))
    # Too few labels, or none: nothing is certified, all is kept.
    for some in (labels.where("doc_id < 100"), labels.where("false")):
        assert quality.judge(features, quality.fit(features, some)).where("not kept").count() == 0


def test_quality_small_strata_share_a_pool(spark):
    """No language but en certifies a cut alone; the pool of de and fr does,
    with es lent no cut that its own good labels speak against."""
    clean, junk = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}||" for i in range(60))

    def docs_of(langs):
        rows = [(lang, bad, odd) for lang, good, bads, odds in langs for bad, odd in [(0, 0)] * good + [(1, 1)] * bads + [(0, 1)] * odds]
        return spark.createDataFrame([(i, junk if odd else clean, lang, 1 - bad) for i, (lang, bad, odd) in enumerate(rows)],
                                     "doc_id long, text string, lang string, quality int")

    def rejected(langs):
        df = docs_of(langs)
        features = quality.with_features(df.drop("quality"))
        out = quality.judge(features, quality.fit(features, df.select("doc_id", "quality"))).where("not kept").groupBy("lang").count()
        return {r[0]: r[1] for r in out.collect()}

    # de and fr suffice together (n >= 1059 with 3 strata); each alone does not.
    assert rejected([("en", 3000, 100, 0), ("de", 700, 30, 0), ("fr", 600, 20, 0)]) == {"en": 100, "de": 30, "fr": 20}
    # They do not suffice together: en lends its labels.
    assert rejected([("en", 3000, 100, 0), ("de", 300, 30, 0), ("fr", 200, 20, 0)]) == {"en": 100, "de": 30, "fr": 20}
    # es's own good documents look like junk: it is left alone, the others are not.
    assert rejected([("en", 3000, 100, 0), ("de", 1150, 30, 0), ("fr", 1150, 20, 0), ("es", 8, 5, 2)]) == {"en": 100, "de": 30, "fr": 20}
    # All together are too few.
    assert rejected([("en", 300, 100, 0), ("de", 300, 30, 0)]) == {}


# --- line dedup --------------------------------------------------------------

def _key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def _lines_brute(rows, min_docs, min_chars):
    seen = {}
    for d, t in {(r[0], r[1] or "") for r in rows}:
        for k in {_key(x) for x in t.split("\n")}:
            seen[k] = seen.get(k, 0) + 1
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        keep = [x for x in lines if len(_key(x)) < min_chars or seen[_key(x)] < min_docs]
        out.append(tuple(map(repr, (r[0], len(lines), len(lines) - len(keep), "\n".join(keep)))))
    return sorted(out)


@pytest.mark.parametrize("min_docs,min_chars", [(10, 1), (2, 1), (2, 8), (1, 1)])
def test_line_dedup(spark, docs, rows, empty, min_docs, min_chars):
    bitmaps = line_dedup.keep_bitmaps(docs, min_docs=min_docs, min_chars=min_chars)
    got = line_dedup.apply_bitmaps(docs, bitmaps).select("row.doc_id", "n_lines", "n_dropped", "kept_text")
    assert _by_row(got, "doc_id", "n_lines", "n_dropped", "kept_text") == _lines_brute(rows, min_docs, min_chars)
    assert line_dedup.apply_bitmaps(empty, line_dedup.keep_bitmaps(empty)).count() == 0


def test_line_dedup_run_over_many_partitions(spark):
    many = [(i, f"Common\nown {i}\ncommon ", "en") for i in range(400)]
    df = spark.createDataFrame(many, "doc_id long, text string, lang string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df, min_docs=400)).select("row.doc_id", "kept_text").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {tuple(r) for r in out} == {(i, f"own {i}") for i in range(400)}


# --- SimHash -----------------------------------------------------------------

def _fp(text):
    import xxhash

    ws = [w.lower() if w.isascii() else "".join(_key(c) or c for c in w) for w in re.split(f"[{BLANK}]+", text or "") if w]
    grams = [" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    v = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    return v - (1 << 64) if v >> 63 else v


def test_fingerprints_and_components(spark, docs, rows, empty):
    got = {(r[0], r[1]) for r in simhash.near_duplicates(docs).select("doc_id", "fp").collect()}
    assert got == {(r[0], _fp(r[1])) for r in rows}
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("hot", [64, 3, 0])
def test_multi_index_links_against_all_pairs(spark, hot):
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(-(1 << 63), (1 << 63) - 1, 30)]
    fps = set(base)
    for b in base:
        for _ in range(25):
            for bit in rng.integers(0, 64, int(rng.integers(1, 4))):
                b ^= int(np.uint64(1 << int(bit)).astype(np.int64))
            fps.add(b)
    # A hot segment: many with one low or high half.
    fps |= {int(x) >> 32 << 32 | 12345 for x in rng.integers(-(1 << 63), (1 << 63) - 1, 100)}
    fps |= {77 << 32 | int(x) for x in rng.integers(0, 200, 100)}
    nodes = sorted(fps)
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = set()
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                pairs.add((a, b))
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in nodes], "fp long"), hot)
    assert {tuple(r) for r in links.collect()} == pairs
    got = {r.node: r.root for r in components.components(links).collect()}
    assert {x: got.get(x, x) for x in nodes} == {x: find(x) for x in nodes}


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i * 7919 % 1000, (i + 1) * 7919 % 1000) for i in range(600)], "u long, v long")
    assert {r.root for r in components.components(links).collect()} == {0}
    assert components.components(links.where("false")).count() == 0


# --- decontamination -----------------------------------------------------------

def test_decontamination(spark, docs, rows, empty):
    items = [(1, PASSAGE), (2, "word5 word6"), (3, " ".join(f"Word{i}" for i in range(50, 60)) + "!"), (4, None), (5, "..."), (5, "own"), (None, "end")]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def ws(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    want = []
    for r in rows:
        w, hit, found = ws(r[1]), set(), set()
        for i, t in items:
            iw = ws(t)
            for win in [iw[k:k + 10] for k in range(max(1, len(iw) - 9))] if iw else []:
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit |= set(range(p, p + len(win)))
                        found |= {str(i)} if i is not None else set()
        want.append(tuple(map(repr, (r[0], len(w), len(hit), sorted(found)))))
    for block in (200_000, 7):
        got = decontaminate.mark(docs, bench, block_windows=block).select("row.doc_id", "n_words", "n_hit", "items")
        assert _by_row(got, "doc_id", "n_words", "n_hit", "items") == sorted(want)
    assert decontaminate.mark(docs, bench.where("false")).where("n_hit > 0").count() == 0
    assert decontaminate.mark(empty, bench).count() == 0


# --- tokenizers ------------------------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_rows(spark, docs, rows, empty, tik):
    got = bpe.encode_texts(docs, RANKS, public_tokenizers.PATTERN, keep_ids=True).select("row.doc_id", "token_ids", "decoded_sha256")
    want = [(r[0], tik.encode_ordinary(r[1] or ""), hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows]
    assert _by_row(got, "doc_id", "token_ids", "decoded_sha256") == sorted(tuple(map(repr, w)) for w in want)
    assert bpe.encode_texts(empty, RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet="abehinost é東\n '0!"), max_size=6))
def test_merge_replay_equals_the_library(tik, texts):
    encode = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    for t, ids in zip(texts, encode([t.encode() for t in texts])):
        assert ids.tolist() == tik.encode_ordinary(t) and bpe.decode(ids, RANKS) == t.encode()


def test_token_counts(spark, docs, rows, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    extra = spark.createDataFrame([(900, "a <|endoftext|> B<|startoftext|>c"), (901, "ΣΑΣ İstanbul é \x1c  x"), (902, "It's 2024, they'll ''s")], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(extra)
    got = token_count.count_tokens(both, path).select("row.doc_id", "n_bytes", "n_tokens")
    want = [(r[0], len((r[1] or "").encode()), len(tok.encode(r[1] or "", add_special_tokens=False).ids)) for r in both.collect()]
    assert _by_row(got, "doc_id", "n_bytes", "n_tokens") == sorted(tuple(map(repr, w)) for w in want)
    assert token_count.count_tokens(empty, path).count() == 0


_ODD = "aJ\u030c\u0301ẞİΣςÅ\u1100\u1161\u11a8\u0345\u09c7\u09be\u0344Ⓐ東、한'’sт—\u00a0\u200d\u3000\u2028\x1c😀٣² <|endoftext|>"


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet=_ODD, max_size=40), st.lists(st.sampled_from(["<|endoftext|>", "<|EndOfText|>", "<|", *_ODD])).map("".join)))
def test_every_script_is_looked_up_by_pretokens(text):
    """No text goes to the library whole, and the sums are the library's."""
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = token_count.pretokens(text, path)
    assert sum(token_count.lengths(pieces, path)) == token_count.lengths([text], path)[0]
    assert not any(" " in p for p in pieces)


def test_worker_cache_is_bounded(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    known, held = token_count._worker_cache(path)
    known["left over"], held[0] = 1, token_count.CACHE_BYTES + 1
    run = token_count.counter(path, {"the": 1})
    texts = [r.text or "" for r in docs.select("text").collect()]
    assert sorted(run([t.encode() for t in texts])) == sorted(token_count.lengths(texts, path))
    assert "left over" not in known and 0 < held[0] <= token_count.CACHE_BYTES


# --- PII -------------------------------------------------------------------------

EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1.2@-+ 5()9%", max_size=60))
def test_base_spans_follow_the_patterns(text):
    got = pii.base_spans(text)
    assert [s[1:] for s in got if s[0] == "email"] == [m.span() for m in EMAIL.finditer(text)]
    assert [s[1:] for s in got if s[0] == "ip"] == [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]


def test_pii_field_adds_what_the_patterns_lose(spark, docs, empty):
    rng = np.random.default_rng(3)

    def card():
        while True:
            c = "4" + "".join(map(str, rng.integers(0, 10, 15)))
            if pii._luhn(c):
                return c

    texts = []
    for i in range(200):
        kinds = [f"u{i}.x@mail{i % 9}.example.com", card(), f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}",
                 ".".join(map(str, rng.integers(1, 255, 4))), "version 3.", "password=e3b3ed3cc8548923d6"]
        texts.append(f"some words here {kinds[i % 6]} then others " * 2)
    texts.append(f"call +1 (503) 555-8963 {card()} now, not 3. or 2.0 of it")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r[0]: r[1] for r in pii.find(df).select("row.doc_id", "spans").collect()}
    assert out[200] == "card:23:39,phone:5:22"
    assert all(not out[i] for i in range(200) if i % 6 > 3)
    got = pii.find(docs).select("row.doc_id", "base_sha256").collect()
    assert len(got) == docs.count()
    assert pii.find(empty).count() == 0


# --- sharding ----------------------------------------------------------------------

def test_sharding(spark, docs, rows, empty):
    copies = spark.range(3000).selectExpr("id + 1000 AS doc_id", "IF(id % 3 = 0, 'the same text in a third of all rows', repeat(cast(id AS string), 9)) AS text")
    both = docs.select("doc_id", "text").where("length(text) < 1000 OR text IS NULL").unionByName(copies)
    out = sharding.assign(both, shards=6).toPandas()
    assert len(out) == both.count()
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    sizes = out.groupby("shard")["size"].sum()
    assert len(sizes) == 6 and sizes.max() / sizes.mean() < 1.05 and sizes.min() / sizes.mean() > 0.95
    want = sorted((len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in both.collect())
    assert sorted(zip(out["size"], out["text_crc32"])) == want
    assert sharding.assign(empty).count() == 0


def test_copies_share_a_shard(spark):
    """At any size copies stay together unless they exceed a shard."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    long = spark.range(2).selectExpr("100000 + id AS doc_id", "repeat('a long text twice ', 3000) AS text")
    out = sharding.assign(docs.unionByName(long)).toPandas()
    whole = out["size"].sum() / 24
    of_text = out.groupby(["text_crc32", "size"])
    n_shards = of_text["shard"].nunique()
    assert (n_shards[of_text["size"].sum() <= whole] == 1).all() and (of_text["size"].count() > 1).any()
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    largest = of_text["size"].sum().max()
    assert (out.groupby("shard")["size"].sum() - whole).abs().max() <= max(largest, whole / 64)


# --- suffix dedup --------------------------------------------------------------------

@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(s):
    assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 2), st.sampled_from([0, 0, 0, 0, -1, 3])), max_size=40), st.integers(1, 9))
def test_anchors_of_several_documents(found, size):
    found.sort()
    rows = [(h, k, d, 7, 300 + k, k % 27) for k, (h, d, _) in enumerate(found)]
    place = np.array([a << 5 | last | (deal & 4095) << 48 for (*_, a, last), (_, _, deal) in zip(rows, found)], np.int64).byteswap()
    cols = {"h": [r[0] for r in rows], "k": [r[1] for r in rows], "d": [r[2] for r in rows], "o": [r[3] for r in rows], "place": place}
    batch = pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in cols.items()})
    got = [tuple(r.values()) for b in suffix_dedup._only_shared(batch.slice(k, size) for k in range(0, len(found), size)) for r in b.to_pylist()]
    docs = {h: {d for x, d, _ in found if x == h} for h, _, _ in found}
    assert sorted(got) == sorted(r for r in rows if len(docs[r[0]]) > 1 or any(x == r[0] and e for x, _, e in found))


def test_context_hashes():
    rng = random.Random(7)
    texts = [bytes(rng.choices(b"ab ", k=rng.randint(40, 300))) for _ in range(60)] + [b"a" * 200, b"b" + b"a" * 150]
    texts += [b"x" + t for t in texts] + [b"", b"a" * 49, b"b" * 50, b"c" * 40_000]
    n, *cols = suffix_dedup.anchors(texts)
    owner = [k for k, m in enumerate(n) for _ in range(m)]
    contexts, windows = {}, Counter()
    for o, h, k, at, first, last in zip(owner, *(c.tolist() for c in cols)):
        c = (at - first, texts[o][first:last + suffix_dedup.LENGTH])
        assert contexts.setdefault((h, k), c) == c
        assert first <= at and at + suffix_dedup.GRAM <= first + suffix_dedup.LENGTH <= len(texts[o]) and at >= last
        windows.update((o, w) for w in range(first, last + 1))
    assert len(set(contexts.values())) == len(contexts)
    assert windows == Counter((o, w) for o, t in enumerate(texts) for w in range(len(t) - 49))
    alone = [suffix_dedup.anchors([t]) for t in texts]
    assert all((np.concatenate(a) == b).all() for a, b in zip(zip(*alone), [n, *cols]))


@pytest.mark.parametrize("frequent", [10_000, 1])
def test_suffix_dedup(spark, docs, rows, empty, monkeypatch, frequent):
    monkeypatch.setattr(suffix_dedup, "FREQUENT_ROWS", frequent)
    order = sorted({(r[0] if r[0] is not None else 1 << 62, r[1] or "") for r in rows})
    first, want = {}, {}
    for d, t in order:
        b = t.encode()
        for k in range(len(b) - 49):
            first.setdefault(b[k:k + 50], d)
    for d, t in order:
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k:k + 50]] < d:
                gone[k:k + 50] = b"\1" * 50
        want[d, t] = (len(b), sum(gone), sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1])), bytes(c for c, g in zip(b, gone) if not g))
    got = suffix_dedup.remove_repeats(docs).select("row.doc_id", "row.text", "n_bytes", "n_removed", "n_spans", "kept").collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r[2], r[3], r[4], bytes(r[5])) == want[r[0] if r[0] is not None else 1 << 62, r[1] or ""]
    assert suffix_dedup.remove_repeats(empty).count() == 0


# --- toxicity --------------------------------------------------------------------------

@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-3, -2, -1, 0, 1, 2, 4]), max_size=25))
def test_maximal_segments_are_all_found(scores):
    def best(lo, hi):  # the recursive definition
        top = max(((sum(scores[a:b]), a - b, -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0,))
        if top[0] <= 0:
            return []
        # Of equal scores the shortest, then the first.
        a, b = top[3], top[4]
        return [*best(lo, a), (a, b, top[0]), *best(b, hi)]

    items = [(i, float(s)) for i, s in enumerate(scores) if s]
    got = toxicity.maximal_segments([i for i, _ in items], [s for _, s in items], len(scores), 0.0)
    assert sum(s for *_, s in got) == sum(s for *_, s in best(0, len(scores)))
    assert max((s for *_, s in got), default=0) == max((s for *_, s in best(0, len(scores))), default=0)


def test_toxicity_held_out(spark, docs, empty):
    rng = np.random.default_rng(2)
    clean, bad = [f"word{i}" for i in range(300)], [f"vilest{c}" for c in "abcdefghij"]
    rows = []
    for i in range(1200):
        ws = list(rng.choice(clean, 40))
        if i % 4 == 0:
            for p in rng.integers(0, 40, 3):
                ws[p] = rng.choice(bad)
        rows.append((i, " ".join(ws)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(800)] + [(801, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    out = {r[0]: r[1] for r in toxicity.score(df, model).select("row.doc_id", "score").collect()}
    right = sum((out[i] >= 0.5) == (i % 4 == 0) for i in range(800, 1200))
    assert right >= 390 and all(0 <= s <= 1 for s in out.values())
    assert toxicity.score(docs, model).count() == docs.count() and toxicity.score(empty, model).count() == 0
    none = toxicity.fit(df, labels.where("toxic = 0"))
    assert {r[0] for r in toxicity.score(df, none).select("score").collect()} == {0.0}
