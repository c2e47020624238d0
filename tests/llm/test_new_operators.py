"""Cross-tokenizer alignment, the conversation trie and chunk reuse against
plain versions and the public libraries, on rows with nulls, empty and long
texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from oracle_compare import compare, duck
from pyspark.sql import functions as F

from rankforge.llm import alignment, chunk_reuse, prefix_trie
from rankforge.llm.queries import ORACLE, QUERIES
from rankforge.llm.token_count import _tokenizer
from rankforge.session import arrow_batches

SF = "/root/testdata/sf0.001"
BYTES, PIECES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
PASSAGE = " ".join(f"Passage{i}, it's" for i in range(400))
TEXTS = [None, "", " ", "  a  b", "a\n\tb", "<|endoftext|> <s> </s> <unk> <0x41>", "é́ ﬁ Ａ Ⅸ", "東京。は、▁日本 ▁", "x" * 70_000, "\x00\x01", "\x1c\x85 " * 200,
         "İstanbul ΣΑΣ  " * 60, "中。文，" * 900, "a'" * 900, "don't x's ?'s " * 90, "word " * 3000, *[f"start{i} {PASSAGE} stop{i}" for i in range(6)], PASSAGE, PASSAGE,
         f"{PASSAGE}\n{PASSAGE.upper()}<|startoftext|>{PASSAGE}"]


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, row string, x string, k long, pairs string, ids string, n_a string"
    rows = [(i, t, "r", "x", 1, "p", "i", "n") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "r", "x", 1, "p", "i", "n"), (None, PASSAGE, None, None, None, None, None, None)]
    own = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return spark.createDataFrame(rows, schema).unionByName(own, allowMissingColumns=True).repartition(5).cache()


# --- alignment ---------------------------------------------------------------

def _spans(ids, vocab):
    ends = np.cumsum([len(vocab[i]) for i in ids]).tolist()
    return list(zip([0, *ends], ends, ids))


def _aligned(texts):
    """All pairs of tokens of each text, by their byte ranges."""
    (encode_a, vocab_a), (encode_b, vocab_b) = alignment.byte_level(BYTES), alignment.pieces(PIECES)
    out, counts = [], Counter()
    for t in texts:
        want = (" " + (t or "")).encode()
        a, b = (encode_a([" " + t])[0], encode_b([t])[0]) if t else ([], [])
        if b"".join(vocab_a[i] for i in a) != want or b"".join(vocab_b[i] for i in b) != want:
            out.append(None)
            continue
        a, b = _spans(a, vocab_a), _spans(b, vocab_b)
        first, links = 0, []
        for lo, hi, i in a:
            while b[first][1] <= lo:
                first += 1
            k = first
            while k < len(b) and b[k][0] < hi:
                links.append((i, b[k][2]))
                k += 1
        groups, at_a, at_b = [], 0, 0
        for end in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
            to_a, to_b = (next(j for j in range(at, len(s)) if s[j][1] == end) + 1 for s, at in ((a, at_a), (b, at_b)))
            groups.append("|".join(",".join(str(x[2]) for x in s) for s in (a[at_a:to_a], b[at_b:to_b])))
            at_a, at_b = to_a, to_b
        counts.update(links)
        out.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (*d[:3], len(d[3]), sum(counts[x] == top[x[1]] for x in d[3]), sum(counts[x] for x in d[3]), d[4]) for d in out]


@pytest.mark.parametrize("head", [alignment.HEAD, 40, 0])
def test_alignment(docs, head):
    rows = docs.collect()
    want = sorted(repr((r.doc_id, r.text, *w)) for r, w in zip(rows, _aligned([r.text for r in rows])))
    out = alignment.align_texts(docs, BYTES, PIECES, head=head)
    got = out.select("row.doc_id", "row.text", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert sorted(repr(tuple(r)) for r in got) == want
    assert out.schema["row"].dataType.names == docs.columns


def test_pretokens_are_encoded_as_by_the_library(spark, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    texts = [f" {t or ''}" for t in TEXTS] + [chr(c) * 2 + f" a{chr(c)}1 {chr(c)}'s\n \t{chr(c)}" for c in (*range(0x250), 0x2028, 0x3000, 0x10FFFF)]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").collect()]
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    encode, _ = alignment.byte_level.__wrapped__(BYTES)
    assert encode.__qualname__.startswith("_by_pretokens") and encode(texts) == want
    monkeypatch.setattr(alignment, "CACHE_BYTES", 0)  # emptied before each call
    assert encode(texts) == want and encode(texts[::-1]) == want[::-1]


def test_alignment_takes_rows_in_bounded_batches(spark, monkeypatch):
    """Both passes get batches of bounded bytes, not 10,000 rows of any length."""
    key, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before = spark.conf.get(key)
    for name in ("_aligned", "_looked_up"):
        monkeypatch.setattr(alignment, name, lambda *args, own=getattr(alignment, name): seen.append(spark.conf.get(key)) or own(*args))
    texts = spark.createDataFrame([(i, PASSAGE) for i in range(3)], "doc_id long, text string")
    assert alignment.align_texts(texts, BYTES, PIECES).count() == 3
    assert seen == [str(alignment.BATCH_BYTES)] * 2 and spark.conf.get(key) == before
    with arrow_batches(spark, 1 << 16):
        sizes = texts.select(F.explode(F.sequence(F.lit(1), F.lit(100))), "text").mapInArrow(
            lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches), "n long").collect()
    assert sum(r.n for r in sizes) == 300 and max(r.n for r in sizes) <= 20


def test_alignment_of_nothing(docs):
    assert alignment.align_texts(docs.limit(0), BYTES, PIECES).count() == 0
    assert [r.n_a for r in alignment.align_texts(docs.where("text is null"), BYTES, PIECES).collect()] == [0]


# --- chunk reuse -------------------------------------------------------------

def _library(text):
    ids = _tokenizer(WORDS).encode(text or "", add_special_tokens=False).ids
    decoded = _tokenizer(WORDS).decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids


def test_chunk_reuse(docs):
    want = sorted(repr((r.doc_id, r.text, *_library(r.text))) for r in docs.collect())
    out = chunk_reuse.encode_texts(docs, WORDS, keep_ids=True).select("row.doc_id", "row.text", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids")
    assert sorted(repr(tuple(r)) for r in out.collect()) == want
    assert chunk_reuse.encode_texts(docs.limit(0), WORDS).count() == 0


def test_a_full_filter_changes_nothing(docs, monkeypatch):
    monkeypatch.setattr(chunk_reuse, "FILTER_BITS", 6)
    want = sorted(repr((r.doc_id, *_library(r.text)[:3])) for r in docs.collect())
    out = chunk_reuse.encode_texts(docs, WORDS, keep=["doc_id"]).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(repr(tuple(r)) for r in out.collect()) == want


def test_shared_passages_give_equal_chunks():
    one, two = chunk_reuse.cut([f"first {PASSAGE} end".encode(), f"another beginning, {PASSAGE}".encode()])
    assert len(set(one) & set(two)) >= len(one) - 3 and b"".join(one).endswith(b" end")
    assert max(map(len, chunk_reuse.cut([b"x" * 1_000_000, "é".encode() * 500_000])[1])) <= chunk_reuse.MAX_CHUNK


@pytest.mark.parametrize("size", [1, 2, 3, 7, 20, 31, 64])
def test_any_cuts_are_repaired(size):
    dice = random.Random(size)
    alphabet = "ab 'sS.,<|>endoftext。，中々́é \n\tΣ９٣"
    texts = ["".join(dice.choice(alphabet) for _ in range(dice.randint(1, 900))) for _ in range(40)] + [t[:900] for t in TEXTS if t]
    for t in texts:
        parts = [chunk_reuse.record(t[i:i + size].encode(), WORDS) for i in range(0, len(t), size)]
        assert np.frombuffer(chunk_reuse.assemble(parts, WORDS), chunk_reuse.width(WORDS)).tolist() == _library(t)[3]


def test_a_tokenizer_that_keeps_blanks_is_refused():
    with pytest.raises(ValueError):
        chunk_reuse.encoder(BYTES)


# --- trie --------------------------------------------------------------------

def _trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), digest, role, text))
    own = {c: [(r, x) for _, _, r, x in sorted(v, key=lambda z: z[:2])] for c, v in own.items()}
    nodes, whole, children, below, out = {}, {}, {}, {}, []
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = s = (*own.get(c - c % 5, [])[:h], *own[c][h:])
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    for s in nodes:
        if s:
            children.setdefault(s[:-1], []).append(s)
    for s in sorted(nodes, key=len, reverse=True):
        mine = children.get(s, [])
        saved = (len(nodes[s]) - 1) * len(s[-1][1].encode()) if s else 0
        below[s] = (saved + sum(below[k][0] for k in mine), sum(below[k][1] for k in mine) or 1)
        ends = ",".join(str(c) for c in sorted(nodes[s]) if len(whole[c]) == len(s))
        out.append((min(nodes[s]), len(s), min(nodes[s[:-1]]) if s else None, len(nodes[s]), len(mine), below[s][1], below[s][0],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, out))


def _built(conversations, **more):
    return prefix_trie.build(conversations, base_of=lambda c: c - F.pmod(c, F.lit(5)),
                             head_of=lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(9)), max_head=8, **more)


def _conversations(spark):
    dice = random.Random(5)
    rows = [(c, t, dice.choice(["user", "assistant", None, ""]), dice.choice(["hi", "ho", "", None, "é" * 40])) for c in range(-3, 90) for t in range(dice.randint(1, 9))]
    rows += [(c, t, "user", f"same {t}") for c in range(100, 180) for t in range(12)]  # many equal ones
    rows += [(200, t, "user", f"turn {t % 7}") for t in range(3000)] + [(201, t, "user", f"turn {t % 7}") for t in range(2500)]  # long ones
    rows += [(300, None, "a", "x"), (300, None, "b", "y"), (300, None, "b", "y"), (300, 0, "u", "z"), (None, 1, "a", "x"), (307, 0, None, None)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"c": F.lit("c"), "i": F.lit(1), "digest": F.lit("d")})


def test_trie(spark, monkeypatch):
    conversations = _conversations(spark).repartition(7)
    want = _trie([tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()])
    assert sorted(repr(tuple(r)) for r in _built(conversations).collect()) == want
    monkeypatch.setattr(prefix_trie, "BLOCK", 2)
    monkeypatch.setattr(prefix_trie, "ENDS_PART", 3)
    assert sorted(repr(tuple(r)) for r in _built(conversations).collect()) == want
    assert _built(conversations.limit(0)).count() == 0


def test_trie_builds_again_after_a_collision(spark, monkeypatch):
    conversations = _conversations(spark)
    want = _trie([tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()])
    power = prefix_trie._base
    monkeypatch.setattr(prefix_trie, "_base", lambda seed, j: 1 if seed == 1 else power(seed, j))  # sums that forget the order
    assert sorted(repr(tuple(r)) for r in _built(conversations).collect()) == want
    with pytest.raises(RuntimeError):
        _built(conversations, seeds=(1,))


# --- as registered -----------------------------------------------------------

def test_trie_against_sql(spark):
    got = compare(QUERIES["op12_prefix_trie"](spark, SF), duck(SF), ORACLE["op12_prefix_trie"])
    assert got["cols_match"] and got["hash_match"] and got["rows_spark"] > 0


def test_registered_columns(spark):
    want = {
        "op11_alignment": [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups_sha256", "string")],
        "op12_prefix_trie": [*[(c, "bigint") for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
                             ("ends_sha256", "string")],
        "op13_chunk_reuse": [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")],
    }
    for name, columns in want.items():
        assert QUERIES[name](spark, SF).dtypes == columns
