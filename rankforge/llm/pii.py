"""Personal data: patterns, and a linear-chain conditional random field.

The base spans come from four patterns (leftmost, non-overlapping per kind,
checked, no retries). They also make the small labelled table: the windows
around base spans, and around other words with a digit or an at sign, of at
most ``FIT_WINDOWS`` windows (those with the smallest hash), each word labelled
with the kind of the span that it lies in. The field is trained on that table
by gradient ascent on the exact log-likelihood (forward-backward in numpy
batches); training sequences are also made of two windows put side by side, as
personal data often stand next to each other. Windows of more than 64 words are
left out of the fit, and such pairs are cut to 64. Features are word shapes, of
the word and its neighbours, of the first 40 characters of a shape.

Decoding: a word that can be personal data holds a digit or an at sign. Every
such word outside the base spans, with ``CONTEXT`` words around it, is decoded
by Viterbi, in batches padded to powers of two. A run of one label is a new
span, with punctuation trimmed, if it meets no base span of any kind and its
content is checked: a card by length and Luhn, a phone by its digits, an
address by its parts, an email by its at sign. This finds what the patterns
lose where two kinds touch, such as a card number after a phone number.

Spans are (kind, start, end) in code points, end exclusive.

Defined cases: a null text is empty; no base span anywhere gives no model and
no added spans; bytes that are not valid UTF-8 are read as U+FFFD.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import carried, whole_text

KINDS = ("email", "ip", "card", "phone")
FIT_WINDOWS, CONTEXT, EPOCHS, RATE, L2, SEED = 2_000, 2, 80, 0.2, 1e-4, 5

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SEED_WORD = re.compile(r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for m in _DOMAIN.finditer(text):
        # The local part: all that may stand in it, back to the last match or at sign.
        low = max(end, text.rfind("@", end, m.start()) + 1)
        before = text[low:m.start()]
        n = len(before) - len(before.rstrip(_LOCAL))
        if n:
            end = m.end()
            yield m.start() - n, end


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """By kind as listed, then start."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


# --- windows ---------------------------------------------------------------

def _neighbours(text: str, start: int, end: int) -> tuple[int, int]:
    """The stretch with CONTEXT words on each side."""
    a, b = start, end
    for _ in range(CONTEXT):
        while a > 0 and text[a - 1] in " \t\n\x0b\x0c\r":
            a -= 1
        while a > 0 and text[a - 1] not in " \t\n\x0b\x0c\r":
            a -= 1
        while b < len(text) and text[b] in " \t\n\x0b\x0c\r":
            b += 1
        while b < len(text) and text[b] not in " \t\n\x0b\x0c\r":
            b += 1
    return a, b


def _windows(text: str, wanted: list[tuple[int, int]]) -> list[list[tuple[str, int, int]]]:
    """Words (word, start, end) of the merged stretches around ``wanted``."""
    merged: list[list[int]] = []
    for s, e in wanted:
        a, b = _neighbours(text, s, e)
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    return [[(m.group(), m.start(), m.end()) for m in _WORD.finditer(text, a, b)] for a, b in merged]


def _overlaps(starts: list[int], ends: list[int], a: int, b: int) -> int:
    """Index of a span (sorted, disjoint) that meets [a, b), or -1."""
    i = bisect.bisect_left(ends, a + 1)
    return i if i < len(starts) and starts[i] < b else -1


def _cover(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int], list[str]]:
    """Sorted disjoint cover; where kinds overlap the first listed stays."""
    starts: list[int] = []
    ends: list[int] = []
    kinds: list[str] = []
    for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if not ends or a >= ends[-1]:
            starts.append(a)
            ends.append(b)
            kinds.append(k)
        else:
            ends[-1] = max(ends[-1], b)
    return starts, ends, kinds


def labelled_windows(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[list[str], list[int]]]:
    """Rows of the labelled table: words and labels (0 = none, else kind + 1)."""
    starts, ends, kinds = _cover(spans)
    out = []
    for ws in _windows(text, [m.span() for m in _SEED_WORD.finditer(text)]):
        labels = []
        for _, a, b in ws:
            i = _overlaps(starts, ends, a, b)
            labels.append(1 + KINDS.index(kinds[i]) if i >= 0 else 0)
        # A word of digits or an address that failed its check teaches nothing.
        if any(y == 0 and (sum(map(str.isdigit, w)) >= 9 and not any(c.isalpha() for c in w) or "@" in w) for (w, _, _), y in zip(ws, labels)):
            continue
        if len(ws) <= 64:
            out.append(([w for w, _, _ in ws], labels))
    return out


# --- the field -------------------------------------------------------------

def shape(word: str) -> str:
    """Runs of capitals, small letters and digits; runs of digits with their length."""
    out, i = [], 0
    word = word.strip(".,;:!?\"'")
    while i < len(word):
        c = word[i]
        kind = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        j = i
        while j < len(word) and (kind == "9" and word[j].isdigit() or kind == "A" and word[j].isupper()
                                 or kind == "a" and word[j].isalpha() and not word[j].isupper()):
            j += 1
        out.append(f"9{{{j - i}}}" if kind == "9" else kind)
        i = max(j, i + 1)
    return "".join(out)[:40]


def features(words: list[str]) -> list[list[str]]:
    shapes = [shape(w) for w in words]
    brief = [re.sub(r"9\{\d+\}", "9", s) for s in shapes]
    out = []
    for i, w in enumerate(words):
        digits = sum(map(str.isdigit, w))
        out.append([
            "s=" + shapes[i], "b=" + brief[i], f"d={min(digits, 20)}", f"at={'@' in w}", f"plus={w[:1] == '+'}",
            "alpha" if digits == 0 and "@" not in w else f"letters={any(c.isalpha() for c in w)}",
            "p=" + (shapes[i - 1] if i else "^") + "|" + brief[i], "n=" + (shapes[i + 1] if i + 1 < len(words) else "$") + "|" + brief[i],
        ])
    return out


class Field:
    """Emission weights (feature, label) and transitions (label, label)."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.names, self.emit, self.move = names, emit, move

    def encode(self, sequences: list[list[str]], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Feature ids (sequence, place, feature; the last id weighs nothing), lengths."""
        none = len(self.names)
        ids = np.full((len(sequences), width, 8), none, np.int32)
        for k, words in enumerate(sequences):
            for i, fs in enumerate(features(words)):
                ids[k, i] = [self.names.get(f, none) for f in fs]
        return ids, np.array([len(s) for s in sequences])

    def viterbi(self, sequences: list[list[str]], width: int) -> list[list[int]]:
        """Best labels of sequences of at most ``width`` words."""
        ids, n = self.encode(sequences, width)
        scores = self.emit[ids].sum(axis=2)
        best, back = scores[:, 0], np.zeros((len(sequences), width, self.move.shape[0]), np.int8)
        for t in range(1, width):
            paths = best[:, :, None] + self.move
            back[:, t] = paths.argmax(axis=1)
            step = paths.max(axis=1) + scores[:, t]
            best = np.where((t < n)[:, None], step, best)
        out = []
        for k in range(len(sequences)):
            y = [int(best[k].argmax())]
            for t in range(n[k] - 1, 0, -1):
                y.append(int(back[k, t, y[-1]]))
            out.append(y[::-1])
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(table: list[tuple[list[str], list[int]]]) -> Field | None:
    """Maximum likelihood with an L2 penalty (Adam, full batches)."""
    if not any(any(y) for _, y in table):
        return None
    rng = np.random.default_rng(SEED)
    pairs = []
    for _ in range(len(table)):
        (w1, y1), (w2, y2) = (table[k] for k in rng.integers(0, len(table), 2))
        last = max((i for i, y in enumerate(y1) if y), default=len(y1) - 1) + 1
        first = min((i for i, y in enumerate(y2) if y), default=0)
        pairs.append((w1[:last] + w2[first:], y1[:last] + y2[first:]))
    table = [(w[:64], y[:64]) for w, y in [*table, *pairs]]
    names: dict[str, int] = {}
    for w, _ in table:
        for fs in features(w):
            for f in fs:
                names.setdefault(f, len(names))
    n_labels, width = 1 + len(KINDS), max(len(w) for w, _ in table)
    field = Field(names, np.zeros((len(names) + 1, n_labels)), np.zeros((n_labels, n_labels)))
    ids, n = field.encode([w for w, _ in table], width)
    gold = np.zeros((len(table), width), int)
    for k, (_, y) in enumerate(table):
        gold[k, :len(y)] = y
    live = np.arange(width) < n[:, None]
    # Observed counts.
    seen_emit, seen_move = np.zeros_like(field.emit), np.zeros_like(field.move)
    k, t = np.nonzero(live)
    np.add.at(seen_emit, (ids[k, t].ravel(), np.repeat(gold[k, t], ids.shape[2])), 1)
    k, t = np.nonzero(live[:, 1:])
    np.add.at(seen_move, (gold[k, t], gold[k, t + 1]), 1)
    moments = [np.zeros_like(x) for x in (field.emit, field.emit, field.move, field.move)]
    for epoch in range(1, EPOCHS + 1):
        scores = field.emit[ids].sum(axis=2)
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0]
        for t in range(1, width):
            step = _log_sum(forward[:, t - 1, :, None] + field.move, 1) + scores[:, t]
            forward[:, t] = np.where(live[:, t, None], step, forward[:, t - 1])
        for t in range(width - 2, -1, -1):
            step = _log_sum(field.move + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(live[:, t + 1, None], step, 0)
        whole = _log_sum(forward[:, -1], 1)
        marginal = np.exp(forward + backward - whole[:, None, None]) * live[:, :, None]
        want_emit, want_move = np.zeros_like(field.emit), np.zeros_like(field.move)
        for y in range(n_labels):
            want_emit[:, y] = np.bincount(ids.ravel(), np.repeat(marginal[:, :, y].ravel(), ids.shape[2]), len(field.emit))
        for t in range(1, width):
            pair = forward[:, t - 1, :, None] + field.move + (scores[:, t] + backward[:, t])[:, None, :] - whole[:, None, None]
            want_move += (np.exp(pair) * live[:, t, None, None]).sum(axis=0)
        for x, seen, want, m, v in ((field.emit, seen_emit, want_emit, *moments[:2]), (field.move, seen_move, want_move, *moments[2:])):
            g = (seen - want) / len(table) - L2 * x
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x += RATE * (m / (1 - 0.9 ** epoch)) / (np.sqrt(v / (1 - 0.999 ** epoch)) + 1e-8)
        field.emit[-1] = 0
    return field


_STRIP = " \t\n\x0b\x0c\r.,;:!?\"'<>[]{}"


def _checked(kind: str, text: str, a: int, b: int) -> tuple[str, int, int] | None:
    """The span without outer punctuation, if its content fits its kind."""
    strip = _STRIP + ("()" if kind != "phone" else "")
    piece = text[a:b]
    a, piece = a + len(piece) - len(piece.lstrip(strip)), piece.strip(strip)
    digits = "".join(c for c in piece if c in "0123456789")
    plain = len(digits) + sum(c in " -().+" for c in piece) == len(piece)
    fits = {
        "email": bool(re.fullmatch(r"[^@\s]+@[^@\s]+\.[^@\s]+", piece)),
        "ip": bool(re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", piece)) and all(int(p) <= 255 for p in piece.split(".")),
        "card": plain and "+" not in piece and 13 <= len(digits) <= 19 and _luhn(digits),
        "phone": plain and 8 <= len(digits) <= 15 and piece[:1] in "+(0123456789",
    }[kind]
    return (kind, a, a + len(piece)) if fits and piece else None


def added_spans(texts: list[str], bases: list[list[tuple[str, int, int]]], field: Field | None) -> list[list[tuple[str, int, int]]]:
    """The field's spans of each text."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    if field is None:
        return out
    covers, groups = {}, {}
    for k, (text, base) in enumerate(zip(texts, bases)):
        seeds = [m.span() for m in _SEED_WORD.finditer(text)]
        if not seeds:
            continue
        starts, ends, _ = covers[k] = _cover(base)
        open_ = [s for s in seeds if _overlaps(starts, ends, *s) < 0]
        for ws in _windows(text, open_) if open_ else []:
            groups.setdefault(1 << max(2, (len(ws) - 1).bit_length()), []).append((k, ws))
    for width, found in groups.items():
        step = max(1, (1 << 15) // width)
        for lo in range(0, len(found), step):
            part = found[lo:lo + step]
            for (k, ws), labels in zip(part, field.viterbi([[w for w, _, _ in ws] for _, ws in part], width)):
                starts, ends, _ = covers[k]
                i = 0
                while i < len(ws):
                    j = i
                    while j < len(ws) and labels[j] == labels[i]:
                        j += 1
                    # One word is a whole card, address or email; phones have several.
                    pieces = [(i, j)] if KINDS[labels[i] - 1] == "phone" else [(x, x + 1) for x in range(i, j)]
                    if labels[i] and KINDS[labels[i] - 1] == "card" and j - i > 1 and _checked("card", texts[k], ws[i][1], ws[j - 1][2]):
                        pieces = [(i, j)]
                    for a, b in pieces if labels[i] else []:
                        span = _checked(KINDS[labels[i] - 1], texts[k], ws[a][1], ws[b - 1][2])
                        if span and _overlaps(starts, ends, span[1], span[2]) < 0:
                            out[k].append(span)
                    i = j
    return out


def label_table(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", limit: int = FIT_WINDOWS) -> list[tuple[list[str], list[int]]]:
    """The labelled table: at most ``limit`` windows, half of them with spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for h, t in zip(b.column(0).to_pylist(), b.column(1)):
                s = t.as_py().decode("utf-8", "replace")
                rows += [(h, w, y, any(y)) for w, y in labelled_windows(s, base_spans(s))]
            h, w, y, p = zip(*rows) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h, pa.int64()), pa.array(w, pa.list_(pa.string())), pa.array(y, pa.list_(pa.int32())), pa.array(p, pa.bool_())],
                names=["h", "w", "y", "p"])

    rows = docs.where(F.col(f"`{text}`").rlike("[0-9@]")).select(
        F.xxhash64(F.col(f"`{doc_id}`"), F.lit(17)), whole_text(f"`{text}`").cast("binary")).mapInArrow(
        run, "h long, w array<string>, y array<int>, p boolean")
    ranked = rows.groupBy("w", "y", "p").agg(F.min("h").alias("h"))  # windows that repeat count once
    both = [ranked.where("p" if p else "not p").orderBy("h", "w").limit(limit // 2) for p in (True, False)]
    return [(r["w"], r["y"]) for r in both[0].unionByName(both[1]).collect()]


def find(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as a struct ``row`` with the counts of the base
    spans, ``base_sha256`` and ``spans``, all spans as kind:start:end."""
    shared = docs.sparkSession.sparkContext.broadcast(train(label_table(docs, doc_id=doc_id, text=text)))
    rows = carried(docs, keep, x=whole_text(f"`{text}`").cast("binary"))

    def joined(spans: list[tuple[str, int, int]]) -> str:
        return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.slice(lo, 256)
                texts = [t.as_py().decode("utf-8", "replace") for t in part.column("x")]
                bases = [base_spans(t) for t in texts]
                more = added_spans(texts, bases, field)
                counts = [pa.array([sum(s[0] == k for s in base) for base in bases], pa.int64()) for k in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), *counts, pa.array([hashlib.sha256(joined(s).encode()).hexdigest() for s in bases], pa.string()),
                     pa.array([joined([*s, *m]) for s, m in zip(bases, more)], pa.string())],
                    names=["row", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    schema = T.StructType([rows.schema["row"], *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])
    return rows.mapInArrow(run, schema)
