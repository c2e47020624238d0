"""Prefix trie of rebuilt conversations by composable fingerprints.

A conversation is rebuilt as the first turns of its base conversation and its
own later turns. The fingerprint of a turn sequence is the sum of
``x_i * B^i`` modulo a prime over its turns (four bases), a monoid: the
fingerprint of ``uv`` is that of ``u`` plus ``B^|u|`` times that of ``v``. So
a rebuilt prefix is put together from two running sums, the base's head and
the difference of two of the conversation's own, moved by a power of ``B``;
no rebuilt text is ever made, and texts are read once, for the digest and the
length of each turn, and never shuffled.

Each prefix row refers to its last turn by the turn's SHA-256 and to the
prefix before it. A fingerprint whose rows do not all agree in both is a
collision; the trie is then built again with other bases. If no fingerprint
is, equal fingerprints mean equal sequences, turn by turn.

Running sums go by blocks of ``BLOCK`` turns (a sum within each block, and one
over the blocks of a conversation), positions by the distributed ordinal, so
a conversation may hold a large share of all rows. For sums over subtrees,
each node belongs to its smallest member; the nodes of a member are a chain
of growing depth, which hangs from a node of another chain. The chains' sums
go up by doubling (rounds: the logarithm of the nesting of chains), then a
suffix sum along each chain gives every node's.

Defined cases: a null role or text is the empty one. Turns are ordered by
``turn`` (null first) and, where it repeats, by their SHA-256; repeated rows
are turns of their own. Rows without a conversation id belong to no
conversation and are left out. The remainder of a negative id is taken as
positive. An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.operators.ordinal import with_ordinal

from .text import whole_text

#: A Mersenne prime; products of two residues fit a long.
PRIME = (1 << 31) - 1
BASES, BLOCK, ENDS_PART = 4, 10, 12  # turns a block and ids a part of the ends: powers of two
_DIGIT, _DIGITS = 6, 6
_SUMS = [f"s{j}" for j in range(BASES)]
_TERMS = [f"t{j}" for j in range(BASES)]
_KEY, _UP = ["d", "f0", "f1"], ["ud", "u0", "u1"]


def _base(seed: int, j: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{seed}:{j}".encode()).digest()[:8], "big") % (PRIME - 2) + 2


def _modulo(c: Column) -> Column:
    return F.pmod(c, F.lit(PRIME))


def _power(base: int, i: Column) -> Column:
    """base^i, by the base-64 digits of i."""
    parts = []
    for k in range(_DIGITS):
        table = [pow(base, d << (_DIGIT * k), PRIME) for d in range(1 << _DIGIT)]
        digit = F.shiftright(i, _DIGIT * k).bitwiseAND(F.lit((1 << _DIGIT) - 1)).cast("int")
        parts.append(F.array(*[F.lit(v).cast("long") for v in table])[digit])
    return reduce(lambda a, b: _modulo(a * b), parts)


def _packed(sums: list[Column]) -> list[Column]:
    return [F.shiftleft(sums[k], 31).bitwiseOR(sums[k + 1]) for k in range(0, BASES, 2)]


def _own_sums(turns: DataFrame, seed: int) -> DataFrame:
    """(c, i, digest, bytes) with each turn's terms and the sums up to it."""
    terms = [_modulo((F.pmod(F.xxhash64("digest", F.lit(seed), F.lit(j)), F.lit(PRIME - 1)) + 1) * _power(_base(seed, j), F.col("i")))
             for j in range(BASES)]
    rows = turns.select("*", F.shiftright("i", BLOCK).alias("b"), *[t.alias(n) for t, n in zip(terms, _TERMS)])
    before = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("c", "b").agg(*[_modulo(F.sum(n)).alias(n) for n in _TERMS])
    offsets = totals.select("c", "b", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"o{n}") for n in _TERMS]).where("b > 0")
    within = Window.partitionBy("c", "b").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.select("*", *[F.sum(n).over(within).alias(s) for n, s in zip(_TERMS, _SUMS)])
    joined = inside.join(offsets, ["c", "b"], "left")
    return joined.select("c", "i", "digest", "bytes", *_TERMS,
                         *[_modulo(F.col(s) + F.coalesce(F.col(f"o{n}"), F.lit(0))).alias(s) for n, s in zip(_TERMS, _SUMS)])


def _members(own: DataFrame, base_of: Callable[[Column], Column], head_of: Callable[[Column], Column], max_head: int, seed: int) -> DataFrame:
    """A row for each conversation and depth: c, the prefix's key, the key of
    the prefix before it, its last turn's digest and bytes, whether c ends."""
    turn = F.struct("i", "digest", "bytes", *_TERMS, *_SUMS)
    heads = own.groupBy("c").agg((F.max("i") + 1).alias("n"), F.sort_array(F.collect_list(F.when(F.col("i") < max_head, turn))).alias("head"))
    convs = heads.select("c", "n", "head", base_of(F.col("c")).alias("base"), head_of(F.col("c")).alias("h"))
    bases = heads.select(F.col("c").alias("base"), F.col("head").alias("base_head"))
    convs = convs.join(bases, "base", "left").select(
        "c", "n", "h", "head", F.slice(F.coalesce("base_head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h").cast("int")).alias("bh"))
    convs = convs.select("*", F.size("bh").cast("long").alias("hb"))
    length = F.col("hb") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = convs.select("c", "n", "h", "hb", "bh", length.alias("len"),
                         *[F.when(F.col("hb") > 0, F.element_at("bh", -1)[s]).otherwise(0).alias(f"b{s}") for s in _SUMS],
                         *[F.when((F.col("h") > 0) & (F.col("n") > F.col("h")), F.get("head", F.col("h").cast("int") - 1)[s]).otherwise(0).alias(f"h{s}")
                           for s in _SUMS]).checkpoint()

    def rows(df: DataFrame, depth: Column, sums: list[Column], before: list[Column]) -> DataFrame:
        up = [F.when(F.col("d") > 0, x) for x in (F.col("d") - 1, *_packed([F.col(f"p{j}") for j in range(BASES)]))]
        made = df.select("c", "digest", "bytes", "len", depth.cast("long").alias("d"), *[s.alias(f"q{j}") for j, s in enumerate(sums)],
                         *[s.alias(f"p{j}") for j, s in enumerate(before)])
        return made.select("c", "d", *[f.alias(n) for f, n in zip(_packed([F.col(f"q{j}") for j in range(BASES)]), _KEY[1:])],
                           *[u.alias(n) for u, n in zip(up, _UP)], "digest", "bytes", (F.col("d") == F.col("len")).alias("ends"))

    none = [F.lit(0).cast("long")] * BASES
    roots = rows(convs.select("c", "len", F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("bytes")), F.lit(0), none, none)
    in_head = rows(convs.select("c", "len", F.explode("bh").alias("e")).select("c", "len", "e.*"), F.col("i") + 1,
                   [F.col(s) for s in _SUMS], [_modulo(F.col(s) - F.col(t)) for s, t in zip(_SUMS, _TERMS)])
    later = own.join(convs.drop("bh", "n"), "c").where("i >= h")
    back = [F.array(*[F.lit(pow(_base(seed, j), -k, PRIME)).cast("long") for k in range(max_head + 1)])[(F.col("h") - F.col("hb")).cast("int")]
            for j in range(BASES)]

    def moved(j: int, s: Column) -> Column:
        return _modulo(F.col(f"bs{j}") + _modulo(back[j] * _modulo(s - F.col(f"hs{j}"))))

    in_own = rows(later, F.col("hb") + F.col("i") - F.col("h") + 1, [moved(j, F.col(s)) for j, s in enumerate(_SUMS)],
                  [moved(j, F.col(s) - F.col(t)) for j, (s, t) in enumerate(zip(_SUMS, _TERMS))])
    return roots.unionByName(in_head).unionByName(in_own)


def _ends(members: DataFrame) -> DataFrame:
    """SHA-256 of the sorted ids that end at a node. Ids meet in parts of a
    bounded range, and the parts are streamed in order."""
    parts = members.where("ends").groupBy(*_KEY, F.shiftright("c", ENDS_PART).alias("part")).agg(F.sort_array(F.collect_list("c")).alias("ids"))
    parts = parts.select(*_KEY, "part", F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) or [()] * 4
            return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], names=[*_KEY, "ends_sha256"])

        for b in batches:
            done = []
            for *k, ids in zip(*(b.column(n).to_pylist() for n in (*_KEY, "ids"))):
                if k == key:
                    state.update(b"," + ids)
                    continue
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids)
            yield batch(done)
        if key is not None:
            yield batch([(*key, state.hexdigest())])

    ordered = parts.repartition(*_KEY).sortWithinPartitions(*_KEY, "part")
    return ordered.mapInArrow(run, "d long, f0 long, f1 long, ends_sha256 string")


def _chain_totals(nodes: DataFrame) -> DataFrame:
    """(chain, saved, leaves) summed over each chain and all that hang from it,
    with the place (up, at) that the chain hangs from."""
    chains = nodes.groupBy("conv_id").agg(
        F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"),
        F.max(F.when(F.col("parent_conv_id") != F.col("conv_id"), F.struct(F.col("parent_conv_id").alias("up"), (F.col("d") - 1).alias("at")))).alias("top"))
    chains = chains.select(F.col("conv_id").alias("chain"), "saved", "leaves", F.col("top")["up"].alias("up"), F.col("top")["at"].alias("at")).checkpoint()
    state = chains.select("chain", "saved", "leaves", F.col("up").alias("anc"))
    while not state.where("anc is not null").isEmpty():
        below = state.where("anc is not null").groupBy("anc").agg(F.sum("saved").alias("more"), F.sum("leaves").alias("more_leaves"))
        higher = state.select(F.col("chain").alias("anc"), F.col("anc").alias("next"))
        state = state.join(below.withColumnRenamed("anc", "chain"), "chain", "left").select(
            "chain", "anc", (F.col("saved") + F.coalesce("more", F.lit(0))).alias("saved"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"))
        state = state.join(higher, "anc", "left").select("chain", "saved", "leaves", F.col("next").alias("anc")).checkpoint()
    return state.drop("anc").join(chains.select("chain", "up", "at"), "chain")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` with saved_tokens and n_leaves of whole subtrees."""
    hanging = _chain_totals(nodes).where("up is not null").groupBy(F.col("up").alias("conv_id"), F.col("at").alias("d")).agg(
        F.sum("saved").alias("more"), F.sum("leaves").alias("more_leaves"))
    both = nodes.join(hanging, ["conv_id", "d"], "left").select(
        *nodes.columns, F.shiftright("d", BLOCK).alias("b"), (F.col("saved") + F.coalesce("more", F.lit(0))).alias("v"),
        (F.col("leaf") + F.coalesce("more_leaves", F.lit(0))).alias("w"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    totals = both.groupBy("conv_id", "b").agg(F.sum("v").alias("v"), F.sum("w").alias("w"))
    deeper = totals.select("conv_id", "b", *[F.coalesce(F.sum(x).over(after), F.lit(0)).alias(f"o{x}") for x in ("v", "w")])
    within = Window.partitionBy("conv_id", "b").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    inside = both.select("*", F.sum("v").over(within).alias("sv"), F.sum("w").over(within).alias("sw"))
    return inside.join(deeper, ["conv_id", "b"]).select(
        *nodes.columns, (F.col("sv") + F.col("ov")).alias("saved_tokens"), (F.col("sw") + F.col("ow")).alias("n_leaves"))


def build(conversations: DataFrame, *, base_of: Callable[[Column], Column], head_of: Callable[[Column], Column], max_head: int,
          conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", seeds: tuple[int, ...] = (1, 2, 3, 4)) -> DataFrame:
    """The nodes: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. ``base_of`` and ``head_of`` give a
    conversation's base and the number (0 to ``max_head``) of its turns."""
    said, spoke = whole_text(f"`{text}`"), whole_text(f"`{role}`")
    digest = F.unhex(F.sha2(F.concat(F.octet_length(spoke).cast("string"), F.lit(":"), spoke, said).cast("binary"), 256))
    turns = conversations.select(F.col(f"`{conv_id}`").cast("long").alias("c"), F.col(f"`{turn}`").alias("turn"), digest.alias("digest"),
                                 F.octet_length(said).cast("long").alias("bytes")).where("c is not null")
    turns = with_ordinal(turns, ["turn", "digest"], ["c"]).select("c", (F.col("ordinal") - 1).alias("i"), "digest", "bytes")
    for seed in seeds:
        members = _members(_own_sums(turns, seed).checkpoint(), base_of, head_of, max_head, seed)
        before = F.struct(*_UP)
        nodes = members.groupBy(*_KEY).agg(
            F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), *[F.min(u).alias(u) for u in _UP],
            ((F.min(before) == F.max(before)) & F.min("digest").eqNullSafe(F.max("digest"))).alias("agree")).checkpoint()
        if nodes.where("not agree").isEmpty():
            break
    else:
        raise RuntimeError("fingerprints collide under all seeds")
    children = nodes.where("d > 0").groupBy(*_UP).agg(F.count("*").alias("n_children")).toDF(*_KEY, "n_children")
    parents = nodes.select(*[F.col(k).alias(u) for k, u in zip(_KEY, _UP)], F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(children, _KEY, "left").join(parents, _UP, "left").select(
        *_KEY, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"), F.col("n_children").isNull().cast("long").alias("leaf")).checkpoint()
    out = _subtree_sums(nodes).join(_ends(members), _KEY, "left")
    return out.select("conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
