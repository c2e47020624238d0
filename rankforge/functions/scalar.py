"""Scalar functions F1-F13 as Spark Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters removed from chart names (backslash and double quote).
NAME_JUNK_PATTERN = r'[\\"]'


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rank_class(rank, width: int = 10, clamp_to: int | None = None) -> Column:
    """ordinal bucket ``floor((rank - 1) / width)`` as bigint.

    Rank 1-10 -> 0, 11-20 -> 1, ... With ``clamp_to`` the bucket is capped
    (ranks beyond the chart fall into the default class); the plain floor is
    the default, so rank 111 gives 11.
    """
    cls = F.floor((_col(rank) - F.lit(1)) / F.lit(width))
    if clamp_to is not None:
        cls = F.least(cls, F.lit(clamp_to).cast("bigint"))
    return cls


def clean_name(c) -> Column:
    """Drop every backslash and double quote."""
    return F.regexp_replace(_col(c), NAME_JUNK_PATTERN, "")


def quote(c) -> Column:
    """wrap in one pair of double quotes."""
    return F.concat(F.lit('"'), _col(c), F.lit('"'))


def to_csv_line(*cols, quoted: bool = False) -> Column:
    """row -> CSV line. ``quoted`` uses RFC-4180 quoting (safe for commas)."""
    if quoted:
        return F.to_csv(F.struct(*[_col(c) for c in cols]))
    return F.concat_ws(",", *[_col(c).cast("string") for c in cols])


def fielded_query(artist, title) -> Column:
    """fielded lookup text ``artist:{a} track:{t}`` (null if a part is null)."""
    return F.concat(F.lit("artist:"), _col(artist), F.lit(" track:"), _col(title))


def free_text_query(title, artist) -> Column:
    """free-text lookup text ``{t} {a}`` (null if a part is null)."""
    return F.concat(_col(title), F.lit(" "), _col(artist))


def normalize_text(c) -> Column:
    """Match key of a free-text query: lower case, runs of characters that are
    neither letters nor digits (of any script) become one space, trimmed; null
    if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(_col(c)), r"[^\p{L}\p{N}]+", " ")), F.lit(""))


def json_field(c, path: str, dtype: str | None = None) -> Column:
    """F8: one field of a JSON string by JSON path (``$.tracks.items[0].id``)."""
    out = F.get_json_object(_col(c), path)
    return out.try_cast(dtype) if dtype else out


def first_hit_field(response, field: str) -> Column:
    """F8: ``tracks.items[0].<field>`` of a lookup response, null when empty."""
    return json_field(response, f"$.tracks.items[0].{field}")


def binary_relabel_expr(c, positive=10) -> Column:
    """1 for the positive label, 0 for everything else (null included)."""
    return F.when(_col(c) == F.lit(positive), F.lit(1)).otherwise(F.lit(0))


def hash_order(*keys, seed: int = 0) -> Column:
    """Seeded, engine-portable pseudo-random order: ``md5('<seed>:<k1>:<k2>')``.

    Sorting by it (then by the key) gives a stable sample order that does not
    depend on partitioning, unlike ``rand(seed)``.
    """
    parts = [F.lit(str(seed))] + [_col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def hash_bucket(*keys, seed: int = 0, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of :func:`hash_order`."""
    h = F.conv(F.substring(hash_order(*keys, seed=seed), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))
