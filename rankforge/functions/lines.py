"""Repair of chart lines whose names contain unquoted commas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankforge.functions.scalar import clean_name, quote


def repair_line_struct(line, sep: str = ",") -> Column:
    """Split a raw line on every separator (CSV quotes are ignored) and rebuild
    (song, artist, class).

    * 3 fields: song and artist are cleaned, class is kept as is.
    * k > 3 fields: song = fields 1..k-2 joined back with the separator,
      cleaned and wrapped in quotes; artist = field k-1 cleaned; class = field k.
    * fewer than 3 fields: ``ok`` is false (the caller drops and counts them).
    """
    line = F.col(line) if isinstance(line, str) else line
    parts = F.split(line, sep, -1)
    k = F.size(parts)
    song_many = quote(clean_name(F.array_join(F.slice(parts, 1, F.greatest(k - 2, F.lit(0))), sep)))
    song = F.when(k == 3, clean_name(F.try_element_at(parts, F.lit(1)))).otherwise(song_many)
    artist = clean_name(F.try_element_at(parts, F.lit(-2)))
    return F.struct(
        k.alias("n_fields"),
        (k >= 3).alias("ok"),
        F.when(k >= 3, song).alias("song"),
        F.when(k >= 3, artist).alias("artist"),
        F.when(k >= 3, F.try_element_at(parts, F.lit(-1))).alias("class"),
    )
