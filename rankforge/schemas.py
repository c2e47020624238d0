"""Fixed schemas of the logical tables. No inference pass."""

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# Raw weekly chart as text: everything is a string until parsed.
CHART_RAW = _struct(("date", S), ("rank", S), ("song", S), ("artist", S))

CHART = _struct(("date", T.DateType()), ("rank", I), ("song", S), ("artist", S))

BEST_RANK = _struct(("song", S), ("artist", S), ("top_rank", I))

CLASSIFIED = _struct(("song", S), ("artist", S), ("class", L))

# The 11 feature-table columns, in the order the reference keeps.
TRACK_FEATURE_COLUMNS = [
    "artist_name", "title", "year", "danceability", "duration", "energy",
    "key", "loudness", "song_hotttnesss", "tempo", "time_signature",
]

TRACK_FEATURES_A = _struct(
    ("artist_name", S), ("title", S), ("year", I), ("danceability", D),
    ("duration", D), ("energy", D), ("key", I), ("loudness", D),
    ("song_hotttnesss", D), ("tempo", D), ("time_signature", I),
)

IDENTIFIED = _struct(
    ("song", S), ("artist", S), ("class", L), ("track_id", S), ("popularity", I)
)

# Audio-feature columns of the lookup service, in its order.
AUDIO_FEATURE_COLUMNS = [
    "danceability", "energy", "key", "loudness", "mode", "speechiness",
    "acousticness", "instrumentalness", "liveness", "valence", "tempo",
    "duration_ms", "time_signature",
]

TRACK_FEATURES_B = _struct(
    ("id", S), ("danceability", D), ("energy", D), ("key", I), ("loudness", D),
    ("mode", I), ("speechiness", D), ("acousticness", D),
    ("instrumentalness", D), ("liveness", D), ("valence", D), ("tempo", D),
    ("duration_ms", I), ("time_signature", I),
)

CATALOGUE = _struct(("id", S), ("artist", S), ("title", S), ("popularity", I))

# Nested lookup response: {"tracks": {"items": [{"id": .., "popularity": ..}]}}
SEARCH_RESPONSE = T.StructType([
    T.StructField("tracks", T.StructType([
        T.StructField("items", T.ArrayType(_struct(("id", S), ("popularity", I))), True)
    ]), True)
])

# Feature lists used by the models (8 and 14 columns).
FEATURES_8 = [
    "danceability", "duration", "energy", "key", "loudness",
    "song_hotttnesss", "tempo", "time_signature",
]
FEATURES_14 = [
    "popularity", "danceability", "energy", "key", "loudness", "mode",
    "speechiness", "acousticness", "instrumentalness", "liveness", "valence",
    "tempo", "duration_ms", "time_signature",
]
