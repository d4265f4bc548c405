"""Declared schemas of the catalogue tables (Spark form of the warehouse schemas).

File sources always yield nullable columns, so ``REQUIRED`` fields are listed
separately and enforced with :func:`cadenza.operators.quality.require_not_null`.
"""

from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DateType()


# Column names and types of the tables below.
def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CATALOGUE_IDS = _schema(
    ("item", S), ("itemLabel", S), ("deezer_artist_id", S), ("spotify_artist_id", S),
    ("youtube_artist_id", S), ("artist_official_url", S))

DEEZER_ARTISTS = _schema(
    ("deezer_artist_id", S), ("deezer_artist_name", S), ("deezer_artist_url", S),
    ("deezer_artist_total_followers", L), ("ingestion_date", D))

SPOTIFY_ARTISTS = _schema(
    ("spotify_artist_id", S), ("spotify_artist_name", S),
    ("spotify_artist_genres", T.ArrayType(S)), ("spotify_artist_url", S),
    ("spotify_artist_popularity", L), ("spotify_artist_total_followers", L),
    ("ingestion_date", D))

SPOTIFY_DIM = _schema(
    ("spotify_artist_id", S), ("spotify_artist_name", S), ("spotify_artist_genres", S),
    ("spotify_artist_url", S))

SPOTIFY_FACT = _schema(
    ("spotify_artist_id", S), ("spotify_artist_popularity", L),
    ("spotify_artist_total_followers", L), ("date", D))

TOP_TRACKS = _schema(
    ("spotify_track_artists", S), ("spotify_track_artist_names", S), ("spotify_track_id", S),
    ("spotify_track_name", S), ("spotify_track_popularity", L), ("spotify_track_url", S),
    ("spotify_track_markets", S), ("spotify_track_isrc", S), ("spotify_track_ean", S),
    ("spotify_track_upc", S))

TRIPLES = _schema(("subject", S), ("predicate", S), ("object", S))

# Fields declared REQUIRED per table.
REQUIRED = {
    "catalogue_ids": ("item", "deezer_artist_id"),
    "deezer_artists": ("deezer_artist_id",),
    "spotify_artists": ("spotify_artist_id",),
    "spotify_artists_fact": ("spotify_artist_id", "date"),
}

# The eight audio features of the tracks dataset (fixed names).
AUDIO_FEATURES = ("danceability", "energy", "loudness", "speechiness",
                  "acousticness", "liveness", "valence", "tempo")
