"""Similar-tracks flow: clean -> choose artist and title -> exactly one track
-> standardise features over the whole cleaned table -> exact k nearest ->
the display columns of the hits, in rank order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.aggregates import exactly_one, first_per_key
from cadenza.operators.ordering import first_row
from cadenza.operators.similarity import ranked


def clean_tracks(tracks: DataFrame, title: str, order_col: str) -> DataFrame:
    """P12 + A2: drop rows with any null, then keep one row per title (the
    first by ``order_col``), across artists."""
    return first_per_key(tracks.dropna("any"), title, order_col)


def similar_tracks(tracks: DataFrame, id_col: str, artist_col: str, title_col: str,
                   features, artist: str, title: str, display, k: int = 10,
                   digits: int | None = 4) -> DataFrame:
    """The ``k`` tracks closest to (``artist``, ``title``) on the standardised
    ``features`` (the track itself ranks first). ``tracks`` is the cleaned
    table; the scaler is fitted on all of it, not on a selection. Scans: the choice, the
    exactly-one check (which also brings the track's features), the statistics,
    and the distances, which carry the display columns along."""
    features = list(features)
    chosen = first_row(tracks, [id_col], where=(F.col(artist_col) == F.lit(artist)) &
                       (F.col(title_col) == F.lit(title))).select(id_col)
    track_id = exactly_one(chosen, "track")[id_col]                       # O5
    # The id must be unique in the table, not only in the choice.
    query = exactly_one(tracks.filter(F.col(id_col) == F.lit(track_id)).select(*features), "track")
    stats = tracks.agg(*[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)],
                       *[F.stddev_pop(f).alias(f"s{i}") for i, f in enumerate(features)]).first()
    distance = F.lit(0.0)
    for i, f in enumerate(features):
        # A10 + F1: standardised, as float32; F9: squared difference in double.
        z = lambda x, i=i: ((x - F.lit(stats[f"m{i}"])) / F.lit(stats[f"s{i}"] or 1.0)).cast(
            "float").cast("double")
        diff = z(F.col(f).cast("double")) - z(F.lit(float(query[f])))
        distance = distance + diff * diff
    scored = tracks.select(id_col, *display, distance.alias("distance"))
    return ranked(scored, id_col, k, digits).orderBy("rank")
