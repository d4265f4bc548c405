"""Catalogue flows: the published union of two artist catalogues, daily
enrichment snapshots, dimension / fact split and the matched MERGE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.aggregates import distinct_ids
from cadenza.operators.enrich import enrich_batches
from cadenza.operators.graph import triple_pattern
from cadenza.operators.joins import left_join_on_name
from cadenza.operators.merge import merge_into_path, merge_matched
from cadenza.operators.setops import split_dim_fact
from cadenza.schemas import REQUIRED, SPOTIFY_DIM, SPOTIFY_FACT
from cadenza.session import work_path
from cadenza.sources import storage
from cadenza.sources.sinks import (append_day_partition, conform, publish_catalog_view,
                                   publish_view, read_day, resolve_day, run_date,
                                   write_full_refresh)

# The columns of the published view.
UNION_COLUMNS = (
    "spotify_artist_id", "spotify_artist_name", "spotify_artist_genres",
    "spotify_artist_url", "spotify_artist_total_followers", "spotify_artist_popularity",
)
DEEZER_COLUMNS = ("deezer_artist_url", "deezer_artist_name", "deezer_artist_total_followers")


def artists_union(spotify: DataFrame, deezer: DataFrame, as_of=None,
                  view_name: str | None = "artists_union", snapshot_day=None) -> DataFrame:
    """J1 + P1 + P6 + K6: every spotify artist with the deezer measures of the
    artists of the same name, stamped with the run date. ``snapshot_day``
    restricts both catalogues to one ingestion day first (P19); by default all
    accumulated snapshots take part, as in the reference model."""
    if snapshot_day is not None:
        day = F.lit(str(snapshot_day)).cast("date")
        spotify = spotify.filter(F.col("ingestion_date") == day)
        deezer = deezer.filter(F.col("ingestion_date") == day)
    s = spotify.select(*UNION_COLUMNS)
    d = deezer.select(*DEEZER_COLUMNS)
    joined = left_join_on_name(s, d, "spotify_artist_name", "deezer_artist_name")
    out = joined.select(*UNION_COLUMNS, *DEEZER_COLUMNS,
                        run_date(as_of).alias("ingestion_date"))
    if view_name:
        publish_view(out, view_name)
    return out


def publish_artists_union(spark: SparkSession, name: str, spotify_table: str, deezer_table: str,
                          as_of=None) -> DataFrame:
    """K6: the union of :func:`artists_union`, all its columns, as a stored view over two catalog
    tables. The view holds SQL and no data: it follows the tables, outlives the session, and
    its stamp is the day it is read, or ``as_of``.

    The deezer side is completed by a row of nulls for every spotify name that it lacks (no
    name included), so the join is an inner one, in which AQE may split a hot name of
    either side."""
    stamp = "current_date()" if as_of is None else f"DATE '{as_of}'"
    s, d = "spotify_artist_name", "deezer_artist_name"
    measures = ", ".join(DEEZER_COLUMNS)
    nulls = ", ".join("NULL" for _ in DEEZER_COLUMNS)
    return publish_catalog_view(spark, name, f"""
        SELECT {", ".join(f"a.{c}" for c in UNION_COLUMNS)}, {", ".join(f"b.{c}" for c in DEEZER_COLUMNS)},
               {stamp} AS ingestion_date
        FROM {spotify_table} a JOIN (
            SELECT {d} AS name, {measures} FROM {deezer_table} WHERE {d} IS NOT NULL
            UNION ALL
            SELECT DISTINCT x.{s}, {nulls} FROM {spotify_table} x
            LEFT ANTI JOIN (SELECT DISTINCT {d} FROM {deezer_table}) y ON x.{s} = y.{d}) b
        ON a.{s} <=> b.name""")


def artists_dim_fact(artists: DataFrame, as_of=None):
    """U4 + F4: artist records (id, name, genres array, url, popularity,
    followers) -> dimension (genres as comma text, null when empty) and fact
    (measures stamped with the run date)."""
    prepared = artists.withColumn(
        "spotify_artist_genres",
        F.when(F.size("spotify_artist_genres") > 0,
               F.array_join("spotify_artist_genres", ",")))
    return split_dim_fact(
        prepared, "spotify_artist_id",
        ["spotify_artist_name", "spotify_artist_genres", "spotify_artist_url"],
        ["spotify_artist_popularity", "spotify_artist_total_followers"],
        stamp=run_date(as_of), stamp_name="date")


def merge_fact_into_dim(dim: DataFrame, fact: DataFrame, day, check_source_unique=True):
    """J2 + P19: today's fact rows update the matching dimension rows."""
    todays = fact.filter(F.col("date") == F.lit(str(day)).cast("date"))
    return merge_matched(
        dim, todays, "spotify_artist_id",
        {"spotify_artist_popularity": "spotify_artist_popularity",
         "spotify_artist_total_followers": "spotify_artist_total_followers"},
        check_source_unique=check_source_unique)


def load_catalogue(triples: DataFrame, path: str, required: tuple, optional=(),
                   label: str | None = None, required_cols=None, schema=None) -> DataFrame:
    """§3.1 stages 1-3: triple pattern -> declared schema and REQUIRED check ->
    full refresh, in one evaluation of the pattern (see
    :func:`cadenza.sources.sinks.write_full_refresh`). An empty result, or a null in a
    required field, leaves the table as it was."""
    rows = triple_pattern(triples, required, optional, label=label)
    write_full_refresh(rows, path, schema=schema, required=required_cols or ["item", required[1]])
    return rows.sparkSession.read.parquet(path)


def daily_enrichment(catalogue: DataFrame, id_col: str, fetch, body_schema, path: str,
                     columns: dict, as_of=None, batch_size: int = 500,
                     max_parallel: int | None = None, replace_day: bool = False,
                     schema=None, required=(), on_error: str = "raise",
                     ledger: str | None = None) -> DataFrame:
    """§3.1 stages 4-7: distinct ids of ``catalogue`` -> batched lookups ->
    rows stamped with the run date -> append to the day-partitioned snapshot
    table at ``path``. ``columns`` maps output names to response fields
    (names or Column expressions over them). With a ``ledger`` folder (one per day: it answers
    an id once) a rerun after a failure asks only for the ids that have no answer yet.
    Returns that day's snapshot (one partition read)."""
    ids = distinct_ids(catalogue, id_col, "id")
    rows = enrich_batches(ids, "id", fetch, body_schema, batch_size=batch_size,
                          max_parallel=max_parallel, on_error=on_error, ledger=ledger)
    day = run_date(resolve_day(catalogue.sparkSession, as_of))
    stamped = rows.select(*[(src if isinstance(src, Column) else F.col(src)).alias(out)
                            for out, src in columns.items()],
                          day.alias("ingestion_date"))
    append_day_partition(stamped, path, replace_day=replace_day, schema=schema, required=required)
    snapshot = rows.sparkSession.read.parquet(path)
    return snapshot.filter(F.col("ingestion_date") == day)


def artist_refresh(ids: DataFrame, id_col: str, fetch, body_schema, dim_path: str,
                   fact_path: str, as_of=None, batch_size: int = 50,
                   max_parallel: int | None = None) -> DataFrame:
    """The artist refresh of the draft pipeline: batched artist lookups
    (``{"artists": [...]}`` per batch; null records and records without an id
    are dropped) -> fact (the run day's partition, replaced by a rerun of the day) -> MERGE of
    the run day's facts into the new dimension -> one full refresh of the dimension at
    ``dim_path``, so its readers see it with its measures or not yet. Returns the
    dimension. Both writes enforce the declared schemas. The landed records are
    removed when the run ends."""
    from cadenza.operators.enrich import enrich_children

    children = enrich_children(distinct_ids(ids, id_col, "id"), "id", fetch, "artists",
                               body_schema, batch_size=batch_size, max_parallel=max_parallel)
    a = "child."
    artists = (children.filter(F.col("child").isNotNull() & F.col(a + "id").isNotNull() &
                               (F.col(a + "id") != ""))
               .select(F.col(a + "id").alias("spotify_artist_id"),
                       F.col(a + "name").alias("spotify_artist_name"),
                       F.col(a + "genres").alias("spotify_artist_genres"),
                       F.col(a + "external_urls.spotify").alias("spotify_artist_url"),
                       F.col(a + "popularity").alias("spotify_artist_popularity"),
                       F.col(a + "followers.total").alias("spotify_artist_total_followers")))
    # Landed once: the dimension and the fact are both written from it, and
    # the service must be called only once per id.
    spark = ids.sparkSession
    day = resolve_day(spark, as_of)
    records = work_path(spark, "artist_records")
    try:
        artists.write.parquet(records)
        dim, fact = artists_dim_fact(spark.read.parquet(records), as_of=day)
        append_day_partition(fact, fact_path, date_col="date", schema=SPOTIFY_FACT,
                             required=REQUIRED["spotify_artists_fact"], replace_day=True)
        return merge_into_path(
            conform(dim, SPOTIFY_DIM), read_day(spark, fact_path, day, "date"), "spotify_artist_id",
            {"spotify_artist_popularity": "spotify_artist_popularity",
             "spotify_artist_total_followers": "spotify_artist_total_followers"},
            out_path=dim_path)
    finally:
        storage.delete(spark, records)
