"""One day of the catalogue flow, end to end, on the driver's tables.

    python scripts/daily_run.py [sf_dir] [as_of]

catalogue load (triples -> pattern -> REQUIRED check -> table) -> daily
enrichment of the catalogue ids (lookups -> day partition) -> published union
view over that day's snapshot -> declared data tests -> a SQL question with a
10-record preview. On a cluster, pass a session whose spark.checkpoint.dir is
a shared folder and size it with cadenza.session.scale_conf.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cadenza.operators.quality import run_data_tests  # noqa: E402
from cadenza.plans import catalogue as C  # noqa: E402
from cadenza.plans import queries as Q  # noqa: E402
from cadenza.plans import responders as R  # noqa: E402
from cadenza.plans.sql_surface import preview, register_sql_functions  # noqa: E402
from cadenza.session import build_session, clean_work, work_path  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    as_of = sys.argv[2] if len(sys.argv) > 2 else Q.AS_OF
    spark = build_session("local[*]", 8, app_name="cadenza-daily")

    catalogue = C.load_catalogue(
        Q._triples(spark, sf_dir), work_path(spark, "catalogue"), ("in_nation", "nation"),
        [("placed", "order_ref"), ("segment", "segment")], label="label")
    print("catalogue rows:", catalogue.count())

    # Catalogue ids (customer numbers) are looked up and land as today's partition.
    ids = catalogue.select(F.regexp_replace("item", "^C", "").cast("long").alias("cid"))
    deezer = C.daily_enrichment(
        ids, "cid", R.artist_lookup, R.ARTIST_BODY_SCHEMA, work_path(spark, "deezer_artists"),
        {"deezer_artist_id": F.col("id").cast("string"),
         "deezer_artist_name": F.format_string("Customer#%09d", F.col("id")),
         "deezer_artist_url": "link", "deezer_artist_total_followers": "nb_fan"},
        as_of=as_of)
    print("enriched today:", deezer.count())

    spotify = Q.spotify_standin(spark, sf_dir)
    view = C.artists_union(spotify, deezer, as_of=as_of, view_name="artists_union")
    print("union rows:", view.count())
    run_data_tests(view, Q.UNION_VIEW_TESTS).show(truncate=False)

    register_sql_functions(spark)
    records, err = preview(
        spark, "SELECT spotify_artist_name, deezer_artist_total_followers FROM artists_union "
               "WHERE has_genre(spotify_artist_genres, :g)", {"g": "Machinery"}, n=10,
        order_by=["spotify_artist_name"])
    print(err or "\n".join(records))
    clean_work(spark)
    spark.stop()


if __name__ == "__main__":
    main()
