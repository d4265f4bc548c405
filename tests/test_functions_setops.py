import datetime as dt

from pyspark.sql import functions as F

from cadenza.functions import scalars as S
from cadenza.operators import ordering as O
from cadenza.operators import setops as U
from cadenza.plans import catalogue as C
from conftest import rows


def test_scalar_functions(spark):
    df = spark.createDataFrame(
        [([{"id": "a", "name": "A"}, {"id": "b", "name": "B"}], ["FR", "US"], [1.0, 2.0],
          [1.0, 4.0], "x" * 22, "1700000000000"),
         ([], None, [0.0], [0.0], "short", "bad")],
        "artists array<struct<id:string,name:string>>, markets array<string>, "
        "a array<double>, b array<double>, id string, t string")
    out = df.select(
        S.join_field("artists", "id").alias("ids"), S.join_strings("markets").alias("m"),
        S.array_or_empty("markets").alias("me"),
        S.valid_length_id("id").alias("ok"), S.present_id("id").alias("present"),
        S.to_timestamp_coerced(F.col("t"), numeric=True).alias("ts"),
        S.iso_date(F.lit("2024-02-03").cast("date")).alias("iso"),
        S.lower_eq(F.lit("Rock"), "ROCK").alias("eq")).collect()
    assert out[0]["ids"] == "a,b" and out[1]["ids"] is None
    assert out[0]["m"] == "FR,US" and out[1]["m"] == ""
    assert out[1]["me"] == []
    assert out[0]["ok"] is True and out[1]["ok"] is False
    assert out[0]["present"] is True
    assert out[0]["ts"] == dt.datetime(2023, 11, 14, 22, 13, 20) and out[1]["ts"] is None
    assert out[0]["iso"] == "2024-02-03" and out[0]["eq"] is True


def test_union_flatten_split(spark):
    tracks = spark.createDataFrame([(1, "t", "art", 1)], "id long, name string, artist string, rank long")
    artists = spark.createDataFrame([(2, "a", 5)], "id long, name string, rank long")
    u = U.union_by_name(tracks.withColumn("type", S.tag("track")),
                        artists.withColumn("type", S.tag("artist")))
    assert rows(u, "id", "artist", "type") == [(1, "art", "track"), (2, None, "artist")]
    nested = spark.createDataFrame([(1, [[1, 2], [3]]), (2, [])], "k int, ids array<array<int>>")
    assert rows(U.flatten_nested(nested, "ids", "id"), "k", "id") == [(1, 1), (1, 2), (1, 3)]
    recs = spark.createDataFrame([("a", "n", 3), (None, "x", 1), ("", "y", 2)],
                                 "id string, name string, pop int")
    dim, fact = U.split_dim_fact(recs, "id", ["name"], ["pop"], stamp=F.lit("2024-01-01"))
    assert rows(dim) == [("a", "n")]
    assert rows(fact) == [("a", 3, "2024-01-01")]


def test_ordering(spark):
    df = spark.createDataFrame([(3, "b", "x"), (1, "a", "y"), (2, "a", "x"), (4, None, "x")],
                               "row_id int, brand string, kind string")
    assert [r["brand"] for r in O.sorted_choices(df, "brand").collect()] == ["a", "b"]
    assert [r["brand"] for r in O.sorted_choices(df, "brand", F.col("kind") == "x")
            .collect()] == ["a", "b"]
    assert O.first_row(df, ["row_id"], F.col("brand") == "a").first()["row_id"] == 1
    assert [r["row_id"] for r in O.head(df, 2, ["row_id"]).collect()] == [1, 2]
    dated = spark.createDataFrame([(2, 1), (1, 2)], "release_date int, n int")
    assert O.date_columns(dated) == ["release_date"]
    assert [r["n"] for r in O.sort_by_date(dated).collect()] == [2, 1]


def test_artists_union_and_dim_fact(spark):
    spotify = spark.createDataFrame(
        [("s1", "Alpha", ["rock"], "u1", 10, 5, dt.date(2024, 1, 1)),
         ("s1", "Alpha", ["rock"], "u1", 11, 6, dt.date(2024, 1, 2)),
         ("s2", "Beta", [], "u2", 1, 1, dt.date(2024, 1, 2))],
        "spotify_artist_id string, spotify_artist_name string, spotify_artist_genres "
        "array<string>, spotify_artist_url string, spotify_artist_popularity long, "
        "spotify_artist_total_followers long, ingestion_date date")
    deezer = spark.createDataFrame(
        [("d1", "Alpha", "x1", 100, dt.date(2024, 1, 1)),
         ("d1", "Alpha", "x1", 101, dt.date(2024, 1, 2))],
        "deezer_artist_id string, deezer_artist_name string, deezer_artist_url string, "
        "deezer_artist_total_followers long, ingestion_date date")
    all_days = C.artists_union(spotify, deezer, as_of="2024-01-03", view_name="u_all")
    # snapshots accumulate: 2 spotify x 2 deezer rows for Alpha, plus Beta unmatched
    assert all_days.count() == 5
    assert spark.table("u_all").count() == 5
    one_day = C.artists_union(spotify, deezer, as_of="2024-01-03", view_name=None,
                              snapshot_day="2024-01-02")
    assert rows(one_day, "spotify_artist_id", "deezer_artist_total_followers") == [
        ("s1", 101), ("s2", None)]
    assert {r["ingestion_date"] for r in one_day.collect()} == {dt.date(2024, 1, 3)}
    dim, fact = C.artists_dim_fact(spotify.drop("ingestion_date"), as_of="2024-01-02")
    assert rows(dim, "spotify_artist_id", "spotify_artist_genres") == [
        ("s1", "rock"), ("s1", "rock"), ("s2", None)]
    merged = C.merge_fact_into_dim(dim.dropDuplicates(["spotify_artist_id"]),
                                   fact.filter("spotify_artist_popularity > 10 or "
                                               "spotify_artist_id = 's2'"), "2024-01-02")
    assert rows(merged, "spotify_artist_id", "spotify_artist_popularity") == [
        ("s1", 11), ("s2", 1)]


def test_scale_conf():
    from cadenza.session import scale_conf
    conf = scale_conf(100 * (1 << 40))                      # 100 TB
    assert conf["spark.sql.shuffle.partitions"] == "200000"
    small = scale_conf(10 << 20)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 128 << 20


def test_browse_flow(spark):
    from cadenza.plans.browse import browse, slider_bounds
    tracks = spark.createDataFrame(
        [("rock", 0.2, 0.5, "a"), ("rock", 0.6, 0.7, "b"), ("pop", 0.9, 0.1, "c")],
        "genre string, dance double, energy double, name string")
    b = {r["feature"]: tuple(r)[1:] for r in
         slider_bounds(tracks, "genre", "rock", ["dance", "energy"], ("energy",)).collect()}
    assert b["dance"] == (0.2, 0.6, 0.2, 0.6)
    assert b["energy"] == (0.5, 0.7, 0.1, 0.7)        # default = global range
    hits = browse(tracks, "genre", "rock", {"dance": (0.1, 0.3), "energy": (0.1, 0.7)}, ["name"])
    assert [r["name"] for r in hits.collect()] == ["a"]
