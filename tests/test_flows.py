import json
import os

import pytest

from cadenza.plans.catalogue import daily_enrichment, load_catalogue
from conftest import rows


def triples(spark, data):
    return spark.createDataFrame(data, "subject string, predicate string, object string")


def test_load_catalogue(spark, scratch_dir):
    path = os.path.join(scratch_dir, "catalogue")
    t = triples(spark, [("Q1", "deezer", "d1"), ("Q1", "spotify", "s1"), ("Q1", "spotify", "s2"),
                        ("Q1", "label", "Alpha"), ("Q2", "deezer", "d2"), ("Q3", "spotify", "s3")])
    out = load_catalogue(t, path, ("deezer", "deezer_artist_id"),
                         [("spotify", "spotify_artist_id")], label="label")
    # multi-valued optional property multiplies; no label -> the item itself;
    # a subject without the required property is absent
    assert rows(out, "item", "itemLabel", "deezer_artist_id", "spotify_artist_id") == [
        ("Q1", "Alpha", "d1", "s1"), ("Q1", "Alpha", "d1", "s2"), ("Q2", "Q2", "d2", None)]
    # an empty result keeps the previous table
    empty = triples(spark, [("Q9", "spotify", "s9")])
    again = load_catalogue(empty, path, ("deezer", "deezer_artist_id"),
                           [("spotify", "spotify_artist_id")], label="label")
    assert again.count() == 3
    # a null in a REQUIRED field stops the load
    bad = triples(spark, [("Q5", "deezer", None)])
    with pytest.raises(ValueError):
        load_catalogue(bad, path, ("deezer", "deezer_artist_id"))


def lookup(ids):
    for i in ids:
        yield i, 200, json.dumps({"id": i, "name": f"n{i}"})


def test_daily_enrichment_append_and_replace(spark, scratch_dir):
    path = os.path.join(scratch_dir, "snap")
    cat = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("",)], "deezer_artist_id string")
    cols = {"deezer_artist_id": "id", "deezer_artist_name": "name"}
    day1 = daily_enrichment(cat, "deezer_artist_id", lookup, "id string, name string", path,
                            cols, as_of="2024-01-01")
    assert rows(day1, "deezer_artist_id", "deezer_artist_name") == [("a", "na"), ("b", "nb")]
    daily_enrichment(cat, "deezer_artist_id", lookup, "id string, name string", path, cols,
                     as_of="2024-01-02")
    # a second run on the same day appends again (reference behaviour) ...
    again = daily_enrichment(cat, "deezer_artist_id", lookup, "id string, name string", path,
                             cols, as_of="2024-01-02")
    assert again.count() == 4
    # ... unless the day is replaced
    fixed = daily_enrichment(cat, "deezer_artist_id", lookup, "id string, name string", path,
                             cols, as_of="2024-01-02", replace_day=True)
    assert fixed.count() == 2
    assert spark.read.parquet(path).count() == 4


def test_artist_refresh_calls_service_once_per_id(spark, scratch_dir):
    from cadenza.plans.catalogue import artist_refresh
    from cadenza.plans.responders import ARTISTS_BATCH_SCHEMA, artists_batch_lookup

    log = os.path.join(scratch_dir, "calls.txt")

    def counted(ids):
        with open(log, "a") as fh:
            fh.write("\n".join(ids) + "\n")
        yield from artists_batch_lookup(ids)

    ids = spark.createDataFrame([(i,) for i in [1, 2, 3, 5, 17, 17, 34]], "o_orderkey long")
    out = artist_refresh(ids, "o_orderkey", counted, ARTISTS_BATCH_SCHEMA,
                         os.path.join(scratch_dir, "dim"), os.path.join(scratch_dir, "fact"),
                         as_of="2024-01-31", batch_size=2)
    with open(log) as fh:
        calls = sorted(line for line in fh.read().split("\n") if line)
    assert calls == ["1", "17", "2", "3", "34", "5"]          # each distinct id once
    got = {r["spotify_artist_id"]: r for r in out.collect()}
    assert sorted(got) == ["sp1", "sp2", "sp3", "sp5"]        # null records dropped
    assert got["sp3"]["spotify_artist_genres"] is None        # empty genres -> null
    assert got["sp2"]["spotify_artist_genres"] == "rock,Pop"
    assert got["sp5"]["spotify_artist_total_followers"] is None
    assert got["sp1"]["spotify_artist_popularity"] == 1


def test_daily_enrichment_calls_service_once_per_id(spark, scratch_dir):
    log = os.path.join(scratch_dir, "calls.txt")

    def counted(ids):
        with open(log, "a") as fh:
            fh.write("".join(f"{i}\n" for i in ids))
        yield from lookup(ids)

    cat = spark.createDataFrame([(f"a{i % 40}",) for i in range(100)], "deezer_artist_id string")
    day = daily_enrichment(cat, "deezer_artist_id", counted, "id string, name string",
                           os.path.join(scratch_dir, "snap"),
                           {"deezer_artist_id": "id", "deezer_artist_name": "name"}, batch_size=7)
    assert day.count() == 40
    with open(log) as fh:
        calls = fh.read().split()
    assert sorted(calls) == sorted(set(calls)) and len(calls) == 40


def test_artist_refresh_updates_the_dimension_readers_use(spark, scratch_dir):
    from cadenza.plans.catalogue import artist_refresh
    from cadenza.plans.responders import ARTISTS_BATCH_SCHEMA, artists_batch_lookup

    dim = os.path.join(scratch_dir, "dim")
    ids = spark.createDataFrame([(1,), (2,)], "o_orderkey long")
    artist_refresh(ids, "o_orderkey", artists_batch_lookup, ARTISTS_BATCH_SCHEMA, dim,
                   os.path.join(scratch_dir, "fact"), as_of="2024-01-31")
    assert rows(spark.read.parquet(dim), "spotify_artist_id", "spotify_artist_popularity") == [
        ("sp1", 1), ("sp2", 2)]
    assert sorted(n for n in os.listdir(scratch_dir) if not n.startswith(".")) == ["dim", "fact"]
    assert not [n for n in os.listdir(scratch_dir) if n.startswith(".")]


def test_artist_refresh_reruns_on_the_same_day(spark, scratch_dir):
    from cadenza.plans.catalogue import artist_refresh
    from cadenza.plans.responders import ARTISTS_BATCH_SCHEMA, artists_batch_lookup

    dim, fact = os.path.join(scratch_dir, "dim"), os.path.join(scratch_dir, "fact")
    ids = spark.createDataFrame([(1,), (2,)], "o_orderkey long")
    for _ in range(2):
        out = artist_refresh(ids, "o_orderkey", artists_batch_lookup, ARTISTS_BATCH_SCHEMA, dim, fact,
                             as_of="2024-01-31")
        assert rows(out, "spotify_artist_id", "spotify_artist_popularity") == [("sp1", 1), ("sp2", 2)]
    assert spark.read.parquet(fact).count() == 2
