import json
import os

import datetime as dt
from pyspark.sql import functions as F

from cadenza.schemas import SPOTIFY_ARTISTS
from cadenza.sources import sinks as K
from cadenza.sources.files import (envelope_rows, parse_json_column, read_csv_inferred,
                                   read_csv_strings, read_json_documents)
from cadenza.sources.tables import read_table, register_tables
from conftest import SF_SMALL, rows


def test_csv_strings_keep_ids_and_inferred_types(spark, scratch_dir):
    path = os.path.join(scratch_dir, "ids.csv")
    with open(path, "w") as fh:
        fh.write("item,itemLabel,deezer_artist_id\nQ1,Alpha,007\nQ2,,0042\n")
    s = read_csv_strings(spark, path)
    assert s.dtypes == [("item", "string"), ("itemLabel", "string"),
                        ("deezer_artist_id", "string")]
    assert rows(s) == [("Q1", "Alpha", "007"), ("Q2", None, "0042")]
    inferred = read_csv_inferred(spark, path)
    assert dict(inferred.dtypes)["deezer_artist_id"] == "int"


def test_json_envelope(spark, scratch_dir):
    path = os.path.join(scratch_dir, "chart.json")
    with open(path, "w") as fh:
        json.dump({"data": [{"id": 1, "title": "t1", "rank": 1,
                             "artist": {"id": 9, "name": "A"}},
                            {"id": 2, "title": "t2", "rank": 2, "artist": None}]}, fh)
    docs = read_json_documents(spark, path)
    out = envelope_rows(docs, "data")
    got = rows(out.select("id", "title", F.col("artist.name").alias("artist"), "rank"))
    assert got == [(1, "t1", "A", 1), (2, "t2", None, 2)]


def test_parse_json_column_malformed(spark):
    df = spark.createDataFrame([('{"k": 3}',), ("not json",), (None,)], "props string")
    out = df.select(parse_json_column("props", "k int").alias("d")).select("d.k")
    assert sorted(r["k"] is None for r in out.collect()) == [False, True, True]


def test_register_and_scan(spark):
    frames = register_tables(spark, SF_SMALL, ["region", "nation"])
    assert set(frames) == {"region", "nation"}
    assert spark.sql("SELECT count(*) AS n FROM region").first()["n"] == 5
    assert read_table(spark, SF_SMALL, "nation", "n_name").columns == ["n_name"]


def test_full_refresh_and_empty_guard(spark, scratch_dir):
    path = os.path.join(scratch_dir, "t")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert K.write_full_refresh(df, path)
    assert K.write_full_refresh(df, path)
    assert not K.write_full_refresh(df.limit(0), path)
    assert spark.read.parquet(path).count() == 2


def test_append_partitions_retention_and_day(spark, scratch_dir):
    path = os.path.join(scratch_dir, "snap")
    base = spark.createDataFrame(
        [("a", dt.date(2024, 1, d)) for d in (1, 2, 8, 9)], "id string, ingestion_date date")
    K.append_day_partition(base.filter("ingestion_date < '2024-01-05'"), path)
    K.append_day_partition(base.filter("ingestion_date >= '2024-01-05'"), path)
    assert spark.read.parquet(path).count() == 4
    K.append_day_partition(base.filter("ingestion_date = '2024-01-09'"), path)   # rerun
    assert spark.read.parquet(path).count() == 5                                  # duplicates
    K.append_day_partition(base.filter("ingestion_date = '2024-01-09'"), path, replace_day=True)
    assert spark.read.parquet(path).count() == 4                                  # idempotent
    assert K.read_day(spark, path, "2024-01-08").count() == 1
    kept = K.read_retained(spark, path, days=7)
    assert rows(kept.select("ingestion_date")) == [(dt.date(2024, 1, 8),), (dt.date(2024, 1, 9),)]
    assert K.read_retained(spark, path, days=7, as_of="2024-01-03").count() == 4


def test_preview_and_view(spark):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "id int, name string")
    recs = K.preview_records(df, 3, order_by=["id"]).collect()
    assert [json.loads(r["record"]) for r in recs] == [
        {"id": 0, "name": "n0"}, {"id": 1, "name": "n1"}, {"id": 2, "name": "n2"}]
    dated = spark.createDataFrame([(dt.date(2024, 1, 1),)], "release_date date")
    rec = json.loads(K.preview_records(dated).first()["record"])
    assert rec == {"release_date": 1704067200000}          # epoch milliseconds
    with_null = spark.createDataFrame([(1, None)], "id int, name string")
    assert json.loads(K.preview_records(with_null).first()["record"]) == {"id": 1, "name": None}
    iso = json.loads(K.preview_records(dated, epoch_dates=False).first()["record"])
    assert iso == {"release_date": "2024-01-01"}
    K.publish_view(df, "people_view")
    assert spark.table("people_view").count() == 20


def test_declared_schema(spark):
    assert SPOTIFY_ARTISTS["spotify_artist_genres"].dataType.simpleString() == "array<string>"


def test_append_files_per_day(spark, scratch_dir):
    import glob
    path = os.path.join(scratch_dir, "bounded")
    df = spark.range(0, 3000).select(
        F.col("id"), F.when(F.col("id") < 2000, F.lit("2024-01-01"))   # a hot day
        .otherwise(F.lit("2024-01-02")).cast("date").alias("ingestion_date")).repartition(16)
    K.append_day_partition(df, path, files_per_day=3)
    for day in ("2024-01-01", "2024-01-02"):
        files = glob.glob(os.path.join(path, f"ingestion_date={day}", "*.parquet"))
        assert 1 <= len(files) <= 3
    assert spark.read.parquet(path).count() == 3000


def test_failing_write_leaves_the_old_table(spark, scratch_dir):
    import pytest

    path = os.path.join(scratch_dir, "t")
    K.write_full_refresh(spark.createDataFrame([(1,), (2,)], "x int"), path)
    broken = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(
        F.raise_error(F.lit("broken"))).cast("int").alias("x"))
    with pytest.raises(Exception, match="broken"):
        K.write_full_refresh(broken, path)
    nulls = spark.createDataFrame([(None,), (5,)], "x int")
    with pytest.raises(ValueError):
        K.write_full_refresh(nulls, path, required=["x"])
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]
    assert os.listdir(scratch_dir) == ["t"]                    # no staging folder stays
    # A table can be rewritten from itself.
    old = spark.read.parquet(path)
    K.write_full_refresh(old.select((F.col("x") + 10).alias("x")), path)
    assert rows(spark.read.parquet(path)) == [(11,), (12,)]


def test_input_is_evaluated_once(spark, scratch_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 50).mapInArrow(count, "id long")
    K.write_full_refresh(df, os.path.join(scratch_dir, "t"))
    assert seen.value == 50
    K.append_day_partition(df.withColumn("ingestion_date", F.lit("2024-01-01").cast("date")),
                           os.path.join(scratch_dir, "d"))
    assert seen.value == 100


def test_append_of_nothing_writes_nothing(spark, scratch_dir):
    path = os.path.join(scratch_dir, "snap")
    none = spark.createDataFrame([], "id string, ingestion_date date")
    assert not K.append_day_partition(none, path) and not os.path.exists(path)


def test_expired_days_are_deleted(spark, scratch_dir):
    path = os.path.join(scratch_dir, "snap")
    days = spark.createDataFrame([("a", dt.date(2024, 1, d)) for d in (1, 2, 8, 9)],
                                 "id string, ingestion_date date")
    K.append_day_partition(days, path)
    assert K.expire_partitions(spark, path, days=7) == ["2024-01-01", "2024-01-02"]
    assert spark.read.parquet(path).count() == 2
    assert K.expire_partitions(spark, path, days=7) == []
    assert K.expire_partitions(spark, path, days=1, as_of="2024-01-09") == ["2024-01-08"]
    assert K.expire_partitions(spark, os.path.join(scratch_dir, "none")) == []


def test_declared_schema_is_enforced(spark, scratch_dir):
    import pytest

    from cadenza.schemas import REQUIRED, SPOTIFY_FACT

    path = os.path.join(scratch_dir, "fact")
    facts = spark.createDataFrame([("x", 7, 5, dt.date(2024, 1, 1), "more")],
                                  "extra string, spotify_artist_id int, spotify_artist_popularity int, date date, "
                                  "spotify_artist_total_followers string").withColumn(
        "spotify_artist_total_followers", F.lit("12"))
    K.append_day_partition(facts, path, date_col="date", schema=SPOTIFY_FACT,
                           required=REQUIRED["spotify_artists_fact"])
    assert rows(spark.read.parquet(path).drop("date")) == [("7", 5, 12)]
    with pytest.raises(ValueError, match="missing"):
        K.write_full_refresh(facts.drop("spotify_artist_id"), path, schema=SPOTIFY_FACT)


def test_landed_tables_go_when_the_run_ends(spark):
    from cadenza.session import clean_work

    landed = K.land_table(spark.range(3), "landed")
    path = landed.inputFiles()[0].replace("file://", "")
    assert landed.count() == 3 and os.path.exists(path)
    assert clean_work(spark) >= 1 and not os.path.exists(path)


def test_published_refresh_survives_failure_and_readers(spark, scratch_dir, monkeypatch):
    """A failing last step leaves the old rows; a reader that loops over the table in another
    session meets whole versions only and never fails."""
    import threading

    import pytest

    name, folder = "versions_under_test", os.path.join(scratch_dir, "versions")
    version = lambda v: spark.range(20).select(F.lit(v).alias("v"))
    assert K.refresh_published(version(0), name, folder)
    with monkeypatch.context() as m:
        m.setattr(K, "publish_catalog_view", lambda *a: (_ for _ in ()).throw(OSError("switch failed")))
        with pytest.raises(OSError, match="switch"):
            K.refresh_published(version(9), name, folder)
    assert rows(spark.table(name).distinct()) == [(0,)] and len(os.listdir(folder)) == 1
    with pytest.raises(ValueError):
        K.refresh_published(spark.createDataFrame([(None,)], "v int"), name, folder, required=["v"])
    assert not K.refresh_published(version(1).limit(0), name, folder)
    seen, errors, stop = [], [], threading.Event()

    def read():
        other = spark.newSession()
        while not stop.is_set():
            try:
                seen.append(tuple(other.table(name).groupBy("v").count().first()))
            except Exception as exc:  # noqa: BLE001
                errors.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 6):
        K.refresh_published(version(v), name, folder)
    stop.set()
    reader.join()
    assert not errors and seen and all(n == 20 for _, n in seen)
    assert [v for v, _ in seen] == sorted(v for v, _ in seen)
    assert rows(spark.table(name).distinct()) == [(5,)] and len(os.listdir(folder)) == 2
    spark.sql(f"DROP VIEW {name}")


def test_refresh_puts_the_old_table_back(spark, scratch_dir, monkeypatch):
    import pytest

    from cadenza.sources import storage

    path = os.path.join(scratch_dir, "t")
    K.write_full_refresh(spark.createDataFrame([(1,)], "x int"), path)
    real, calls = storage.move, []

    def fails_second(s, a, b):
        calls.append(b)
        if len(calls) == 2:
            raise OSError("second rename")
        real(s, a, b)

    monkeypatch.setattr(storage, "move", fails_second)
    with pytest.raises(OSError, match="second"):
        K.write_full_refresh(spark.createDataFrame([(2,)], "x int"), path)
    assert rows(spark.read.parquet(path)) == [(1,)] and os.listdir(scratch_dir) == ["t"]


def test_failing_append_leaves_the_table_as_it_was(spark, scratch_dir):
    import pytest

    path = os.path.join(scratch_dir, "days")
    day = lambda c: F.date_add(F.lit("2024-01-01").cast("date"), (F.col(c) % 3).cast("int"))
    base = spark.range(9).select("id", day("id").alias("ingestion_date"))
    K.append_day_partition(base, path)
    broken = spark.range(0, 400, 1, 8).select(
        F.when(F.col("id") != 399, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("id"),
        day("id").alias("ingestion_date"))
    nulls = base.withColumn("id", F.nullif("id", F.lit(4)))
    for replace in (False, True):
        with pytest.raises(Exception, match="broken"):
            K.append_day_partition(broken, path, replace_day=replace)
        with pytest.raises(Exception, match="required column id holds nulls"):
            K.append_day_partition(nulls, path, replace_day=replace, required=["id"])
        assert rows(spark.read.parquet(path), "id") == [(i,) for i in range(9)]
    # A day that is replaced takes no other day with it.
    K.append_day_partition(base.filter("id = 4"), path, replace_day=True)
    assert rows(spark.read.parquet(path), "id") == [(0,), (2,), (3,), (4,), (5,), (6,), (8,)]
    assert os.listdir(scratch_dir) == ["days"]


def test_keyed_append_happens_once(spark, scratch_dir, monkeypatch):
    import pytest

    from cadenza.sources import storage

    path = os.path.join(scratch_dir, "days")
    rows_of = lambda k: spark.range(40 * k, 40 * k + 40).select(
        "id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("ingestion_date"))
    ids = lambda: sorted(r["id"] for r in spark.read.parquet(path).collect())
    assert K.append_day_partition(rows_of(0), path, commit_key=("w", 0))
    assert not K.append_day_partition(rows_of(0), path, commit_key=("w", 0))
    assert K.append_day_partition(rows_of(1), path, commit_key=("other", 0))
    real, left = storage.move, [2]

    def fails_third(s, a, b):
        left[0] -= 1
        if left[0] < 0:
            raise OSError("lost")
        real(s, a, b)

    with monkeypatch.context() as m:
        m.setattr(storage, "move", fails_third)
        with pytest.raises(OSError):
            K.append_day_partition(rows_of(2), path, commit_key=("w", 1))
    assert K.append_day_partition(rows_of(2), path, commit_key=("w", 1))      # the repeat
    assert not K.append_day_partition(rows_of(0), path, commit_key=("w", 0))
    assert ids() == list(range(120)) and os.listdir(scratch_dir) == ["days"]
