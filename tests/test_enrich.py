import json

import pytest
from pyspark.sql import functions as F

from cadenza.operators.enrich import FAILED, enrich_batches, enrich_children, request_batches
from cadenza.plans.queries import flatten_tracks
from cadenza.plans.responders import TRACKS_BODY_SCHEMA
from conftest import rows

SCHEMA = "id string, name string, nb_fan long"


def lookup(ids):
    for i in ids:
        if i == "bad":
            yield i, 200, json.dumps({"error": {"code": 800}})
        elif i == "gone":
            yield i, 404, ""
        elif i == "html":
            yield i, 200, "<html>"
        elif i == "noid":
            yield i, 200, json.dumps({"name": "x"})
        else:
            yield i, 200, json.dumps({"id": i, "name": f"n{i}", "nb_fan": len(i)})


def test_enrich_drops_failures(spark):
    ids = spark.createDataFrame([(x,) for x in ["a", "bb", "bad", "gone", "html", "noid"]],
                                "id string")
    out = enrich_batches(ids, "id", lookup, SCHEMA, batch_size=2, max_parallel=2)
    assert rows(out, "id", "name", "nb_fan") == [("a", "na", 1), ("bb", "nbb", 2)]


def test_batches_are_bounded_and_errors(spark):
    seen = []

    def record(ids):
        if len(ids) > 3:
            raise AssertionError("batch too large")
        for i in ids:
            yield i, 200, json.dumps({"size": len(ids)})

    ids = spark.range(0, 10).select(F.col("id").cast("string").alias("id")).coalesce(1)
    raw = request_batches(ids, "id", record, batch_size=3, on_error="raise")
    sizes = sorted(json.loads(r["body"])["size"] for r in raw.collect())
    assert sizes == [1] + [3] * 9
    assert not seen

    def broken(ids):
        raise RuntimeError("service down")

    # Failures are rows of their own; by default they fail the job.
    lost = request_batches(ids, "id", broken, 3, on_error="drop").collect()
    assert len(lost) == 10 and {r["status"] for r in lost} == {FAILED}
    with pytest.raises(Exception):
        request_batches(ids, "id", broken, 3).count()


def test_one_failing_id_costs_one_id(spark):
    def fails_on_five(ids):
        if "5" in ids:
            raise RuntimeError("no answer")
        for i in ids:
            yield i, 200, json.dumps({"id": i})

    ids = spark.range(0, 1000).select(F.col("id").cast("string").alias("id")).coalesce(1)
    raw = request_batches(ids, "id", fails_on_five, 500, on_error="drop").collect()
    assert sorted(r["request_id"] for r in raw if r["status"] == FAILED) == ["5"]
    assert len(raw) == 1000
    assert enrich_batches(ids, "id", fails_on_five, "id string", on_error="drop").count() == 999


def test_batches_run_over_the_whole_partition(spark):
    """Batches larger than an Arrow record batch (10,000 rows) are not cut by it."""
    def size(ids):
        yield ids[0], 200, str(len(ids))

    ids = spark.range(0, 25_000, 1, 1).select(F.col("id").cast("string").alias("id"))
    assert sorted(int(r["body"]) for r in request_batches(ids, "id", size, 20_000).collect()) == [5_000, 20_000]


def test_children_flatten(spark):
    def tracks(ids):
        for i in ids:
            if i == "404":
                yield i, 404, ""
                continue
            yield i, 200, json.dumps({"tracks": [
                {"id": "t1", "name": "one", "popularity": 5,
                 "artists": [{"id": "a1", "name": "A1"}, {"id": "a2", "name": "A2"}],
                 "available_markets": ["FR", "US"],
                 "external_urls": {"spotify": "u1"}, "external_ids": {"isrc": "I1"}},
                {"id": "t2", "name": "two", "artists": []}]})

    ids = spark.createDataFrame([("x",), ("404",)], "id string")
    flat = flatten_tracks(enrich_children(ids, "id", tracks, "tracks", TRACKS_BODY_SCHEMA))
    got = {r["spotify_track_id"]: r for r in flat.collect()}
    assert set(got) == {"t1", "t2"}
    assert got["t1"]["spotify_track_artists"] == "a1,a2"
    assert got["t1"]["spotify_track_artist_names"] == "A1,A2"
    assert got["t1"]["spotify_track_markets"] == "FR,US"
    assert got["t1"]["spotify_track_url"] == "u1" and got["t1"]["spotify_track_upc"] is None
    assert got["t2"]["spotify_track_artists"] is None      # empty list -> null
    assert got["t2"]["spotify_track_markets"] == ""        # missing list -> ''
    assert got["t2"]["spotify_track_url"] is None          # missing parent -> null


def _calls(log):
    with open(log) as fh:
        return [line.split(",") for line in fh.read().splitlines()]


def test_ledger_asks_again_only_for_what_failed(spark, scratch_dir):
    """A service that fails once half way: one answer per id, and no more calls than ids plus
    one batch per failed call."""
    import os

    import pytest

    from cadenza.operators import enrich as E
    from conftest import rows

    log, mark = os.path.join(scratch_dir, "calls"), os.path.join(scratch_dir, "failed")

    def service(ids):
        with open(log, "a") as fh:
            fh.write(",".join(ids) + "\n")
        if "77" in ids and not os.path.exists(mark):
            open(mark, "w").close()
            raise ConnectionError("down")
        for i in ids:
            if i != "13":                       # left out by the service
                yield i, 200 if int(i) % 10 else 404, '{"id": "%s"}' % i

    ids = spark.range(150).union(spark.range(30)).union(spark.createDataFrame([(None,)], "id long"))
    ledger = os.path.join(scratch_dir, "ledger")
    out = E.enrich_batches(ids, "id", service, "id string", batch_size=10, max_parallel=3, ledger=ledger)
    good = [(str(i), str(i)) for i in range(150) if i % 10 and i != 13]
    assert rows(out) == sorted(good)
    asked = [i for c in _calls(log) for i in c]
    assert sorted(set(asked), key=int) == [str(i) for i in range(150)] and len(asked) <= 150 + 10
    answered = E.read_ledger(spark, ledger).filter("status <> -1").groupBy("request_id").count()
    assert answered.count() == 150 and answered.filter("count > 1").count() == 0
    # A rerun asks for new ids only.
    E.enrich_batches(spark.range(140, 155), "id", service, "id string", batch_size=10, ledger=ledger)
    assert sorted(i for c in _calls(log) for i in c)[-5:] and \
        {i for c in _calls(log) for i in c} - set(asked) == {str(i) for i in range(150, 155)}

    def broken(ids):
        raise TimeoutError("never")

    more = spark.range(149, 200)
    with pytest.raises(RuntimeError, match="45 ids have no answer"):
        E.answer_all(more, "id", broken, ledger, attempts=2)
    some = E.answer_all(more, "id", broken, ledger, attempts=1, on_error="drop")
    assert rows(some, "request_id") == [(str(i),) for i in range(149, 155)]


def test_ledger_in_rounds(spark, scratch_dir):
    import os

    from cadenza.operators import enrich as E

    log = os.path.join(scratch_dir, "calls")

    def service(ids):
        with open(log, "a") as fh:
            fh.write(",".join(ids) + "\n")
        yield from ((i, 200, "{}") for i in ids)

    got = E.answer_all(spark.range(300), "id", service, os.path.join(scratch_dir, "ledger"), batch_size=7,
                       max_parallel=2, batches_per_task=3)
    assert got.count() == 300 and sorted(int(i) for c in _calls(log) for i in c) == list(range(300))
    assert max(len(c) for c in _calls(log)) <= 7
    assert E.answer_all(spark.range(0), "id", service, os.path.join(scratch_dir, "none")).count() == 0


def _answer_each(ids):
    yield from ((i, 200, "{}") for i in ids)


def test_fast_service_is_asked_in_few_rounds(spark, scratch_dir):
    """Rounds that end soon grow, so that the number of Spark writes does not follow the ids."""
    import os

    from cadenza.operators import enrich as E

    ledger = os.path.join(scratch_dir, "ledger")
    got = E.answer_all(spark.range(60), "id", _answer_each, ledger, batch_size=1, max_parallel=1, batches_per_task=1)
    assert sorted(int(r.request_id) for r in got.collect()) == list(range(60))
    assert len([f for f in os.listdir(ledger) if f.endswith(".parquet")]) <= 7      # one file per write


@pytest.mark.parametrize("seconds, writes", [(30, 1), (0, 4)])
def test_failed_call_costs_its_turn_in_any_round(spark, scratch_dir, monkeypatch, seconds, writes):
    import os

    from cadenza.operators import enrich as E

    log, ledger = os.path.join(scratch_dir, "calls"), os.path.join(scratch_dir, "ledger")

    def service(ids):
        with open(log, "a") as fh:
            fh.write(",".join(ids) + "\n")
        if "7" in ids:
            raise ConnectionError("down")
        yield from ((i, 200, "{}") for i in ids)

    monkeypatch.setattr(E, "ROUND_SECONDS", seconds)
    monkeypatch.setattr(E, "MAX_ROUNDS", writes)
    got = E.answer_all(spark.range(200), "id", service, ledger, batch_size=5, max_parallel=1, batches_per_task=2,
                       attempts=1, on_error="drop")
    left = {str(i) for i in range(200)} - {r.request_id for r in got.collect()}
    assert "7" in left and len(left) <= 10 and max(len(c) for c in _calls(log)) <= 5
    # The next run asks for those only.
    got = E.answer_all(spark.range(200), "id", _answer_each, ledger, batch_size=5, max_parallel=1)
    assert got.count() == 200 and got.distinct().count() == 200
    assert E.read_ledger(spark, ledger).filter("status = 200").count() == 200
