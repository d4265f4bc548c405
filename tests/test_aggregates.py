import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadenza.operators import aggregates as A
from cadenza.operators import quality as Q
from cadenza.operators.numbering import assign_batches, global_cumsum, global_row_number
from cadenza.operators.profile import column_profile, describe_numeric
from conftest import rows


def test_distinct_ids_drops_null_and_empty(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), ("a",), ("b",)], "id string")
    assert rows(A.distinct_ids(df, "id")) == [("a",), ("b",)]


def test_first_per_key(spark):
    df = spark.createDataFrame(
        [(3, "song", "x"), (1, "song", "y"), (2, "other", "z"), (1, "song", "a")],
        "row_id int, title string, artist string")
    out = A.first_per_key(df, "title", "row_id")
    assert out.columns == df.columns
    # smallest row_id wins; a tie on row_id is broken by the remaining columns
    assert rows(out) == [(1, "song", "a"), (2, "other", "z")]


def test_value_counts_order(spark):
    df = spark.createDataFrame([("rock",), ("pop",), ("rock",), (None,), ("jazz",),
                                ("pop",)], "g string")
    out = A.value_counts(df, "g", names=("genre", "count")).collect()
    assert [tuple(r) for r in out] == [("pop", 2), ("rock", 2), ("jazz", 1)]


def test_group_bounds_and_global(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", -2.0)], "g string, x double")
    out = A.with_global_bounds(A.group_bounds(df, "g", ["x"]), df, "x")
    assert rows(out) == [("a", 1.0, 3.0, -2.0, 3.0), ("b", -2.0, -2.0, -2.0, 3.0)]


def test_group_means_exclusion(spark):
    df = spark.createDataFrame([("sleep", 1.0), ("rock", 2.0), ("rock", 4.0)],
                               "g string, x double")
    assert rows(A.group_means(df, "g", ["x"], exclude=["sleep", "comedy"])) == [("rock", 3.0)]


def test_exactly_one_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id int, v string")
    assert A.exactly_one(df.filter("id = 1"))["v"] == "a"
    with pytest.raises(ValueError):
        A.exactly_one(df.filter("id = 2"))
    with pytest.raises(ValueError):
        A.exactly_one(df.filter("id = 3"))
    assert A.is_empty(df.filter("id = 3")) and not A.is_empty(df)
    assert A.row_count(df).first()["n_rows"] == 3


def test_quality_tests(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "name string")
    assert Q.not_null_failures(df, "name").count() == 1
    assert rows(Q.unique_failures(df, "name")) == [("a", 2)]
    summary = {(r["test"], r["column_name"]): r["failures"] for r in
               Q.summarize_tests(df, [("not_null", "name"), ("unique", "name")]).collect()}
    assert summary == {("not_null", "name"): 1, ("unique", "name"): 1}
    with pytest.raises(ValueError):
        Q.require_not_null(df, ["name"])
    Q.require_not_null(df.dropna(), ["name"])


def test_global_row_number_and_batches(spark):
    ids = spark.range(0, 1234).select((F.col("id") * 7 % 1234).alias("k"))
    numbered = global_row_number(ids, ["k"], num_partitions=5)
    got = sorted((r["k"], r["rn"]) for r in numbered.collect())
    assert got == [(k, k + 1) for k in range(1234)]
    batches = assign_batches(ids, "k", 50)
    sizes = batches.groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in sizes] == [50] * 24 + [34]


def test_global_cumsum_weighted(spark):
    pdf = pd.DataFrame({"k": np.arange(500)[::-1], "w": (np.arange(500) % 9) + 1})
    df = spark.createDataFrame(pdf)
    got = {r["k"]: r["cum"] for r in global_cumsum(df, ["k"], "w", num_partitions=4).collect()}
    expect = pdf.sort_values("k")
    expect = dict(zip(expect["k"], expect["w"].cumsum()))
    assert got == expect


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.integers(0, 5, 301).astype(float),   # heavy ties
                        "b": rng.normal(10, 3, 301),
                        "c": [None if i % 10 == 0 else float(i) for i in range(301)]})
    df = spark.createDataFrame(pdf)
    got = {r["column"]: r for r in describe_numeric(df).collect()}
    ref = pdf.describe()
    for col in "abc":
        for stat, name in (("count", "count"), ("mean", "mean"), ("std", "std"),
                           ("min", "min"), ("25%", "p25"), ("50%", "p50"), ("75%", "p75"),
                           ("max", "max")):
            assert math.isclose(got[col][name], ref.loc[stat, col], rel_tol=1e-9,
                                abs_tol=1e-9), (col, stat)


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    assert rows(column_profile(df)) == [(0, "a", "bigint", 2, 2), (1, "b", "string", 1, 2)]


def test_describe_text(spark):
    from cadenza.operators.profile import describe_text
    pdf = pd.DataFrame({"g": ["rock", "pop", "rock", None, "jazz", "rock"],
                        "h": ["b", "a", "a", "b", None, None]})
    got = {r["column"]: r for r in describe_text(spark.createDataFrame(pdf)).collect()}
    ref = pdf.describe()
    assert got["g"]["count"] == ref.loc["count", "g"] == 5
    assert got["g"]["unique"] == ref.loc["unique", "g"] == 3
    assert got["g"]["top"] == ref.loc["top", "g"] == "rock"
    assert got["g"]["freq"] == ref.loc["freq", "g"] == 3
    # tie on frequency: the smallest value is reported
    assert got["h"]["top"] == "a" and got["h"]["freq"] == 2 and got["h"]["unique"] == 2


def test_run_data_tests(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "name string, id int")
    spec = [("name", ["not_null", "unique"]), ("id", ["not_null"]), ("gone", ["not_null"])]
    got = {(r["column_name"], r["test"]): (r["status"], r["failures"])
           for r in Q.run_data_tests(df, spec).collect()}
    assert got == {("name", "not_null"): ("fail", 1), ("name", "unique"): ("fail", 1),
                   ("id", "not_null"): ("fail", 1), ("gone", "not_null"): ("error", None)}


def test_describe_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "x double, y double")
    got = {r["column"]: r for r in describe_numeric(df).collect()}
    assert got["y"]["count"] == 0 and got["y"]["mean"] is None and got["y"]["p50"] is None
    assert got["x"]["count"] == 2 and got["x"]["p50"] == 2.0 and got["x"]["std"] > 0
