"""Property tests: the scale-oriented rewrites equal their naive forms."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cadenza.operators import joins as J
from cadenza.operators.aggregates import first_per_key
from cadenza.operators.numbering import global_row_number
from conftest import rows

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.integers(0, 4))


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(0, 9)), max_size=25),
       st.lists(st.tuples(keys, st.integers(0, 9)), max_size=60))
def test_balanced_left_join_equals_left_join(spark, left_rows, right_rows):
    left = spark.createDataFrame(left_rows, "k int, a int")
    right = spark.createDataFrame(right_rows, "k int, b int")
    plain = left.join(right, "k", "left")
    assert rows(J.left_join_balanced(left, right, "k")) == rows(plain)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.text(max_size=2)),
                min_size=1, max_size=30))
def test_first_per_key_equals_window(spark, data):
    df = spark.createDataFrame(data, "g int, o int, v string")
    got = rows(first_per_key(df, "g", "o"))
    want = {}
    for g, o, v in sorted(data, key=lambda t: (t[0], t[1], t[2])):
        want.setdefault(g, (g, o, v))
    assert got == sorted(want.values())


@SETTINGS
@given(st.sets(st.integers(-1000, 1000), min_size=1, max_size=80), st.integers(1, 5))
def test_global_row_number_is_rank(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "k int")
    got = sorted((r["k"], r["rn"]) for r in global_row_number(df, ["k"], num_partitions=parts)
                 .collect())
    assert got == [(v, i + 1) for i, v in enumerate(sorted(values))]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=60),
       st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=2, max_size=40))
def test_exact_quantiles_equal_numpy(spark, ints, floats):
    import numpy as np

    from cadenza.operators.profile import exact_quantiles
    n = max(len(ints), len(floats))
    data = [(ints[i] if i < len(ints) else None, floats[i] if i < len(floats) else None)
            for i in range(n)]
    df = spark.createDataFrame(data, "a int, b double")
    got = {(r["column"], r["p"]): r["q"] for r in exact_quantiles(df, ["a", "b"]).collect()}
    for col, values in (("a", [v for v in ints if v is not None]), ("b", floats)):
        for p in (0.25, 0.5, 0.75):
            if not values:
                assert (col, p) not in got
                continue
            want = float(np.percentile(np.array(values, dtype=float), p * 100))
            assert abs(got[(col, p)] - want) <= 1e-9 * max(1.0, abs(want)), (col, p)


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(0, 9)), max_size=25),
       st.lists(st.tuples(keys, st.integers(0, 9)), max_size=60))
def test_balanced_join_named_keys(spark, left_rows, right_rows):
    left = spark.createDataFrame(left_rows, "lk int, a int")
    right = spark.createDataFrame(right_rows, "rk int, b int")
    plain = left.join(right, left.lk == right.rk, "left")
    balanced = J.left_join_balanced(left, right, "lk", "rk")
    assert rows(balanced, "lk", "a", "rk", "b") == rows(plain, "lk", "a", "rk", "b")


@SETTINGS
@given(st.dictionaries(st.integers(0, 8), st.integers(0, 5), max_size=8),
       st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.integers(10, 15)), max_size=8))
def test_merge_matched_equals_model(spark, target, source):
    from cadenza.operators.merge import merge_matched
    t = spark.createDataFrame([(k, v) for k, v in target.items()] or [(None, None)],
                              "id int, pop int").filter("id is not null")
    s = spark.createDataFrame([(k, v) for k, v in source.items()] or [(None, None)],
                              "id int, pop int").filter("id is not null")
    got = sorted((r["id"], r["pop"]) for r in merge_matched(t, s, "id", {"pop": "pop"}).collect())
    want = sorted((k, source[k] if k in source else v) for k, v in target.items())
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "dd"])), min_size=1,
                max_size=40))
def test_describe_text_equals_model(spark, values):
    from collections import Counter

    from cadenza.operators.profile import describe_text
    df = spark.createDataFrame([(v,) for v in values], "g string")
    got = describe_text(df).collect()
    present = [v for v in values if v is not None]
    if not present:
        assert got == []
        return
    counts = Counter(present)
    top = min(counts, key=lambda v: (-counts[v], v))
    r = got[0]
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (
        len(present), len(counts), top, counts[top])
