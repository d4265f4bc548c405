import pytest

from cadenza.operators.merge import merge_into_path, merge_matched
from conftest import rows


def test_merge_matched(spark):
    dim = spark.createDataFrame([("a", "A", 1), ("b", "B", 2), ("c", "C", 3)],
                                "id string, name string, pop long")
    src = spark.createDataFrame([("a", 10, 100), ("b", None, 200), ("z", 9, 9)],
                                "id string, pop long, fans long")
    out = merge_matched(dim, src, "id", {"pop": "pop", "fans": "fans"})
    assert out.columns == ["id", "name", "pop", "fans"]
    # matched rows take source values, a null source value overwrites, an
    # unmatched target row keeps its values, an unmatched source row is ignored
    assert rows(out) == [("a", "A", 10, 100), ("b", "B", None, 200), ("c", "C", 3, None)]


def test_merge_duplicate_source_key_raises(spark):
    dim = spark.createDataFrame([("a", 1)], "id string, pop long")
    src = spark.createDataFrame([("a", 5), ("a", 6), ("q", 1), ("q", 2)], "id string, pop long")
    with pytest.raises(ValueError):
        merge_matched(dim, src, "id", {"pop": "pop"})
    # duplicates that match nothing are not an error
    src2 = spark.createDataFrame([("a", 5), ("q", 1), ("q", 2)], "id string, pop long")
    assert rows(merge_matched(dim, src2, "id", {"pop": "pop"})) == [("a", 5)]


def test_merge_into_path(spark, scratch_dir):
    dim = spark.createDataFrame([("a", 1), ("b", 2)], "id string, pop long")
    src = spark.createDataFrame([("b", 7)], "id string, pop long")
    out = merge_into_path(dim, src, "id", {"pop": "pop"}, scratch_dir + "/v2")
    assert rows(out) == [("a", 1), ("b", 7)]
