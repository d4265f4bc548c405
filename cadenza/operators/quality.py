"""Declared data tests and required-field checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null_failures(df: DataFrame, col: str) -> DataFrame:
    """Q1: rows whose ``col`` is null (a test passes when this is empty)."""
    return df.filter(F.col(col).isNull())


def unique_failures(df: DataFrame, col: str) -> DataFrame:
    """Q2: non-null values that occur more than once, with their count."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1))


def summarize_tests(df: DataFrame, tests) -> DataFrame:
    """Run several tests (pairs of kind, column): all not_null tests share one
    aggregate pass, each unique test is one grouped pass. Returns
    (test, column_name, failures) in the order given."""
    tests = list(tests)
    for kind, _ in tests:
        if kind not in ("not_null", "unique"):
            raise ValueError(f"unknown test {kind!r}")
    parts = []
    nn_cols = [c for kind, c in tests if kind == "not_null"]
    if nn_cols:
        counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_nn{i}")
                          for i, c in enumerate(nn_cols)])
        entries = F.array(*[F.struct(F.lit("not_null").alias("test"),
                                     F.lit(c).alias("column_name"),
                                     F.col(f"_nn{i}").cast("long").alias("failures"))
                            for i, c in enumerate(nn_cols)])
        parts.append(counts.select(F.explode(entries).alias("_t")).select("_t.*"))
    for kind, col in tests:
        if kind == "unique":
            parts.append(unique_failures(df, col)
                         .agg(F.count(F.lit(1)).cast("long").alias("failures"))
                         .select(F.lit(kind).alias("test"), F.lit(col).alias("column_name"),
                                 "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reject_nulls(df: DataFrame, cols) -> DataFrame:
    """``df`` whose evaluation fails at the first null in one of ``cols``: the check of
    required fields in the write's own pass, before anything is committed."""
    checked = {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"required column {c} holds nulls"))
                             .cast(df.schema[c].dataType)).alias(c) for c in cols}
    return df.select(*[checked.get(c, F.col(c)) for c in df.columns]) if checked else df


def require_not_null(df: DataFrame, cols) -> DataFrame:
    """Enforce REQUIRED fields before a write; raises if any is null.
    Checks all columns in one aggregate pass."""
    cols = list(cols)
    if not cols:
        return df
    nulls = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols]).first()
    bad = {c: nulls[c] for c in cols if nulls[c]}
    if bad:
        raise ValueError(f"required fields contain nulls: {bad}")
    return df


def run_data_tests(df: DataFrame, spec) -> DataFrame:
    """Declared data tests, as a schema file lists them: ``spec`` is a list of
    (column, [test, ...]) with tests ``not_null`` / ``unique``. Returns one row
    per test: (column_name, test, status, failures) where status is ``pass``,
    ``fail`` or ``error`` (the column does not exist; failures is null). All
    runnable tests share the passes of :func:`summarize_tests`."""
    spark = df.sparkSession
    runnable = [(kind, col) for col, kinds in spec for kind in kinds if col in df.columns]
    missing = [(col, kind) for col, kinds in spec for kind in kinds if col not in df.columns]
    parts = []
    if runnable:
        counted = summarize_tests(df, runnable)
        parts.append(counted.select(
            "column_name", "test",
            F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail"))
            .alias("status"), "failures"))
    if missing:
        parts.append(spark.createDataFrame(
            [(c, k, "error", None) for c, k in missing],
            "column_name string, test string, status string, failures long"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

