"""Audio-feature style operators: range filters, standardisation, PCA."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.scalars import all_of, to_float32_array


def range_filter(df: DataFrame, ranges: dict, equals: dict | None = None) -> DataFrame:
    """Conjunction of closed ranges plus equalities; Catalyst
    combines it into one filter that reaches the parquet scan."""
    conds = [F.col(c).between(lo, hi) for c, (lo, hi) in ranges.items()]
    conds += [F.col(c) == F.lit(v) for c, v in (equals or {}).items()]
    return df.filter(all_of(*conds))


def _safe_std(std: Column) -> Column:
    # A constant column has std 0; divide by 1 instead (scikit-learn behaviour).
    return F.when(std.isNull() | (std == 0), F.lit(1.0)).otherwise(std)


def standardize(df: DataFrame, features, fit_on: DataFrame | None = None,
                suffix: str = "") -> DataFrame:
    """A10: (x - mean) / population std, statistics fitted on ``fit_on``
    (default ``df``). The statistics are one aggregate row, evaluated once as a
    scalar subquery and inlined, so there is no join. J8: the scaled values are
    added to the same rows (``suffix``) or replace the features."""
    fit_on = fit_on if fit_on is not None else df
    stats = fit_on.agg(F.struct(
        *[F.avg(f).alias(f"m{i}") for i, f in enumerate(features)],
        *[F.stddev_pop(f).alias(f"s{i}") for i, f in enumerate(features)])).scalar()
    # Bound once, so the plan holds a single subquery.
    out = df.withColumn("_stats", stats)
    for i, f in enumerate(features):
        z = (F.col(f) - F.col("_stats")[f"m{i}"]) / _safe_std(F.col("_stats")[f"s{i}"])
        out = out.withColumn(f + suffix, z)
    return out.drop("_stats")


def vector_stats(df: DataFrame, vec: str) -> tuple[list, list]:
    """Mean and population deviation (1 where constant) of each position of a
    vector column (null vectors do not count): one aggregate whose buffer holds d numbers, no
    row per entry."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    present = df.filter(F.col(vec).isNotNull())
    got = present.select(array_to_vector(F.col(vec).cast("array<double>")).alias("_v")).agg(
        Summarizer.metrics("mean", "variance", "count").summary(F.col("_v")).alias("s")).select(
        "s.mean", "s.variance", "s.count").first()
    n = got["count"]
    # The summary's variance divides by n - 1.
    std = [(v * (n - 1) / n) ** 0.5 if n > 1 else 0.0 for v in got["variance"]]
    return list(map(float, got["mean"])), [float(x) if x > 0 else 1.0 for x in std]


def _scaler(mean: list, std: list, dtype: str):
    """Arrow function: (vector - mean) / std, one matrix operation per batch."""
    def run(vectors):
        import numpy as np
        import pyarrow as pa

        held = vectors.drop_null()
        x = np.asarray(held.flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(-1, len(mean))
        z = ((x - np.array(mean)) / np.array(std)).astype(dtype).reshape(-1)
        ends = np.concatenate([[0], np.cumsum(np.where(vectors.is_valid(), len(mean), 0))])
        # A null offset marks a null vector.
        missing = np.append(vectors.is_null(), False)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32(), mask=missing), pa.array(z))
    return run


def standardize_array(df: DataFrame, vec: str, out: str | None = None,
                      fit_on: DataFrame | None = None, float32: bool = True) -> DataFrame:
    """A10 for a vector column (all vectors of one length; a null one stays null); F1: the
    result is cast to float32 like the index input of the reference."""
    mean, std = vector_stats(fit_on if fit_on is not None else df, vec)
    scale = F.arrow_udf(_scaler(mean, std, "float32" if float32 else "float64"),
                        "array<float>" if float32 else "array<double>")
    return df.withColumn(out or vec, scale(F.col(vec).cast("array<double>")))


def group_vector_means(df: DataFrame, group: str, vec: str, exclude=()) -> DataFrame:
    """A4 for a vector column (all vectors of one length; null ones do not count): per-group
    mean of each position. One aggregate whose buffer per group holds the d sums, combined in
    each task first, so a hot group costs one buffer per task and no row is made per entry."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    if exclude:
        df = df.filter(~F.col(group).isin(list(exclude)))
    return (df.filter(F.col(vec).isNotNull())
            .select(group, array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
            .groupBy(group).agg(vector_to_array(Summarizer.mean(F.col("_v"))).alias(vec)))


def pca_projection(df: DataFrame, vec: str, k: int = 3, prefix: str = "pc") -> DataFrame:
    """Project ``vec`` (already standardised, so centred) onto its first
    ``k`` principal components with ``pyspark.ml``. Signs are fixed so that
    the largest-magnitude loading of each component is positive."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    data = df.withColumn("_v", array_to_vector(F.col(vec).cast("array<double>")))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(data)
    loadings = model.pc.toArray()  # d x k, small
    signs = []
    for j in range(k):
        column = loadings[:, j]
        signs.append(1.0 if column[abs(column).argmax()] >= 0 else -1.0)
    projected = model.transform(data).withColumn("_a", vector_to_array("_p"))
    cols = [(F.col("_a")[j] * F.lit(signs[j])).alias(f"{prefix}{j + 1}") for j in range(k)]
    return projected.select(*[c for c in df.columns if c != vec], *cols)


def explained_variance(df: DataFrame, features) -> DataFrame:
    """Second moments of standardised feature columns: one row per pair of
    features with their correlation (the matrix whose eigenvectors are the
    components), from one aggregate."""
    features = list(features)
    pairs = [(a, b) for a in features for b in features]
    row = df.agg(*[F.avg(F.col(a) * F.col(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("feature"), F.lit(b).alias("other"), F.col(f"c{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)])).alias("_p")).select("_p.*")


def pca_of_group_means(df: DataFrame, group: str, features, k: int = 3, exclude=(),
                       prefix: str = "pc") -> DataFrame:
    """A4 + P17 + A10 + A11 for scalar feature columns: mean of each feature
    per group (excluded groups removed), standardised across the groups
    (population std), projected on the first ``k`` principal components.
    One partial aggregate over ``df``; the rest works on one row per group."""
    from cadenza.operators.aggregates import group_means
    from cadenza.sources.sinks import land_table

    # One row per group: kept, as the scaler, the fit and the projection all read it.
    means = land_table(group_means(df, group, features, exclude=exclude), "group_means")
    scaled = standardize(means, list(features))
    vectors = scaled.select(group, F.array(*[F.col(f).cast("double") for f in features])
                            .alias("_v"))
    return pca_projection(vectors, "_v", k=k, prefix=prefix)

