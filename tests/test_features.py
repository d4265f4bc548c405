import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cadenza.operators import features as FT
from cadenza.operators.similarity import nearest
from conftest import SF_CHECK, rows


def test_standardize_population_std_and_constant(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 3.0, 10.0], "c": [5.0] * 4})
    out = FT.standardize(spark.createDataFrame(pdf), ["x", "c"], suffix="_z").toPandas()
    x = pdf["x"].to_numpy()
    assert np.allclose(out["x_z"], (x - x.mean()) / x.std(ddof=0))
    assert np.allclose(out["c_z"], 0.0)   # zero variance: divided by 1
    assert np.allclose(out["x"], x)       # J8: original columns kept


def test_range_filter(spark):
    df = spark.createDataFrame([(0.5, 0.1, "rock"), (0.9, 0.2, "rock"), (0.5, 0.1, "pop")],
                               "dance double, energy double, genre string")
    out = FT.range_filter(df, {"dance": (0.4, 0.6), "energy": (0.1, 0.1)},
                          equals={"genre": "rock"})
    assert rows(out) == [(0.5, 0.1, "rock")]


def test_knn_matches_numpy_bruteforce(spark):
    emb = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    pdf = emb.toPandas().sort_values("vec_id")
    X = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
    Z = ((X - X.mean(0)) / np.where(X.std(0) == 0, 1, X.std(0))).astype(np.float32)
    ids = pdf["vec_id"].to_numpy()
    q = Z[ids == 7][0].astype(np.float64)
    d = ((Z.astype(np.float64) - q) ** 2).sum(1)
    order = np.lexsort((ids, d))[:10]      # by the raw distance
    got = nearest(emb, "vec_id", "embedding", 7, k=10).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == list(ids[order])
    assert got[0]["vec_id"] == 7 and got[0]["distance"] == 0.0   # the query itself
    assert np.allclose([r["distance"] for r in got], np.round(d[order], 4), atol=1e-4)


def test_knn_excluding_self(spark):
    emb = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    got = nearest(emb, "vec_id", "embedding", 7, k=3, include_self=False).collect()
    assert 7 not in [r["vec_id"] for r in got] and len(got) == 3


def test_pca_matches_numpy_svd(spark):
    emb = spark.read.parquet(f"{SF_CHECK}/embeddings.parquet")
    means = FT.group_vector_means(emb, "label", "embedding")
    scaled = FT.standardize_array(means, "embedding", float32=False)
    got = FT.pca_projection(scaled, "embedding", k=3).orderBy("label").toPandas()
    pdf = emb.toPandas()
    M = np.stack(pdf.groupby("label")["embedding"].apply(
        lambda s: np.stack(s.to_numpy()).astype(np.float64).mean(0)).to_numpy())
    S = (M - M.mean(0)) / np.where(M.std(0) == 0, 1, M.std(0))
    _, _, vt = np.linalg.svd(S - S.mean(0), full_matrices=False)
    comps = vt[:3]
    for j in range(3):
        if comps[j][np.abs(comps[j]).argmax()] < 0:
            comps[j] = -comps[j]
    ref = S @ comps.T
    assert np.allclose(got[["pc1", "pc2", "pc3"]].to_numpy(), ref, atol=1e-8)
    # invariants: variance decreasing
    var = got[["pc1", "pc2", "pc3"]].var().to_numpy()
    assert var[0] >= var[1] >= var[2]


def test_group_vector_means(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 4.0]), ("b", [0.0, 1.0])],
                               "g string, v array<double>")
    got = {r["g"]: r["v"] for r in FT.group_vector_means(df, "g", "v").collect()}
    assert got == {"a": [2.0, 3.0], "b": [0.0, 1.0]}
    assert F is not None


def test_pca_of_group_means_matches_numpy(spark):
    li = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet").select(
        "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    got = (FT.pca_of_group_means(li, "l_suppkey", feats, k=3, exclude=[0])
           .orderBy("l_suppkey").toPandas())
    pdf = li.toPandas()
    M = pdf[pdf.l_suppkey != 0].groupby("l_suppkey")[feats].mean().sort_index()
    S = ((M - M.mean()) / M.std(ddof=0)).to_numpy()
    _, _, vt = np.linalg.svd(S - S.mean(0), full_matrices=False)
    comps = vt[:3]
    for j in range(3):
        if comps[j][np.abs(comps[j]).argmax()] < 0:
            comps[j] = -comps[j]
    assert list(got["l_suppkey"]) == list(M.index)
    assert np.allclose(got[["pc1", "pc2", "pc3"]].to_numpy(), S @ comps.T, atol=1e-8)



def test_similar_tracks_flow(spark):
    import pytest

    from cadenza.plans.similarity import clean_tracks, similar_tracks
    raw = spark.createDataFrame(
        [(1, 1, "A", "song", 0.1, 10.0), (2, 2, "B", "song", 0.9, 90.0),    # duplicate title
         (3, 3, "A", "other", 0.2, 12.0), (4, 4, "C", "far", 0.95, 99.0),
         (5, 5, "D", "near", 0.12, 10.5), (6, 6, "E", None, 0.5, 50.0)],     # null dropped
        "track_id long, row_order long, artist string, title string, dance double, tempo double")
    tracks = clean_tracks(raw, "title", "row_order")
    assert sorted(r["track_id"] for r in tracks.collect()) == [1, 3, 4, 5]
    hits = similar_tracks(tracks, "track_id", "artist", "title", ["dance", "tempo"], "A",
                          "song", display=["artist", "title"], k=3).collect()
    assert [r["rank"] for r in hits] == [1, 2, 3]
    assert hits[0]["track_id"] == 1 and hits[0]["distance"] == 0.0
    assert [r["track_id"] for r in hits[1:]] == [5, 3]
    with pytest.raises(ValueError):
        similar_tracks(tracks, "track_id", "artist", "title", ["dance", "tempo"], "B", "song",
                       display=["artist"])


def test_vector_scaling_and_group_means_with_nulls(spark):
    import numpy as np

    df = spark.createDataFrame([(1, "a", [1.0, 5.0]), (2, "a", [3.0, 5.0]), (3, "b", None), (4, "b", [8.0, 5.0]),
                                (5, "c", None)], "id int, g string, v array<float>")
    for f32, kind in ((True, "array<float>"), (False, "array<double>")):
        out = FT.standardize_array(df, "v", "z", float32=f32)
        assert dict(out.dtypes)["z"] == kind
        got = {r["id"]: r["z"] for r in out.collect()}
        std = np.std([1, 3, 8])
        assert got[3] is None and got[5] is None
        assert np.allclose([got[i] for i in (1, 2, 4)], [[-3 / std, 0], [-1 / std, 0], [4 / std, 0]], atol=1e-6)
    means = {r["g"]: r["v"] for r in FT.group_vector_means(df, "g", "v").collect()}
    assert means == {"a": [2.0, 5.0], "b": [8.0, 5.0]}
    plan = FT.group_vector_means(df, "g", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
