import numpy as np
import pytest
from pyspark.sql import functions as F

from seqprep.operators import analysis as N

VECTORS = "token_id long, embedding array<float>"


def test_similarity(spark):
    src = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [1.0, 1.0])], VECTORS)
    tgt = spark.createDataFrame([(1, [0.0, 2.0]), (2, [2.0, 2.0]), (3, [1.0, 0.0])], VECTORS)
    got = {r["token_id"]: r["similarity"] for r in N.embedding_similarity(src, tgt).collect()}
    assert got[1] == 0 and got[2] == pytest.approx(1) and got[3] is None and 4 not in got
    wanted = spark.createDataFrame([(2, "two"), (99, "beyond")], "token_id long, word string")
    assert [(r["word"], r["token_id"]) for r in N.embedding_similarity(src, tgt, wanted).collect()] == [("two", 2)]


@pytest.mark.parametrize(
    "other, same",
    [
        ([(1, [1.0, 2.0]), (2, [3.0])], True),
        ([(1, [1.000001, 2.0]), (2, [3.0])], True),
        ([(1, [1.001, 2.0]), (2, [3.0])], False),
        ([(1, [1.0, 2.0])], False),
        ([(1, [1.0]), (2, [3.0])], False),
        ([(1, [1.0, float("nan")]), (2, [3.0])], False),
        ([(1, [1.0, 2.0]), (2, [3.0]), (3, [1.0])], False),
    ],
)
def test_tables_close(spark, other, same):
    src = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0])], VECTORS)
    assert N.tables_close(src, spark.createDataFrame(other, VECTORS)).head()["is_shared"] is same


def test_empty_tables_are_close(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert N.tables_close(empty, empty).head()["is_shared"] is True


def test_parameters(spark):
    rows = [("w", True, [1.0, -3.0]), ("w", True, [2.0]), ("b", False, [7.0, 7.0])]
    df = spark.createDataFrame(rows, "tensor string, trainable boolean, values array<float>")
    assert tuple(N.param_counts(df).head()) == (5, 3)
    assert [tuple(r) for r in N.param_magnitudes(df).collect()] == [("w", 2.0, 3.0)]
    assert tuple(N.param_counts(df.limit(0)).head()) == (0, 0)


def test_pca_is_centred_and_matches_numpy(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(60, 5)) * [5, 3, 1, 1, 1] + [10, -4, 0, 0, 2]
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "token_id long, embedding array<double>")
    got = np.array([(r["pc1"], r["pc2"]) for r in N.pca_project(df, 2).orderBy("token_id").collect()])
    centred = points - points.mean(axis=0)
    _, scale, axes = np.linalg.svd(centred, full_matrices=False)
    signs = np.sign(axes[np.arange(2), np.abs(axes[:2]).argmax(axis=1)])
    assert np.allclose(got, centred @ axes[:2].T * signs)
    assert np.allclose(got.mean(axis=0), 0)
    shares = [r["ratio"] for r in N.explained_variance(df, 2).orderBy("component").collect()]
    assert np.allclose(shares, (scale**2 / (scale**2).sum())[:2])


def test_labelled_projection(spark):
    df = spark.range(20).select(
        F.col("id"), F.lit(0).alias("pos"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("embedding")
    )
    labels = spark.createDataFrame([(3, 0, "cat"), (99, 0, "none")], "id long, pos int, token string")
    got = N.labelled_projection(df, labels, 1).collect()
    assert [(r["id"], r["token"]) for r in got] == [(3, "cat")] and got[0]["pc1"] == pytest.approx(3 - 9.5)


def test_pca_of_vectors_wider_than_the_block(spark, monkeypatch):
    """More dimensions than trial axes: subspace iteration has to find them."""
    monkeypatch.setattr(N, "GUARD", 6)
    rng = np.random.default_rng(6)
    points = rng.normal(size=(300, 40)) * np.linspace(4, 0.5, 40) + 3
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "token_id long, embedding array<double>").repartition(5)
    fitted = N.fit_pca(df, 3)
    centred = points - points.mean(axis=0)
    _, scale, axes = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.abs(fitted.axes.T @ axes[:3].T), np.eye(3), atol=1e-9)
    assert np.allclose(fitted.explained_variance, (scale**2 / (scale**2).sum())[:3])
    got = np.array([r["pc3"] for r in fitted.transform(df).orderBy("token_id").collect()])
    assert np.allclose(np.abs(got), np.abs(centred @ axes[2]))


def test_pca_passes_over_unusable_vectors(spark):
    good = [(i, [float(i), float(i % 3)]) for i in range(9)]
    bad = [(90, None), (91, [1.0]), (92, [float("nan"), 1.0]), (93, [None, 1.0]), (94, [])]
    made = {r["token_id"]: r for r in N.pca_project(spark.createDataFrame(good + bad, VECTORS), 1).collect()}
    want = {r["token_id"]: r["pc1"] for r in N.pca_project(spark.createDataFrame(good, VECTORS), 1).collect()}
    assert {k: made[k]["pc1"] for k in want} == pytest.approx(want)
    assert all(made[k]["pc1"] is None for k, _ in bad)
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], VECTORS)
    assert {r["pc1"] for r in N.pca_project(same, 1).collect()} == {0.0} and N.fit_pca(same, 1).explained_variance == [0.0]
    for empty in (same.limit(0), spark.createDataFrame([(1, None)], VECTORS), spark.createDataFrame([(1, [float("inf")])], VECTORS)):
        with pytest.raises(ValueError):
            N.fit_pca(empty)
