"""Whitening against a dense decomposition."""

import numpy as np
import pytest

from seqprep.llm import whitening
from tests.llm.cases import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, wanted=4):
    """vec_id -> (deviation, whitened), and n and explained, by numpy."""
    x = {k: [int(np.floor(256 * np.float64(np.float32(c)))) for c in v] for k, v in rows}
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=np.int64)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    points = {k: ((np.array(v) - total / n) @ vectors / np.sqrt(values)) for k, v in x.items()}
    deviation = {k: sum(int(n * a - s) ** 2 for a, s in zip(v, total.tolist())) for k, v in x.items()}
    return n, deviation, points, values / np.trace(covariance)


def vectors(n=300, size=48, seed=1):
    rng = np.random.default_rng(seed)
    spread = np.linspace(3, 0.5, size)
    return [(k, (rng.normal(size=size) * spread * 0.2 + 0.1).astype(np.float32).tolist()) for k in range(n)]


def check(made, rows, wanted=4):
    n, deviation, points, explained = plain(rows, wanted)
    found = {}
    for r in made:
        assert r.n == n and r.deviation == deviation[r.vec_id] and 0 <= r.identity_error <= 1e-4
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-10
        found.setdefault(r.component, {})[r.vec_id] = r.whitened
    assert sorted(found) == list(range(1, wanted + 1))
    for c, own in found.items():
        assert own.keys() == points.keys()
        a, b = np.array([own[k] for k in sorted(own)]), np.array([points[k][c - 1] for k in sorted(own)])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8


def test_whitening(spark):
    rows = vectors()
    bad = [(900, None), (901, [1.0] * 47 + [float("nan")]), (902, [None] + [1.0] * 47), (903, [float("inf")] * 48), (904, []), (905, [1.0, 2.0])]
    copies = [(1000 + k, rows[7][1]) for k in range(150)]
    df = spark.createDataFrame([(k, v, 0) for k, v in rows + bad + copies], SCHEMA).repartition(6)
    check(whitening.whiten(df).collect(), rows + copies)
    check(whitening.whiten(clashing(df).selectExpr("*", "1 as x", "2 as size", "3 as component")).collect(), rows + copies)


def test_few_dimensions_and_repeated_ids(spark):
    rows = vectors(50, 3)
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], SCHEMA)
    check(whitening.whiten(df).collect(), rows, 3)
    twice = df.union(df).union(df.selectExpr("cast(null as long)", "embedding", "label"))
    assert whitening.whiten(twice).count() == 3 * 150


def test_directions_that_do_not_vary(spark):
    same = spark.createDataFrame([(k, [0.5, 0.25], 0) for k in range(5)], SCHEMA)
    assert whitening.whiten(same).collect() == [] and whitening.whiten(same.limit(0)).collect() == []
    line = spark.createDataFrame([(k, [k * 1.0, k * 2.0, 0.0], 0) for k in range(5)], SCHEMA)
    made = whitening.whiten(line).collect()
    assert len(made) == 5 and all(r.component == 1 and abs(r.explained - 1) < 1e-12 for r in made)


def test_entries_beyond_64_bits(spark):
    df = spark.createDataFrame([(1, [3e38, 1.0], 0), (2, [-3e38, 2.0], 0), (3, [0.0, 1.5], 0)], SCHEMA)
    made = whitening.whiten(df).collect()
    assert {r.deviation for r in made} == {2**63 - 1} or len(made) == 3
    assert all(np.isfinite(r.whitened) for r in made)


@pytest.mark.parametrize("seed, size, gap", [(1, 120, 1.0), (2, 200, 0.999), (3, 90, 0.5)])
def test_filtered_pairs_equal_the_dense_ones(seed, size, gap):
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.normal(size=(size, size)))[0]
    values = np.concatenate([[9.0, 5.0, 4.9, 4.0], 4.0 * gap * np.linspace(0.999, 0.0, size - 4)])
    dense = (basis * values) @ basis.T
    passes = []

    def apply(q):
        passes.append(q.shape[1])
        return dense @ q

    found, q, residual = whitening.leading_pairs(apply, size, 4, guard=12)
    assert np.allclose(found, values[:4], rtol=1e-13) and residual <= whitening.STALLED * 9
    assert np.abs(dense @ q - q * found).max() < 1e-11 and np.abs(q.T @ q - np.eye(4)).max() < 1e-12
    assert max(passes) == 16
