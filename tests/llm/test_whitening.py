import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import whitening
from tickloom.llm.queries import QUERIES

VECTORS = "vec_id long, vector array<double>"


def brute(rows, components):
    """vec_id -> (n, deviation, {component: |whitened|}, explained) by a full decomposition."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in kept], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s) / n
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return [i for i, _ in kept], n, deviation, centred @ vectors / np.sqrt(values), values / np.trace(v)


def agrees(found, expected):
    ids, n, deviation, white, shares = expected
    rows = sorted(found.collect(), key=lambda r: (r.deviation, str(r.vec_id)))
    order = sorted(range(len(ids)), key=lambda i: (deviation[i], str(ids[i])))
    assert [(r.vec_id, r.n, int(r.deviation)) for r in rows] == [(ids[i], n, deviation[i]) for i in order]
    got, want = np.array([r.whitened for r in rows]), white[order]
    signs = np.sign((got * want).sum(axis=0))
    assert np.allclose(got, want * signs, atol=1e-8) and np.allclose(rows[0].explained, shares, rtol=1e-10)
    assert rows[0].identity_error < 1e-9


def test_query_agrees_with_a_full_decomposition(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    ids, n, deviation, white, shares = brute(rows, 32)
    got = QUERIES["op11_whitening"](spark, sf_dir).collect()
    assert len(got) == 32 * len(ids) and {(r.vec_id, r.n, r.deviation) for r in got} == {(i, n, d) for i, d in zip(ids, deviation)}
    place = {i: p for p, i in enumerate(ids)}
    matrix = np.zeros((len(ids), 32))
    for r in got:
        matrix[place[r.vec_id], r.component - 1] = r.whitened
        assert abs(r.explained / shares[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-8
    assert np.allclose(matrix, white * np.sign((matrix * white).sum(axis=0)), atol=1e-7)


@pytest.mark.parametrize("leading", [1, 100])
def test_cycles_find_the_leading_components(spark, leading):
    """Blocks much narrower than the space, and a first direction far above the others."""
    rng = np.random.default_rng(leading)
    x = rng.standard_normal((400, 40)) * np.linspace(3, 1, 40)
    x[:, 7] *= leading
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    model = whitening.fit(spark.createDataFrame(rows, VECTORS), components=4, guard=3)
    assert model.residual <= whitening.CERTIFIED and model.passes > 5
    agrees(whitening.whiten(spark.createDataFrame(rows, VECTORS), components=4, guard=3), brute(rows, 4))


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((60, 6)))]
    good += [(None, good[0][1]), (3, good[3][1]), (3, good[4][1])] + [(100 + i, good[1][1]) for i in range(40)]
    bad = [(900, None), (901, []), (902, [1.0]), (903, [None] * 6), (904, [float("nan"), *[0.0] * 5]), (905, [float("inf"), *[0.0] * 5]), (None, None)]
    vectors = spark.createDataFrame(good + bad, VECTORS).withColumns({c: F.lit("other") for c in ("n", "deviation", "cell", "value", "whitened", "d")})
    agrees(whitening.whiten(vectors, components=4, guard=1), brute(good, 4))


def test_without_variance_or_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(5)], VECTORS)
    assert [(r.vec_id, int(r.deviation), r.whitened, r.identity_error) for r in whitening.whiten(same).orderBy("vec_id").collect()] == [(i, 0, [], 0.0) for i in range(5)]
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 3.0]) for i in range(50)], VECTORS)
    assert {len(r.whitened) for r in whitening.whiten(line, guard=0).collect()} == {1}
    empty = whitening.whiten(spark.createDataFrame([], VECTORS))
    assert empty.count() == 0 and empty.columns == whitening.whiten(same).columns
    assert whitening.whiten(spark.createDataFrame([(1, None)], VECTORS)).count() == 0


def test_large_entries_stay_exact(spark):
    rows = [(1, [1e30, 0.0]), (2, [-5e6, 1.0]), (3, [2.5e7, 3.0])]
    exact = rows[1:]
    found = {r.vec_id: r.deviation for r in whitening.whiten(spark.createDataFrame(exact, VECTORS)).collect()}
    assert {i: int(d) for i, d in found.items()} == dict(zip([2, 3], brute(exact, 1)[2]))
    assert whitening.whiten(spark.createDataFrame(rows, VECTORS)).count() == 3
