from fractions import Fraction

import numpy as np
import pytest

from postlake.llm import whitening as w
from postlake.llm.queries import QUERIES

ROWS = "vec_id BIGINT, embedding ARRAY<DOUBLE>"


def plain(vectors):
    """(n, deviations, covariance) of a list of float vectors, in fractions."""
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(column) for column in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = [[Fraction(n * a - s, n) for a, s in zip(row, sums)] for row in x]
    covariance = [[sum(r[i] * r[j] for r in centred) / n for j in range(len(sums))] for i in range(len(sums))]
    return n, deviations, covariance


def check(rows, vectors, count):
    """Rows of ``whiten`` against numpy on the plain covariance; vec_id is the place in ``vectors``."""
    n, deviations, covariance = plain(vectors)
    v = np.array(covariance, float)
    values = np.linalg.eigvalsh(v)[::-1]
    assert len(rows) == count * len(vectors)
    got = np.zeros((len(vectors), count))
    for row in rows:
        got[row["vec_id"], row["component"] - 1] = row["whitened"]
        assert (row["n"], int(row["deviation"])) == (n, deviations[row["vec_id"]])
        assert row["explained"] == pytest.approx(values[row["component"] - 1] / values.sum(), rel=1e-9)
        assert row["identity_error"] < 1e-9
    cov = got.T @ got / n - np.outer(got.mean(0), got.mean(0))
    assert np.abs(cov - np.eye(count)).max() < 1e-9
    # Projections on unit eigenvectors: whitened values times sqrt(e), regressed on the vectors, are rows of V's basis.
    x = np.array([[np.floor(1024 * c) for c in one] for one in vectors])
    x -= x.mean(0)
    for k in range(count):
        direction = x.T @ got[:, k] / n / np.sqrt(values[k])
        assert np.linalg.norm(direction) == pytest.approx(1, abs=1e-9)
        assert np.abs(v @ direction - values[k] * direction).max() < 1e-8 * values[0]


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    place = {row["vec_id"]: at for at, row in enumerate(table)}
    rows = [row.asDict() | {"vec_id": place[row["vec_id"]]} for row in QUERIES["op13_whitening"](spark, sf_dir).collect()]
    check(rows, [row["embedding"] for row in table], 8)


def test_ragged_null_and_repeated_vectors(spark):
    random = np.random.default_rng(3)
    good = [random.normal(size=5).tolist() for _ in range(40)]
    good += good[:7]
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf")] + [0.0] * 4, [1.0, 2.0]]
    rows = [(at, v) for at, v in enumerate(good)] + [(None, v) for v in bad]
    frame = spark.createDataFrame(rows, ROWS).selectExpr("*", "'own' AS vector", "'own' AS whitened", "1 AS id")
    check(w.whiten(frame, 4).collect(), good, 4)
    kept = w.whiten(spark.createDataFrame([(None, v) for v in good], ROWS), 2).collect()
    assert len(kept) == 2 * len(good) and all(row["vec_id"] is None for row in kept)


def test_empty_constant_and_low_rank(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [0.5, 0.5])] * 9):
        assert w.whiten(spark.createDataFrame(rows, ROWS)).collect() == []
    line = [[float(at), 2.0 * at, 0.0] for at in range(10)]
    check(w.whiten(spark.createDataFrame(list(enumerate(line)), ROWS)).collect(), line, 1)


def test_equal_eigenvalues_get_a_basis(spark):
    cross = [[s if i == j else 0.0 for j in range(4)] for i in range(4) for s in (1.0, -1.0)]
    check(w.whiten(spark.createDataFrame(list(enumerate(cross)), ROWS)).collect(), cross, 4)


def test_large_entries_stay_exact(spark):
    random = np.random.default_rng(5)
    large = (random.normal(size=(30, 3)) * np.array([1e12, 3e11, 1.0])).tolist()
    rows = w.whiten(spark.createDataFrame(list(enumerate(large)), ROWS), 2).collect()
    _, deviations, _ = plain(large)
    assert {row["vec_id"]: int(row["deviation"]) for row in rows} == dict(enumerate(deviations))
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 5.0])], ROWS)
    assert len(w.whiten(huge).collect()) == 6


def test_exact_gram_of_any_size():
    random = np.random.default_rng(1)
    for most in (1 << 10, 1 << 35, 1 << 61):
        values = random.integers(-most, most, (500, 3))
        want = values.astype(object).T @ values.astype(object)
        assert (w.exact_gram(values) == want).all()


def test_limbs_add_up():
    for value in (0, -1, 1, 5, -(1 << 30), (1 << 30) - 1, -(1 << 95) + 7, 1 << 200):
        assert sum(digit << 30 * at for at, digit in w._limbs(value)) == value


def test_polynomial_and_roots(spark):
    matrix = [[2, 1, 0], [1, 2, 0], [0, 0, 0]]  # roots 3, 1, 0
    assert w.characteristic_polynomial(spark, matrix) == [0, 3, -4, 1]
    assert w.largest_roots([0, 3, -4, 1], 5) == [3 << w.ROOT_BITS, 1 << w.ROOT_BITS]
    assert w.largest_roots([4, -4, 1], 2) == [2 << w.ROOT_BITS] * 2
    assert w.largest_roots([2, -4, 1], 1)[0] / (1 << w.ROOT_BITS) == pytest.approx(2 + 2 ** 0.5, rel=1e-15)
    random = np.random.default_rng(2)
    base = random.integers(-9, 9, (12, 7))
    integer = (base.T @ base).tolist()
    roots = [root / (1 << w.ROOT_BITS) for root in w.largest_roots(w.characteristic_polynomial(spark, integer), 7)]
    assert roots == pytest.approx(np.linalg.eigvalsh(np.array(integer, float))[::-1].tolist(), rel=1e-8)


def test_primes_fall_from_the_top():
    some = [p for p, _ in zip(w.primes(), range(5))]
    assert some[0] == (1 << 31) - 1 and all(all(p % q for q in range(3, 50_000, 2)) for p in some)
