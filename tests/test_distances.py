"""Components of the distance matrix against numpy on the whole matrix."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallycrest.operators import distances
from tallycrest.plans import queries as q


def whole(rows, count):
    """Scores by key, from the full matrix."""
    wrong = sorted((k, v) for k, v, t, p in rows if t != p)
    right = [v for _, v, t, p in rows if t == p]
    d = np.array([[np.linalg.norm(np.subtract(v, c)) for c in right] for _, v in wrong])
    d -= d.mean(axis=0)
    u, s, _ = np.linalg.svd(d, full_matrices=False)
    scores = np.zeros((len(wrong), count))
    k = min(count, len(s))
    scores[:, :k] = u[:, :k] * s[:k]
    scores[:, :k][:, s[:k] < 1e-9 * s[0]] = 0
    for j in range(count):
        size = np.abs(scores[:, j])
        if scores[np.flatnonzero(size >= size.max() * (1 - 1e-9))[0], j] < 0:
            scores[:, j] *= -1
    return {k: row for (k, _), row in zip(wrong, scores)}


def compare(spark, rows, count=2, **options):
    df = spark.createDataFrame(rows, "id long, vector array<double>, target_encoded int, predictions int")
    got = distances.distance_components(df, "id", "vector", count, **options).collect()
    want = whole(rows, count)
    assert sorted(r["id"] for r in got) == sorted(want)
    scale = max(abs(x).max() for x in want.values())
    for r in got:
        assert [r[f"pc{i + 1}"] for i in range(count)] == pytest.approx(list(want[r["id"]]), abs=1e-6 * scale)


@pytest.mark.parametrize("block_rows", [8192, 13])
def test_components_equal_those_of_the_whole_matrix(spark, block_rows):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(90):
        vector = [float(rng.integers(0, 60)), float(rng.integers(0, 2)), float(rng.integers(0, 2))]  # many copies
        rows.append((i, vector, int(rng.integers(0, 2)), int(rng.integers(0, 2))))
    rows += [(1000 + i, [500.0, 0.0, 1.0], 0, i % 2) for i in range(60)]  # a hot vector on both sides
    compare(spark, rows, 3, block_rows=block_rows)


def test_components_of_few_rows(spark):
    rows = [(1, [0.0, 1.0], 0, 1), (2, [3.0, 1.0], 1, 1), (3, [5.0, 5.0], 1, 0)]
    compare(spark, rows)
    df = spark.createDataFrame(rows, "id long, vector array<double>, target_encoded int, predictions int")
    alone = distances.distance_components(df.filter("id <> 2"), "id", "vector").collect()
    assert sorted(tuple(r) for r in alone) == [(1, 0.0, 0.0), (3, 0.0, 0.0)]
    assert distances.distance_components(df.filter("id = 2"), "id", "vector").collect() == []
    assert distances.distance_components(df.limit(0), "id", "vector").collect() == []


def test_query_equals_the_whole_matrix(spark, views):
    vectors = q._prediction_vectors(views).collect()
    rows = [(r["customer_id"], r["vector"], r["target_encoded"], r["predictions"]) for r in vectors]
    want = whole(rows, 2)
    got = {r["customer_id"]: (r["pc1"], r["pc2"]) for r in q.pca_distances(views).collect()}
    assert got.keys() == want.keys()
    for key, scores in got.items():
        assert scores == pytest.approx(list(want[key]), rel=1e-6, abs=1e-3)
