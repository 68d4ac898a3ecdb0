"""Neighbour search and distances against brute force."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest

from tallycrest.operators import neighbours as nb


def brute(rows, k):
    out = {}
    for i, x, _ in rows:
        x = np.array(x)
        others = sorted((float(((x - np.array(y)) ** 2).sum()), j, c) for j, y, c in rows if j != i)
        out[i] = others[:k]
    return out


def make(seed, n, copies, clusters=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 10, (clusters, 3))
    points = [list(map(float, centres[rng.integers(clusters)] + rng.normal(0, 1, 3))) for _ in range(n)]
    points += [points[0]] * copies + [points[1]] + [points[2]] * 2
    order = rng.permutation(len(points))
    return [(int(i) * 7 % 100003, points[p], int(rng.integers(2))) for i, p in enumerate(order)]


@pytest.mark.parametrize("k,copies,block,pivots", [(2, 150, 8192, 1024), (1, 0, 16, 7), (2, 40, 16, 1), (3, 5, 50, 30)])
def test_equals_brute_force(spark, k, copies, block, pivots):
    rows = make(k + copies, 250, copies)
    df = spark.createDataFrame(rows, "id long, v array<double>, c int")
    found = nb.nearest_neighbours(df, "id", "v", "c", k, block_rows=block, max_pivots=pivots).collect()
    got = {r["id"]: [(n["squared"], n["id"], n["class"]) for n in r["neighbours"]] for r in found}
    want = brute(rows, k)
    assert got.keys() == want.keys()
    for i in want:
        assert [n[1:] for n in got[i]] == [n[1:] for n in want[i]], i
        np.testing.assert_allclose([n[0] for n in got[i]], [n[0] for n in want[i]], rtol=1e-9, atol=1e-12)


def test_few_rows(spark):
    schema = "id long, v array<double>, c int"
    one = spark.createDataFrame([(1, [0.0], 1)], schema)
    assert [list(r["neighbours"]) for r in nb.nearest_neighbours(one, "id", "v", "c", 2).collect()] == [[]]
    two = spark.createDataFrame([(1, [0.0], 1), (2, [3.0], 0)], schema)
    got = {r["id"]: [n["id"] for n in r["neighbours"]] for r in nb.nearest_neighbours(two, "id", "v", "c", 2).collect()}
    assert got == {1: [2], 2: [1]}
    none = spark.createDataFrame([], schema)
    assert nb.nearest_neighbours(none, "id", "v", "c", 2).count() == 0


@pytest.mark.parametrize("mode", ["reference", "tomek"])
def test_undersample(spark, mode):
    rows = [(i, x, 1 if c or i % 2 else 0) for i, x, c in make(11, 200, 60)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    near = brute([(i, x, c) for i, x, c in rows], 2)
    classes = {i: c for i, _, c in rows}
    if mode == "reference":
        dropped = {i for i in near if classes[i] == 1 and near[i][1][2] == 0}
    else:
        first = {i: n[0][1] for i, n in near.items()}
        dropped = {i for i in near if first[first[i]] == i and classes[i] == 1 and classes[first[i]] == 0}
    kept = {r["id"] for r in nb.undersample(df, "id", "v", "label", mode).collect()}
    assert dropped and kept == set(classes) - dropped


def test_balanced_classes_stay(spark):
    df = spark.createDataFrame([(i, [float(i)], i % 2) for i in range(10)], "id long, v array<double>, label int")
    assert nb.undersample(df, "id", "v", "label").count() == 10


def test_error_distance(spark, monkeypatch):
    monkeypatch.setattr(nb, "HOT_SHARE", 5)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(0, 4, 2)], int(rng.integers(2)), int(rng.integers(2))) for i in range(300)]
    rows += [(1000 + i, [1.0, 1.0], 1, 0) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, v array<double>, target_encoded int, predictions int")
    right = np.array([r[1] for r in rows if r[2] == r[3]])
    got = {r["id"]: r for r in nb.error_distance(df, "id", "v", block_rows=5).collect()}
    assert set(got) == {r[0] for r in rows if r[2] != r[3]}
    for i, x, a, p in rows:
        if a != p:
            d = np.sqrt(((right - np.array(x)) ** 2).sum(axis=1))
            assert got[i]["n_correct"] == len(right)
            assert got[i]["min_distance"] == pytest.approx(d.min())
            assert got[i]["avg_distance"] == pytest.approx(d.mean())


def test_text_keys(spark):
    rows = [(f"C{i:06}", x, c) for i, x, c in make(11, 120, 30)]
    df = spark.createDataFrame(rows, "id string, v array<double>, c int")
    found = nb.nearest_neighbours(df, "id", "v", "c", 2, block_rows=32, max_pivots=5).collect()
    want = brute(rows, 2)
    assert {r["id"]: [(n["id"], n["class"]) for n in r["neighbours"]] for r in found} == {
        i: [n[1:] for n in ns] for i, ns in want.items()
    }
    marked = spark.createDataFrame([(i, x, c, 1) for i, x, c in rows], "id string, v array<double>, predictions int, target_encoded int")
    wrong = {r["id"]: r["n_correct"] for r in nb.error_distance(marked, "id", "v").collect()}
    assert wrong == {i: sum(c == 1 for *_, c in rows) for i, _, c in rows if c == 0}


def clustered(n, seed=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 100, (6, 3))
    x = centres[rng.integers(6, size=n)] + rng.normal(0, 1, (n, 3))
    return [(i, list(map(float, v)), int(rng.integers(2))) for i, v in enumerate(x)]


@pytest.mark.parametrize("k,block,pivots,fanout", [(2, 16, 3, 4), (1, 8, 1, 2), (3, 25, 5, 64)])
def test_cells_are_split_until_they_fit_a_block(spark, monkeypatch, k, block, pivots, fanout):
    """Several levels of pivots, leaves of at most a block, and the neighbours of brute force."""
    rows = clustered(400) + make(3, 5, 40)
    rows = [(i, x, c) for i, (_, x, c) in enumerate(rows)]
    df = spark.createDataFrame(rows, "id long, v array<double>, c int")
    seen = []
    split = nb._split_cells

    def watched(cells, block_rows, fan):
        leaves, levels = split(cells, block_rows, fan)
        seen.append((max(r["count"] for r in leaves.groupBy("cell").count().collect()), len(levels)))
        return leaves, levels

    monkeypatch.setattr(nb, "_split_cells", watched)
    monkeypatch.setattr(nb, "MOST_SENT", 0)  # joins by shuffle, as for many cells
    found = nb.nearest_neighbours(df, "id", "v", "c", k, block_rows=block, max_pivots=pivots, fanout=fanout).collect()
    want = brute(rows, k)
    assert {r["id"]: [(n["id"], n["class"]) for n in r["neighbours"]] for r in found} == {
        i: [n[1:] for n in ns] for i, ns in want.items()
    }
    (largest, levels), = seen
    assert largest <= block and levels >= (1 if fanout > block else 2)


def test_work_per_point_stays_flat_as_clusters_grow(spark, monkeypatch):
    """Compared pairs per point, which a fixed number of pivots would double with the points."""

    def pairs_per_point(n, depth):
        monkeypatch.setattr(nb, "MAX_DEPTH", depth)
        total = []
        search = nb._search

        def counted(queries, candidates, k, block_rows):
            a = queries.groupBy("cell").count().withColumnRenamed("count", "a")
            b = candidates.groupBy("cell").count().withColumnRenamed("count", "b")
            total.append(a.join(b, "cell").selectExpr("coalesce(sum(a * b), 0) AS n").first()["n"])
            return search(queries, candidates, k, block_rows)

        with monkeypatch.context() as m:
            m.setattr(nb, "_search", counted)
            df = spark.createDataFrame(clustered(n), "id long, v array<double>, c int")
            nb.nearest_neighbours(df, "id", "v", "c", 2, block_rows=64, max_pivots=6, fanout=8).count()
        return sum(total) / n

    few, many = pairs_per_point(2400, 32), pairs_per_point(4800, 32)
    assert many < 1.3 * few
    assert pairs_per_point(4800, 0) > 5 * many  # the first pivots alone


def test_a_worker_holds_bounded_arrays():
    """Peak memory of a block pair, of finding cells and of copying queries to all of 1,024 cells."""
    rng = np.random.default_rng(5)
    block, pivots = rng.normal(size=(8192, 8)), rng.normal(size=(1024, 8))
    few = block[:1000]
    queries = pd.DataFrame({"point": range(1000), "features": list(few), "home": "0", "bound": np.inf})
    low, high = np.zeros(1024), np.full(1024, np.inf)

    def peak(work):
        tracemalloc.start()
        result = work()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return result, most / 1e6

    def copied():
        sizes = [len(b) for b in nb._copies_by_cell(queries, pivots, np.arange(1024).astype(str).astype(object), low, high)]
        return sum(sizes), max(sizes)

    found, most = peak(lambda: list(nb.nearest_in_block(np.arange(1000), few, np.arange(8192), block, 1)))
    assert sum(len(q) for q, _, _ in found) == 1000 and most < 30
    (place, _), most = peak(lambda: nb.nearest_pivot(block, pivots))
    assert len(place) == 8192 and most < 30
    (total, largest), most = peak(copied)
    assert total == 1000 * 1024 and largest * 8 <= nb.NUMBERS_AT_ONCE and most < 60


@pytest.mark.parametrize("shift,scale", [(0.0, 1.0), (1e8, 1.0), (0.0, 1e200), (3.0, 1e-9)])
def test_block_search_equals_plain_distances(shift, scale):
    """Ties, far origins, overflow and equal ids: the places and the very numbers of plain sums."""
    rng = np.random.default_rng(6)
    for whole in (True, False):
        draw = (lambda n: rng.integers(0, 3, (n, 3)) * 1.0) if whole else (lambda n: rng.normal(size=(n, 3)))
        queries, vectors = draw(50) * scale + shift, draw(90) * scale + shift
        own, ids = rng.integers(0, 60, 50), np.sort(rng.integers(0, 60, 90))
        got = {(int(q), int(c), float(s)) for parts in nb.nearest_in_block(own, queries, ids, vectors, 3) for q, c, s in zip(*parts)}
        d = nb.squared_distances(queries, vectors)
        d[own[:, None] == ids[None, :]] = np.inf
        best = np.argsort(d, axis=1, kind="stable")[:, :3]
        want = {(q, int(c), float(d[q, c])) for q in range(50) for c in best[q] if np.isfinite(d[q, c])}
        assert got == want
