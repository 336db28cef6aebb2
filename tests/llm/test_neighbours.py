import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtally.llm import neighbours


def brute(rows, k=5, every=50):
    ids = [i for i, _ in rows]
    m = np.array([v for _, v in rows], dtype=np.float64)
    n = np.sqrt((m * m).sum(axis=1))
    out = {}
    for p, i in enumerate(ids):
        if i % every == 0:
            c = m @ m[p] / (n * n[p])
            near = sorted((-round(float(x), 9), j, q) for q, (x, j) in enumerate(zip(c, ids)) if q != p)
            out.setdefault(i, []).append([j for _, j, _ in near[:k]])
    return out


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16))
    return [(i, (centres[i % 40] + 0.2 * rng.standard_normal(16)).astype(np.float32).tolist())
            for i in range(1500)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1))


def test_recall_and_scores(spark, code, clustered):
    got = {}
    for r in neighbours.search(frame(spark, clustered)).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    want = brute(clustered)
    hits = sum(len(set(w[0]) & {v for v, _ in got[q].values()}) for q, w in want.items())
    assert set(got) == set(want) and hits >= 0.9 * 5 * len(want)
    vectors = {i: np.array(v, dtype=np.float64) for i, v in clustered}
    for q, near in got.items():
        assert sorted(near) == [1, 2, 3, 4, 5] and q not in {v for v, _ in near.values()}
        scores = [near[i][1] for i in range(1, 6)]
        assert scores == sorted(scores, reverse=True)
        for v, s in near.values():
            a, b = vectors[q], vectors[v]
            assert abs(s - a @ b / (np.linalg.norm(a) * np.linalg.norm(b))) < 1e-12


def test_copies_ties_and_unfit_vectors(spark, code):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(200)] + [(1000 + i, [float(i), 1.0, 0.5]) for i in range(30)]
    odd = [(300, None), (350, [0.0, 0.0, 0.0]), (400, [1.0, None, 2.0]), (450, [float("nan"), 1.0, 1.0]),
           (500, [float("inf"), 1.0, 1.0]), (None, same), (550, [])]
    got = {}
    for r in neighbours.search(frame(spark, rows + odd)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert {q: [v for _, v in sorted(n)] for q, n in got.items()} == {q: w[0] for q, w in brute(rows).items()}


def test_few_rows_dimensions_and_repeats(spark, code):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.0, 1.0]), (50, [1.0, 1.0, 1.0]), (51, [1.0, 0.0, 0.0])]
    got = sorted((r.query_id, r.rank, r.vec_id) for r in neighbours.search(frame(spark, rows)).collect())
    assert got == [(0, 1, 0), (0, 1, 0), (0, 2, 1), (0, 2, 1), (50, 1, 51)]
    assert neighbours.search(frame(spark, [])).count() == 0
    assert neighbours.search(frame(spark, [(7, [1.0])])).count() == 0


def test_ids_of_a_vector_that_a_third_of_the_rows_hold(spark, code, monkeypatch):
    """Only the smallest ids of each salt leave a task, queries among them."""
    rows = [(i, [1.0, 2.0] if i % 3 else [float(i), 1.0]) for i in range(6000)]
    points = neighbours.distinct_points(neighbours.valid_vectors(frame(spark, rows)), 6, 50)
    hot = [r for r in points.collect() if list(r.v) == [1.0, 2.0]]
    assert [list(r.ids) for r in hot] == [[1, 2, 4, 5, 7, 8]] and hot[0].is_query
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    # No query among the rows: none is made up.
    few = neighbours.distinct_points(neighbours.valid_vectors(frame(spark, [(i, [1.0]) for i in range(1, 49)])), 6, 50)
    assert [(list(r.ids), r.is_query) for r in few.collect()] == [([1, 2, 3, 4, 5, 6], False)]


def test_hilbert_curve_visits_neighbours():
    side = 16
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    path = cells[np.argsort(neighbours.hilbert_keys(cells, 4))]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
