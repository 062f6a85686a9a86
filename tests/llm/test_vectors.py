"""Nearest neighbours, clustering and whitening against plain NumPy, on tables with every odd case."""

import hashlib
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from telemetry_spark.llm import clustering, permutation_index, whitening
from telemetry_spark.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")
CLASH = ("id", "x", "v", "vector", "node", "found", "group", "cluster", "distance", "component", "n", "label", "_rank", "score")


def embeddings(spark, rows, kind=T.FloatType):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(kind()))]
                          + [T.StructField(c, T.StringType()) for c in CLASH])
    return spark.createDataFrame([(i, v, *["clash"] * len(CLASH)) for i, v in rows], schema)


def odd_rows(width=64, n=400, seed=1):
    draw = np.random.default_rng(seed)
    rows = [(i, v) for i, v in enumerate(np.round(draw.normal(size=(n, width)), 3).astype("float32").tolist(), 1)]
    one = rows[5][1]
    return rows + [(1000, one), (1001, one), (1002, one), (1002, one), (1002, rows[6][1]), (1100, None), (1200, []), (1300, [0.0] * width),
                   (1400, [NAN] + one[1:]), (1500, [None] + one[1:]), (1600, [INF] + one[1:]), (1700, one[:3]), (1800, one[:3]),
                   (None, one), (None, None)] + [(2000 + i, rows[9][1]) for i in range(40)]


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


def neighbours(rows, k=10):
    """{(query id, n-th row with it): [(score, id)]} by comparing every query with every row."""
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and good(v) and any(v)]
    out = {}
    for at, (q, v) in enumerate(rows):
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for j, (i, w) in enumerate(rows) if j != at and len(w) == len(v))
            out[at] = (q, near[:k])
    return out.values()


def found_lists(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return out


def agree(got, want, least):
    hits = total = 0
    for q, near in want:
        mine = got.get(q, [])
        assert len(mine) == len(near) and mine == sorted(mine)
        hits += len(set(i for _, i in mine) & set(i for _, i in near))
        total += len(near)
    assert hits >= least * total


def test_neighbours_of_odd_vectors(spark):
    rows = odd_rows()
    got = permutation_index.nearest_neighbours(embeddings(spark, rows), block=64, target=0.99)
    lists = found_lists(got)
    want = list(neighbours(rows))
    assert set(lists) == {q for q, _ in want} == {100, 200, 300, 400, 1000, 1700, 1800, 2000}
    agree(lists, want, 0.95)
    vectors = {}
    for i, v in rows:
        vectors.setdefault(i, []).append(v)
    for q, near in lists.items():
        for score, i in near:      # exactly the measure on the original vectors
            assert min(abs(score - np.sqrt(((np.array(a, float) - np.array(b, float)) ** 2).sum()))
                       for a in vectors[q] for b in vectors[i] if len(a) == len(b)) < 1e-12
    exact = dict(want)
    assert lists[1000][:4] == exact[1000][:4] == [(0.0, 6), (0.0, 1001), (0.0, 1002), (0.0, 1002)]
    assert lists[2000] == exact[2000] == [(0.0, 10)] + [(0.0, 2001 + i) for i in range(9)]
    assert lists[1700] == [(0.0, 1800)]


def test_few_and_no_vectors(spark):
    few = [(100, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (100, [1.0, 0.0])]
    got = found_lists(permutation_index.nearest_neighbours(embeddings(spark, few)))
    assert got == {100: sorted([(0.0, 100), (1.0, 2), (1.0, 2), (float(np.sqrt(2)), 1)] * 2)}
    for rows in ([], [(1, [1.0])], [(None, None)]):
        assert permutation_index.nearest_neighbours(embeddings(spark, rows)).collect() == []
    assert permutation_index.nearest_neighbours(embeddings(spark, [(100, [1.0])])).collect() == []


def test_registered_neighbours_reach_the_recall(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    agree(found_lists(QUERIES["op11_permutation_index"](spark, SF_SMALL)), list(neighbours(rows)), 0.9)


def test_footrule_counts_places():
    orders = np.array([[3, 1, 0], [0, 1, 2]])
    where = permutation_index.places(orders, 5)
    assert where.tolist() == [[2, 1, 3, 0, 3], [0, 1, 2, 3, 3]]
    assert permutation_index.footrule(where, np.array([3, 1, 0])).tolist() == [0, 3 + 0 + 2]


def lloyd_by_hand(rows, width, clusters, rounds, scale=1024, seed=3):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows if good(v) and len(v) == width]
    start = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:clusters]
    centroids = [list(x) for _, x in start]
    if not centroids:
        return [], []

    def assign():
        out = []
        for _, x in kept:
            far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids]
            out.append((min(far), far.index(min(far))))
        return out

    for _ in range(rounds):
        label = assign()
        for k in range(len(centroids)):
            mine = [x for (_, x), (_, c) in zip(kept, label) if c == k]
            if mine:
                centroids[k] = [sum(col) // len(mine) for col in zip(*mine)]
    return [(i, c, d) for (i, _), (d, c) in zip(kept, assign())], centroids


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, *(x or 0 for x in r)))


@pytest.mark.parametrize("blocks, rows_a_group", [(4, 4096), (5, 7), (1, 64)])
def test_clusters_of_odd_vectors(spark, blocks, rows_a_group):
    rows = odd_rows(n=120)
    got, centroids = clustering.lloyd(embeddings(spark, rows), blocks=blocks, rows=rows_a_group, rounds=4)
    want, there = lloyd_by_hand(rows, 64, 8, 4)
    assert key(got.collect()) == key(want) and centroids == there


def test_few_equal_large_and_no_vectors_to_cluster(spark):
    same = [(i, [1.5, -0.25]) for i in range(5)] + [(9, [7.0, 7.0]), (10, [1e30, 0.0]), (None, [7.0, 6.0])]
    got, centroids = clustering.lloyd(embeddings(spark, same, T.DoubleType), width=2, clusters=3, blocks=4)
    want, there = lloyd_by_hand([r for r in same if r[0] != 10], 2, 3, 10)
    assert key(got.collect()) == key(want) and centroids == there
    for none in ([], [(1, None)], [(None, [1.0, 2.0])]):
        assert clustering.cluster_report(embeddings(spark, none), width=2).collect() == []


def whole(v):
    return tuple(int(np.floor(64 * float(np.float32(x)))) + 1_000_000 for x in v)


def whitened_by_hand(rows, width, components=16):
    kept = [(i, whole(v)) for i, v in rows if good(v) and len(v) == width]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = [Fraction(s, n) for s in sums]
    centred = np.array([[float(a - m) for a, m in zip(x, mean)] for x in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    rows = {}
    for i, x in kept:
        w = np.array([float(a - m) for a, m in zip(x, mean)]) @ axes / np.sqrt(values)
        rows.setdefault(i, []).append((sum((n * a - s) ** 2 for a, s in zip(x, sums)), w))
    return n, rows, values / (centred ** 2).sum() * n


def check_whitening(frame, rows, width):
    n, want, explained = whitened_by_hand(rows, width)
    got = {}
    for r in frame.collect():
        got.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
        assert r["n"] == n and r["identity_error"] <= 1e-8
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
    assert set(got) == set(want)
    for i, parts in got.items():
        assert sorted(parts) == list(range(1, len(explained) + 1))
        for c, found in parts.items():
            assert sorted(r["deviation"] for r in found) == sorted(d for d, _ in want[i])
            assert sorted(abs(r["whitened"]) for r in found) == pytest.approx(sorted(abs(w[c - 1]) for _, w in want[i]), abs=1e-6)
    # one sign for all rows
    for c in range(1, len(explained) + 1):
        signs = {np.sign(parts[c][0]["whitened"] * want[i][0][1][c - 1]) for i, parts in got.items()
                 if len(want[i]) == 1 and abs(want[i][0][1][c - 1]) > 1e-3}
        assert len(signs) == 1


def test_whitening_of_odd_vectors(spark):
    rows = odd_rows()
    check_whitening(whitening.whiten(embeddings(spark, rows)), rows, 64)


def test_registered_whitening(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(QUERIES["op13_whitening"](spark, SF_SMALL), rows, 64)


def test_whitening_of_few_equal_and_no_vectors(spark):
    line = [(1, [0.0, 0.0, 1.0]), (2, [1.0, 2.0, 1.0]), (3, [3.0, 6.0, 1.0]), (4, [3.0, 6.0, 1.0]), (5, [1.0])]
    got = whitening.whiten(embeddings(spark, line)).collect()
    assert [(r["vec_id"], r["component"], r["n"]) for r in sorted(got)] == [(i, 1, 3) for i in (1, 2, 3, 4)]    # rank one
    assert all(abs(r["explained"] - 1) < 1e-12 and r["identity_error"] < 1e-12 for r in got)
    for none in ([], [(1, None)], [(1, [])], [(1, [2.0, 3.0]), (2, [2.0, 3.0])]):
        assert whitening.whiten(embeddings(spark, none)).collect() == []
    far = whitening.whiten(embeddings(spark, [(i, [i * 1e9, 0.0]) for i in range(1, 9)] + [(9, [1e300, 0.0])], T.DoubleType)).collect()
    assert {r["vec_id"] for r in far} == set(range(1, 9)) and all(r["deviation"] is None for r in far)


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 12), st.integers(1, 20), st.integers(0, 10_000))
def test_factor_and_rotation(width, points, seed):
    x = np.random.default_rng(seed).normal(size=(points, width)) * np.logspace(0, -4, width)
    scatter = x.T @ x
    g = whitening.pivoted_cholesky(scatter)
    assert np.allclose(g @ g.T, scatter, atol=1e-12 * np.trace(scatter))
    rotated = whitening.jacobi_columns(g)
    assert np.allclose(rotated @ rotated.T, scatter, atol=1e-12 * np.trace(scatter))
    gram = rotated.T @ rotated
    assert np.abs(gram - np.diag(gram.diagonal())).max(initial=0) <= 1e-12 * np.trace(scatter)
    assert (np.diff(gram.diagonal()) <= 0).all()
