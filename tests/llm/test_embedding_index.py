"""Links of embeddings through the multi-index against all pairs, on fine grids, hot labels and odd rows."""

import numpy as np
import pytest
from cases import components
from conftest import SF_SMALL
from test_operators import brute_links

from telemetry_spark.llm import embedding_dedup
from telemetry_spark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, node string, id string, level string, tree string"


def expected(rows):
    """[(id, links, component)] of every row by all pairs; a row is a vector of its own, but one without id has no links."""
    links = brute_links([(i, v, label if i is not None else None) for i, v, label in rows], 0.98)
    trees = components(range(len(rows)), [(a, b) for a, bs in links.items() for b in bs])
    least = {}
    for k, tree in trees.items():
        least[tree] = min((i for i in (rows[k][0], least.get(tree)) if i is not None), default=None)
    return sorted(((rows[k][0], len(links[k]), least[trees[k]]) for k in range(len(rows))), key=str)


def check(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "c", "c", "c", "c") for r in rows], SCHEMA)
    got = embedding_dedup.embedding_links(frame, **options).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == expected(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def vectors(n, width, seed, spread=0.03):
    """Groups of near copies of different sizes, in float precision."""
    draw, out = np.random.default_rng(seed), []
    while len(out) < n:
        centre = draw.normal(size=width)
        out += [(centre + draw.normal(size=width) * spread * draw.integers(1, 5)).astype("float32").tolist() for _ in range(draw.integers(1, 9))]
    return out[:n]


@pytest.mark.parametrize("options", [{"residents": 3, "block": 5}, {"residents": 1, "block": 4096}, {"residents": 4096, "block": 7}, {}])
def test_a_label_with_a_third_of_all_vectors(spark, options):
    all_of = vectors(360, 16, 11)
    check(spark, [(i, v, 0 if i % 3 == 0 else i % 40) for i, v in enumerate(all_of)], **options)


def test_levels_follow_the_largest_label(spark):
    """A hot label among many small ones has a fine grid, and the small ones do not fill it."""
    seen = []
    fit = embedding_dedup._fit
    embedding_dedup._fit = lambda *a: seen.append(fit(*a)) or seen[-1]
    try:
        check(spark, [(i, v, 0 if i % 3 == 0 else i) for i, v in enumerate(vectors(300, 8, 4))], residents=6)
    finally:
        embedding_dedup._fit = fit
    assert [len(g.books[0]) for g in seen[0]] == [1, 2, 4, 8]


def test_repeated_ids_odd_lengths_and_hot_groups(spark):
    some = vectors(90, 16, 2)
    rows = [(i, v, i % 2) for i, v in enumerate(some)]
    rows += [(5, some[40], 1), (5, some[41], 0), (7, some[7], 1), (7, some[7], 1), (None, some[3], 1), (None, None, None),
             (500, some[0][:3], 0), (501, some[0][:3], 0), (502, [1.0], 0), (503, [2.0], 0), (504, [-2.0], 0)]
    rows += [(600 + i, some[0], 0) for i in range(150)]
    near = np.float32(some[1])
    rows += [(900 + i, (near * np.float32(1 + i / 64)).tolist(), 1) for i in range(60)]     # one direction, many lengths
    check(spark, rows, residents=4, block=16)


def test_vectors_wider_than_the_index(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "INDEXED", 6)
    tails = vectors(60, 12, 8)
    rows = [(i, ([0.0] * 6 if i % 5 == 0 else v[:6]) + v[6:], 1) for i, v in enumerate(tails)]
    check(spark, rows, residents=2, block=8)


def test_registered_query_is_all_pairs(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    got = QUERIES["op7_embedding_dedup"](spark, SF_SMALL).collect()
    rows = [tuple(r) for r in table]
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == expected(rows)


def test_roots_of_random_graphs():
    draw = np.random.default_rng(9)
    for n in (1, 2, 30):
        for share in (0, 0.03, 0.2):
            linked = draw.random((n, n)) < share
            linked |= linked.T
            np.fill_diagonal(linked, False)
            names = draw.permutation(n) * 10
            want = components(names.tolist(), [(int(names[a]), int(names[b])) for a, b in zip(*np.nonzero(linked))])
            assert dict(zip(names.tolist(), embedding_dedup.spanning_roots(linked, names).tolist())) == want
