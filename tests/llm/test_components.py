from __future__ import annotations

import numpy as np
import pytest

from llm import brute
from rowharbor.llm.components import connected_components, reached
from rowharbor.llm.embeddings import near_duplicate_vectors, plan_tables
from rowharbor.llm.lyndon import suffix_array


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7), (300, 299)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame([(b, a) for a, b in links], "a long, b long")).collect()}
    want = brute.components({x for p in links for x in p}, links)
    assert got == want


def test_components_of_no_links(spark):
    assert connected_components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).count() == 0


def test_reached_follows_links_within_a_block():
    ids = np.array([9, 4, 7, 1, 8])
    links = np.zeros((5, 5), bool)
    for i, j in ((0, 2), (2, 1), (3, 4)):
        links[i, j] = links[j, i] = True
    assert reached(links, ids).tolist() == [4, 4, 4, 1, 1]


def test_vectors_near_the_threshold(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 64))
    rows = [*base]
    for c in (0.86, 0.9, 0.92, 0.95, 0.99, 1.0):
        noise = rng.normal(size=base.shape)
        unit = base / np.linalg.norm(base, axis=1, keepdims=True)
        noise -= (noise * unit).sum(1, keepdims=True) * unit
        noise /= np.linalg.norm(noise, axis=1, keepdims=True)
        rows += [*(3 * (c * unit + np.sqrt(1 - c * c) * noise))]
    v = np.array(rows).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, x.tolist(), "z") for i, x in enumerate(v)], "vec_id long, embedding array<float>, n_links string")
    got = {r.vec_id: r for r in near_duplicate_vectors(df).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    found = np.array([got[i].n_links for i in range(len(v))])
    assert (found <= near.sum(1)).all()
    assert found.sum() >= 0.95 * near.sum() > 500


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [1.0]), (8, []), (None, [1.0, 0.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]), (10, [-1.0, 0.0])]
    got = sorted(near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect(), key=lambda r: (r.vec_id or 0))
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in got] == [
        (None, 0, None, True), (1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
        (7, 0, 7, True), (8, 0, 8, True), (9, 3, 1, False), (9, 3, 1, False), (10, 0, 10, True),
    ]
    assert near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 10**4, 10**9])
def test_tables_grow_slowly(n):
    bits, tables = plan_tables(n)
    assert 4 <= bits <= 32 and 4 <= tables <= 150


@pytest.mark.parametrize("kinds", [1, 2, 4, 200])
def test_suffix_array(kinds):
    rng = np.random.default_rng(kinds)
    for n in (*range(12), 300):
        text = (rng.integers(0, kinds, n) + 1).tolist() + [0]
        assert suffix_array(text) == sorted(range(n + 1), key=lambda i: text[i:])
