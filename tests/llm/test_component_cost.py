"""Components take few tables: each is a shuffle over all partitions."""

from __future__ import annotations

import random

from llm import brute
from rowharbor.llm import components


def written(monkeypatch, links):
    """Components of ``links``, and how many tables were written for them."""
    labels = []
    keep = components.cut_lineage
    monkeypatch.setattr(components, "cut_lineage", lambda df, label, *a: labels.append(label) or keep(df, label, *a))
    got = {r.node: r.component for r in components.connected_components(links).collect()}
    return got, labels


def test_stars_need_no_round(spark, monkeypatch):
    links = [(i % 5, i) for i in range(5, 60)]
    got, labels = written(monkeypatch, spark.createDataFrame(links * 2, "a long, b long"))
    assert got == brute.components({x for p in links for x in p}, links)
    assert len(labels) == 2


def test_a_full_group_needs_one_round(spark, monkeypatch):
    links = [(a, b) for a in range(20) for b in range(a)] + [(30, 31), (31, 32)]
    got, labels = written(monkeypatch, spark.createDataFrame(links, "a long, b long"))
    assert got == brute.components({x for p in links for x in p}, links)
    assert len(labels) == 6


def test_components_of_random_links(spark):
    rng = random.Random(5)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(400 + rng.randrange(9), 400 + rng.randrange(9)) for _ in range(60)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [p for p in links if p[0] != p[1]]
    assert got == brute.components({x for p in real for x in p}, real)
