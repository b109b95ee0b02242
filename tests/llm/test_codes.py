"""Vector codes against a plain version, and the shortcut of a round against comparing everything."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st

from llm import brute
from rowharbor.llm import codes
from rowharbor.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain(rows, parts=16, entries=64, rounds=2):
    """rows: (id, label, vector); returns sorted (id, code, error, label_error, digest)."""
    kept = [(i, label, [max(-(2**27), min(2**27, math.floor(256 * x))) for x in v]) for i, label, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    length = max(parts, -(-max(len(v) for *_, v in kept) // parts) * parts)
    kept = sorted(((i, label, v + [0] * (length - len(v))) for i, label, v in kept), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    width = length // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for *_, v in kept[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for *_, v in kept:
                own[near(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(own[e]) for c in zip(*own[e], strict=True)] if own[e] else c for e, c in enumerate(books[p])]
    out, total = [], defaultdict(int)
    for i, label, v in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        total[label] += error
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), error))
    digest = brute.sha(",".join(str(x) for book in books for c in book for x in c))
    return sorted(((i, code, error, total[label], digest) for i, label, code, error in out), key=repr)


def found(rows):
    coded, books = codes.vector_codes(rows)
    return sorted(((r.vec_id, bytes(r.codes).hex(), r.error, r.label_error, codes.books_digest(books)) for r in codes.with_label_errors(coded).collect()), key=repr)


def test_whole_table(spark):
    rows = [(r.vec_id, r.label, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op13_active_entry_codes"](spark, FOLDER).collect()), key=repr)
    assert got == plain(rows)


SCHEMA = "vec_id long, label string, embedding array<double>, codes string, error string, v int, slot int"


def made(spark, rows):
    return spark.createDataFrame([(*r, "c", "e", 1, 2) for r in rows], SCHEMA).repartition(3)


def test_cases(spark):
    rng = np.random.default_rng(3)
    rows = [(i, f"l{i % 3}" if i % 4 else None, rng.normal(size=48).round(2).tolist()) for i in range(90)]
    rows += [(200, "x", None), (201, "x", [None] * 48), (202, "x", [math.nan] * 48), (203, "x", [math.inf] + [0.0] * 47), (204, "x", [0.0] * 48), (205, "x", [0.0] * 48)]
    rows += [(3, "l0", rows[3][2]), (3, "l0", rows[4][2]), (None, "x", rows[5][2]), (206, "x", [1.0] * 5), (207, "x", []), (-4, "x", [-0.001] * 48)]
    assert found(made(spark, rows)) == plain(rows)


def test_few_large_and_none(spark):
    few = [(1, "a", [1.0, 2.0]), (2, "a", [3.0]), (2, None, [-1e300, 1e18])]
    assert found(made(spark, few)) == plain(few)
    assert found(made(spark, [])) == [] and found(made(spark, [(1, "a", None)])) == []


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_active_entries_agree_with_all(data):
    small = st.integers(-3, 3)
    n, k, d = data.draw(st.integers(1, 12)), data.draw(st.integers(1, 8)), data.draw(st.integers(1, 3))
    matrix = lambda rows: np.array(data.draw(st.lists(st.lists(small, min_size=d, max_size=d), min_size=rows, max_size=rows)), np.int64)
    parts, before, after = matrix(n), matrix(k), matrix(k)
    stays = np.array(data.draw(st.lists(st.booleans(), min_size=k, max_size=k)))
    after[stays] = before[stays]
    scale = data.draw(st.sampled_from([1, 1 << 26]))
    code, distance = codes.assign(parts * scale, before * scale)
    got = codes.reassign(parts * scale, after * scale, (after != before).any(1), code, distance)
    want = codes.assign(parts * scale, after * scale)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
