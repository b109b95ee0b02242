"""Removal of repeated windows of words, against a plain version."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm import brute
from rowharbor.llm import passages
from rowharbor.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORDS = [f"w{i * i % 991}x{i % 17}" for i in range(400)]
PASSAGE = " ".join(WORDS[:70])
LONG = " ".join(f"t{i % 7919}y{i % 13}" for i in range(300_000))


def plain(docs):
    """docs: (id, text) -> list of (id, words, removed, digest)."""
    first: dict = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    for i, w in split:
        if i is not None:
            for a in range(len(w) - 49):
                key = tuple(w[a : a + 50])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = bytearray(len(w))
        for a in range(len(w) - 49):
            if i is not None and first[tuple(w[a : a + 50])] < i:
                gone[a : a + 50] = b"\1" * 50
        out.append((i, len(w), sum(gone), brute.sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return Counter(out)


def found(docs):
    return Counter(map(tuple, passages.remove_passages(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()))


CASES = [
    (1, None), (2, ""), (3, " \n\t\x0b\x0c\r "), (4, "few words"), (5, PASSAGE), (6, "before " + PASSAGE + " after"), (7, PASSAGE.upper()),
    (8, PASSAGE + " " + PASSAGE), (9, " ".join(WORDS[20:70])), (10, " ".join(WORDS[20:69])), (11, "\x1c" + PASSAGE.replace(" ", "\x85 \n")),
    (12, " ".join(WORDS[100:149])), (13, " ".join(WORDS[100:149])), (14, "same " * 200), (15, "same " * 60), (16, "é\U0001f600 " * 55), (17, "é\U0001f600\x0b" * 70),
    (None, PASSAGE), (5, " ".join(WORDS[:60])), (5, PASSAGE), (5, PASSAGE), (30, " ".join(WORDS[:30] + WORDS[200:260])), (31, " ".join(WORDS[230:300])),
    *[(i, " ".join(WORDS[i : i + 90])) for i in range(40, 60)], (-7, " ".join(WORDS[300:360])), (70, " ".join(WORDS[290:365])),
    (80, LONG), (81, "one more " + LONG[1000:]),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "d", 1, [2], True, 4.0, "s") for i, t in CASES]
    return spark.createDataFrame(rows, "doc_id long, text string, digest string, low int, marks array<int>, first boolean, n double, source string").repartition(4)


def test_cases(docs):
    assert found(docs) == plain(CASES)


def test_a_full_sketch_changes_nothing(docs):
    read = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("digest"), "text")
    width = passages.sketch_width(0)
    marks = lambda bits: {(r.doc_id, r.digest): sorted(r.marks) for r in passages.repeated_windows(passages.candidate_runs(read, width, bits)).collect()}
    sketch = passages.merged_sketch(read, width)
    assert len(sketch) == passages.DEPTH * width // 8 and sketch.count(0) > len(sketch) // 2
    assert marks(sketch) == marks(b"\xff" * len(sketch))


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == Counter()


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = Counter(map(tuple, QUERIES["op11_count_min_passages"](spark, FOLDER).collect()))
    assert got == plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert any(r[2] for r in got)


def test_hot_groups_stay_split(spark):
    """A third of all rows is one text: its runs meet as one row per task, and no row holds a list over documents."""
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(PASSAGE)).otherwise(F.concat(F.lit(" ".join(WORDS[100:150])), F.lit(" "), F.col("id"))).alias("text"))
    removed = passages.remove_passages(rows).groupBy("n_removed").count().collect()
    assert {r.n_removed: r["count"] for r in removed} == {0: 2, 70: 999, 50: 1999}


def test_sketch_width_follows_the_text():
    widths = [passages.sketch_width(n) for n in (0, 10**6, 10**9, 10**10, 10**14)]
    assert widths == sorted(widths) and widths[-1] == passages.MAX_CELLS and all(w & (w - 1) == 0 for w in widths)
    assert widths[2] >= 10**9 / passages.TEXT_BYTES_PER_CELL


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=140), min_size=1, max_size=5), st.integers(50, 60))
def test_keys_count_no_less_than_their_windows(texts, block):
    """Every window of a key is counted by it, however texts are cut into pieces and blocks."""
    rows = [(i, 0, " ".join(map(str, t))) for i, t in enumerate(texts)]
    saved, passages.BLOCK_WORDS = passages.BLOCK_WORDS, block
    try:
        entries, windows = Counter(), {}
        for pieces in passages.blocks(rows):
            runs = passages.Runs(pieces)
            entries.update(runs.key.tolist())
            where = zip(runs.owner[runs.of_run], np.arange(len(runs.of_run)), strict=True)
            place = np.arange(len(runs.of_run)) - np.repeat(np.cumsum(runs.length) - runs.length, runs.length)
            for (owner, _), at, h, key in zip(where, runs.low[runs.of_run] + place, runs.windows().tolist(), runs.key[runs.of_run].tolist(), strict=True):
                windows[pieces[owner][0][0], int(at)] = (h, key)
    finally:
        passages.BLOCK_WORDS = saved
    assert set(windows) == {(i, a) for i, t in enumerate(texts) for a in range(len(t) - 49)}
    same: dict = {}
    for (i, a), (h, key) in windows.items():
        same.setdefault(tuple(texts[i][a : a + 50]), []).append((h, key))
    for found in same.values():
        assert len(set(found)) == 1 and entries[found[0][1]] >= len(found)
    assert len({h for h, _ in windows.values()}) == len(same)
