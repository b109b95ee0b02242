from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from llm import brute
from llm.test_edges import ROWS, SCHEMA
from rowharbor.llm import lines
from rowharbor.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain(rows, edits, min_chars, max_documents):
    """(id, text) rows -> list of (lines, repeated, removed) by comparing all pairs of distinct lines."""
    split = [[] if t is None else t.split("\n") for _, t in rows]
    names = sorted({x for s in split for x in s if len(x) >= min_chars}, key=lambda x: (len(x), x))
    links = []
    for i, x in enumerate(names):
        for y in names[i + 1 :]:
            if len(y) - len(x) > edits:
                break
            if brute.edit_distance(x, y, edits) <= edits:
                links.append((x, y))
    kind = brute.components(names, links)
    places = {}
    for order, ((doc_id, _), s) in enumerate(zip(rows, split, strict=True)):
        for n, x in enumerate(s):
            if len(x) >= min_chars:
                places.setdefault(kind[x], []).append(((doc_id is not None, doc_id or 0), order, n))
    out = [[len(s), 0, []] for s in split]
    for found in places.values():
        wide = len({p[1] for p in found}) > max_documents
        for p in found:
            out[p[1]][1] += len(found) > 1
            if wide and p != min(found):
                out[p[1]][2].append(p[2])
    return [(n, r, sorted(gone)) for n, r, gone in out]


def results(df):
    return sorted(((r.doc_id is not None, r.doc_id or 0), r.n_lines, r.n_repeated, r.removed) for r in df.collect())


def wanted(rows, *args):
    return sorted(((d is not None, d or 0), *w) for (d, _), w in zip(rows, plain(rows, *args), strict=True))


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_distance(spark, edits):
    rng = random.Random(edits)
    rows = []
    for _ in range(600):
        a = rng.choices("abé\U0001f600", k=rng.randint(0, 14))
        b = list(a)
        for _ in range(rng.randint(0, edits + 1)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choices("abé", k=rng.randint(0, 1))
        rows.append(("".join(a), "".join(b)))
    df = spark.createDataFrame(rows, "l string, r string").where(F.abs(F.length("l") - F.length("r")) <= edits)
    for r in df.withColumn("d", lines.banded_distance(F.col("l"), F.col("r"), edits)).collect():
        assert min(r.d, edits + 1) == brute.edit_distance(r.l, r.r, edits)


def test_slots_are_few():
    assert [len(lines.slots(k)) for k in (1, 2, 3)] == [4, 12, 25] or len(lines.slots(2)) == 12


@pytest.mark.parametrize(("edits", "short"), [(1, 32), (2, 2), (3, 3)])
def test_classes_of_lines(spark, monkeypatch, edits, short):
    """Families of lines with one to four edits, also where nearly all lists are divided again."""
    monkeypatch.setattr(lines, "SHORT_LIST", short)
    rng = random.Random(7)
    bases = ["".join(rng.choices("abcdef ", k=rng.randint(8, 30))) for _ in range(20)] + ["aaaaaaaaaaaa", "abababababab"]
    rows = []
    for i in range(120):
        found = []
        for _ in range(rng.randint(0, 4)):
            x = list(rng.choice(bases))
            for _ in range(rng.choice((0, 0, 1, 2, 4))):
                at = rng.randint(0, len(x))
                x[at : at + rng.randint(0, 1)] = rng.choices("abcx", k=rng.randint(0, 1))
            found.append("".join(x))
        rows.append((i, "\n".join(found)))
    got = lines.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), edits, 6, 3)
    assert results(got) == wanted(rows, edits, 6, 3)


def test_edges(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    rows = [(r[0], r[1]) for r in ROWS]
    got = lines.repeated_lines(docs).drop("row_id")
    want = wanted(rows, lines.EDITS, lines.MIN_CHARS, lines.MAX_DOCUMENTS)
    assert sorted(x[:3] for x in results(got)) == sorted(x[:3] for x in want)
    assert results(got) == want
    assert lines.repeated_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    kept = lines.remove_lines(docs)
    assert kept.columns == docs.columns
    whole = [w for w in want if w[3] and len(w[3]) == w[1]]
    assert kept.count() == len(ROWS) - len(whole)


def test_removal_keeps_the_first(spark):
    line = "this line stands in every document of the table"
    rows = [(i, f"own text {i} {'x' * i}\n{line}{'!' * (i % 2)}", i) for i in range(1, 10)] + [(50, line, 3)]
    out = {r.doc_id: r for r in lines.remove_lines(spark.createDataFrame(rows, "doc_id long, text string, n_chars int")).collect()}
    assert out[1].text == rows[0][1] and out[1].n_chars == 1 and 50 not in out
    assert all(out[i].text == f"own text {i} {'x' * i}" and out[i].n_chars == len(out[i].text) for i in range(2, 10))


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert results(QUERIES["op7_segment_lines"](spark, FOLDER)) == wanted(rows, lines.EDITS, lines.MIN_CHARS, lines.MAX_DOCUMENTS)


def test_middles(spark):
    rows = [("", ""), ("a", ""), ("abc", "abc"), ("abxc", "abyyc"), ("aaa", "aaaa"), ("é\U0001f600x", "é\U0001f600y"), ("abab", "ab"), ("x" * 3000 + "1", "x" * 3000 + "2y")]
    got = spark.createDataFrame(rows, "l string, r string").select(lines.middles(F.col("l"), F.col("r")).alias("m")).collect()
    assert [tuple(r.m) for r in got] == [("", ""), ("a", ""), ("", ""), ("x", "yy"), ("", "a"), ("x", "y"), ("ab", ""), ("1", "2y")]


def test_a_column_named_row_id_is_data(spark):
    line = "a line of more than twenty-four characters that stands in ten documents"
    docs = spark.createDataFrame([(i, f"{line}\nown {i}", 7) for i in range(10)], "doc_id long, text string, row_id int")
    assert sorted(r.removed for r in lines.repeated_lines(docs).collect()) == [[]] + [[0]] * 9
    left = lines.remove_lines(docs)
    assert left.columns == ["doc_id", "text", "row_id"] and sum(line in r.text for r in left.collect()) == 1


def test_an_edit_changes_letter_counts_by_two_at_most(spark):
    rng = random.Random(4)
    letters = "abcxyzAÉé 019字\U0001f600"
    pairs = []
    for _ in range(300):
        a = [rng.choice(letters) for _ in range(rng.randint(0, 30))]
        b = list(a)
        for _ in range(lines.EDITS):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = [rng.choice(letters)] * rng.randint(0, 1)
        pairs.append(("".join(a), "".join(b)))
    found = spark.createDataFrame(pairs, "a string, b string").select(lines.letter_counts(F.col("a")).alias("a"), lines.letter_counts(F.col("b")).alias("b")).collect()
    assert all(sum(abs(x - y) for x, y in zip(r.a, r.b, strict=True)) <= 2 * lines.EDITS for r in found)
    assert found[0].a != found[1].a
