"""Each stage of the pipeline against a plain version, on the output of the stage before."""

from __future__ import annotations

import re

import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from llm import brute
from llm.test_edges import ROWS, SCHEMA
from llm.test_lines import plain
from rowharbor.llm import classifier, lines
from rowharbor.session import cut_lineage

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows after each stage, and the documents before the first."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, FOLDER), name.replace(" ", "-"))
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(steps):
    assert all(s.columns == steps[0].columns for s in steps[1:5])
    assert all(r.n_chars == len(r.text) for r in steps[4].collect())


def test_quality(spark, steps):
    scores = classifier.quality_scores(steps[0], spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()
    assert set(texts(steps[1])) == {r.doc_id for r in scores if r.predicted == 1}


def test_lines(steps):
    rows = sorted(texts(steps[1]).items())
    want = {}
    for (doc_id, text), (_, _, gone) in zip(rows, plain(rows, lines.EDITS, lines.MIN_CHARS, lines.MAX_DOCUMENTS), strict=True):
        left = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in set(gone))
        if not gone or left.strip():
            want[doc_id] = left
    assert texts(steps[2]) == want


def test_near_duplicates(steps):
    docs = texts(steps[2])
    want = brute.near_duplicate_rows(list(docs.items()))
    assert texts(steps[3]) == {i: t for i, t in docs.items() if want[i][1] == i}


def test_secrets(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert before.keys() == after.keys()
    for i, text in before.items():
        spans = [s for s in brute.secret_row(text)[4].split(",") if s]
        assert bool(spans) == ("[SECRET]" in after[i])
        assert not re.search("[0-9a-f]{24,}", after[i])


def test_packing(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts(steps[4]).items()}
    got = {}
    for r in steps[5].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_odd_documents(spark):
    """Nulls, repeated rows and columns of clashing names pass through every stage; so does an empty table."""
    for rows in (ROWS, []):
        docs = spark.createDataFrame(rows, SCHEMA)
        for name, stage in corpus_pipeline.STAGES:
            found = cut_lineage(stage(spark, docs, FOLDER), "odd")
            assert name == "packing" or found.columns == docs.columns
            docs = found
        assert (docs.count() > 0) == bool(rows)
