"""The registered queries over a whole table, against plain versions and the libraries themselves."""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from llm import brute
from rowharbor.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def run(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def test_op1_ids_and_bytes(spark, docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = run(spark, "op1_byte_bpe")
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id].text or ""
        ids = plain.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(text))


def test_op2_base_spans(spark, docs):
    rows = run(spark, "op2_secret_scan")
    assert len(rows) == len(docs)
    for r in rows:
        *want, base = brute.secret_row(docs[r.doc_id].text)
        assert [r.n_assign, r.n_access, r.n_hex, r.base_sha256] == want
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_op4_counts(spark, docs):
    rows = run(spark, "op4_robust_outliers")
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.statistics_row(docs[r.doc_id].text)
        assert not (r.base_failed and r.kept)


def test_op5_held_out(spark, docs):
    rows = {r.doc_id: r for r in run(spark, "op5_byte_cnn_quality")}
    assert rows.keys() == docs.keys()
    assert all(r.held_out == (brute.crc(i) % 3 == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for i, r in rows.items())


def test_op6_pieces(spark, docs):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = {}, {}
    for r in run(spark, "op6_cost_balanced_packing"):
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == docs.keys()
    for i, own in pieces.items():
        ids = plain.encode(docs[i].text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(sequences) * 1024 < 1.02 * sum(r.length for own in sequences.values() for r in own) + 1024


def test_op8_base(spark, docs):
    rows = run(spark, "op8_license_rules")
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_row(docs[r.doc_id].text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert re.fullmatch(r"[a-z0-9.,-]*", r.labels) and 0 <= r.score <= 1
    assert any(r.n_base for r in rows)


def test_op10_components(spark, docs):
    want = brute.near_duplicate_rows([(i, r.text) for i, r in docs.items()])
    got = {r.doc_id: r for r in run(spark, "op10_bottom_k_minhash")}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    assert any(not r.kept for r in got.values())


def test_op3_links(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    v = np.array([r.embedding for r in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T >= 0.9
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in run(spark, "op3_hyperplane_cosine")}
    assert got.keys() == {r.vec_id for r in rows}
    found = np.array([got[r.vec_id].n_links for r in rows])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.9 * near.sum()
    if found.sum() == near.sum():
        ids = [r.vec_id for r in rows]
        want = brute.components(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near), strict=True)])
        assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_op9_bytes(spark, docs):
    ids = sorted(docs)
    want = dict(zip(ids, brute.repeated_bytes([docs[i].text for i in ids]), strict=True))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in run(spark, "op9_lyndon_substrings")}
    assert got == want
    assert any(r[1] for r in want.values())
