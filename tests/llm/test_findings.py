"""Cases that a review found to be left out."""

from __future__ import annotations

import random
import re
import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pytest

from rowharbor.llm import bpe, licenses, lines, secrets
from rowharbor.llm.queries import pack


def test_packing_knows_added_tokens(spark):
    """The ids of the tokenizer file itself, with its own settings."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    name = "<|endoftext|>"
    texts = ["a <|endoftext|> b", name, name * 3, f"  {name}  \n x{name}1 ", "<|endoftext|", f"it{name}'s <|{name}|>", ("word 12ab  \n" * 20 + name) * 9, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: plain.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    assert len(want[0]) == 4 + 1
    for r in pack(docs).collect():
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert (r.doc_tokens, r.ids_crc32) == (len(want[r.doc_id]), zlib.crc32(np.array(ids, "<u4").tobytes()))
    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoding = bpe.encoder(vocabulary.value, public_tokenizers.PATTERN)
    added = bpe.added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in enumerate(texts):
        assert bpe.encode_text(encoding, text, 7, added) + [0] == want[i]


def expansions(pattern):
    """All texts of a pattern of branches, classes and optional parts; a longer repetition is taken as often as it must be."""

    def of(items):
        return ["".join(x) for x in product(*map(one, items))]

    def one(item):
        kind, value = str(item[0]), item[1]
        if kind == "LITERAL":
            return [chr(value)]
        if kind == "BRANCH":
            return [x for branch in value[1] for x in of(branch)]
        if kind == "SUBPATTERN":
            return of(value[3])
        if kind == "MAX_REPEAT":
            low, high, inner = value
            return [x for n in ((0, 1) if (low, high) == (0, 1) else (low,)) for x in ("".join(p) for p in product(of(inner), repeat=n))]
        if kind == "IN":
            ranges = [v for k, v in value if str(k) == "RANGE"]
            return ["x"] if str(value[0][0]) == "NEGATE" else [chr(v) for k, v in value if str(k) == "LITERAL"] + [chr(v[0]) for v in ranges]
        assert kind == "NOT_LITERAL", kind
        return ["x"]

    return of(re._parser.parse(pattern))


def test_every_license_name_holds_a_keyword():
    named = [(label, keywords, name) for label, (keywords, names) in licenses.NAMES.items() for name in names]
    named += [(label, [keyword], pattern) for label, keyword, pattern in licenses.WORDINGS]
    for label, keywords, pattern in named:
        for text in expansions(pattern):
            assert any(f" {k}" in f" {text} " for k in keywords), (label, text)
    assert all("{name}" in statement for _, statement in licenses.STATEMENTS)


def test_every_license_rule_is_reached(spark):
    """The shortest text of every rule gives a detection of that rule, or of one that covers it."""
    rules = [(f["label"], r["pattern"].removeprefix("(?<= )").removesuffix("(?= )")) for f in licenses.rule_table() for r in f["rules"]]
    rows = [(i, min(expansions(pattern), key=len)) for i, (_, pattern) in enumerate(rules)]
    found = {r.doc_id: r for r in licenses.detect_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert any(d.start <= 0 and d.stop >= len(text.split()) for d in found[i].detections), (rules[i][0], text)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under Apache 2.0.", "apache-2.0"),
        ("It is available under the MPL 2.0", "mpl-2.0"),
        ("distributed under BSD 3-Clause", "bsd-3-clause"),
        ("under the terms of the EUPL 1.2", "eupl-1.2"),
        ("Open Data Base License 1.0 licence", "odbl-1.0"),
        ("offered under Expat", "mit"),
        ("available under ASL 2.0", "apache-2.0"),
        ("provided under the Internet Systems Consortium License", "isc"),
        ("a limited discussion of the deployment", ""),
    ],
)
def test_license_statements_without_the_word(spark, text, labels):
    row = licenses.detect_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.labels == labels and (row.score > 0) == bool(labels)


def test_private_keys_are_whole(spark):
    """Different keys in many sources are each live; one key in many sources is an example, however its lines are broken."""
    rng = random.Random(3)

    def key(lines=600):
        return ["".join(rng.choices("ABCDefgh0123+/", k=64)) for _ in range(lines)] + ["Qw12=="]

    def pem(body, between="\n", end=True):
        return between.join(["-----BEGIN RSA PRIVATE KEY-----", *body, *(["-----END RSA PRIVATE KEY-----"] if end else [])])

    own, example = [key() for _ in range(5)], key(12)
    encrypted = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0A1B", "", *key(3)]
    rows = [(i, f"before {i}\n{pem(k)}\nafter\n-----\n", f"o{i}") for i, k in enumerate(own)]
    rows += [(10 + i, "x " + pem(example, b) + " y", f"o{i}") for i, b in enumerate(("\n", "\r\n", "\\n", "\n    "))]
    rows += [(20, "a " + pem(encrypted, end=False), "o1"), (21, "b " + pem(key(4), end=False) + "\n\nA word or two.", "o2"), (22, "b " + pem([*key(2)[:2], "Ab1"], end=False), "o3")]
    rows += [(30 + i, "It starts with -----BEGIN RSA PRIVATE KEY----- as a mark.", f"o{i}") for i in range(3)]
    rows += [(40, pem(encrypted) + " - " + pem(own[0]), "o1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in secrets.scan_documents(docs).collect()}
    assert all((found[i].n_live, found[i].n_widespread) == (1, 0) for i in (*range(5), 20, 21, 22)) and found[40].n_live == 2
    assert all((found[i].n_live, found[i].n_widespread) == (0, 1) for i in (10, 11, 12, 13, 30, 31, 32))
    clean = {r.doc_id: r.text for r in secrets.redact_documents(docs).collect()}
    assert all(clean[i] == f"before {i}\n[SECRET]\nafter\n-----\n" for i in range(5))
    assert (clean[20], clean[21], clean[22], clean[40]) == ("a [SECRET]", "b [SECRET]\n\nA word or two.", "b [SECRET]", "[SECRET] - [SECRET]")
    assert all(clean[i] == t for i, t, _ in rows if 10 <= i < 20 or 30 <= i < 40)


def test_short_lines_go_by_equality(spark):
    short, cjk, few = "All rights reserved.", "\u7248\u6743\u6240\u6709", "seen in six"
    rows = [(i, f"own {i}\n{short}\n\n{cjk}" + (f"\n{few}" if i <= 6 else "") + f"\nAll rights reserved{i}") for i in range(1, 9)] + [(20, short), (21, f"{short}\n{short}\nx"), (22, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in lines.repeated_lines(docs).collect()}
    assert [found[i].removed_short for i in (1, 2, 8, 20, 21, 22)] == [[], [1, 3], [1, 3], [0], [0, 1], []]
    assert all(r.n_repeated == 0 and r.removed == [] for r in found.values())
    clean = {r.doc_id: r.text for r in lines.remove_lines(docs).collect()}
    assert clean[1] == rows[0][1] and clean[2] == f"own 2\n\n{few}\nAll rights reserved2" and clean[21] == "x" and 20 not in clean and clean[22] is None
