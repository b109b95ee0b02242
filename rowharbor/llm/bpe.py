"""Byte-level BPE with a local rank file: encoding of whole texts and decoding to raw bytes.

A long run of blanks is one match of the pattern but for its last character where text follows; it is encoded without the
splitter, which would look ahead from every place of it. Other long texts are cut before encoding, only where no match of the split pattern can reach across: between
a printable ASCII character and a following blank or line feed, and between an ASCII letter and an ASCII digit. The
pattern looks ahead but never back, so each cut piece is split exactly as it would be within the whole text.

Defined cases: a NULL text is the empty text; an empty text has no ids and decodes to no bytes; NULL
document ids are kept; repeated rows give repeated results; an empty table gives no rows; other
columns are not read. Text that holds names of special tokens is ordinary text, unless the added tokens of a
tokenizer file are given: each place of such a name is then its one id, and what stands between is encoded by itself.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from rowharbor.llm.arrow_tasks import SLICE_ROWS, map_rows

#: Code points after which a long text is cut at the next safe place.
CUT_AFTER = 1 << 16

#: White space as the split pattern knows it, and the length of a run that is not left to the splitter.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 4096
_LONG_BLANKS = re.compile(f"[{BLANKS}]{{{LONG_RUN},}}")

SAFE = re.compile(r"[!-~](?=[ \n])|[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")


def read_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The rank file, for all tasks. Its size is that of a vocabulary, whatever the documents are."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


@lru_cache(maxsize=4)
def encoder(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoder of a rank file; built once per worker."""
    merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def added_tokens(path: str) -> dict[str, int]:
    """Names and ids of the added tokens of a tokenizer file, which it finds in a text before anything else."""
    with open(path, encoding="utf-8") as file:
        tokenizer = json.load(file)
    tokens = tokenizer["added_tokens"]
    for t in tokens:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or (t["normalized"] and tokenizer["normalizer"]):
            raise ValueError(f"added token {t['content']!r} is not found by its plain name")
    return {t["content"]: t["id"] for t in tokens}


@lru_cache(maxsize=4)
def _names(names: tuple[str, ...]) -> re.Pattern:
    """Any of the names; of those that start at one place the longest."""
    return re.compile("(" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + ")")


def safe_pieces(text: str, cut_after: int = CUT_AFTER) -> Iterator[str]:
    """The text in pieces whose separate encodings join to the encoding of the whole."""
    start = 0
    while len(text) - start > cut_after:
        cut = SAFE.search(text, start + cut_after - 1)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def encode_text(encoding: tiktoken.Encoding, text: str | None, cut_after: int = CUT_AFTER, added: Mapping[str, int] | None = None) -> list[int]:
    if not text:
        return []
    if added and any(name in text for name in added):
        # Every other part is a name.
        parts = _names(tuple(added)).split(text)
        return [i for k, part in enumerate(parts) for i in ([added[part]] if k % 2 else encode_text(encoding, part, cut_after))]
    if len(text) >= LONG_RUN and (run := _LONG_BLANKS.search(text)):
        ids, start = [], 0
        while run:
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += encode_text(encoding, text[start : run.start()], cut_after)
            ids += encoding._encode_single_piece(text[run.start() : end])
            start, run = end, _LONG_BLANKS.search(text, run.end())
        return ids + encode_text(encoding, text[start:], cut_after)
    if len(text) <= cut_after:
        return encoding.encode_ordinary(text)
    return [i for piece in safe_pieces(text, cut_after) for i in encoding.encode_ordinary(piece)]


def encode_documents(docs: DataFrame, vocabulary: Broadcast, pattern: str, cut_after: int = CUT_AFTER) -> DataFrame:
    """``doc_id, ids``: the ids of every whole text, in one pass without a shuffle."""

    def task(rows):
        encoding = encoder(vocabulary.value, pattern)
        for doc_id, text in rows:
            yield doc_id, np.array(encode_text(encoding, text, cut_after), np.int32)

    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    return map_rows(docs, ["doc_id", "text"], "doc_id long, ids array<int>", schema, task, lambda row: 4 * len(row[1]))


def decode_documents(encoded: DataFrame, vocabulary: Broadcast, pattern: str) -> DataFrame:
    """``doc_id, ids, decoded``: the raw bytes the ids stand for, which need not be whole characters."""

    def run(batches):
        encoding = encoder(vocabulary.value, pattern)
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                ids = batch.column("ids")
                decoded = [b"" if x.values is None else encoding.decode_bytes(x.values.to_numpy().tolist()) for x in ids]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
