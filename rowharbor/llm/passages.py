"""Passages that repeat across documents: a count-min prefilter, then exact groups of the windows it cannot rule out.

A window is ``WINDOW`` consecutive words. Its key is the smallest hash of the ``ANCHOR``-word shingles in it, so consecutive windows
mostly share a key, and such a run of windows is one entry. The first pass writes a partial count-min sketch per task: the cells
that the keys of its runs fall into, ``DEPTH`` for each. Partial sketches are dealt by segment of cells and added up, one
segment at a time; counts stop at two, as no more is asked of them. Equal windows at two places are two entries of one key,
so the least cell of a key never counts less than any of its windows has places, and no repeated window is lost.

The second pass reads the texts again and hands on only runs of which every cell counts two. These are grouped exactly: equal
runs first, which settles all copies but the first of each; then, where runs that differ share a key, the single windows of each first
copy. A window is grouped by its key, its place around it, and its own 64-bit hash, a run by those of all its windows.

The sketch has about a cell for every ``TEXT_BYTES_PER_CELL`` bytes of text in each row, up to ``MAX_CELLS`` (64 MB of bits for
both rows, what a task holds at most). Beyond some 8 GB of text its cells fill up and it rules out less, and the exact groups, whose
entries are runs, do more; the result does not change.

Defined cases: NULL and empty texts have no words; a text of fewer words than a window loses none; a document without an id neither loses
words nor takes any from others; rows that share an id are one document, whose texts are judged by those of smaller ids only; an
empty table gives no rows. Texts are split at any length, in pieces. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rowharbor.llm.arrow_tasks import map_rows, rows_of
from rowharbor.session import cut_lineage

WINDOW = 50
ANCHOR = 8
DEPTH = 2
TEXT_BYTES_PER_CELL = 32
MAX_CELLS = 1 << 28
SEGMENT = 1 << 18

#: Words that are hashed at once, and words of one text after which it is cut (with a window's overlap).
BLOCK_WORDS = 1 << 17
TEXT_CHUNK = 1 << 20
_CACHED_WORDS = 1 << 20
_SEPARATOR = re.compile(rb"[\x20\x09-\x0D]")


class WordHashes(dict):
    """64-bit hashes of words, computed once per task while they are few and short."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= _CACHED_WORDS:
                self.clear()
            self[word] = value
        return value

    def of_text(self, text: str) -> np.ndarray:
        data, at, found = text.encode(), 0, []
        while at < len(data):
            cut = _SEPARATOR.search(data, at + TEXT_CHUNK)
            end = cut.start() if cut else len(data)
            words = data[at:end].split()
            found.append(np.fromiter(map(self.__getitem__, words), np.uint64, len(words)))
            at = end
        return np.concatenate(found) if found else np.empty(0, np.uint64)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit values spread over all their bits."""
    x = x ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def joined(words: np.ndarray, width: int, factor: int) -> np.ndarray:
    """A hash of every ``width`` consecutive values, put together from those of widths that are powers of two."""
    out, done, power, span, step = None, 0, words, 1, factor
    while span <= width:
        if width & span:
            out = power if out is None else out[: len(power) - done] * np.uint64(step) + power[done:]
            done += span
        if 2 * span <= width:
            power = power[:-span] * np.uint64(step) + power[span:]
        span, step = 2 * span, step * step & 0xFFFFFFFFFFFFFFFF
    return mixed(out)


def leftmost_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of every ``width`` consecutive values stands, the first one if there are several."""
    at, span = np.arange(len(values)), 1
    while span < width:
        shift = min(span, width - span)
        later = values[shift:] < values[:-shift]
        values, at = np.where(later, values[shift:], values[:-shift]), np.where(later, at[shift:], at[:-shift])
        span += shift
    return at


class Runs:
    """The windows of some pieces of texts, in runs of one key. Arrays over runs, but for ``of_run``, which is over windows."""

    def __init__(self, pieces: list[tuple]) -> None:
        self.words = np.concatenate([words for _, _, words in pieces])
        sizes = np.array([len(words) for _, _, words in pieces])
        owner = np.repeat(np.arange(len(pieces)), sizes)
        shingles = joined(self.words, ANCHOR, 0x9E3779B97F4A7C15)
        at = leftmost_smallest(shingles, WINDOW - ANCHOR + 1)
        self.inside = owner[: len(at)] == owner[WINDOW - 1 :]
        first = self.inside.copy()
        first[1:] &= ~(self.inside[:-1] & (at[1:] == at[:-1]))
        starts = np.flatnonzero(first)
        self.owner = owner[starts]
        self.low = starts - (np.cumsum(sizes) - sizes)[self.owner] + np.array([start for _, start, _ in pieces])[self.owner]
        self.shift = at[starts] - starts
        self.key = shingles[at[starts]]
        self.of_run = np.cumsum(first)[self.inside] - 1
        self.length = np.bincount(self.of_run, minlength=len(starts))

    def windows(self) -> np.ndarray:
        return joined(self.words, WINDOW, 0xD6E8FEB86659FD93)[self.inside]

    def cells(self, width: int) -> list[np.ndarray]:
        """The cell of every run in each row of the sketch."""
        return [(mixed(self.key, 0x5851F42D4C957F2D * (d + 1) & 0xFFFFFFFFFFFFFFFF) & np.uint64(width - 1)).astype(np.int64) + d * width for d in range(DEPTH)]


def blocks(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    """``(id and digest, first word, word hashes)`` of pieces of texts, some at a time; pieces of one text overlap by a window less a word."""
    hashes, held, total = WordHashes(), [], 0
    for doc_id, digest, text in rows:
        words = hashes.of_text(text)
        for start in range(0, len(words) - WINDOW + 1, BLOCK_WORDS):
            held.append(((doc_id, digest), start, words[start : start + BLOCK_WORDS + WINDOW - 1]))
            total += len(held[-1][2])
            if total >= BLOCK_WORDS:
                yield held
                held, total = [], 0
    if held:
        yield held


def sketch_width(text_bytes: int) -> int:
    """Cells of a row of the sketch for so much text, a power of two."""
    return min(MAX_CELLS, 1 << max((SEGMENT // DEPTH).bit_length() - 1, (text_bytes // TEXT_BYTES_PER_CELL).bit_length()))


def partial_sketches(docs: DataFrame, width: int) -> DataFrame:
    """``segment, cells, counts``: the cells that a task has met, by segment, each with its count up to two."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        cells, counts = np.unique(np.concatenate(held), return_counts=True)
        segments, starts = np.unique(cells // SEGMENT, return_index=True)
        parts = list(zip(starts, [*starts[1:], len(cells)], strict=True))
        offsets = [(cells[a:b] % SEGMENT).astype("<u4").tobytes() for a, b in parts]
        small = np.minimum(counts, 2).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array(segments, pa.int64()), pa.array(offsets, pa.binary()), pa.array([small[a:b].tobytes() for a, b in parts], pa.binary())], ["segment", "cells", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for block in blocks(rows_of(batches, ["doc_id", "digest", "text"])):
            held += Runs(block).cells(width)
            if sum(map(len, held)) >= 1 << 20:
                yield flush(held)
                held = []
        if held:
            yield flush(held)

    return docs.mapInArrow(run, "segment long, cells binary, counts binary")


def repeated_cells(partials: DataFrame) -> DataFrame:
    """``segment, bits``: the cells that count two or more in all tasks together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("segment", pa.int64()), ("bits", pa.binary())])

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"segment": current, "bits": np.packbits(total > 1).tobytes()}], schema)

        current, total = None, np.zeros(SEGMENT, np.uint8)
        for segment, cells, counts in rows_of(batches, ["segment", "cells", "counts"]):
            if segment != current:
                if current is not None:
                    yield done()
                current, total = segment, np.zeros(SEGMENT, np.uint8)
            at = np.frombuffer(cells, "<u4")
            total[at] = np.minimum(total[at] + np.frombuffer(counts, np.uint8), 2)
        if current is not None:
            yield done()

    return partials.repartition("segment").sortWithinPartitions("segment").mapInArrow(run, "segment long, bits binary")


def merged_sketch(docs: DataFrame, width: int) -> bytes:
    """One bit per cell of all rows, set where it counts two or more: ``DEPTH * width / 8`` bytes."""
    bits = np.zeros((DEPTH * width // SEGMENT, SEGMENT // 8), np.uint8)
    for row in cut_lineage(repeated_cells(partial_sketches(docs, width)), "sketch").collect():  # as many bytes as are returned
        bits[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.tobytes()


def candidate_runs(docs: DataFrame, width: int, bits: bytes) -> DataFrame:
    """``doc_id, digest, low, shift, anchor, windows`` of the runs that the sketch takes to be repeated."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    names = ["doc_id", "digest", "low", "shift", "anchor", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.frombuffer(shared.value, np.uint8)
        for block in blocks(rows_of(batches, ["doc_id", "digest", "text"])):
            runs = Runs(block)
            keep = np.ones(len(runs.key), bool)
            for cells in runs.cells(width):
                keep &= (sketch[cells >> 3] >> (7 - (cells & 7)) & 1).astype(bool)
            ids, digests = (np.array(column, np.int64)[runs.owner[keep]] for column in zip(*[key for key, _, _ in block], strict=True))
            windows = runs.windows()[keep[runs.of_run]].view(np.int64)
            bounds = np.concatenate([[0], np.cumsum(runs.length[keep])]).astype(np.int32)
            columns = [ids, digests, runs.low[keep], runs.shift[keep].astype(np.int32), runs.key[keep].view(np.int64)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.ListArray.from_arrays(pa.array(bounds), pa.array(windows))], names)

    return docs.mapInArrow(run, "doc_id long, digest long, low long, shift int, anchor long, windows array<long>")


def repeated_windows(runs: DataFrame) -> DataFrame:
    """``doc_id, digest, marks``: of each run with a repeated window its first word and, as bits, which of its windows stand in a document of a smaller id."""
    same = ["anchor", "shift", "length", "run"]
    runs = runs.withColumns({"length": F.size("windows"), "run": F.xxhash64("windows")})
    classes = cut_lineage(runs.groupBy(*same).agg(F.min("doc_id").alias("first")), "passage-classes")
    several = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", F.lit(True).alias("contested"))
    judged = runs.join(classes.join(several, "anchor", "left"), same).where("doc_id > first OR contested")
    whole = F.col("doc_id") > F.col("first")
    judged = judged.select("doc_id", "digest", "low", "anchor", "shift", "length", whole.alias("whole"), F.when(~whole, F.col("windows")).alias("windows"))
    judged = cut_lineage(judged, "passage-judged")

    copies = judged.where("whole").select("doc_id", "digest", "low", (F.expr("shiftleft(1L, length)") - 1).alias("mask"))
    single = judged.where("NOT whole").select("doc_id", "digest", "low", "anchor", "shift", F.posexplode("windows").alias("place", "window"))
    single = single.withColumn("around", F.col("shift") - F.col("place"))
    equal = ["anchor", "around", "window"]
    firsts = single.groupBy(*equal).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
    later = single.join(firsts, equal).where("doc_id > first").select("doc_id", "digest", "low", F.expr("shiftleft(1L, place)").alias("mask"))
    marks = copies.unionByName(later).groupBy("doc_id", "digest", "low").agg(F.bit_or("mask").alias("mask"))
    return marks.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("low", "mask")).alias("marks"))


def covered(lows: list[int], masks: list[int]) -> np.ndarray:
    """Which words the marked windows cover, up to the last one."""
    bits = (np.array(masks, np.int64)[:, None] >> np.arange(WINDOW - ANCHOR + 1)) & 1
    run, place = np.nonzero(bits)
    starts = np.array(lows, np.int64)[run] + place
    edges = np.zeros(int(starts.max()) + WINDOW + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return np.cumsum(edges) > 0


def without_marked(text: str | None, lows: list[int] | None, masks: list[int] | None) -> tuple[int, int, str]:
    """Words, removed words, and the words that are left, joined by a space."""
    gone = covered(lows, masks) if lows else np.empty(0, bool)
    data, at, n_words, kept = (text or "").encode(), 0, 0, []
    while at < len(data):
        cut = _SEPARATOR.search(data, at + TEXT_CHUNK)
        end = cut.start() if cut else len(data)
        words = data[at:end].split()
        here = gone[n_words : n_words + len(words)]
        n_words, at = n_words + len(words), end
        left = [w for w, g in zip(words, here.tolist(), strict=False) if not g] + words[len(here) :] if here.any() else words
        if left:
            kept.append(b" ".join(left))
    return n_words, int(gone.sum()), b" ".join(kept).decode()


def remove_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: every text without the words of windows that stand in a document of a smaller id."""
    text = F.col(text_column)
    own = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("digest"))
    read = own.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    width = sketch_width(own.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    runs = cut_lineage(candidate_runs(read, width, merged_sketch(read, width)), "passage-runs")
    marked = own.join(repeated_windows(runs), ["doc_id", "digest"], "left")
    marked = marked.select("doc_id", "text", F.col("marks.low").alias("lows"), F.col("marks.mask").alias("masks"))

    def task(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text, lows, masks in rows:
            yield doc_id, *without_marked(text, lows, masks)

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
    return map_rows(marked, ["doc_id", "text", "lows", "masks"], "doc_id long, n_words long, n_removed long, kept string", schema, task, lambda row: len(row[3]))
