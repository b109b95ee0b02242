"""Product codes for vectors: each part of a vector becomes the index of its nearest codebook entry.

Components are scaled to whole numbers, so every distance is exact. The codebooks start as the parts of the vectors of smallest id. A
round assigns every part to its nearest entry (the lower index of equally near ones) and replaces each entry by the rounded-down mean of its parts.

Codes and exact distances are kept with the vectors between rounds. Where the entry a part is assigned to has not moved, all
unmoved entries are still no nearer than it, so the part compares only the entries that moved with its stored distance; a part whose own
entry moved is compared with all of them. Tasks add up the parts of each entry before the shuffle; the driver holds the codebooks and their
sums, which have a fixed number of entries.

Defined cases: vectors that are NULL or hold NULL or non-finite components are left out; vectors of fewer components than the longest
are filled with zeros, as is the longest up to a multiple of the parts; scaled components beyond ``LARGEST`` in size count as
``LARGEST``, so that no sum overflows; rows are ordered by id (NULL first), then components; fewer vectors than entries give
shorter codebooks; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowharbor.session import cut_lineage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 27
SLICE = 4096

_STATE = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("vector", pa.binary()), ("codes", pa.binary()), ("distances", pa.binary())])
_STATE_DDL = "vec_id long, label string, vector binary, codes binary, distances binary"


def finite_vectors(rows: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``vec_id, label, v``: the vectors that take part; labels are compared as text."""
    v = F.col(vector_column)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(v.isNotNull() & good).select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("string").alias("label"), v.cast("array<double>").alias("v"))


def scaled(batch: pa.RecordBatch, length: int) -> np.ndarray:
    """The whole-number components of a batch of vectors, one row each."""
    column = batch.column(batch.schema.get_field_index("v"))
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.clip(np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE), -LARGEST, LARGEST).astype(np.int64)
    out = np.zeros((len(sizes), length), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def distances_to(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every part to every entry."""
    largest = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * largest * largest * parts.shape[1] < 1 << 53:  # whole numbers that doubles hold
        a, b = parts.astype(float), entries.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]).astype(np.int64)
    return np.stack([((parts - e) ** 2).sum(1) for e in entries], 1)


def assign(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every part and its distance, by comparing all entries."""
    found = distances_to(parts, entries)
    code = found.argmin(1)
    return code, found[np.arange(len(code)), code]


def reassign(parts: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`assign` from the codes and distances of the round before, where ``moved`` says which entries changed since."""
    code, distance = code.copy(), distance.copy()
    lost = moved[code]
    if lost.any():
        code[lost], distance[lost] = assign(parts[lost], entries)
    active = np.flatnonzero(moved)
    stayed = np.flatnonzero(~lost)
    if len(active) and len(stayed):
        near, to = assign(parts[stayed], entries[active])
        near = active[near]
        better = (to < distance[stayed]) | ((to == distance[stayed]) & (near < code[stayed]))
        code[stayed[better]], distance[stayed[better]] = near[better], to[better]
    return code, distance


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def _state(batch: pa.RecordBatch, vectors: np.ndarray, codes: np.ndarray, distances: np.ndarray) -> pa.RecordBatch:
    rows = lambda x, kind: pa.array([r.tobytes() for r in np.ascontiguousarray(x, kind)], pa.binary())
    return pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), rows(vectors, "<i4"), rows(codes, "u1"), rows(distances, "<i8")], schema=_STATE)


def _matrix(batch: pa.RecordBatch, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, -1).astype(np.int64)


def first_codes(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """Vectors with the codes and distances of the first assignment. ``books``: part, entry, component."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            vectors = scaled(batch, parts * width)
            found = [assign(vectors[:, p * width : (p + 1) * width], books[p]) for p in range(parts)]
            yield _state(batch, vectors, np.stack([c for c, _ in found], 1), np.stack([d for _, d in found], 1))

    return vectors.mapInArrow(run, _STATE_DDL)


def next_codes(state: DataFrame, books: np.ndarray, moved: np.ndarray) -> DataFrame:
    """The state after the codebooks have become ``books``; ``moved``: part, entry."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            vectors, codes, distances = _matrix(batch, "vector", "<i4"), _matrix(batch, "codes", "u1"), _matrix(batch, "distances", "<i8")
            found = [reassign(vectors[:, p * width : (p + 1) * width], books[p], moved[p], codes[:, p], distances[:, p]) for p in range(parts)]
            yield _state(batch, vectors, np.stack([c for c, _ in found], 1), np.stack([d for _, d in found], 1))

    return state.mapInArrow(run, _STATE_DDL)


def entry_sums(state: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the parts assigned to each entry; tasks send one row per entry they have met."""
    parts, entries, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in _slices(batches):
            slot = _matrix(batch, "codes", "u1") + np.arange(parts) * entries
            np.add.at(sums, slot.ravel(), _matrix(batch, "vector", "<i4").reshape(-1, width))
            counts += np.bincount(slot.ravel(), minlength=len(counts))
        met = np.flatnonzero(counts)
        columns = [pa.array(met), pa.array(counts[met]), pa.array(list(sums[met]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "n", "total"])

    sent = state.select("vector", "codes").mapInArrow(run, "slot long, n long, total array<long>")
    added = sent.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)])
    sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
    for row in added.collect():  # at most a row per entry of the codebooks
        counts[row["slot"]], sums[row["slot"]] = row["n"], row[2:]
    return sums.reshape(shape), counts.reshape(parts, entries)


def first_books(vectors: DataFrame, length: int, parts: int, entries: int) -> np.ndarray:
    """The parts of the vectors of smallest id."""
    rows = vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_first(), "v").limit(entries).collect()
    batch = pa.RecordBatch.from_arrays([pa.array([r["v"] for r in rows], pa.list_(pa.float64()))], ["v"])
    return scaled(batch, length).reshape(len(rows), parts, length // parts).transpose(1, 0, 2).copy()


def vector_codes(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, codes`` (one byte per part) and ``error`` of every vector, and the final codebooks (part, entry, component)."""
    vectors = finite_vectors(rows, id_column, vector_column, label_column)
    longest = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    length = max(parts, -(-longest // parts) * parts)
    books = first_books(vectors, length, parts, entries)
    if not books.shape[1]:
        return rows.sparkSession.createDataFrame([], "vec_id long, label string, codes binary, error long"), books
    state = cut_lineage(first_codes(vectors, books), "vector-codes")
    for _ in range(rounds):
        sums, counts = entry_sums(state, books.shape)
        used = counts > 0
        fresh = books.copy()
        fresh[used] = sums[used] // counts[used][:, None]
        moved = (fresh != books).any(2)
        books = fresh
        state = cut_lineage(next_codes(state, books, moved), "vector-codes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            error = pa.array(_matrix(batch, "distances", "<i8").sum(1))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), batch.column("codes"), error], ["vec_id", "label", "codes", "error"])

    return state.mapInArrow(run, "vec_id long, label string, codes binary, error long"), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all vectors of the same label; those without a label are together."""
    totals = coded.groupBy(F.col("label").alias("own_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, coded["label"].eqNullSafe(totals["own_label"]), "left").drop("own_label")


def books_digest(books: np.ndarray) -> str:
    return sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
