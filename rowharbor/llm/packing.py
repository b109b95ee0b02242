"""Packing of documents into token sequences of even attention cost.

Each task cuts its documents into full sequences and one remainder per document, holds the
remainders of ``window`` documents, and deals them out in descending length: a remainder goes to the sequence of
lowest cost (``linear * n + quadratic * n * n`` summed over its pieces) that still has room for it. A window opens
as many sequences as its tokens need, so at most one sequence's worth of padding is left per window; a piece
that fits nowhere is cut to the largest rooms left. No shuffle is needed and memory is bounded by the window.

Ids are those of the byte-level vocabulary that the rank file lists, and of the ``added`` tokens where a text holds their
names, with ``end_id`` after each document.

Defined cases: a NULL or empty text is the end id alone; NULL document ids are kept; repeated rows are packed
as often as they stand; equal lengths keep their order of reading; an empty table gives no rows; other
columns are not read. Sequence ids hold the number of the input partition, so the input should be a table, whose
partitions are the same when a task is run again.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame

from rowharbor.llm.arrow_tasks import map_rows
from rowharbor.llm.bpe import encode_text, encoder

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
DDL = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Balancer:
    """Open sequences by the room they have left; each room keeps its sequences in order of cost."""

    def __init__(self, sequences: int, capacity: int, linear: float, quadratic: float):
        self.linear, self.quadratic = linear, quadratic
        self.by_room: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
        self.by_room[capacity] = [(0.0, s) for s in range(sequences)]
        self.lowest = np.full(capacity + 1, np.inf)
        self.lowest[capacity] = 0.0 if sequences else np.inf

    def place(self, length: int) -> tuple[int, int, int]:
        """Sequence, room it had, and how many of the ``length`` tokens it takes."""
        rooms = self.lowest[length:]
        room = length + int(rooms.argmin()) if len(rooms) and np.isfinite(rooms.min()) else int(np.flatnonzero(np.isfinite(self.lowest))[-1])
        taken = min(length, room)
        cost, sequence = heapq.heappop(self.by_room[room])
        self._refresh(room)
        if room > taken:
            cost += self.linear * taken + self.quadratic * taken * taken
            heapq.heappush(self.by_room[room - taken], (cost, sequence))
            self._refresh(room - taken)
        return sequence, room, taken

    def _refresh(self, room: int) -> None:
        heap = self.by_room[room]
        self.lowest[room] = heap[0][0] if heap else np.inf


def pack_window(lengths: list[int], capacity: int, linear: float, quadratic: float) -> Iterator[tuple[int, int, int, int, int]]:
    """Yields item, start in the item, length, sequence and offset of each piece; lengths are 1 to ``capacity``."""
    balancer = Balancer(-(-sum(lengths) // capacity), capacity, linear, quadratic)
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        start, left = 0, lengths[item]
        while left:
            sequence, room, taken = balancer.place(left)
            yield item, start, taken, sequence, capacity - room
            start += taken
            left -= taken


def pack_documents(
    docs: DataFrame,
    vocabulary: Broadcast,
    pattern: str,
    capacity: int = 1024,
    end_id: int = 0,
    window: int = 2048,
    linear: float = 1.0,
    quadratic: float = 1.0 / 1024,
    added: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per piece; ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers."""

    def task(rows):
        encoding = encoder(vocabulary.value, pattern)
        first = TaskContext.get().partitionId() << 32
        held: list[tuple[int | None, int, bytes, int]] = []

        def deal():
            nonlocal first
            used = 0
            for item, start, length, sequence, offset in pack_window([len(x[2]) // 4 for x in held], capacity, linear, quadratic):
                doc_id, before, ids, total = held[item]
                yield doc_id, before + start, length, ids[4 * start : 4 * (start + length)], total, first + sequence, offset
                used = max(used, sequence + 1)
            first += used
            held.clear()

        for doc_id, text in rows:
            ids = np.array(encode_text(encoding, text, added=added) + [end_id], "<u4")
            total, full = len(ids), len(ids) // capacity * capacity
            for start in range(0, full, capacity):
                yield doc_id, start, capacity, ids[start : start + capacity].tobytes(), total, first, 0
                first += 1
            if total > full:
                held.append((doc_id, full, ids[full:].tobytes(), total))
            if len(held) >= window:
                yield from deal()
        yield from deal()

    return map_rows(docs, ["doc_id", "text"], DDL, SCHEMA, task, lambda row: len(row[3]))
