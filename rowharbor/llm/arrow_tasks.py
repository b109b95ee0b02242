"""Row-wise Python work on Arrow batches, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

Row = tuple

#: Rows and bytes of text after which an output slice is handed back to Spark.
SLICE_ROWS = 1024
SLICE_BYTES = 16 << 20


def rows_of(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[Row]:
    """The named columns of every row as Python values, one small slice at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            yield from zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns), strict=True)


def batches_of(rows: Iterable[Row], schema: pa.Schema, weight: Callable[[Row], int] | None = None) -> Iterator[pa.RecordBatch]:
    """Rows packed into batches; ``weight`` gives the bytes of a row where rows can be long."""
    held: list[Row] = []
    size = 0
    for row in rows:
        held.append(row)
        size += weight(row) if weight else 0
        if len(held) >= SLICE_ROWS or size >= SLICE_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[Row], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def map_rows(
    df: DataFrame,
    columns: list[str],
    ddl: str,
    schema: pa.Schema,
    task: Callable[[Iterator[Row]], Iterable[Row]],
    weight: Callable[[Row], int] | None = None,
) -> DataFrame:
    """Run ``task`` over the rows of each partition; no shuffle, and no other column is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(task(rows_of(batches, columns)), schema, weight)

    return df.select(*columns).mapInArrow(run, ddl)
