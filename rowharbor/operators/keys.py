"""Key handling: keep-last, duplicate counts, generated keys."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F

from rowharbor.functions.text import KEY_TOKENS, is_missing
from rowharbor.operators.clean import ROW_SEQ
from rowharbor.session import cut_lineage
from rowharbor.spec import SpecError

#: ``monotonically_increasing_id`` keeps the position within a partition in this many bits.
_POSITION_BITS = 33

#: Present keys that count as whole numbers, also with a decimal point and zeros.
WHOLE_KEY = r"^\s*\+?[0-9]{1,18}(\.0*)?\s*$"


def dedupe_last(df: DataFrame, pk: Sequence[str], order_by: Sequence[str] = (ROW_SEQ,)) -> DataFrame:
    """Keep the last row per key in ``order_by``, which must be a total order within a key.

    Ranking with a limit of one lets every task drop all but its own last row of a key
    before the shuffle, so a key held by many rows sends one row per task.
    """
    absent = [c for c in pk if c not in df.columns]
    if absent:
        raise SpecError(f"primary key columns absent from the rows: {absent}")
    last_first = Window.partitionBy(*pk).orderBy(*[F.col(c).desc() for c in order_by])
    return df.withColumn("_rn", F.row_number().over(last_first)).where("_rn = 1").drop("_rn")


def dup_count(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, and rows a keep-last removes."""
    per_key = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("_n"))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return per_key.agg(
        total.alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), (total - F.count(F.lit(1))).alias("n_removed")
    )


def number_rows(df: DataFrame, seq: str, start: int, out: str) -> DataFrame:
    """Consecutive numbers in ``seq`` order without bringing all rows to one task.

    Rows are range-partitioned and sorted by ``seq`` and written once with their
    position, which holds the partition in its upper bits. Each partition is then
    shifted by the rows of the partitions before it. The driver sees one count per
    partition, never rows; writing fixes the positions, so a repeated task cannot
    renumber them.
    """
    placed = df.repartitionByRange(F.col(seq)).sortWithinPartitions(seq)
    stored = cut_lineage(placed.withColumn("_pos", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_pos", _POSITION_BITS).cast("int")
    index = F.col("_pos").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    counts = {r["part"]: r["n"] for r in stored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return stored.withColumn(out, F.lit(None).cast("bigint")).drop("_pos")
    sizes = [counts.get(i, 0) for i in range(max(counts) + 1)]
    shifts = F.array(*[F.lit(start + s) for s in [0, *accumulate(sizes)][: len(sizes)]]).cast("array<bigint>")
    return stored.withColumn(out, F.element_at(shifts, part + 1) + index).drop("_pos")


def generate_keys(
    df: DataFrame, column: str, seq: str = ROW_SEQ, start: str = "after_max", tokens: Sequence[str] = KEY_TOKENS
) -> DataFrame:
    """Fill missing keys with consecutive numbers in row order; present keys and the column's type stay.

    ``start="one"`` numbers from 1 even where that collides with present keys;
    ``start="after_max"`` continues after the largest present key that is a whole number. In a text column
    the new keys are written as text.
    """
    if start not in ("one", "after_max"):
        raise SpecError(f"unknown start {start!r}")
    missing = is_missing(F.col(column), tokens)
    present, kind = df.where(~missing), df.schema[column].dataType
    first = 1
    if start == "after_max":
        whole = F.when(F.col(column).cast("string").rlike(WHOLE_KEY), F.floor(F.col(column).cast("string").try_cast("decimal(38,2)")).try_cast("bigint"))
        first = max(present.agg(F.max(whole).alias("m")).first()["m"] or 0, 0) + 1
    order = df.columns
    filled = number_rows(df.where(missing).drop(column), seq, first, column).withColumn(column, F.col(column).cast(kind))
    return present.select(order).unionByName(filled.select(order))
