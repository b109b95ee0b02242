"""Keyed loads: upsert, change classes, replace.

``target`` and ``incoming`` must each hold a key once (run ``dedupe_last`` first) and
no NULL keys. Stored and arriving rows are put side by side once, and the new row, its class and
its old values are read from that pair: by one full outer join, or, where Spark's estimate of the batch is within its
broadcast limit, by joins that leave the target where it is. A value the stored column cannot hold is
never stored as NULL: it stops the load, or its row is handed back (``upsert_or_reject``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowharbor.operators.clean import evolve_target, project_to_target
from rowharbor.operators.coerce import REASON
from rowharbor.operators.validate import fill_defaults, range_reason
from rowharbor.session import fits_broadcast

CHANGE = "change"
KEPT = "kept"

#: Prefixes of stored and arriving columns side by side; the bare prefix says whether that side is there.
STORED, ARRIVED = "_t_", "_i_"


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(f"`{c}`").alias(f"{prefix}{c}") for c in df.columns])


def stored(c: str) -> Column:
    return F.col(f"`{STORED}{c}`")


def arrived(c: str) -> Column:
    return F.col(f"`{ARRIVED}{c}`")


def side_by_side(target: DataFrame, incoming: DataFrame, pk: Sequence[str], mergeable: str | None = None, one_scan: bool = False) -> DataFrame:
    """Every stored row next to the arriving row of its key, and the arriving rows without one.

    ``mergeable`` names a true-or-false column of ``incoming``; rows where it is not true stand alone. The flags ``_t_``
    and ``_i_`` say which sides a row has. ``one_scan`` asks for the full join at any size, for a target that is dear to read.
    """
    left = _prefixed(target, STORED).withColumn(STORED, F.lit(True))
    right = _prefixed(incoming, ARRIVED).withColumn(ARRIVED, F.lit(True))
    match = reduce(and_, [stored(c) == arrived(c) for c in pk])
    if mergeable:
        match = match & arrived(mergeable)
    if one_scan or not fits_broadcast(incoming):
        return left.join(right, match, "full")
    kept = left.join(right.where(arrived(mergeable)) if mergeable else right, match, "left")
    known = left.select([stored(c) for c in pk]).join(right, match, "left_semi")
    alone = right.join(known, match, "left_anti")
    return kept.unionByName(alone, allowMissingColumns=True)


def _strict(value: Column, name: str, kind: T.DataType) -> Column:
    """The value as the stored type, which must be able to hold it."""
    message = F.concat(F.lit(f"{name} cannot hold "), value.cast("string"), F.lit(f" as {kind.simpleString()}"))
    return F.coalesce(value.try_cast(kind), F.when(value.isNotNull(), F.raise_error(message)).cast(kind))


def as_stored(incoming: DataFrame, schema: T.StructType) -> DataFrame:
    """The arriving rows in the stored types; a value that does not fit raises an error when it is read."""
    kinds, own = {f.name: f.dataType for f in schema}, {f.name: f.dataType for f in incoming.schema}
    return incoming.select([F.col(f"`{c}`") if own[c] == kinds[c] else _strict(F.col(f"`{c}`"), c, kinds[c]).alias(c) for c in incoming.columns])


def merged_value(field: T.StructField, columns: Sequence[str], pk: Sequence[str], defaults: Mapping[str, object]) -> Column:
    """The value a column has after the merge, from both sides; ``columns`` are those of the batch."""
    c = field.name
    if c in columns:
        return F.when(F.col(ARRIVED), arrived(c)).otherwise(stored(c)).alias(c)
    if c in defaults:
        value = F.current_timestamp() if defaults[c] == "now" else F.lit(defaults[c])
        return F.when(F.col(STORED), stored(c)).otherwise(value.try_cast(field.dataType)).alias(c)
    return stored(c).alias(c)


def merged_change(columns: Sequence[str], pk: Sequence[str]) -> Column:
    """``kept``, ``inserted``, ``updated`` or ``unchanged``, from both sides."""
    same = reduce(and_, [stored(c).eqNullSafe(arrived(c)) for c in columns if c not in pk], F.lit(True))
    found = F.when(F.col(ARRIVED).isNull(), F.lit(KEPT)).when(F.col(STORED).isNull(), F.lit("inserted"))
    return found.when(same, F.lit("unchanged")).otherwise(F.lit("updated"))


def merged(target: DataFrame, incoming: DataFrame, pk: Sequence[str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """The rows of the table after the load, each with its ``change``; see :func:`upsert`."""
    wide = evolve_target(target, incoming)
    both = side_by_side(wide, as_stored(incoming, wide.schema), pk)
    values = [merged_value(f, incoming.columns, pk, defaults or {}) for f in wide.schema]
    return both.select(*values, merged_change(incoming.columns, pk).alias(CHANGE))


def classify_changes(target: DataFrame, incoming: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Incoming rows with ``change``: ``inserted``, ``updated`` or ``unchanged``."""
    shared = [c for c in incoming.columns if c in target.columns]
    both = side_by_side(target.select(shared), incoming, pk).where(F.col(ARRIVED))
    return both.select(*[arrived(c).alias(c) for c in incoming.columns], merged_change(shared, pk).alias(CHANGE))


def change_counts(target: DataFrame, incoming: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One row: inserted, updated and unchanged incoming rows.

    An upsert statement that overwrites every present key reports updated plus unchanged.
    """
    seen = classify_changes(target, incoming, pk)
    return seen.agg(*[F.count_if(F.col(CHANGE) == kind).alias(kind) for kind in ("inserted", "updated", "unchanged")])


def upsert(
    target: DataFrame, incoming: DataFrame, pk: Sequence[str], defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Target after inserting new keys and overwriting the incoming columns of present keys.

    An incoming NULL overwrites. Columns the batch lacks keep their stored value on
    update and get their default (else NULL) on insert. Columns the target lacks are
    added to it. A batch of keys only inserts what is absent. A value that its column cannot hold is an error.
    """
    return merged(target, incoming, pk, defaults).drop(CHANGE)


def upsert_or_reject(
    target: DataFrame, incoming: DataFrame, pk: Sequence[str], defaults: Mapping[str, object] | None = None
) -> tuple[DataFrame, DataFrame]:
    """:func:`upsert` of the rows whose values the target can hold, and the others with their first reason."""
    checked = incoming.withColumn(REASON, range_reason(incoming, evolve_target(target, incoming).schema))
    good = checked.where(F.col(REASON).isNull()).drop(REASON)
    return upsert(target, good, pk, defaults), checked.where(F.col(REASON).isNotNull())


def merge_into_catalog(incoming: DataFrame, table: str, pk: Sequence[str]) -> None:
    """The same upsert as a MERGE on a catalog table whose format supports row-level changes.

    Preferred for very large targets: the table format rewrites only touched files.
    """
    condition = reduce(and_, [F.col(f"{table}.{c}") == F.col(f"incoming.{c}") for c in pk])
    values = {c: F.col(f"incoming.{c}") for c in incoming.columns}
    changed = {c: v for c, v in values.items() if c not in pk}
    writer = incoming.alias("incoming").mergeInto(table, condition)
    if changed:
        writer = writer.whenMatched().update(changed)
    writer.whenNotMatched().insert(values).merge()


def replace(target: DataFrame, incoming: DataFrame, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Only the incoming rows, or the target untouched when no incoming row is left.

    Columns the batch lacks get their default, else NULL. A value that its column cannot hold is an error.
    """
    if incoming.isEmpty():
        return target
    rows = project_to_target(fill_defaults(incoming, defaults or {}), target.columns)
    return target if rows is None else _typed_like(target, rows)


def _typed_like(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows in the columns and types of the target."""
    own = {f.name: f.dataType for f in rows.schema}

    def value(f: T.StructField) -> Column:
        if f.name not in own:
            return F.lit(None).cast(f.dataType)
        return F.col(f"`{f.name}`") if own[f.name] == f.dataType else _strict(F.col(f"`{f.name}`"), f.name, f.dataType)

    return rows.select([value(f).alias(f.name) for f in target.schema])


def verify_load(before: DataFrame, after: DataFrame, processed: DataFrame) -> DataFrame:
    """One row: rows before, after and added, rows processed, and a warning when fewer were added."""

    def rows(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    one = after.agg(F.count(F.lit(1)).alias("rows_after"))
    counted = one.select(
        rows(before).alias("rows_before"), "rows_after", rows(processed).alias("rows_processed")
    ).withColumn("rows_added", F.col("rows_after") - F.col("rows_before"))
    return counted.withColumn("warning", load_warning())


def load_warning() -> Column:
    """Text for a load that added fewer rows than it processed, from ``rows_added`` and ``rows_processed``."""
    added, processed = F.col("rows_added"), F.col("rows_processed")
    return F.when((added == 0) & (processed > 0), "no rows were added").when(added < processed, "fewer rows added than processed")
