"""Load metrics, run totals, statuses, notes and issue lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowharbor.functions.messages import (
    action_for_error,
    action_for_reason,
    classify_error,
    classify_reason,
)

#: Row statuses that add up to the rows read, and notes of a run.
REJECTED = ("rejected_pk", "rejected_type", "rejected_constraint", "rejected_fk")
LOADED = ("inserted", "updated", "unchanged")  # a dry run counts them as "valid"
NOTE_DEDUPED = "Deduplicated %d duplicate rows on keys %s"
NOTE_FK = "%d rows rejected due to missing foreign key references"
NOTE_IDEMPOTENT = (
    "No rows were inserted or updated because all rows already exist in the database with the same keys/data "
    "(idempotent load – database was already in sync with Excel)."
)
STATUS_ALL = ("SUCCESS", "PARTIAL SUCCESS")
STATUS_TABLE = ("SUCCESS", "PARTIAL", "ERROR")


def status_counts(rows: DataFrame, table: Column | str, status: Column | str) -> DataFrame:
    """Rows per (table, status)."""
    t = F.lit(table) if isinstance(table, str) else table
    s = F.col(status) if isinstance(status, str) else status
    return rows.groupBy(t.alias("table"), s.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def load_metrics(counts: DataFrame) -> DataFrame:
    """Per table: rows read, valid, rejected, deduplicated, inserted, updated, unchanged.

    ``counts`` has (table, status, n), every read row counted under one status. Rows
    stored over an equal row are ``unchanged`` and not part of ``updated``.
    """

    def total(*statuses: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("status").isin(*statuses), F.col("n"))), F.lit(0))

    return counts.groupBy("table").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("read_rows"),
        total(*LOADED, "valid", "rejected_fk").alias("valid_rows"),
        total(*REJECTED).alias("rejected_rows"),
        total("deduplicated").alias("deduplicated"),
        total("inserted").alias("inserted"),
        total("updated").alias("updated"),
        total("unchanged").alias("unchanged"),
    )


def run_totals(metrics: DataFrame) -> DataFrame:
    """Totals over all tables and the overall status."""
    totals = metrics.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}")
            for c in ("read_rows", "valid_rows", "rejected_rows", "inserted", "updated")
        ]
    )
    return totals.withColumn(
        "status", F.when(F.col("total_rejected_rows") == 0, STATUS_ALL[0]).otherwise(STATUS_ALL[1])
    )


def table_status(records: DataFrame) -> DataFrame:
    """Run records with their status; idle tables without an error note are left out."""
    read, rejected = F.col("read_rows"), F.col("rejected_rows")
    idle = (read == 0) & (F.col("inserted") == 0) & (F.col("updated") == 0)
    status = (
        F.when((rejected == 0) & (read > 0), STATUS_TABLE[0])
        .when(rejected > 0, STATUS_TABLE[1])
        .when((read == 0) & F.contains(F.col("notes"), F.lit("ERROR")), STATUS_TABLE[2])
        .when(idle, F.lit(None))
        .otherwise(STATUS_TABLE[2])
    )
    return records.withColumn("status", status).where("status IS NOT NULL")


def reason_counts(rejected: DataFrame, reason: str = "rejection_reason") -> DataFrame:
    """Rows per rejection reason, most frequent first."""
    return (
        rejected.groupBy(reason).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), reason)
    )


def merge_reasons(rejected: DataFrame, reason: str = "rejection_reason") -> DataFrame:
    """One row per distinct data row with its distinct reasons joined, for display.

    A data row has at most one reason per rule, so the set is small; equal rows are
    merged before the shuffle.
    """
    data = [c for c in rejected.columns if c != reason]
    return rejected.groupBy(*data).agg(
        F.array_join(F.array_sort(F.collect_set(reason)), "; ").alias(reason)
    )


def notes(reasons: DataFrame, table: str, seq: str, reason: str) -> DataFrame:
    """One text per table: its distinct reasons in first-seen order, joined with ``'; '``.

    Feed it reasons of bounded variety (see ``reason_kind``); the row-level reasons
    stay in the rejects table.
    """
    firsts = reasons.where(F.col(reason).isNotNull()).groupBy(table, reason).agg(F.min(seq).alias("_first"))
    ordered = F.array_sort(F.collect_list(F.struct("_first", F.col(reason).alias("_text"))))
    return firsts.groupBy(table).agg(F.array_join(F.transform(ordered, lambda x: x["_text"]), "; ").alias("notes"))


ACTIVITY = ("read_rows", "inserted", "updated", "rejected_rows")


def dedupe_run_records(records: DataFrame, seq: str) -> DataFrame:
    """One record per (sheet, table): the most active, the first of equals.

    Records tied with it add their notes in order, unless the text is already there.
    """
    keys = ["sheet", "table"]
    active = records.withColumn("_activity", sum((F.coalesce(F.col(c), F.lit(0)) for c in ACTIVITY), F.lit(0)))
    rest = [c for c in records.columns if c not in (*keys, "notes")]
    best = active.groupBy(*keys).agg(
        F.max(F.struct("_activity", (-F.col(seq)).alias("_order"), *[F.col(c).alias(f"_b_{c}") for c in rest])).alias("_best")
    )
    # Notes per activity level: equal notes collapse before they are gathered.
    noted = active.groupBy(*keys, "_activity", "notes").agg(F.min(seq).alias("_first"))
    top = best.select(*keys, F.col("_best._activity").alias("_activity"), *[F.col(f"_best._b_{c}").alias(c) for c in rest])
    tied = (
        noted.join(top.select(*keys, "_activity"), [*keys, "_activity"], "left_semi")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("_first", F.coalesce("notes", F.lit("")).alias("_text")))).alias("_notes"))
    )
    joined = F.aggregate(
        "_notes",
        F.lit(""),
        lambda acc, x: F.when(F.contains(acc, x["_text"]), acc)
        .when(acc == "", x["_text"])
        .otherwise(F.concat(acc, F.lit("; "), x["_text"])),
    )
    order = [c for c in records.columns]
    return top.join(tied, keys, "left").withColumn("notes", joined).select(order)


def sorted_report(records: DataFrame) -> DataFrame:
    """Records in report order."""
    return records.orderBy("sheet", "table")


def issues(records: DataFrame, reasons: str = "reasons") -> DataFrame:
    """One (sheet, table, issue, action) row per reason of a record with rejects."""
    exploded = records.where(F.col("rejected_rows") > 0).select("sheet", "table", F.explode(reasons).alias("_r"))
    return exploded.select(
        "sheet",
        "table",
        classify_reason(F.col("_r")).alias("issue"),
        action_for_reason(F.col("_r")).alias("action_needed"),
    )


def error_records(errors: DataFrame) -> DataFrame:
    """Run records of tables that failed; input has (sheet, table, error)."""
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("read_rows", "valid_rows", "rejected_rows", "inserted", "updated")]
    return errors.select(
        "sheet",
        "table",
        *zero,
        F.concat(F.lit("ERROR: "), F.col("error")).alias("notes"),
        classify_error(F.col("error"), F.col("table")).alias("business_error"),
        action_for_error(F.col("error")).alias("action_needed"),
    )


def idempotent_note(metrics: DataFrame) -> DataFrame:
    """Metrics with the no-op note where rows were read but nothing changed."""
    noop = (
        (F.col("inserted") == 0)
        & (F.col("updated") == 0)
        & (F.col("rejected_rows") == 0)
        & (F.col("read_rows") > 0)
        & (F.col("valid_rows") > 0)
    )
    return metrics.withColumn("notes", F.when(noop, F.lit(NOTE_IDEMPOTENT)).otherwise(F.lit("")))


def standard_notes(deduplicated: int, fk_rejected: int, pk: Sequence[str]) -> list[str]:
    """Notes a run adds after its reject reasons."""
    out = []
    if deduplicated:
        out.append(NOTE_DEDUPED % (deduplicated, list(pk)))
    if fk_rejected:
        out.append(NOTE_FK % fk_rejected)
    return out
