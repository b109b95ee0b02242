"""Incremental loads driven by arriving files."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from rowharbor.operators.merge import CHANGE, KEPT
from rowharbor.plans.load import load_table
from rowharbor.session import ROW_GROUP, cut_lineage
from rowharbor.sources.changes import current_rows, write_changes
from rowharbor.sources.tables import write_rejects
from rowharbor.spec import TableSpec

#: Folder whose files are outputs and must not trigger a load.
REPORTS = "/reports/"

#: Helper column: the place of a row in its batch. Names of data columns are trimmed, so a leading blank sets it apart.
PLACE = " place"


def stream_files(
    spark: SparkSession, folder: str, schema: T.StructType | str, fmt: str = "parquet", files_per_batch: int | None = 1
) -> DataFrame:
    """Rows of every new file under ``folder``, sub-folders included, except those under ``reports/``.

    Files come one per batch, oldest first, so that of two files with a key the later one wins; None takes all that wait.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    rows = reader.format(fmt).load(folder)
    return rows.where(~F.contains(F.col("_metadata.file_path"), F.lit(REPORTS)))


def upsert_batch(
    rows: DataFrame,
    batch: str,
    path: str,
    spec: TableSpec,
    parents: Mapping[str, DataFrame] | None = None,
    seq: str | None = None,
    rejects_folder: str | None = None,
) -> dict[str, int]:
    """Load one batch into the change table at ``path``; returns its counts by status.

    The stored rows of the batch's keys are read once, from the buckets of those keys, and whole rows are written for the
    keys that change. A batch that is loaded again leaves the same table and the same rejects.
    """
    spark = rows.sparkSession

    def held(keys: DataFrame) -> DataFrame:
        found = current_rows(spark, path, spec.pk, keys, without=batch)
        return spark.createDataFrame([], spec.storage_schema()) if found is None else found

    outcome = load_table(rows, spec, held, parents, seq=seq)
    if rejects_folder:
        for kind, part in (("row", outcome.rejected), ("fk", outcome.fk_rejected)):
            write_rejects(part, f"{rejects_folder}/batch={batch}/kind={kind}", spec.name, mode="overwrite")
    if outcome.tally["inserted"] or outcome.tally["updated"]:
        changed = outcome.changes.where(F.col(CHANGE) != "unchanged").drop(CHANGE)
        write_changes(changed, path, batch, spec.pk)
    return {s: n for s, n in outcome.tally.items() if n and s != KEPT}


def stream_load(
    stream: DataFrame,
    path: str,
    spec: TableSpec,
    checkpoint: str,
    parents: Callable[[], Mapping[str, DataFrame]] | None = None,
    seq: str | None = None,
    rejects_folder: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that upserts each batch of files into the change table at ``path``.

    Batches are named by the query's own id, which its checkpoint keeps, and their number: two queries, or one that has
    lost its checkpoint, never take each other's batches for their own. ``parents`` is called per batch so that
    reference tables are read fresh.
    """

    def load(rows: DataFrame, batch_id: int) -> None:
        query = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        # A batch is often a single file, written by one task: its copy is what the tasks of the load share out.
        # Rows without an order of their own get their place in it, which sorts like the path and row of the copy in eight bytes.
        placed = rows if seq else rows.withColumn(PLACE, F.monotonically_increasing_id())
        stable = cut_lineage(placed, f"{spec.name}-batch", ROW_GROUP)
        upsert_batch(stable, f"{query}-{batch_id}", path, spec, parents() if parents else None, seq or PLACE, rejects_folder)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
