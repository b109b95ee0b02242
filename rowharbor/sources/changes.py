"""A keyed table as parquet folders of whole rows, one folder per batch; the newest row of a key is current.

Batches only add files, so nothing that is read is rewritten and writers of different batches do not meet. A batch
that is delivered again replaces its own folder. The folder names carry the version and the batch, and the files of a batch lie in
folders by bucket of the key: the next version is found by listing, and a batch reads the buckets of its own keys only.
Every batch has all columns of the table, so the newest one tells the schema. One writer at a time is assumed per
table; where a catalog with row-level changes is at hand, use ``merge_into_catalog``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rowharbor.operators.clean import evolve_target
from rowharbor.operators.keys import dedupe_last
from rowharbor.operators.merge import as_stored
from rowharbor.session import ROW_GROUP

VERSION = "_version"
BATCH = "_batch"
BUCKET = "_bucket"
#: Buckets of a table, for as long as it lives. A bucket that grows large has many files, not one.
BUCKETS = 64


def bucket(pk: Sequence[str]) -> Column:
    """The bucket of a key, the same for keys of equal text."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in pk]), F.lit(BUCKETS)).cast("int")


def batches(spark: SparkSession, path: str) -> dict[str, int]:
    """Version of every batch, from the names of the folders."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{VERSION}=*/{BATCH}=*")
    found = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(pattern)
    names = [(p.getParent().getName(), p.getName()) for p in (s.getPath() for s in found or [])]
    return {batch.removeprefix(f"{BATCH}="): int(version.removeprefix(f"{VERSION}=")) for version, batch in sorted(names)}


def _folder(path: str, version: int, batch: str) -> str:
    return f"{path.rstrip('/')}/{VERSION}={version}/{BATCH}={batch}"


def _schema(spark: SparkSession, path: str, held: dict[str, int]) -> T.StructType:
    """Columns of the table, from its newest batch."""
    newest = max(held, key=lambda b: (held[b], b))
    return T.StructType([f for f in spark.read.parquet(_folder(path, held[newest], newest)).schema if f.name != BUCKET])


def change_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of all batches with ``_version``, ``_batch`` and ``_bucket``; None where nothing was written yet."""
    held = batches(spark, path)
    if not held:
        return None
    schema = _schema(spark, path, held).add(VERSION, T.LongType()).add(BATCH, T.StringType()).add(BUCKET, T.IntegerType())
    return spark.read.schema(schema).parquet(path)


def current_rows(spark: SparkSession, path: str, pk: Sequence[str], keys: DataFrame | None = None, without: str | None = None) -> DataFrame | None:
    """The newest row of every key, or of the given keys only; ``without`` leaves one batch out.

    With ``keys``, only the folders of their buckets are read, and those of batches written without a key.
    """
    rows = change_rows(spark, path)
    if rows is None:
        return None
    if without is not None:
        rows = rows.where(F.col(BATCH) != without)
    if keys is not None:
        touched = [r[0] for r in keys.select(bucket(pk)).distinct().collect()]  # at most BUCKETS
        rows = rows.where(F.col(BUCKET).isin(touched) | F.col(BUCKET).isNull())
        rows = rows.join(keys.select(*pk).distinct(), list(pk), "left_semi").select(rows.columns)
    return dedupe_last(rows, pk, (VERSION, BATCH)).drop(VERSION, BATCH, BUCKET)


def write_changes(rows: DataFrame, path: str, batch: str, pk: Sequence[str] | None = None) -> None:
    """Write whole rows as one batch; the rows of an earlier delivery of it are replaced.

    The rows get the columns and types of the table and may add columns to it. Without ``pk`` they lie in no bucket and are read every time.
    """
    spark = rows.sparkSession
    held = batches(spark, path)
    if held:
        table = evolve_target(spark.createDataFrame([], _schema(spark, path, held)), rows)
        rows = table.unionByName(as_stored(rows, table.schema), allowMissingColumns=True)
    version = held.get(batch, max(held.values(), default=0) + 1)
    placed = rows.withColumn(BUCKET, bucket(pk) if pk else F.lit(None).cast("int"))
    placed.hint("rebalance", BUCKET).write.option("parquet.block.size", ROW_GROUP).mode("overwrite").partitionBy(BUCKET).parquet(_folder(path, version, batch))


def rewrite(spark: SparkSession, path: str, pk: Sequence[str], to: str) -> None:
    """The current rows as a single batch of a new table, for when many batches have gathered."""
    rows = current_rows(spark, path, pk)
    if rows is not None:
        write_changes(rows, to, "start", pk)
