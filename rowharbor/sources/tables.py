"""Named tables: load many, count, export, keep rejects, look at the first rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rowharbor.spec import SpecError

@dataclass
class LoadedTables:
    """Tables that could be read, and the error of each that could not."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def read_tables(
    spark: SparkSession, folder: str, names: Sequence[str], fmt: str = "parquet", all_text: bool = False
) -> LoadedTables:
    """Read the named tables of a folder; a table that is absent or unreadable is recorded, not raised.

    CSV is read with a header and without type inference. ``all_text`` turns every
    column to text, the form in which untrusted batches enter a load.
    """
    out = LoadedTables()
    for name in names:
        path = f"{folder.rstrip('/')}/{name}.{fmt}"
        try:
            if fmt == "csv":
                df = spark.read.csv(path, header=True, inferSchema=False, multiLine=False)
            else:
                df = spark.read.format(fmt).load(path)
            out.tables[name] = df.select([F.col(f"`{c}`").cast("string") for c in df.columns]) if all_text else df
        except Exception as e:  # an unreadable file may raise anything
            out.errors[name] = str(e).splitlines()[0]
    return out


def table_names(spark: SparkSession, folder: str, fmt: str = "parquet") -> list[str]:
    """Names of the tables of a folder, sorted."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*.{fmt}")
    found = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(pattern)
    return sorted(s.getPath().getName().removesuffix(f".{fmt}") for s in found or [])


def loaded_counts(loaded: LoadedTables, spark: SparkSession) -> DataFrame:
    """Name, row count (NULL when the table failed) and error of every requested table, sorted by name."""
    schema = T.StructType(
        [
            T.StructField("table_name", T.StringType()),
            T.StructField("n_rows", T.LongType()),
            T.StructField("error", T.StringType()),
        ]
    )
    result = spark.createDataFrame([(n, None, e) for n, e in loaded.errors.items()], schema)
    for name, df in loaded.tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(None).cast("string").alias("error")
        )
        result = result.unionByName(one)
    return result.orderBy("table_name")


def table_inventory(spark: SparkSession, folder: str, names: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Name and row count as text for each table, ``Error`` for those that fail, sorted by name."""
    counts = loaded_counts(read_tables(spark, folder, names, fmt), spark)
    return counts.select(
        "table_name", F.coalesce(F.col("n_rows").cast("string"), F.lit("Error")).alias("n_rows")
    ).orderBy("table_name")


def head(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows in a stated order; Spark keeps only ``n`` rows per task."""
    return df.orderBy(*order_by).limit(n)


def strip_timezone(df: DataFrame) -> DataFrame:
    """Timestamps with a time zone become plain wall-clock timestamps in the session time zone."""
    zoned = {f.name: F.col(f"`{f.name}`").cast("timestamp_ntz") for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    return df.withColumns(zoned) if zoned else df


def export_tables(
    tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet", name_limit: int | None = None
) -> list[str]:
    """Write every non-empty table under its name; returns the names written.

    ``name_limit`` shortens names for consumers that cannot hold long ones. Two names that
    shorten to the same one are an error: writing both would lose a table.
    """
    short = [n[:name_limit] for n in tables]
    clash = sorted({s for s in short if short.count(s) > 1})
    if clash:
        raise SpecError(f"names equal after shortening: {clash}")
    written = []
    for name, df in sorted(tables.items()):
        if df.isEmpty():
            continue
        strip_timezone(df).write.mode("error").format(fmt).save(f"{folder.rstrip('/')}/{name[:name_limit]}")
        written.append(name[:name_limit])
    return written


def write_rejects(rejects: DataFrame, folder: str, table: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Add rejects under ``table=…/reject_stage=…``, written from the tasks that hold them."""
    marked = rejects.withColumn("table", F.lit(table))
    marked.write.mode(mode).partitionBy("table", "reject_stage").format(fmt).save(folder)


def read_rejects(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    """All rejects of a folder; tables with different columns are merged."""
    return spark.read.option("mergeSchema", "true").format(fmt).load(folder)
