"""Headers, cells, column names and projection to a declared schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from rowharbor.functions.text import list_items, null_if_token, strip
from rowharbor.spec import SpecError

#: Row number column every batch carries; input order is meaningful for keep-last and numbering.
ROW_SEQ = "_row_seq"


def with_row_seq(df: DataFrame, order_column: str | None = None) -> DataFrame:
    """Give rows their sequence: an ordering column, which it replaces, or the place in the read files.

    The place is the path of the file, then the start of the split, then the row. Spark packs splits into tasks by
    size, so the number of the task says nothing of the order of files. Rows that no file holds go by their partition.
    """
    if order_column:
        return df.withColumn(ROW_SEQ, F.col(order_column)).drop(order_column)
    row = F.monotonically_increasing_id()
    if "_metadata#" in df._jdf.queryExecution().analyzed().metadataOutput().mkString(","):
        row = F.struct("_metadata.file_path", "_metadata.file_block_start", row.alias("row"))
    return df.withColumn(ROW_SEQ, row)


def clean(df: DataFrame) -> DataFrame:
    """Trim header names and every text cell. NULL stays NULL."""
    named = df.toDF(*[c.strip() for c in df.columns])
    return named.select(
        [
            strip(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
            for f in named.schema
        ]
    )


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename source to target columns; unknown sources are ignored.

    Where several present columns end up with one name, the first non-NULL of them
    is kept, in column order.
    """
    sources: dict[str, list[str]] = {}
    for column in df.columns:
        sources.setdefault(names.get(column, column), []).append(column)
    return df.select([F.coalesce(*[F.col(f"`{s}`") for s in cols]).alias(target) for target, cols in sources.items()])


def null_tokens(df: DataFrame, columns: Sequence[str], tokens: Sequence[str]) -> DataFrame:
    """Turn the given missing-value tokens into NULL."""
    return df.withColumns({c: null_if_token(F.col(c), tokens) for c in columns})


def project_to_target(df: DataFrame, target_columns: Sequence[str]) -> DataFrame | None:
    """Keep the columns the target has, in incoming order; None when there is none."""
    known = set(target_columns)
    kept = [c for c in df.columns if c in known]
    return df.select(kept) if kept else None


#: Type a new column gets in the target, by the type it arrives with.
def _storage_type(t: T.DataType) -> T.DataType:
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType() if isinstance(t, T.LongType) else T.IntegerType()
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(t, (T.BooleanType, T.TimestampType, T.TimestampNTZType)):
        return t
    return T.StringType()


def new_columns(target: DataFrame, incoming: DataFrame) -> T.StructType:
    """Columns the incoming rows have and the target lacks, with the type the target gives them."""
    known = set(target.columns)
    return T.StructType(
        [T.StructField(f.name, _storage_type(f.dataType)) for f in incoming.schema if f.name not in known]
    )


def evolve_target(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """The target widened by the incoming rows' new columns, NULL for the rows it holds."""
    added = new_columns(target, incoming)
    return target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])


def evolve_schema(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Both row sets under the widened schema."""
    wide = evolve_target(target, incoming)
    types = {f.name: f.dataType for f in wide.schema}
    typed = incoming.select([F.col(c).try_cast(types[c]).alias(c) for c in incoming.columns])
    return wide.unionByName(typed, allowMissingColumns=True)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project the present columns to their declared types; a value outside its type becomes NULL."""
    present = [f for f in schema if f.name in df.columns]
    if not present:
        raise SpecError(f"none of {schema.fieldNames()} is in the rows")
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in present])


#: Unsigned plain numbers, and the words for special floats that hold none of the capitals C, F, K.
#: Signs, formula marks, unit letters and words such as "pack" all fail both patterns.
PLAIN_FACTOR = r"^([0-9]+\.?[0-9]*|\.[0-9]+)([eE][0-9]+)?$"
INFINITE_FACTOR = r"^[iI][nN]f([iI][nN][iI][tT][yY])?$"
UNKNOWN_FACTOR = r"(?i)^nan$"


def split_factor(df: DataFrame, factor: str = "conversion_factor", note: str = "syn") -> DataFrame:
    """Move unit factors that are not plain numbers to ``note`` and set them to zero.

    Negative numbers and negative exponents count as formulas because of their sign.
    A factor of ``nan`` is missing.
    """
    if factor not in df.columns:
        return df
    base = df if note in df.columns else df.withColumn(note, F.lit(None).cast("string"))
    cut = base.withColumn("_factor", strip(F.col(factor).cast("string")))
    text = F.col("_factor")
    number = (
        F.when(text.rlike(PLAIN_FACTOR), text.try_cast("double"))
        .when(text.rlike(INFINITE_FACTOR), F.lit(float("inf")))
        .when(text.rlike(UNKNOWN_FACTOR), F.lit(float("nan")))
    )
    read = cut.withColumn("_number", number)
    moved = text.isNotNull() & F.col("_number").isNull()
    return read.withColumns(
        {
            note: F.when(moved, text).otherwise(F.col(note)),
            factor: F.when(moved, F.lit(0.0)).otherwise(F.nanvl("_number", F.lit(None).cast("double"))),
        }
    ).drop("_factor", "_number")


def lists_to_json(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn the comma-separated texts of the given columns into JSON lists."""
    return df.withColumns({c: F.to_json(list_items(F.col(c))) for c in columns if c in df.columns})


