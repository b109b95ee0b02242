"""Row checks. Each returns the row set split in two, or the offending rows with a reason."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowharbor.functions.text import KEY_TOKENS, is_missing
from rowharbor.operators.coerce import REASON, STAGE
from rowharbor.operators.references import keyed_join
from rowharbor.spec import SpecError, TableSpec

#: Wording of rejections.
PK_REASON = "Missing required data in columns: [%s]"
NULL_REASON = "Missing Required Data: %s"
UNIQUE_REASON = "Duplicate value for unique key (%s)"
LENGTH_REASON = "Value too long for %s(%d)"
ENUM_REASON = "Value not allowed in %s: "
DECIMAL_REASON = "Numeric overflow in %s(%d,%d)"
RANGE_REASON = "Value out of range in %s(%s)"


def pk_reason(pk: Sequence[str]) -> Column:
    """Reason naming every missing key column, or NULL when the key is complete."""
    missing = F.array_compact(
        F.array(*[F.when(is_missing(F.col(c), KEY_TOKENS), F.lit(f"'{c}'")) for c in pk])
    )
    return F.when(F.size(missing) > 0, F.format_string(PK_REASON, F.array_join(missing, ", ")))


def split_pk(df: DataFrame, pk: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete primary key, and the others with the columns they miss."""
    absent = [c for c in pk if c not in df.columns]
    if absent:
        raise SpecError(f"primary key columns absent from the rows: {absent}")
    checked = df.withColumn(REASON, pk_reason(pk))
    return checked.where(F.col(REASON).isNull()).drop(REASON), checked.where(F.col(REASON).isNotNull())


def rejects_union(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rejected rows of several stages under one schema, each marked with its stage."""
    result: DataFrame | None = None
    for stage, rows in stages.items():
        marked = rows.withColumn(STAGE, F.lit(stage))
        result = marked if result is None else result.unionByName(marked, allowMissingColumns=True)
    if result is None:
        raise SpecError("no reject stages given")
    return result


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that hold NULL in a required column; the reason names all such columns."""
    empty = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn(
        REASON, F.when(F.size(empty) > 0, F.format_string(NULL_REASON, F.array_join(empty, ", ")))
    ).where(F.col(REASON).isNotNull())


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose unique key occurs more than once. NULL never collides.

    Keys are counted first, with partial counts before the shuffle, so a key held by
    a large share of the rows never gathers its rows in one task. The repeated keys
    then select their rows by a join whose row side may be split.
    """
    complete = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in columns))
    repeated = (
        complete.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select(*[F.col(c).alias(f"_dup_{c}") for c in columns])
    )
    keys, condition = keyed_join(complete, repeated, list(columns), [f"_dup_{c}" for c in columns])
    return complete.join(keys, condition, "left_semi").withColumn(REASON, F.lit(UNIQUE_REASON % ", ".join(columns)))


def check_length(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Rows with a text longer than its column allows; the first such column is named."""
    tests = [F.when(F.char_length(F.col(c)) > n, F.lit(LENGTH_REASON % (c, n))) for c, n in lengths.items()]
    return df.withColumn(REASON, F.coalesce(*tests)).where(F.col(REASON).isNotNull())


def check_enum(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose value is outside the domain; NULL is inside."""
    return df.where(~F.col(column).isin(*allowed)).withColumn(
        REASON, F.concat(F.lit(ENUM_REASON % column), F.col(column))
    )


def check_decimal(df: DataFrame, column: str, precision: int, scale: int) -> tuple[DataFrame, DataFrame]:
    """Values rounded to their scale, and the rows whose value does not fit the precision."""
    fitted = F.col(column).try_cast(T.DecimalType(precision, scale))
    overflow = F.col(column).isNotNull() & fitted.isNull()
    valid = df.where(~overflow).withColumn(column, fitted)
    rejected = df.where(overflow).withColumn(REASON, F.lit(DECIMAL_REASON % (column, precision, scale)))
    return valid, rejected


def constraint_reason(
    spec: TableSpec, columns: Sequence[str], value: Callable[[str], Column] = F.col
) -> Column:
    """Reason of the first row-level constraint a typed row breaks: required, length, domain, precision.

    ``value`` yields the typed value of a column. A required column that the rows lack
    breaks every row unless it has a default.
    """
    tests: list[Column] = []
    for c in spec.not_null:
        if c in columns:
            tests.append(F.when(value(c).isNull(), F.lit(NULL_REASON % c)))
        elif c not in spec.defaults:
            tests.append(F.lit(NULL_REASON % c))
    for c, n in spec.lengths.items():
        if c in columns:
            tests.append(F.when(F.char_length(value(c)) > n, F.lit(LENGTH_REASON % (c, n))))
    for c, allowed in spec.enums.items():
        if c in columns:
            tests.append(F.when(~value(c).isin(*allowed), F.concat(F.lit(ENUM_REASON % c), value(c))))
    for c, (p, s) in spec.decimals.items():
        if c in columns:
            fits = value(c).try_cast(T.DecimalType(p, s)).isNotNull()
            tests.append(F.when(value(c).isNotNull() & ~fits, F.lit(DECIMAL_REASON % (c, p, s))))
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Give inserted rows the default of every column they lack. An explicit NULL stays NULL.

    The default ``"now"`` stands for the time of the run.
    """
    added = {
        c: (F.current_timestamp() if value == "now" else F.lit(value))
        for c, value in defaults.items()
        if c not in df.columns
    }
    return df.withColumns(added) if added else df


def range_reason(rows: DataFrame, schema: T.StructType, value: Callable[[str], Column] = F.col) -> Column:
    """Reason of the first value that the stored column of its name cannot hold, or NULL."""
    kinds = {f.name: f.dataType for f in schema}
    tests = [
        F.when(value(f.name).isNotNull() & value(f.name).try_cast(kinds[f.name]).isNull(), F.lit(RANGE_REASON % (f.name, kinds[f.name].simpleString())))
        for f in rows.schema
        if f.name in kinds and kinds[f.name] != f.dataType
    ]
    return F.coalesce(*tests) if tests else F.lit(None).cast("string")
