"""Comparison of the key sets of two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def reconcile_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Every key of either side with ``in_left`` and ``in_right``.

    Both sides are stacked and reduced by key, which counts repeated keys before the
    single shuffle; NULL is not a key.
    """
    marked = left.select(F.col(left_key).alias("key"), F.lit(True).alias("l")).unionByName(right.select(F.col(right_key).alias("key"), F.lit(False).alias("l")))
    return key_sides(marked)


def key_sides(marked: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Which sides hold each ``key``, where ``l`` says which side a row is from; within each of ``groups``."""
    return marked.where("key IS NOT NULL").groupBy(*groups, "key").agg(F.bool_or("l").alias("in_left"), F.bool_or(~F.col("l")).alias("in_right"))


def side_counts(sides: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Missing, existing, referenced and loaded keys, per group or in one row."""
    return sides.groupBy(*groups).agg(
        F.count_if(F.expr("in_left AND NOT in_right")).alias("total_missing"),
        F.count_if("in_right").alias("existing_count"),
        F.count_if("in_left").alias("referenced_count"),
        F.count_if(F.expr("in_left AND in_right")).alias("loaded_count"),
    )


def missing_keys(referenced: DataFrame, ref_key: str, existing: DataFrame, key: str) -> DataFrame:
    """Referenced keys that do not exist."""
    return reconcile_keys(referenced, ref_key, existing, key).where("in_left AND NOT in_right").select("key")


def loaded_keys(referenced: DataFrame, ref_key: str, existing: DataFrame, key: str) -> DataFrame:
    """Referenced keys that exist."""
    return reconcile_keys(referenced, ref_key, existing, key).where("in_left AND in_right").select("key")


def missing_summary(referenced: DataFrame, ref_key: str, existing: DataFrame, key: str) -> DataFrame:
    """One row: missing, existing, referenced and loaded key counts."""
    return side_counts(reconcile_keys(referenced, ref_key, existing, key))


def missing_topk(referenced: DataFrame, ref_key: str, existing: DataFrame, key: str, k: int = 100) -> DataFrame:
    """The first ``k`` missing keys in order, each with how many more there are."""
    missing = missing_keys(referenced, ref_key, existing, key)
    total = missing.agg(F.count(F.lit(1)).alias("n")).scalar()
    return missing.orderBy("key").limit(k).withColumn("n_more", F.greatest(total - k, F.lit(0)))
