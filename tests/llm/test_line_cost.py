"""Lines are compared in generated code and keyed without a sort."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from llm import brute
from rowharbor.llm import lines


@pytest.mark.parametrize("native", [0, 8, 1024])
def test_distances_are_the_same_by_both_ways(spark, monkeypatch, native):
    monkeypatch.setattr(lines, "NATIVE_CHARS", native)
    rng = random.Random(1)
    rows = []
    for _ in range(150):
        a = rng.choices("abé\U0001f600", k=rng.randint(0, 16))
        b = [*a]
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choices("abé", k=rng.randint(0, 1))
        rows.append(("".join(a), "".join(b)))
    df = spark.createDataFrame([r for r in rows if abs(len(r[0]) - len(r[1])) <= 2], "l string, r string")
    for r in df.withColumn("d", lines.banded_distance(F.col("l"), F.col("r"), 2)).collect():
        assert min(r.d, 3) == brute.edit_distance(r.l, r.r, 2)


def test_distance_in_generated_code_but_for_long_lines(spark):
    long = "".join(random.Random(1).choices("abcdefgh é", k=200_000))
    rows = [(long, long[:500] + "x" + long[501:-1]), (long, "xyz" + long[3:]), (long, long), (long[:900], "x" + long[1:899])]
    df = spark.createDataFrame(rows, "l string, r string").select(lines.banded_distance(F.col("l"), F.col("r"), 2).alias("d"))
    assert [min(r.d, 3) for r in df.collect()] == [2, 3, 0, 2]
    assert "levenshtein" in df._jdf.queryExecution().optimizedPlan().toString()


def test_keys_of_lines_are_hashed_together(spark):
    texts = spark.createDataFrame([("a line that comes twice or more",)] * 3 + [("another line, which comes once",)], "text string")
    keyed = lines.keyed_lines(texts.select(F.xxhash64("text").alias("id"), "text"), 2)
    assert keyed.count() == 2
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
