"""What keeps judging and streams from growing with the size of a batch: compiled methods, and stages that many tasks can read."""

from __future__ import annotations

import contextlib
import glob
import io
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from rowharbor.operators.coerce import check_types
from rowharbor.plans.load import judge, prepare
from rowharbor.session import ROW_GROUP, cut_lineage, scratch_path, shared_folder
from rowharbor.sources.changes import current_rows, write_changes
from rowharbor.spec import TableSpec
from rowharbor.streaming.files import stream_files, stream_load

#: The JVM compiles no method of more bytes than this.
COMPILED = 8000


def row_groups(folder: str) -> list[int]:
    return [pq.ParquetFile(f).num_row_groups for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)]


def test_judging_a_wide_table_stays_within_compiled_methods(spark):
    """Dates and many numbers: the code of a row used to make one method that the JVM left to its interpreter."""
    words = ["int"] * 4 + ["float"] * 4 + ["str", "str", "date"]
    spec = TableSpec("wide", ["c0", "c3"], {f"c{i}": w for i, w in enumerate(words)})
    rows = spark.range(10).select(F.col("id").alias("place"), *[F.col("id").cast("string").alias(c) for c in spec.types])
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        judge(prepare(rows, spec, "place"), spec).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    assert sizes and max(sizes) < COMPILED


def test_the_first_unread_number_gives_the_reason(spark):
    rows = [("1", "x", "12d"), ("1e30", "2", "abc"), ("inf", "nan", "it's"), ("7", "8", "9"), (None, "", "it's"), ("nan ", None, "5")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    found = [r[0] for r in check_types(df, {"a": "int", "b": "float", "c": "float"}).select("rejection_reason").collect()]
    head = "Type coercion failed: "
    assert found == [
        head + "could not convert string to float: 'x'",
        head + "integer out of range",
        head + "cannot convert float infinity to integer",
        None,
        head + "could not convert string to float: \"it's\"",
        head + "cannot convert float NaN to integer",
    ]


def test_one_task_leaves_many_row_groups(spark):
    rows = spark.range(0, 400_000, 1, 1).select("id", F.xxhash64("id").alias("x"))
    path = scratch_path(spark, "groups")
    rows.write.parquet(path)
    assert row_groups(path) == [1]
    stored = cut_lineage(rows, "groups", ROW_GROUP)
    assert min(row_groups(stored.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0])) > 2
    assert stored.agg(F.sum("id"), F.count("x")).first()[:] == (400_000 * 399_999 // 2, 400_000)


def test_a_batch_of_one_file_is_shared_out(spark):
    """The copy of a batch and its judged rows have many row groups, and of the rows of a key the last one still wins."""
    spec = TableSpec("shared_out", ["id"], {"id": "int", "x": "int"})
    n = 300_000
    folder, path = scratch_path(spark, "one-in"), scratch_path(spark, "one")
    write_changes(spark.range(5).select("id", F.lit(0).cast("bigint").alias("x")), path, "start", spec.pk)
    ids = F.when(F.col("id") >= n - 10, F.col("id") - (n - 10)).otherwise(F.col("id"))
    spark.range(0, n, 1, 1).select(ids.cast("string").alias("id"), F.xxhash64("id").bitwiseAND(2**50 - 1).cast("string").alias("x"), F.col("id").alias("n")).drop("n").write.parquet(folder)
    there = set(glob.glob(f"{shared_folder(spark)}/rowharbor/shared_out-*"))
    stream_load(stream_files(spark, folder, "id string, x string"), path, spec, scratch_path(spark, "one-state")).awaitTermination()
    for stage in ("batch", "judged"):
        written = [w for w in glob.glob(f"{shared_folder(spark)}/rowharbor/shared_out-{stage}-*") if w not in there]
        assert len(written) == 1 and max(row_groups(written[0])) > 2, (stage, [row_groups(w) for w in written])
    got = current_rows(spark, path, spec.pk).where("id < 10")
    last = spark.range(n - 10, n).select((F.col("id") - (n - 10)).alias("id"), F.xxhash64("id").bitwiseAND(2**50 - 1).alias("x"))
    assert sorted(got.collect()) == sorted(last.collect())
    (judged,) = [w for w in glob.glob(f"{shared_folder(spark)}/rowharbor/shared_out-judged-*") if w not in there]
    assert spark.read.parquet(judged).schema["_row_seq"].dataType.simpleString() == "bigint"  # no path travels with every row
