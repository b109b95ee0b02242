"""Tables, exports, rejects, lines, markup and messages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rowharbor.functions import messages as G
from rowharbor.session import scratch_path
from rowharbor.sources import tables as S
from rowharbor.sources import text as X
from rowharbor.session import cut_lineage, drop_scratch, scratch_under
from rowharbor.spec import SpecError


def test_csv_tables_are_read_as_text(spark):
    folder = scratch_path(spark, "csv")
    spark.createDataFrame([(1, "007")], "a int, b string").write.csv(f"{folder}/t.csv", header=True)
    loaded = S.read_tables(spark, folder, ["t", "gone"], fmt="csv")
    assert loaded.tables["t"].first() == ("1", "007")
    assert list(loaded.errors) == ["gone"]
    counts = {r["table_name"]: r["n_rows"] for r in S.loaded_counts(loaded, spark).collect()}
    assert counts == {"t": 1, "gone": None}


def test_all_text(spark, sf_dir):
    loaded = S.read_tables(spark, sf_dir, ["orders"], all_text=True)
    assert {f.dataType.simpleString() for f in loaded.tables["orders"].schema} == {"string"}


def test_head_keeps_few_rows_per_task(spark, sf_dir):
    top = S.head(spark.read.parquet(f"{sf_dir}/orders.parquet"), ["o_orderkey"], 5)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert [r["o_orderkey"] for r in top.collect()] == [0, 1, 2, 3, 4]


def test_export_refuses_equal_short_names(spark):
    df = spark.range(1)
    with pytest.raises(SpecError):
        S.export_tables({"n" * 31 + "a": df, "n" * 31 + "b": df}, scratch_path(spark, "export"), name_limit=31)


def test_zoned_timestamps_become_plain(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-02 03:04:05+00:00' AS t, 1 AS k")
    plain = S.strip_timezone(df)
    assert plain.schema["t"].dataType.simpleString() == "timestamp_ntz"
    assert str(plain.first()["t"]) == "2024-01-02 03:04:05"


def test_rejects_of_tables_with_different_columns(spark):
    folder = scratch_path(spark, "rejects")
    S.write_rejects(spark.sql("SELECT 1 AS a, 'r' AS rejection_reason, 'pk' AS reject_stage"), folder, "t")
    S.write_rejects(spark.sql("SELECT 'x' AS b, 'q' AS rejection_reason, 'fk' AS reject_stage"), folder, "u")
    back = S.read_rejects(spark, folder)
    assert sorted((r["table"], r["reject_stage"], r["a"], r["b"]) for r in back.collect()) == [
        ("t", "pk", 1, None),
        ("u", "fk", None, "x"),
    ]


def test_lines_of_other_encodings(spark, tmp_path):
    (tmp_path / "log16.txt").write_bytes("[DEBUG] é one\nskip\n  Rows: 5 \n".encode("utf-16"))
    (tmp_path / "log8.txt").write_text("[DEBUG] é one\nskip\n  Rows: 5 \n", encoding="utf-8")
    for name, encoding in (("log16.txt", "UTF-16"), ("log8.txt", "UTF-8")):
        lines = X.read_lines(spark, str(tmp_path / name), encoding)
        assert sorted(r["value"] for r in X.filter_lines(lines).collect()) == ["Rows: 5", "[DEBUG] é one"]


REPORT = """<h2>Overall Status: <span class="warning">PARTIAL SUCCESS</span></h2>
<p><strong>Total Records Processed:</strong> 120</p><table><tr><td>uom_master</td>
 <td>uom_master</td> <td>53</td><td>53</td> <td title="x">0</td><td>4</td><td>49</td> <td class="success"> SUCCESS</td></tr></table>"""


def test_report_metrics(spark):
    pages = spark.createDataFrame([(1, REPORT), (2, "<p>nothing</p>")], "id int, html string")
    got = pages.select(
        "id",
        X.html_metric(F.col("html"), "Overall Status").alias("status"),
        X.html_metric(F.col("html"), "Total Records Processed", r"\d+").alias("total"),
    ).orderBy("id")
    assert [tuple(r) for r in got.collect()] == [(1, "PARTIAL SUCCESS", "120"), (2, "Unknown", "Unknown")]
    found = X.report_rows(pages, "html", ["uom_master", "other"], ["id"]).collect()
    assert [tuple(r) for r in found] == [(1, "uom_master", 53, 53, 0, 4, 49, "SUCCESS")]


def test_rules_need_their_detail(spark):
    texts = ["ForeignKeyViolation without detail", "UndefinedColumn", "NotNullViolation", "InvalidTextRepresentation Json",
             "InvalidTextRepresentation: numeric", "invalid input syntax for type date", "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = [r["v"].split(":")[0] for r in df.select("i", G.classify_error(F.col("t"), F.lit("a_b")).alias("v")).collect()]
    assert got == ["Data Issue", "Data Issue", "Data Issue", "Data Format Issue", "Number Format Issue", "Date Format Issue", "Data Issue"]


def test_reason_kinds_do_not_quote_values(spark):
    reasons = [
        "Type coercion failed: could not convert string to float: 'a\nb'",
        "Type coercion failed: cannot convert float infinity to integer",
        "Foreign key violation: a=b=c not found in t.x (reference table is empty)",
        "Missing required data in columns: ['a']",
    ]
    df = spark.createDataFrame([(r,) for r in reasons], "r string").select(G.reason_kind(F.col("r")).alias("k"))
    assert [r["k"] for r in df.collect()] == [
        "Type coercion failed: could not convert string to float",
        reasons[1],
        "Foreign key violation: a not found in t.x",
        reasons[3],
    ]


def test_scratch_is_dropped_by_name(spark):
    with scratch_under("one"):
        first = cut_lineage(spark.range(3), "kept")
        with scratch_under("two"):
            second = cut_lineage(spark.range(4), "kept")
    outside = cut_lineage(spark.range(5), "kept")
    drop_scratch(spark, "one")
    assert (second.count(), outside.count()) == (4, 5)
    with pytest.raises(Exception, match="(?i)not.exist"):
        first.collect()
    drop_scratch(spark, "never written")
