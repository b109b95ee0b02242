"""Reading, counting, exporting, lines, markup and arriving files."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowharbor.catalog import query
from rowharbor.catalog.conversions import COERCE_TYPES, TYPE_REASON_SQL
from rowharbor.catalog.fixtures import TABLES, table, with_fixtures
from rowharbor.operators import validate as V
from rowharbor.operators.coerce import coerce_table
from rowharbor.plans.order import read_batches
from rowharbor.session import scratch_path
from rowharbor.sources import tables as S
from rowharbor.sources import text as X
from rowharbor.streaming.files import stream_files

COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n FROM {t}" for t in TABLES)


@query(
    "read_tables",
    f"SELECT table_name, n AS n_rows, FALSE AS failed FROM ({COUNTS}) UNION ALL SELECT 'absent_table', NULL, TRUE",
)
def _read_tables(spark, d):
    loaded = S.read_tables(spark, d, [*TABLES, "absent_table"])
    return S.loaded_counts(loaded, spark).select(
        "table_name", "n_rows", F.col("error").isNotNull().alias("failed")
    )


@query(
    "table_inventory",
    f"SELECT table_name, CAST(n AS VARCHAR) AS n_rows FROM ({COUNTS}) UNION ALL SELECT 'absent_table', 'Error'",
)
def _inventory(spark, d):
    return S.table_inventory(spark, d, [*TABLES, "absent_table"])


@query("strip_timezone", "SELECT event_id, ts FROM events")
def _strip_timezone(spark, d):
    zoned = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return S.strip_timezone(zoned)


@query("head", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def _head(spark, d):
    return S.head(table(spark, d, "orders"), ["o_orderkey"], 5)


MARKERS = ("the", "Elle", "|")


@query(
    "filter_log_lines",
    """WITH lines AS (SELECT doc_id, UNNEST(STRING_SPLIT(text, chr(10))) AS value FROM documents)
    SELECT doc_id, TRIM(value, ' ' || chr(9) || chr(160)) AS value FROM lines
    WHERE CONTAINS(value, 'the') OR CONTAINS(value, 'Elle') OR CONTAINS(value, '|')""",
)
def _filter_lines(spark, d):
    return X.filter_lines(X.split_lines(table(spark, d, "documents"), "text", ["doc_id"]), MARKERS)


@query(
    "extract_html_metrics",
    r"""SELECT page_id, CASE WHEN REGEXP_EXTRACT(html, '<title[^>]*>\s*(.*?)\s*</title>', 1, 'is') <> ''
      THEN REGEXP_EXTRACT(html, '<title[^>]*>\s*(.*?)\s*</title>', 1, 'is') ELSE 'Unknown' END AS title,
    LEN(REGEXP_EXTRACT_ALL(html, '(?i)<a\s[^>]*href')) AS n_links,
    LEN(REGEXP_EXTRACT_ALL(html, '(?is)<td[^>]*>\s*(.*?)\s*</td>')) AS n_cells FROM pages""",
)
def _html(spark, d):
    return X.extract_html_metrics(table(spark, d, "pages"), "html", ["page_id"])


@query(
    "report_rows",
    """SELECT event_id, 'events' AS "table", event_id AS read_rows, user_id AS loaded, ABS(event_id - user_id) AS rejected,
    CAST(0 AS BIGINT) AS inserted, user_id AS updated, event_type AS status FROM events""",
)
def _report_rows(spark, d):
    cells = F.format_string(
        "<tr><td>sheet</td>\n<td>events</td>\n<td>%d</td> <td>%d</td><td title=\"x\">%d</td><td>0</td><td>%d</td>"
        '<td class="success">%s</td></tr>',
        "event_id",
        "user_id",
        F.abs(F.col("event_id") - F.col("user_id")),
        "user_id",
        "event_type",
    )
    pages = table(spark, d, "events").select("event_id", cells.alias("html"))
    return X.report_rows(pages, "html", ["events", "orders"], ["event_id"])


@query(
    "write_rejects",
    with_fixtures("raw_orders")
    + f""" SELECT 'raw_orders' AS "table", 'pk' AS reject_stage, COUNT(*) AS n FROM raw_orders WHERE order_id IN ('', 'nan')
    UNION ALL SELECT 'raw_orders', 'type', COUNT(*) FROM raw_orders
    WHERE order_id NOT IN ('', 'nan') AND {TYPE_REASON_SQL} IS NOT NULL""",
)
def _write_rejects(spark, d):
    valid, no_key = V.split_pk(table(spark, d, "raw_orders"), ["order_id"])
    rejects = V.rejects_union({"pk": no_key, "type": coerce_table(valid, COERCE_TYPES)[1]})
    folder = scratch_path(spark, "rejects")
    S.write_rejects(rejects, folder, "raw_orders")
    return S.read_rejects(spark, folder).groupBy("table", "reject_stage").agg(F.count(F.lit(1)).alias("n"))


EXPORTED = TABLES


@query(
    "export_tables",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in EXPORTED)
    + " UNION ALL SELECT 'a_name_longer_than_what_a_sheet_can_have', COUNT(*) FROM part",
)
def _export(spark, d):
    tables = {t: table(spark, d, t) for t in EXPORTED}
    tables["a_name_longer_than_what_a_sheet_can_have"] = table(spark, d, "part")
    tables["empty"] = table(spark, d, "part").limit(0)
    folder = scratch_path(spark, "export")
    written = S.export_tables(tables, folder)
    out = None
    for name in written:
        one = spark.read.parquet(f"{folder}/{name}").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        out = one if out is None else out.unionByName(one)
    return out


@query("stream_files", "SELECT event_id, user_id, event_type, value FROM events")
def _stream_files(spark, d):
    folder = scratch_path(spark, "arriving")
    events = table(spark, d, "events")
    events.repartition(4, "user_id").write.parquet(f"{folder}/in")
    events.limit(10).write.parquet(f"{folder}/reports/out")
    stream = stream_files(spark, folder, events.schema, files_per_batch=2)
    target = scratch_path(spark, "streamed")
    started = (
        stream.select("event_id", "user_id", "event_type", "value")
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", scratch_path(spark, "stream-state"))
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return spark.read.parquet(target)


#: Target tables and the names they are configured to be read under.
CONFIGURED = {"orders": " ORDERS", "customer": "no such sheet", "line_item": "lineitem", "part": "Part ", "gone": "supp"}
READ_UNDER = {"orders": "orders", "customer": "customer", "line_item": "lineitem", "part": "part"}


@query(
    "read_tables_tolerant",
    " UNION ALL ".join(
        f"SELECT '{t}' AS target, '{n}' AS read_under, (SELECT COUNT(*) FROM {n}) AS n_rows, CAST(NULL AS VARCHAR) AS error" for t, n in READ_UNDER.items()
    )
    + " UNION ALL SELECT 'gone', NULL, NULL, 'no table named ''supp'' or ''gone''; close names: supplier'",
)
def _tolerant(spark, d):
    """Tables under names that differ in case, blanks or are not there, with the fallback to the target's own name."""
    loaded, names = read_batches(spark, d, CONFIGURED)
    under = spark.createDataFrame(list(names.items()), "table_name string, read_under string")
    counted = S.loaded_counts(loaded, spark).join(under, "table_name", "left")
    return counted.select(F.col("table_name").alias("target"), "read_under", "n_rows", "error")
