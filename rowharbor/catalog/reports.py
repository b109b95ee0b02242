"""Metrics, statuses, reasons, messages, keep-last and generated keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowharbor.catalog import query
from rowharbor.catalog.conversions import COERCE_TYPES, TYPE_REASON_SQL
from rowharbor.catalog.fixtures import table, with_fixtures
from rowharbor.catalog.references import LINE_FKS, MANY, line_parents
from rowharbor.functions import messages as G
from rowharbor.operators import keys as K
from rowharbor.operators import metrics as M
from rowharbor.operators import references as R
from rowharbor.operators.coerce import REASON, check_types
from rowharbor.operators.validate import pk_reason

LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
LAST = ", ".join(f"{c} DESC" for c in LINE_ORDER)


@query(
    "dedupe_last",
    f"""SELECT * FROM lineitem
    QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LAST}) = 1""",
)
def _dedupe_last(spark, d):
    return K.dedupe_last(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)


@query(
    "dup_count",
    """SELECT COUNT(*) AS n_rows, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS n_keys,
    COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS n_removed FROM lineitem""",
)
def _dup_count(spark, d):
    return K.dup_count(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def sql_generated(start: str) -> str:
    return (
        with_fixtures("raw_orders")
        + f""", top AS (SELECT {start} AS first_id FROM raw_orders)
    SELECT row_seq, CASE WHEN order_id IN ('', 'nan') THEN CAST(first_id - 1 + ROW_NUMBER() OVER
      (PARTITION BY order_id IN ('', 'nan') ORDER BY row_seq) AS VARCHAR) ELSE order_id END AS order_id
    FROM raw_orders CROSS JOIN top"""
    )


@query("generate_keys_from_one", sql_generated("1").replace("AS first_id FROM raw_orders", "AS first_id"))
def _generate_one(spark, d):
    raw = table(spark, d, "raw_orders").select("row_seq", "order_id")
    return K.generate_keys(raw, "order_id", "row_seq", start="one")


@query("generate_keys_after_max", sql_generated("MAX(TRY_CAST(order_id AS BIGINT)) + 1"))
def _generate_after(spark, d):
    raw = table(spark, d, "raw_orders").select("row_seq", "order_id")
    return K.generate_keys(raw, "order_id", "row_seq")


STATUS_SQL = f"""CASE WHEN order_id IN ('', 'nan') THEN 'rejected_pk'
  WHEN {TYPE_REASON_SQL} IS NOT NULL THEN 'rejected_type'
  WHEN row_seq % 10 < 3 THEN 'inserted' WHEN row_seq % 10 < 6 THEN 'updated' ELSE 'unchanged' END"""
METRICS_SQL = (
    with_fixtures("raw_orders")
    + f""", s AS (SELECT 'orders_' || status AS "table", {STATUS_SQL} AS st FROM raw_orders),
  metrics AS (SELECT "table", COUNT(*) AS read_rows, COUNT(*) FILTER (WHERE st NOT LIKE 'rejected%') AS valid_rows,
    COUNT(*) FILTER (WHERE st LIKE 'rejected%') AS rejected_rows, CAST(0 AS BIGINT) AS deduplicated, COUNT(*) FILTER (WHERE st = 'inserted') AS inserted,
    COUNT(*) FILTER (WHERE st = 'updated') AS updated, COUNT(*) FILTER (WHERE st = 'unchanged') AS unchanged FROM s GROUP BY ALL)"""
)


def metrics_of_orders(spark, d):
    """Metrics of the raw orders, one table per order status."""
    raw = check_types(table(spark, d, "raw_orders"), COERCE_TYPES)
    status = (
        F.when(pk_reason(["order_id"]).isNotNull(), "rejected_pk")
        .when(F.col(REASON).isNotNull(), "rejected_type")
        .when(F.col("row_seq") % 10 < 3, "inserted")
        .when(F.col("row_seq") % 10 < 6, "updated")
        .otherwise("unchanged")
    )
    counts = M.status_counts(raw, F.concat(F.lit("orders_"), F.col("status")), status)
    return M.load_metrics(counts)


@query("load_metrics", METRICS_SQL + " SELECT * FROM metrics")
def _metrics(spark, d):
    return metrics_of_orders(spark, d)


@query(
    "run_totals",
    METRICS_SQL
    + """ SELECT SUM(read_rows)::BIGINT AS total_read_rows, SUM(valid_rows)::BIGINT AS total_valid_rows,
    SUM(rejected_rows)::BIGINT AS total_rejected_rows, SUM(inserted)::BIGINT AS total_inserted,
    SUM(updated)::BIGINT AS total_updated,
    CASE WHEN SUM(rejected_rows) = 0 THEN 'SUCCESS' ELSE 'PARTIAL SUCCESS' END AS status FROM metrics""",
)
def _totals(spark, d):
    return M.run_totals(metrics_of_orders(spark, d))


def run_records(spark, d):
    return table(spark, d, "run_records")


@query(
    "table_status",
    with_fixtures("run_records")
    + """, s AS (SELECT *, CASE WHEN rejected_rows = 0 AND read_rows > 0 THEN 'SUCCESS' WHEN rejected_rows > 0 THEN 'PARTIAL'
      WHEN read_rows = 0 AND CONTAINS(notes, 'ERROR') THEN 'ERROR' WHEN read_rows + inserted + updated = 0 THEN NULL
      ELSE 'ERROR' END AS status FROM run_records) SELECT * FROM s WHERE status IS NOT NULL""",
)
def _table_status(spark, d):
    return M.table_status(run_records(spark, d))


@query(
    "reason_counts",
    MANY
    + """ SELECT COALESCE(r1, r2, r3) AS rejection_reason, COUNT(*) AS n FROM flagged
    WHERE COALESCE(r1, r2, r3) IS NOT NULL GROUP BY 1""",
)
def _reason_counts(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return M.reason_counts(R.fk_split_many(lines, LINE_FKS, line_parents(spark, d))[1])


@query(
    "merge_reasons",
    with_fixtures("raw_reasons")
    + """ SELECT event_type, user_id % 10 AS grp, STRING_AGG(DISTINCT reason, '; ' ORDER BY reason) AS rejection_reason
    FROM raw_reasons JOIN events USING (event_id, event_type) GROUP BY ALL""",
)
def _merge_reasons(spark, d):
    reasons = table(spark, d, "raw_reasons")
    users = table(spark, d, "events").select("event_id", (F.col("user_id") % 10).alias("grp"))
    rows = reasons.join(users, "event_id").select("event_type", "grp", F.col("reason").alias("rejection_reason"))
    return M.merge_reasons(rows)


@query(
    "notes",
    with_fixtures("raw_reasons")
    + """, k AS (SELECT event_type, event_id, CASE event_id % 4
        WHEN 1 THEN 'Type coercion failed: could not convert string to float'
        WHEN 2 THEN 'Foreign key violation: user_id not found in user_master.user_id' ELSE reason END AS kind FROM raw_reasons),
    f AS (SELECT event_type, kind, MIN(event_id) AS first_id FROM k GROUP BY ALL)
    SELECT event_type, STRING_AGG(kind, '; ' ORDER BY first_id) AS notes FROM f GROUP BY ALL""",
)
def _notes(spark, d):
    kinds = table(spark, d, "raw_reasons").withColumn("kind", G.reason_kind(F.col("reason")))
    return M.notes(kinds, "event_type", "event_id", "kind")


@query(
    "dedupe_run_records",
    with_fixtures("run_records")
    + """, a AS (SELECT *, read_rows + inserted + updated + rejected_rows AS act FROM run_records),
    best AS (SELECT * FROM a QUALIFY ROW_NUMBER() OVER (PARTITION BY sheet, "table" ORDER BY act DESC, seq) = 1),
    tied AS (SELECT a.sheet, a."table", LIST_REDUCE(LIST(a.notes ORDER BY a.seq), LAMBDA acc, x: CASE
        WHEN CONTAINS(acc, x) THEN acc WHEN acc = '' THEN x ELSE acc || '; ' || x END) AS notes
      FROM a JOIN best b ON a.sheet = b.sheet AND a."table" = b."table" AND a.act = b.act GROUP BY ALL)
    SELECT b.seq, b.sheet, b."table", b.read_rows, b.valid_rows, b.rejected_rows, b.inserted, b.updated, t.notes
    FROM best b JOIN tied t ON b.sheet = t.sheet AND b."table" = t."table" """,
)
def _dedupe_records(spark, d):
    return M.dedupe_run_records(run_records(spark, d), "seq")


@query("sorted_report", with_fixtures("run_records") + ' SELECT * FROM run_records ORDER BY sheet, "table"')
def _sorted(spark, d):
    return M.sorted_report(run_records(spark, d))


# The wording of issues and actions in the SQL of this module, as in ``functions/messages.py``.
@query(
    "issues",
    with_fixtures("raw_reasons")
    + """ SELECT event_type AS sheet, 'table_' || CAST(event_id % 4 AS VARCHAR) AS "table", CASE event_id % 4
      WHEN 0 THEN 'Missing Required Data: Some rows are missing values in the ''order_id, line_no'' column(s).'
      WHEN 1 THEN 'Data Format Issue: Some values are in the wrong format and cannot be converted to the required data type.'
      ELSE 'Data Quality Issue: ' || reason END AS issue, CASE event_id % 4
      WHEN 0 THEN 'Action Required: Fill in the missing required values in your Excel file.'
      WHEN 3 THEN 'Action Required: Fill in the missing required values in your Excel file.'
      WHEN 1 THEN 'Action Required: Check data formats - ensure numbers are numeric, dates are valid, etc.'
      ELSE 'Action Required: Review the rejected rows CSV file for specific issues.' END AS action_needed
    FROM raw_reasons WHERE event_id % 5 > 0""",
)
def _issues(spark, d):
    records = table(spark, d, "raw_reasons").select(
        F.col("event_type").alias("sheet"),
        F.concat(F.lit("table_"), (F.col("event_id") % 4).cast("string")).alias("table"),
        (F.col("event_id") % 5).alias("rejected_rows"),
        F.array("reason").alias("reasons"),
    )
    return M.issues(records)


@query(
    "classify_error",
    with_fixtures("raw_messages")
    + """ SELECT event_id, CASE event_id % 8
    WHEN 0 THEN 'Missing Reference Data: The value ''' || CAST(user_id AS VARCHAR) || ''' in column ''user_id'' does not exist in the User Master table. Please ensure this value exists in the reference table first.'
    WHEN 1 THEN 'Column Mismatch: The Excel sheet has a column ''c1'' that doesn''t match the database structure. Please check the column names in your Excel file.'
    WHEN 2 THEN 'Missing Required Data: Column ''price'' cannot be empty. Please provide values for all rows in this column.'
    WHEN 3 THEN 'Data Format Issue: Some values are not in the correct format. Text values that should be lists need to be properly formatted.'
    WHEN 4 THEN 'Number Format Issue: Some values cannot be converted to numbers. Please check for special characters, text in number fields, or scientific notation.'
    WHEN 5 THEN 'Date Format Issue: Some date values are invalid or out of range. Please check date formats and extreme dates like ''9999-12-31''.'
    WHEN 6 THEN 'Duplicate Records: There are duplicate entries for the same key. Please remove duplicate rows from your Excel file.'
    ELSE 'Data Issue: There was a problem loading data into Price History. Please check the data format and required fields.' END AS text
    FROM raw_messages JOIN events USING (event_id)""",
)
def _classify_error(spark, d):
    return table(spark, d, "raw_messages").select(
        "event_id", G.classify_error(F.col("message"), F.lit("price_history")).alias("text")
    )


@query(
    "classify_reason",
    with_fixtures("raw_reasons")
    + """ SELECT event_id, CASE event_id % 4
      WHEN 0 THEN 'Missing Required Data: Some rows are missing values in the ''order_id, line_no'' column(s).'
      WHEN 1 THEN 'Data Format Issue: Some values are in the wrong format and cannot be converted to the required data type.'
      ELSE 'Data Quality Issue: ' || reason END AS text FROM raw_reasons""",
)
def _classify_reason(spark, d):
    return table(spark, d, "raw_reasons").select("event_id", G.classify_reason(F.col("reason")).alias("text"))


@query(
    "action_for_error",
    with_fixtures("raw_messages")
    + """ SELECT event_id, 'Action Required: ' || CASE event_id % 8
    WHEN 0 THEN 'Load the referenced table first, or verify the reference values exist.'
    WHEN 1 THEN 'Check your Excel column headers and ensure they match the expected format.'
    WHEN 2 THEN 'Fill in all required fields - no empty cells allowed in this column.'
    WHEN 5 THEN 'Review date formats and replace extreme dates like ''9999-12-31'' with valid dates.'
    WHEN 6 THEN 'Remove duplicate rows with the same ID/key values.'
    ELSE 'Review the data format and contact the system administrator if needed.' END AS text FROM raw_messages""",
)
def _action_error(spark, d):
    return table(spark, d, "raw_messages").select("event_id", G.action_for_error(F.col("message")).alias("text"))


@query(
    "action_for_reason",
    with_fixtures("raw_reasons")
    + """ SELECT event_id, 'Action Required: ' || CASE event_id % 4
      WHEN 1 THEN 'Check data formats - ensure numbers are numeric, dates are valid, etc.'
      WHEN 2 THEN 'Review the rejected rows CSV file for specific issues.'
      ELSE 'Fill in the missing required values in your Excel file.' END AS text FROM raw_reasons""",
)
def _action_reason(spark, d):
    return table(spark, d, "raw_reasons").select("event_id", G.action_for_reason(F.col("reason")).alias("text"))


@query(
    "parse_fk_error",
    with_fixtures("raw_messages")
    + """ SELECT event_id, CASE WHEN event_id % 8 = 0 THEN 'user_id' END AS fk_column,
    CASE WHEN event_id % 8 = 0 THEN CAST(user_id AS VARCHAR) END AS fk_value,
    CASE WHEN event_id % 8 = 0 THEN 'user_master' END AS fk_table FROM raw_messages JOIN events USING (event_id)""",
)
def _parse_fk(spark, d):
    return table(spark, d, "raw_messages").select("event_id", G.parse_fk_error(F.col("message")).alias("p")).select(
        "event_id", "p.*"
    )
