"""Upsert, change classes, replace, defaults and load verification."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowharbor.catalog import query
from rowharbor.catalog.fixtures import table, with_fixtures
from rowharbor.operators import merge as U
from rowharbor.operators import metrics as M

BOTH = with_fixtures("upsert_target", "upsert_incoming")
KEY = ["order_id"]


def sides(spark, d):
    return table(spark, d, "upsert_target"), table(spark, d, "upsert_incoming")


@query(
    "upsert",
    BOTH
    + """ SELECT * FROM upsert_incoming UNION ALL
    SELECT * FROM upsert_target WHERE order_id NOT IN (SELECT order_id FROM upsert_incoming)""",
)
def _upsert(spark, d):
    return U.upsert(*sides(spark, d), KEY)


CLASSES = (
    BOTH
    + """, classes AS (SELECT i.*, CASE WHEN t.order_id IS NULL THEN 'inserted'
      WHEN t.price IS NOT DISTINCT FROM i.price AND t.cust_id = i.cust_id AND t.status = i.status THEN 'unchanged'
      ELSE 'updated' END AS change FROM upsert_incoming i LEFT JOIN upsert_target t ON i.order_id = t.order_id)"""
)


@query("classify_changes", CLASSES + " SELECT * FROM classes")
def _classify(spark, d):
    return U.classify_changes(*sides(spark, d), KEY)


@query(
    "change_counts",
    CLASSES
    + """ SELECT COUNT(*) FILTER (WHERE change = 'inserted') AS inserted, COUNT(*) FILTER (WHERE change = 'updated') AS updated,
    COUNT(*) FILTER (WHERE change = 'unchanged') AS unchanged FROM classes""",
)
def _counts(spark, d):
    return U.change_counts(*sides(spark, d), KEY)


@query(
    "upsert_partial_columns",
    BOTH
    + """ SELECT COALESCE(i.order_id, t.order_id) AS order_id, COALESCE(i.cust_id, t.cust_id) AS cust_id,
    CASE WHEN i.order_id IS NOT NULL THEN i.price ELSE t.price END AS price,
    CASE WHEN t.order_id IS NOT NULL THEN t.status ELSE 'NEW' END AS status
    FROM upsert_target t FULL OUTER JOIN upsert_incoming i ON t.order_id = i.order_id""",
)
def _partial(spark, d):
    target, incoming = sides(spark, d)
    return U.upsert(target, incoming.drop("status"), KEY, {"status": "NEW"})


@query(
    "upsert_new_columns",
    BOTH
    + """ SELECT COALESCE(i.order_id, t.order_id) AS order_id, t.cust_id, t.price, t.status, i.status AS new_col
    FROM upsert_target t FULL OUTER JOIN upsert_incoming i ON t.order_id = i.order_id""",
)
def _new_columns(spark, d):
    target, incoming = sides(spark, d)
    return U.upsert(target, incoming.select("order_id", F.col("status").alias("new_col")), KEY)


@query(
    "upsert_keys_only",
    BOTH + " SELECT order_id FROM upsert_target UNION SELECT order_id FROM upsert_incoming",
)
def _keys_only(spark, d):
    target, incoming = sides(spark, d)
    return U.upsert(target.select("order_id"), incoming.select("order_id"), KEY)


@query("replace", BOTH + " SELECT order_id, cust_id, NULL::DOUBLE AS price, status FROM upsert_incoming")
def _replace(spark, d):
    target, incoming = sides(spark, d)
    return U.replace(target, incoming.drop("price"))


@query("replace_with_nothing", BOTH + " SELECT * FROM upsert_target")
def _replace_nothing(spark, d):
    target, incoming = sides(spark, d)
    return U.replace(target, incoming.where("order_id < 0"))


@query(
    "verify_load",
    BOTH
    + """, k AS (SELECT order_id FROM upsert_target UNION SELECT order_id FROM upsert_incoming)
    SELECT (SELECT COUNT(*) FROM upsert_target) AS rows_before, (SELECT COUNT(*) FROM k) AS rows_after,
    (SELECT COUNT(*) FROM upsert_incoming) AS rows_processed,
    (SELECT COUNT(*) FROM k) - (SELECT COUNT(*) FROM upsert_target) AS rows_added,
    'fewer rows added than processed' AS warning""",
)
def _verify(spark, d):
    target, incoming = sides(spark, d)
    return U.verify_load(target, U.upsert(target, incoming, KEY), incoming)


@query(
    "idempotent_note",
    BOTH
    + f""" SELECT 'orders' AS "table", COUNT(*) AS read_rows, COUNT(*) AS valid_rows, CAST(0 AS BIGINT) AS rejected_rows,
    CAST(0 AS BIGINT) AS deduplicated, CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated,
    COUNT(*) AS unchanged, '{M.NOTE_IDEMPOTENT}' AS notes FROM upsert_incoming""",
)
def _idempotent(spark, d):
    target, incoming = sides(spark, d)
    stored = U.upsert(target, incoming, KEY)
    counts = M.status_counts(U.classify_changes(stored, incoming, KEY), "orders", "change")
    return M.idempotent_note(M.load_metrics(counts))


#: The target keeps order keys as 32-bit numbers of cents; some arriving prices are beyond them.
NARROW_TARGET = "SELECT order_id, CAST(FLOOR(price) AS INT) AS price, status FROM {t}"
WIDE_INCOMING = """SELECT order_id, CASE WHEN order_id % 7 = 0 THEN 9999999999 + order_id ELSE CAST(FLOOR(price) AS BIGINT) END AS price, status FROM {t}"""
OVERFLOW = BOTH + f""", t AS ({NARROW_TARGET.format(t="upsert_target")}), i AS ({WIDE_INCOMING.format(t="upsert_incoming")}),
    bad AS (SELECT * FROM i WHERE price > 2147483647), good AS (SELECT * FROM i WHERE price IS NULL OR price <= 2147483647)"""


def overflow_sides(spark, d):
    target, incoming = sides(spark, d)
    return spark.sql(NARROW_TARGET, t=target), spark.sql(WIDE_INCOMING, t=incoming)


@query(
    "upsert_overflow",
    OVERFLOW + " SELECT order_id, CAST(price AS INTEGER) AS price, status FROM good UNION ALL SELECT * FROM t WHERE order_id NOT IN (SELECT order_id FROM good)",
)
def _overflow(spark, d):
    """Arriving values that the stored column cannot hold leave the stored row as it is."""
    return U.upsert_or_reject(*overflow_sides(spark, d), KEY)[0]


@query("upsert_overflow_rejected", OVERFLOW + " SELECT *, 'Value out of range in price(int)' AS rejection_reason FROM bad")
def _overflow_rejected(spark, d):
    return U.upsert_or_reject(*overflow_sides(spark, d), KEY)[1]
