"""Dirty inputs derived from the test tables by SQL both engines run unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

RAW_ORDERS = """
SELECT o_orderkey AS row_seq,
  CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN 'nan'
       WHEN o_orderkey % 23 = 1 THEN CAST(o_orderkey - 1 AS STRING)
       ELSE CAST(o_orderkey AS STRING) END AS order_id,
  CASE WHEN o_orderkey % 41 = 0 THEN 'NaN' WHEN o_orderkey % 43 = 0 THEN 'abc'
       WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS STRING) || '.0'
       ELSE ' ' || CAST(o_custkey AS STRING) || ' ' END AS cust_text,
  CASE WHEN o_orderkey % 29 = 0 THEN 'n/a' WHEN o_orderkey % 31 = 0 THEN '12d' WHEN o_orderkey % 37 = 0 THEN ''
       ELSE CAST(CAST(FLOOR(o_totalprice / 1000) AS BIGINT) AS STRING) || ',' ||
            LPAD(CAST(CAST(FLOOR(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0') || '.50' END AS price_text,
  CASE WHEN o_orderkey % 11 = 0 THEN '9999-12-31' WHEN o_orderkey % 13 = 0 THEN '2250-01-01'
       WHEN o_orderkey % 14 = 0 THEN 'not a date' WHEN o_orderkey % 15 = 0 THEN ''
       ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS date_text,
  CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN '["x", "y"]'
       WHEN o_orderkey % 5 = 2 THEN 'a, b,,c ' WHEN o_orderkey % 5 = 3 THEN ' , ,' ELSE o_orderpriority END AS tags_text,
  CASE WHEN o_orderkey % 6 = 0 THEN '0.001' WHEN o_orderkey % 6 = 1 THEN '=A1*2'
       WHEN o_orderkey % 6 = 2 THEN 'Depends on substance' WHEN o_orderkey % 6 = 3 THEN '1e3'
       WHEN o_orderkey % 6 = 4 THEN '-5' ELSE '12 pack' END AS factor_text,
  o_orderstatus AS status
FROM {orders}
"""

RAW_LINES = """
SELECT CAST(NULLIF(l_orderkey, 0) AS STRING) AS order_id,
  CASE WHEN l_partkey % 50 = 0 THEN '' ELSE CAST(l_linenumber AS STRING) END AS line_no,
  l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate
FROM {lineitem}
"""

CUSTOMER_SUBSET = "SELECT * FROM {customer} WHERE c_custkey % 7 <> 0"
PART_SUBSET = "SELECT * FROM {part} WHERE p_size < 25"
SUPPLIER_SUBSET = "SELECT * FROM {supplier} WHERE s_suppkey % 11 <> 0"
NATION_SUBSET = "SELECT * FROM {nation} WHERE n_nationkey % 5 <> 0"

UPSERT_TARGET = """
SELECT o_orderkey AS order_id, o_custkey AS cust_id, o_totalprice AS price, o_orderstatus AS status
FROM {orders} WHERE o_orderkey % 10 < 7
"""
UPSERT_INCOMING = """
SELECT o_orderkey AS order_id, o_custkey AS cust_id,
  CASE WHEN o_orderkey % 10 = 4 THEN NULL WHEN o_orderkey % 10 = 5 THEN o_totalprice ELSE o_totalprice + 1 END AS price,
  o_orderstatus AS status
FROM {orders} WHERE o_orderkey % 10 >= 4
"""

RAW_MESSAGES = """
SELECT event_id, CASE event_id % 8
 WHEN 0 THEN 'ForeignKeyViolation: Key (user_id)=(' || CAST(user_id AS STRING) || ') is not present in table "user_master"'
 WHEN 1 THEN 'UndefinedColumn: column "c1" of relation "t" does not exist'
 WHEN 2 THEN 'NotNullViolation: null value in column "price"'
 WHEN 3 THEN 'InvalidTextRepresentation: invalid input syntax for type json'
 WHEN 4 THEN 'InvalidTextRepresentation: invalid input syntax for type integer'
 WHEN 5 THEN 'OutOfBoundsDatetime: out of bounds'
 WHEN 6 THEN 'CardinalityViolation: cannot affect row a second time'
 ELSE 'timeout' END AS message
FROM {events}
"""

#: Rejection reasons of every kind, from the events.
RAW_REASONS = """
SELECT event_id, event_type, CASE event_id % 4
 WHEN 0 THEN 'Missing required data in columns: [''order_id'', ''line_no'']'
 WHEN 1 THEN 'Type coercion failed: could not convert string to float: ''' || event_type || ''''
 WHEN 2 THEN 'Foreign key violation: user_id=' || CAST(user_id AS STRING) || ' not found in user_master.user_id'
 ELSE 'Missing required data' END AS reason
FROM {events}
"""

#: Run records: every event stands for one table load.
RUN_RECORDS = """
SELECT event_id AS seq, event_type AS sheet, 'table_' || CAST(user_id AS STRING) AS "table",
  event_id % 3 AS read_rows, event_id % 3 AS valid_rows, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS rejected_rows,
  0 AS inserted, 0 AS updated,
  CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 11 = 0 THEN 'ERROR: sheet not found'
       ELSE 'note ' || CAST(event_id % 13 AS STRING) END AS notes
FROM {events}
"""

AVAILABLE_NAMES = """
SELECT SUBSTR(p_name || ' ' || p_type || ' ' || p_brand || ' shelf stock', 1, 31) AS name, MIN(p_partkey) AS ord
FROM {part} GROUP BY 1
"""
REQUESTED_NAMES = """
SELECT p_partkey, CASE p_partkey % 7
 WHEN 0 THEN SUBSTR(p_name || ' ' || p_type || ' ' || p_brand || ' shelf stock', 1, 31)
 WHEN 1 THEN UPPER(SUBSTR(p_name || ' ' || p_type || ' ' || p_brand || ' shelf stock', 1, 31)) || ' '
 WHEN 2 THEN REPLACE(SUBSTR(p_name || ' ' || p_type || ' ' || p_brand || ' shelf stock', 1, 31), ' ', '_')
 WHEN 3 THEN REPLACE(UPPER(SUBSTR(p_name || ' ' || p_type || ' ' || p_brand || ' shelf stock', 1, 31)), ' ', '-')
 WHEN 4 THEN p_name || ' ' || p_type || ' ' || p_brand || ' shelf stock and more'
 WHEN 5 THEN SUBSTR(p_name || ' ' || p_type || ' ' || p_brand || ' shelf stock', 1, 26) || ' and other words'
 ELSE 'no such ' || p_name END AS req
FROM {part}
"""

FRAGMENTS = """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN SUBSTR(p_name, 1, 3) WHEN 1 THEN UPPER(p_name) || ' x'
 WHEN 2 THEN ' ' || SUBSTR(p_name, 3, 5) ELSE p_brand END AS fragment
FROM {part}
"""
PART_NAMES = "SELECT p_name AS name, MIN(p_partkey) AS ord FROM {part} GROUP BY p_name"

FIXTURES = {
    "raw_orders": RAW_ORDERS,
    "raw_lines": RAW_LINES,
    "customer_subset": CUSTOMER_SUBSET,
    "part_subset": PART_SUBSET,
    "supplier_subset": SUPPLIER_SUBSET,
    "nation_subset": NATION_SUBSET,
    "upsert_target": UPSERT_TARGET,
    "upsert_incoming": UPSERT_INCOMING,
    "raw_messages": RAW_MESSAGES,
    "raw_reasons": RAW_REASONS,
    "run_records": RUN_RECORDS,
    "available_names": AVAILABLE_NAMES,
    "requested_names": REQUESTED_NAMES,
    "fragments": FRAGMENTS,
    "part_names": PART_NAMES,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, or a fixture derived from one."""
    if name not in FIXTURES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = FIXTURES[name].replace('"table"', '`table`')
    bases = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **bases)


def with_fixtures(*names: str) -> str:
    """``WITH`` clause that defines the fixtures for the SQL side, ending so that more may follow."""
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURES[n].format(**{t: t for t in TABLES})})" for n in names)
