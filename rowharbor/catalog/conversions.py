"""Cleaning, schema, scalar conversions and row validation."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from rowharbor.catalog import query
from rowharbor.catalog.fixtures import table, with_fixtures
from rowharbor.functions.dates import to_date
from rowharbor.functions.json_text import csv_to_array, repair_json, to_json_or_array
from rowharbor.functions.numbers import to_float, to_int
from rowharbor.functions.text import KEY_TOKENS, REFERENCE_TOKENS, VALUE_TOKENS, list_items, to_bool, to_text
from rowharbor.operators import clean as C
from rowharbor.operators import validate as V
from rowharbor.operators.coerce import coerce_table

MISSING = "('', 'nan', 'NaN')"


def sql_int(c: str) -> str:
    t = f"REPLACE(TRIM({c}), ',', '')"
    return f"CASE WHEN {c} NOT IN {MISSING} THEN CAST(TRUNC(TRY_CAST({t} AS DOUBLE)) AS BIGINT) END"


def sql_float(c: str) -> str:
    return f"CASE WHEN {c} NOT IN {MISSING} THEN TRY_CAST(REPLACE(TRIM({c}), ',', '') AS DOUBLE) END"


def sql_number_error(c: str) -> str:
    t = f"REPLACE(TRIM({c}), ',', '')"
    return (
        f"CASE WHEN {c} NOT IN {MISSING} AND TRY_CAST({t} AS DOUBLE) IS NULL"
        f" THEN 'Type coercion failed: could not convert string to float: ''' || {t} || '''' END"
    )


def sql_date(c: str) -> str:
    return (
        f"CASE WHEN {c} LIKE '%9999-12-31%' THEN DATE '9999-12-31'"
        f" WHEN YEAR(TRY_CAST({c} AS DATE)) > 2200 THEN NULL ELSE TRY_CAST({c} AS DATE) END"
    )


def sql_items(c: str) -> str:
    return f"[TRIM(x) FOR x IN STRING_SPLIT({c}, ',') IF TRIM(x) <> '']"


def sql_json_list(c: str) -> str:
    items = sql_items(c)
    return (
        f"CASE WHEN {c} NOT IN {MISSING} AND LEN({items}) > 0"
        f" THEN '[\"' || ARRAY_TO_STRING({items}, '\",\"') || '\"]' END"
    )


def sql_json(c: str) -> str:
    return f"CASE WHEN {c} NOT IN {MISSING} THEN CASE WHEN JSON_VALID({c}) THEN {c} ELSE {sql_json_list(c)} END END"


def sql_moved(c: str) -> str:
    return (
        f"(REGEXP_MATCHES(TRIM({c}), '[=°×÷()+KCF-]|Depends|Varies|substance|pack|box')"
        f" OR TRY_CAST(TRIM({c}) AS DOUBLE) IS NULL)"
    )


RAW_COLUMNS = ("order_id", "cust_text", "price_text", "date_text", "tags_text", "factor_text", "status")
TRIMMED = ", ".join(f"TRIM({c}) AS {c}" for c in RAW_COLUMNS)


@query("clean", with_fixtures("raw_orders") + f" SELECT row_seq, {TRIMMED} FROM raw_orders")
def _clean(spark, d):
    raw = table(spark, d, "raw_orders")
    return C.clean(raw.toDF(*[f" {c} " for c in raw.columns]))


@query(
    "rename",
    "SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id, c_acctbal, c_mktsegment"
    " FROM customer",
)
def _rename(spark, d):
    customer = table(spark, d, "customer")
    two_names = customer.withColumns(
        {
            "c_name": F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")),
            "CUSTOMER_NAME": F.when(F.col("c_custkey") % 2 == 1, F.col("c_name")),
        }
    ).select("c_custkey", "c_name", "CUSTOMER_NAME", "c_nationkey", "c_acctbal", "c_mktsegment")
    names = {
        "c_custkey": "customer_id",
        "c_name": "customer_name",
        "CUSTOMER_NAME": "customer_name",
        "c_nationkey": "nation_id",
        "absent": "ignored",
    }
    return C.rename(two_names, names)


@query(
    "null_tokens",
    with_fixtures("raw_orders")
    + """ SELECT row_seq, CASE WHEN order_id NOT IN ('', 'nan') THEN order_id END AS order_id,
    CASE WHEN cust_text NOT IN ('', 'nan', 'NaN') THEN cust_text END AS cust_text,
    CASE WHEN price_text NOT IN ('', 'nan', 'None') THEN price_text END AS price_text FROM raw_orders""",
)
def _null_tokens(spark, d):
    raw = table(spark, d, "raw_orders").select("row_seq", "order_id", "cust_text", "price_text")
    keyed = C.null_tokens(raw, ["order_id"], KEY_TOKENS)
    return C.null_tokens(C.null_tokens(keyed, ["cust_text"], VALUE_TOKENS), ["price_text"], REFERENCE_TOKENS)


@query("project_to_target", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM lineitem")
def _project(spark, d):
    return C.project_to_target(
        table(spark, d, "lineitem"),
        ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice", "not_there"],
    )


@query(
    "evolve_schema",
    """SELECT n_nationkey, n_name, n_regionkey, CAST(NULL AS VARCHAR) AS new_text, CAST(NULL AS DOUBLE) AS new_number FROM nation
    UNION ALL SELECT CAST(c_custkey AS INTEGER), c_name, NULL, c_mktsegment, c_acctbal FROM customer""",
)
def _evolve(spark, d):
    incoming = table(spark, d, "customer").select(
        F.col("c_custkey").alias("n_nationkey"),
        F.col("c_name").alias("n_name"),
        F.col("c_mktsegment").alias("new_text"),
        F.col("c_acctbal").alias("new_number"),
    )
    return C.evolve_schema(table(spark, d, "nation"), incoming)


@query(
    "cast_to_schema",
    with_fixtures("raw_orders")
    + f""" SELECT {sql_int('order_id')} AS o_orderkey, {sql_int('cust_text')} AS o_custkey,
    CAST({sql_float('price_text')} AS DECIMAL(15, 2)) AS o_totalprice, {sql_date('date_text')} AS o_orderdate,
    status AS o_orderstatus FROM raw_orders""",
)
def _cast(spark, d):
    raw = table(spark, d, "raw_orders").select(
        to_int(F.col("order_id")).alias("o_orderkey"),
        to_int(F.col("cust_text")).alias("o_custkey"),
        to_float(F.col("price_text")).alias("o_totalprice"),
        to_date(F.col("date_text")).alias("o_orderdate"),
        F.col("status").alias("o_orderstatus"),
    )
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_totalprice", T.DecimalType(15, 2)),
            T.StructField("o_orderdate", T.DateType()),
            T.StructField("o_orderstatus", T.StringType()),
        ]
    )
    return C.cast_to_schema(raw, schema)


@query("to_int", with_fixtures("raw_orders") + f" SELECT row_seq, {sql_int('cust_text')} AS v FROM raw_orders")
def _to_int(spark, d):
    return table(spark, d, "raw_orders").select("row_seq", to_int(F.col("cust_text")).alias("v"))


@query("to_float", with_fixtures("raw_orders") + f" SELECT row_seq, {sql_float('price_text')} AS v FROM raw_orders")
def _to_float(spark, d):
    return table(spark, d, "raw_orders").select("row_seq", to_float(F.col("price_text")).alias("v"))


@query("to_date", with_fixtures("raw_orders") + f" SELECT row_seq, {sql_date('date_text')} AS v FROM raw_orders")
def _to_date(spark, d):
    return table(spark, d, "raw_orders").select("row_seq", to_date(F.col("date_text")).alias("v"))


@query(
    "csv_to_array",
    with_fixtures("raw_orders")
    + f""" SELECT row_seq, CASE WHEN LEN({sql_items('tags_text')}) > 0 THEN {sql_items('tags_text')} END AS items,
    CASE WHEN LEN({sql_items('tags_text')}) > 0 THEN CAST(TO_JSON({sql_items('tags_text')}) AS VARCHAR) END AS json FROM raw_orders""",
)
def _csv_to_array(spark, d):
    return table(spark, d, "raw_orders").select(
        "row_seq", list_items(F.col("tags_text")).alias("items"), csv_to_array(F.col("tags_text")).alias("json")
    )


@query(
    "to_json_or_array",
    with_fixtures("raw_orders")
    + f""" SELECT 'order' AS origin, row_seq AS id, {sql_json('tags_text')} AS v FROM raw_orders
    UNION ALL SELECT 'event', event_id, {sql_json('props')} FROM events""",
)
def _to_json_or_array(spark, d):
    orders = table(spark, d, "raw_orders").select(
        F.lit("order").alias("origin"), F.col("row_seq").alias("id"), to_json_or_array(F.col("tags_text")).alias("v")
    )
    events = table(spark, d, "events").select(
        F.lit("event"), F.col("event_id"), to_json_or_array(F.col("props"))
    )
    return orders.union(events)


QUOTED_LISTS = """SELECT p_partkey, CASE p_partkey % 5
 WHEN 0 THEN '[''' || p_name || ''', ''' || p_brand || ''']'
 WHEN 1 THEN '["' || p_name || '", "' || p_brand || '"]'
 WHEN 2 THEN '[''' || p_name || ''', ' || p_brand || ']'
 WHEN 3 THEN '' ELSE p_name || ', ''' || p_brand || '''' END AS raw FROM part"""


@query(
    "repair_json",
    f"""WITH quoted AS ({QUOTED_LISTS}) SELECT q.p_partkey, CASE q.p_partkey % 5
    WHEN 0 THEN '["' || p_name || '","' || p_brand || '"]'
    WHEN 2 THEN REPLACE(raw, '''', '"') WHEN 3 THEN NULL ELSE raw END AS v
    FROM quoted q JOIN part p ON q.p_partkey = p.p_partkey""",
)
def _repair_json(spark, d):
    quoted = spark.sql(QUOTED_LISTS.replace("FROM part", "FROM {part}"), part=table(spark, d, "part"))
    return quoted.select("p_partkey", repair_json(F.col("raw")).alias("v"))


@query(
    "to_text",
    """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust_text,
    CAST(CAST(FLOOR(o_totalprice) AS DOUBLE) AS VARCHAR) AS price_text FROM orders""",
)
def _to_text(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        to_text(F.col("o_custkey")).alias("cust_text"),
        to_text(F.floor("o_totalprice").cast("double")).alias("price_text"),
    )


FLAG_TEXT = """CASE l_returnflag WHEN 'A' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'T' ELSE ' yes ' END
 WHEN 'R' THEN CASE WHEN l_linenumber % 2 = 0 THEN '1' ELSE 'False' END ELSE 'maybe' END"""


@query(
    "to_bool",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, LOWER(TRIM({FLAG_TEXT})) IN ('true', 't', '1', 'yes') AS flag
    FROM lineitem""",
)
def _to_bool(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", to_bool(F.expr(FLAG_TEXT)).alias("flag")
    )


@query(
    "split_factor",
    with_fixtures("raw_orders")
    + f""" SELECT row_seq, CASE WHEN {sql_moved('factor_text')} THEN 0.0::DOUBLE
    ELSE TRY_CAST(TRIM(factor_text) AS DOUBLE) END AS conversion_factor,
    CASE WHEN {sql_moved('factor_text')} THEN TRIM(factor_text) END AS syn FROM raw_orders""",
)
def _split_factor(spark, d):
    raw = table(spark, d, "raw_orders").select("row_seq", F.col("factor_text").alias("conversion_factor"))
    return C.split_factor(raw)


COERCE_TYPES = {"cust_text": "int", "price_text": "float", "date_text": "date", "tags_text": "dict", "status": "str"}
TYPE_REASON_SQL = f"COALESCE({sql_number_error('cust_text')}, {sql_number_error('price_text')})"


@query(
    "coerce_valid",
    with_fixtures("raw_orders")
    + f""" SELECT row_seq, {sql_int('cust_text')} AS cust_text, {sql_float('price_text')} AS price_text,
    {sql_date('date_text')} AS date_text, {sql_json('tags_text')} AS tags_text, status FROM raw_orders
    WHERE {TYPE_REASON_SQL} IS NULL""",
)
def _coerce_valid(spark, d):
    raw = table(spark, d, "raw_orders").drop("order_id", "factor_text")
    return coerce_table(raw, COERCE_TYPES)[0]


@query(
    "coerce_rejected",
    with_fixtures("raw_orders")
    + f""" SELECT row_seq, cust_text, price_text, date_text, tags_text, status, {TYPE_REASON_SQL} AS rejection_reason
    FROM raw_orders WHERE {TYPE_REASON_SQL} IS NOT NULL""",
)
def _coerce_rejected(spark, d):
    raw = table(spark, d, "raw_orders").drop("order_id", "factor_text")
    return coerce_table(raw, COERCE_TYPES)[1]


@query(
    "split_pk_valid",
    with_fixtures("raw_orders") + " SELECT * FROM raw_orders WHERE order_id NOT IN ('', 'nan')",
)
def _split_pk_valid(spark, d):
    return V.split_pk(table(spark, d, "raw_orders"), ["order_id"])[0]


@query(
    "split_pk_rejected",
    with_fixtures("raw_lines")
    + """ SELECT *, 'Missing required data in columns: [' || CASE
      WHEN order_id IS NULL AND line_no = '' THEN '''order_id'', ''line_no'''
      WHEN order_id IS NULL THEN '''order_id''' ELSE '''line_no''' END || ']' AS rejection_reason
    FROM raw_lines WHERE order_id IS NULL OR line_no = ''""",
)
def _split_pk_rejected(spark, d):
    return V.split_pk(table(spark, d, "raw_lines"), ["order_id", "line_no"])[1]


@query(
    "rejects_union",
    with_fixtures("raw_orders")
    + f""" SELECT 'pk' AS reject_stage, COUNT(*) AS n, COUNT(cust_text) AS n_cust FROM raw_orders
      WHERE order_id IN ('', 'nan')
    UNION ALL SELECT 'type', COUNT(*), COUNT(cust_text) FROM raw_orders
      WHERE order_id NOT IN ('', 'nan') AND {TYPE_REASON_SQL} IS NOT NULL""",
)
def _rejects_union(spark, d):
    valid, no_key = V.split_pk(table(spark, d, "raw_orders"), ["order_id"])
    bad_type = coerce_table(valid, COERCE_TYPES)[1]
    return (
        V.rejects_union({"pk": no_key, "type": bad_type.drop("factor_text")})
        .groupBy("reject_stage")
        .agg(F.count(F.lit(1)).alias("n"), F.count("cust_text").alias("n_cust"))
    )


@query(
    "check_not_null",
    with_fixtures("raw_orders")
    + f""", typed AS (SELECT row_seq, {sql_float('price_text')} AS price, {sql_date('date_text')} AS ordered
      FROM raw_orders)
    SELECT *, 'Missing Required Data: ' || CASE WHEN price IS NULL AND ordered IS NULL THEN 'price, ordered'
      WHEN price IS NULL THEN 'price' ELSE 'ordered' END AS rejection_reason
    FROM typed WHERE price IS NULL OR ordered IS NULL""",
)
def _check_not_null(spark, d):
    typed = table(spark, d, "raw_orders").select(
        "row_seq", to_float(F.col("price_text")).alias("price"), to_date(F.col("date_text")).alias("ordered")
    )
    return V.check_not_null(typed, ["price", "ordered"])


@query(
    "check_unique",
    """SELECT l.*, 'Duplicate value for unique key (l_orderkey, l_linenumber)' AS rejection_reason FROM lineitem l
    JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1) USING (l_orderkey, l_linenumber)""",
)
def _check_unique(spark, d):
    return V.check_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_length",
    """SELECT p_partkey, p_name, p_type, CASE WHEN LENGTH(p_name) > 8 THEN 'Value too long for p_name(8)'
    ELSE 'Value too long for p_type(7)' END AS rejection_reason
    FROM part WHERE LENGTH(p_name) > 8 OR LENGTH(p_type) > 7""",
)
def _check_length(spark, d):
    return V.check_length(table(spark, d, "part").select("p_partkey", "p_name", "p_type"), {"p_name": 8, "p_type": 7})


@query(
    "check_enum",
    """SELECT *, 'Value not allowed in o_orderstatus: ' || o_orderstatus AS rejection_reason FROM orders
    WHERE o_orderstatus NOT IN ('O', 'F')""",
)
def _check_enum(spark, d):
    return V.check_enum(table(spark, d, "orders"), "o_orderstatus", ["O", "F"])


@query(
    "check_decimal",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS DECIMAL(6, 1)) AS fitted, NULL AS rejection_reason
    FROM lineitem WHERE TRY_CAST(l_extendedprice AS DECIMAL(6, 1)) IS NOT NULL
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, NULL, 'Numeric overflow in fitted(6,1)' FROM lineitem
    WHERE TRY_CAST(l_extendedprice AS DECIMAL(6, 1)) IS NULL""",
)
def _check_decimal(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("fitted")
    )
    valid, rejected = V.check_decimal(rows, "fitted", 6, 1)
    return valid.withColumn("rejection_reason", F.lit(None).cast("string")).unionByName(
        rejected.withColumn("fitted", F.lit(None).cast("decimal(6,1)"))
    )


@query(
    "fill_defaults",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS o_orderpriority,
    'Active' AS o_orderstatus FROM orders""",
)
def _fill_defaults(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    return V.fill_defaults(rows, {"o_orderstatus": "Active", "o_orderpriority": "5-LOW"})
