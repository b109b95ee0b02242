"""Whole-table loads, runs over many tables, and loads driven by arriving files."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from rowharbor.catalog import query
from rowharbor.catalog.conversions import (
    TRIMMED,
    sql_date,
    sql_float,
    sql_int,
    sql_json,
    sql_moved,
    sql_number_error,
)
from rowharbor.catalog.fixtures import table, with_fixtures
from rowharbor.functions.messages import ACTION_REASON_FORMAT, ACTION_REASON_MISSING, ACTION_REASON_OTHER, REASON_FORMAT
from rowharbor.operators.keys import number_rows
from rowharbor.operators.metrics import run_totals
from rowharbor.plans.load import load_all, load_table
from rowharbor.session import ROW_GROUP, scratch_path
from rowharbor.sources.changes import current_rows, write_changes
from rowharbor.spec import ForeignKey, TableSpec
from rowharbor.streaming.files import stream_files, stream_load, upsert_batch

ORDERS = TableSpec(
    name="orders",
    pk=["o_orderkey"],
    types={
        "o_orderkey": "int",
        "o_custkey": "int",
        "o_totalprice": "float",
        "o_orderdate": "date",
        "tags": "dict",
        "conversion_factor": "float",
        "syn": "str",
        "o_orderstatus": "str",
    },
    renames={
        "order_id": "o_orderkey",
        "cust_text": "o_custkey",
        "price_text": "o_totalprice",
        "date_text": "o_orderdate",
        "tags_text": "tags",
        "factor_text": "conversion_factor",
        "status": "o_orderstatus",
    },
    factor_column="conversion_factor",
    foreign_keys=[ForeignKey("o_custkey", "customer", "c_custkey")],
)

TARGET_SQL = """SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
 CAST(NULL AS STRING) AS tags, CAST(NULL AS DOUBLE) AS conversion_factor, CAST(NULL AS STRING) AS syn, o_orderstatus
 FROM {orders} WHERE o_orderkey % 10 < 7"""

LOAD_SQL = (
    with_fixtures("raw_orders", "customer_subset")
    + f""", target AS ({TARGET_SQL.format(orders='orders')}),
cleaned AS (SELECT row_seq, {TRIMMED} FROM raw_orders),
judged AS (SELECT *, CASE WHEN order_id IN ('', 'nan') THEN 'Missing required data in columns: [''o_orderkey'']'
    ELSE COALESCE({sql_number_error('cust_text')}, {sql_number_error('price_text')}) END AS reason FROM cleaned),
passed AS (SELECT row_seq, {sql_int('order_id')} AS o_orderkey, {sql_int('cust_text')} AS o_custkey,
    {sql_float('price_text')} AS o_totalprice, {sql_date('date_text')} AS o_orderdate, {sql_json('tags_text')} AS tags,
    CASE WHEN {sql_moved('factor_text')} THEN 0.0::DOUBLE ELSE TRY_CAST(factor_text AS DOUBLE) END AS conversion_factor,
    CASE WHEN {sql_moved('factor_text')} THEN factor_text END AS syn, status AS o_orderstatus
  FROM judged WHERE reason IS NULL),
kept AS (SELECT * FROM passed QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY row_seq DESC) = 1),
good AS (SELECT * EXCLUDE (row_seq) FROM kept WHERE o_custkey IS NULL OR o_custkey IN (SELECT c_custkey FROM customer_subset)),
bad AS (SELECT * EXCLUDE (row_seq), 'Foreign key violation: o_custkey=' || CAST(o_custkey AS VARCHAR)
    || ' not found in customer.c_custkey' AS reason FROM kept WHERE o_custkey NOT IN (SELECT c_custkey FROM customer_subset)),
classes AS (SELECT CASE WHEN t.o_orderkey IS NULL THEN 'inserted'
    WHEN ROW(g.o_custkey, g.o_totalprice, g.o_orderdate, g.tags, g.conversion_factor, g.syn, g.o_orderstatus)
      IS NOT DISTINCT FROM ROW(t.o_custkey, t.o_totalprice, t.o_orderdate, t.tags, t.conversion_factor, t.syn, t.o_orderstatus)
    THEN 'unchanged' ELSE 'updated' END AS change FROM good g LEFT JOIN target t ON g.o_orderkey = t.o_orderkey)
"""
)


def orders_load(spark, d, **options):
    target = spark.sql(TARGET_SQL, orders=table(spark, d, "orders"))
    parents = {"customer": table(spark, d, "customer_subset")}
    return load_table(table(spark, d, "raw_orders"), ORDERS, target, parents, seq="row_seq", **options)


COUNTS_SQL = """(SELECT COUNT(*) FROM raw_orders) AS read_rows, (SELECT COUNT(*) FROM kept) AS valid_rows,
  (SELECT COUNT(*) FROM judged WHERE reason IS NOT NULL)"""


@query(
    "load_table_metrics",
    LOAD_SQL
    + f""" SELECT 'orders' AS "table", {COUNTS_SQL} + (SELECT COUNT(*) FROM bad) AS rejected_rows,
    (SELECT COUNT(*) FROM passed) - (SELECT COUNT(*) FROM kept) AS deduplicated,
    COUNT(*) FILTER (WHERE change = 'inserted') AS inserted, COUNT(*) FILTER (WHERE change = 'updated') AS updated,
    COUNT(*) FILTER (WHERE change = 'unchanged') AS unchanged FROM classes""",
)
def _load_metrics(spark, d):
    return orders_load(spark, d).metrics()


@query(
    "load_table_snapshot",
    LOAD_SQL
    + """ SELECT * FROM good UNION ALL SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM good)""",
)
def _load_snapshot(spark, d):
    return orders_load(spark, d).snapshot


@query("load_table_initial", LOAD_SQL + " SELECT * FROM good")
def _load_initial(spark, d):
    return orders_load(spark, d, mode="initial").snapshot


@query(
    "load_table_rejects",
    LOAD_SQL
    + """ SELECT order_id AS o_orderkey, cust_text AS o_custkey, price_text AS o_totalprice, reason AS rejection_reason,
      CASE WHEN order_id IN ('', 'nan') THEN 'pk' ELSE 'type' END AS reject_stage FROM judged WHERE reason IS NOT NULL
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), CAST(o_totalprice AS VARCHAR), reason, 'fk'
    FROM bad""",
)
def _load_rejects(spark, d):
    outcome = orders_load(spark, d)
    shown = ["o_orderkey", "o_custkey", "o_totalprice"]
    typed = outcome.fk_rejected.withColumns({c: F.col(c).cast("string") for c in shown})
    columns = [*shown, "rejection_reason", "reject_stage"]
    return outcome.rejected.select(columns).unionByName(typed.select(columns))


@query(
    "load_table_dry_run",
    LOAD_SQL
    + f""" SELECT 'orders' AS "table", {COUNTS_SQL} + (SELECT COUNT(*) FROM bad) AS rejected_rows,
    (SELECT COUNT(*) FROM target) AS target_rows, CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated""",
)
def _dry_run(spark, d):
    outcome = orders_load(spark, d, dry_run=True)
    rows = outcome.snapshot.agg(F.count(F.lit(1)).alias("n")).scalar()
    return outcome.metrics().select(
        "table", "read_rows", "valid_rows", "rejected_rows", rows.alias("target_rows"), "inserted", "updated"
    )


@query(
    "load_table_notes",
    LOAD_SQL
    + """ SELECT reason, n FROM (
      SELECT CASE WHEN reason LIKE 'Type%' THEN 'Type coercion failed: could not convert string to float' ELSE reason END AS reason,
        COUNT(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY 1
      UNION ALL SELECT 'Deduplicated ' || ((SELECT COUNT(*) FROM passed) - (SELECT COUNT(*) FROM kept))
        || ' duplicate rows on keys [''o_orderkey'']', 0
      UNION ALL SELECT (SELECT COUNT(*) FROM bad) || ' rows rejected due to missing foreign key references', 0)""",
)
def _load_notes(spark, d):
    return orders_load(spark, d).notes.select("reason", "n")


@query(
    "load_all_actions",
    LOAD_SQL
    + f""" SELECT 'orders' AS sheet, 'orders' AS "table", issue, action_needed FROM (
      SELECT 'Missing Required Data: Some rows are missing values in the ''o_orderkey'' column(s).' AS issue, '{ACTION_REASON_MISSING}' AS action_needed
      UNION ALL SELECT '{REASON_FORMAT}', '{ACTION_REASON_FORMAT}'
      UNION ALL SELECT 'Data Quality Issue: Deduplicated ' || ((SELECT COUNT(*) FROM passed) - (SELECT COUNT(*) FROM kept))
        || ' duplicate rows on keys [''o_orderkey'']', '{ACTION_REASON_OTHER}'
      UNION ALL SELECT 'Data Quality Issue: ' || (SELECT COUNT(*) FROM bad) || ' rows rejected due to missing foreign key references', '{ACTION_REASON_OTHER}')""",
)
def _load_all_actions(spark, d):
    """What a run has to say about its rejected rows, in plain words, each with what to do."""
    targets = {"orders": spark.sql(TARGET_SQL, orders=table(spark, d, "orders")), "customer": table(spark, d, "customer_subset")}
    return load_all({"orders": table(spark, d, "raw_orders")}, [ORDERS], targets, seqs={"orders": "row_seq"}).issues()


def star_specs() -> list[TableSpec]:
    """Nations to line items, parents first, with all their columns and references."""
    return [
        TableSpec("nation", ["n_nationkey"], {"n_nationkey": "int", "n_name": "str", "n_regionkey": "int"}),
        TableSpec(
            "customer",
            ["c_custkey"],
            {"c_custkey": "int", "c_name": "str", "c_nationkey": "int", "c_acctbal": "float", "c_mktsegment": "str"},
            foreign_keys=[ForeignKey("c_nationkey", "nation", "n_nationkey")],
        ),
        TableSpec(
            "supplier",
            ["s_suppkey"],
            {"s_suppkey": "int", "s_name": "str", "s_nationkey": "int", "s_acctbal": "float"},
            foreign_keys=[ForeignKey("s_nationkey", "nation", "n_nationkey")],
        ),
        TableSpec(
            "part",
            ["p_partkey"],
            {"p_partkey": "int", "p_name": "str", "p_brand": "str", "p_type": "str", "p_size": "int", "p_retailprice": "float"},
        ),
        TableSpec(
            "orders",
            ["o_orderkey"],
            {
                "o_orderkey": "int",
                "o_custkey": "int",
                "o_orderstatus": "str",
                "o_totalprice": "float",
                "o_orderdate": "date",
                "o_orderpriority": "str",
            },
            foreign_keys=[ForeignKey("o_custkey", "customer", "c_custkey")],
        ),
        TableSpec(
            "lineitem",
            ["l_orderkey", "l_linenumber"],
            {
                "l_orderkey": "int",
                "l_partkey": "int",
                "l_suppkey": "int",
                "l_linenumber": "int",
                "l_quantity": "float",
                "l_extendedprice": "float",
                "l_discount": "float",
                "l_tax": "float",
                "l_returnflag": "str",
                "l_linestatus": "str",
                "l_shipdate": "date",
            },
            foreign_keys=[
                ForeignKey("l_orderkey", "orders", "o_orderkey"),
                ForeignKey("l_partkey", "part", "p_partkey"),
                ForeignKey("l_suppkey", "supplier", "s_suppkey"),
            ],
        ),
    ]


#: What decides which of the line items of a key is the last.
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
SUBSETS = {"nation": "nation_subset", "part": "part_subset"}


def star_run(spark, d, specs=None, mode="initial"):
    specs = specs or star_specs()
    batches = {}
    for spec in specs:
        source = table(spark, d, SUBSETS.get(spec.name, spec.name))
        order = [F.struct(*LINE_ORDER).alias("line_order")] if spec.name == "lineitem" else []
        batches[spec.name] = source.select([F.col(c).cast("string").alias(c) for c in spec.types] + order)
    targets = {s.name: spark.createDataFrame([], s.storage_schema()) for s in specs}
    return load_all(batches, specs, targets, mode=mode, seqs={"lineitem": "line_order"})


STAR_SQL = (
    with_fixtures("part_subset")
    + f""", c AS (SELECT *, c_nationkey % 5 <> 0 AS ok FROM customer),
s AS (SELECT *, s_nationkey % 5 <> 0 AS ok FROM supplier),
o AS (SELECT o_orderkey, o_custkey, c.ok FROM orders JOIN c ON o_custkey = c_custkey),
l AS (SELECT * FROM lineitem QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {', '.join(f'{c} DESC' for c in LINE_ORDER)}) = 1),
lo AS (SELECT l.*, o.ok AND s.ok AND p_partkey IS NOT NULL AS ok FROM l JOIN o ON l_orderkey = o_orderkey JOIN s ON l_suppkey = s_suppkey
  LEFT JOIN part_subset ON l_partkey = p_partkey),
m AS (
SELECT 'nation' AS "table", COUNT(*) AS read_rows, COUNT(*) AS valid_rows, CAST(0 AS BIGINT) AS rejected_rows,
  CAST(0 AS BIGINT) AS deduplicated, COUNT(*) AS inserted FROM nation WHERE n_nationkey % 5 <> 0
UNION ALL SELECT 'part', COUNT(*), COUNT(*), 0, 0, COUNT(*) FROM part_subset
UNION ALL SELECT 'customer', COUNT(*), COUNT(*), COUNT(*) FILTER (WHERE NOT ok), 0, COUNT(*) FILTER (WHERE ok) FROM c
UNION ALL SELECT 'supplier', COUNT(*), COUNT(*), COUNT(*) FILTER (WHERE NOT ok), 0, COUNT(*) FILTER (WHERE ok) FROM s
UNION ALL SELECT 'orders', COUNT(*), COUNT(*), COUNT(*) FILTER (WHERE NOT ok), 0, COUNT(*) FILTER (WHERE ok) FROM o
UNION ALL SELECT 'lineitem', (SELECT COUNT(*) FROM lineitem), COUNT(*), COUNT(*) FILTER (WHERE NOT ok),
  (SELECT COUNT(*) FROM lineitem) - COUNT(*), COUNT(*) FILTER (WHERE ok) FROM lo)"""
)


@query("load_all_metrics", STAR_SQL + " SELECT * FROM m")
def _load_all(spark, d):
    return star_run(spark, d).metrics().drop("updated", "unchanged")


@query(
    "load_all_totals",
    STAR_SQL
    + """ SELECT SUM(read_rows)::BIGINT AS total_read_rows, SUM(valid_rows)::BIGINT AS total_valid_rows,
    SUM(rejected_rows)::BIGINT AS total_rejected_rows, SUM(inserted)::BIGINT AS total_inserted,
    CAST(0 AS BIGINT) AS total_updated, 'PARTIAL SUCCESS' AS status FROM m""",
)
def _load_all_totals(spark, d):
    return run_totals(star_run(spark, d).metrics())


@query("load_all_lineitem", STAR_SQL + " SELECT * EXCLUDE (ok) REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate, CAST(l_linenumber AS BIGINT) AS l_linenumber) FROM lo WHERE ok")
def _load_all_lineitem(spark, d):
    """The line items that are left once each of their three parents is checked."""
    return star_run(spark, d).snapshots()["lineitem"]


def circular_specs() -> list[TableSpec]:
    """The same tables, children first, and nations that refer to their customers' table in a circle."""
    specs = {s.name: s for s in reversed(star_specs())}
    back = ForeignKey("n_nationkey", "customer", "c_nationkey")
    specs["nation"] = replace(specs["nation"], foreign_keys=[back])
    return list(specs.values())


@query("load_all_any_order", STAR_SQL + " SELECT * FROM m")
def _any_order(spark, d):
    """Descriptions in reverse and with a circle: the same run, as every nation has customers."""
    return star_run(spark, d, circular_specs()).metrics().drop("updated", "unchanged")


def _missing_sql(child: str, column: str, parent: str, key: str, rows: str, keys: str) -> str:
    return f"""SELECT '{child}' AS "table", '{column}' AS "column", '{parent}' AS parent,
    (SELECT COUNT(*) FROM (SELECT {column} FROM {rows} EXCEPT SELECT {key} FROM {keys})) AS total_missing, (SELECT COUNT(DISTINCT {key}) FROM {keys}) AS existing_count,
    (SELECT COUNT(DISTINCT {column}) FROM {rows}) AS referenced_count, (SELECT COUNT(*) FROM (SELECT {column} FROM {rows} INTERSECT SELECT {key} FROM {keys})) AS loaded_count"""


STAR_REFERENCES = [
    ("customer", "c_nationkey", "nation", "n_nationkey", "c", "(SELECT * FROM nation WHERE n_nationkey % 5 <> 0)"),
    ("supplier", "s_nationkey", "nation", "n_nationkey", "s", "(SELECT * FROM nation WHERE n_nationkey % 5 <> 0)"),
    ("orders", "o_custkey", "customer", "c_custkey", "o", "(SELECT * FROM c WHERE ok)"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey", "l", "(SELECT * FROM o WHERE ok)"),
    ("lineitem", "l_partkey", "part", "p_partkey", "l", "part_subset"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey", "l", "(SELECT * FROM s WHERE ok)"),
]


@query("load_all_missing", STAR_SQL + " " + " UNION ALL ".join(_missing_sql(*r) for r in STAR_REFERENCES))
def _load_all_missing(spark, d):
    """Per reference of a run: how many of the values it refers to exist after it."""
    return star_run(spark, d).missing_summary()


@query(
    "load_all_missing_keys",
    STAR_SQL
    + " "
    + " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", '{p}' AS parent, CAST({c} AS VARCHAR) AS value FROM (SELECT {c} FROM {rows} EXCEPT SELECT {k} FROM {keys})"""
        for t, c, p, k, rows, keys in STAR_REFERENCES
    ),
)
def _load_all_missing_keys(spark, d):
    return star_run(spark, d).missing_keys()


@query(
    "load_all_verified",
    STAR_SQL
    + """, grown AS (SELECT "table", CAST(0 AS BIGINT) AS rows_before, inserted AS rows_after, inserted AS rows_processed, inserted AS rows_added FROM m)
    SELECT *, CASE WHEN rows_added = 0 AND rows_processed > 0 THEN 'no rows were added' WHEN rows_added < rows_processed THEN 'fewer rows added than processed' END AS warning FROM grown""",
)
def _load_all_verified(spark, d):
    """Row counts before and after every load of a run, as its own writes counted them."""
    return star_run(spark, d, mode="incremental").verification(spark)


#: A chain of every order to the one before it, broken where an order's key is a multiple of a thousand.
CHAIN = TableSpec(
    "chain", ["id"], {"id": "int", "before": "int"}, foreign_keys=[ForeignKey("before", "chain", "id")]
)
CHAIN_SQL = """WITH RECURSIVE n AS (SELECT ROW_NUMBER() OVER (ORDER BY o_orderkey) AS id FROM orders),
r AS (SELECT id, CASE WHEN id = 1 THEN NULL WHEN id % 997 = 0 THEN -id ELSE id - 1 END AS before FROM n),
good AS (SELECT id FROM r WHERE id < 997)
SELECT id, before FROM r WHERE id IN (SELECT id FROM good)"""


@query("fk_self_chain", CHAIN_SQL)
def _self_chain(spark, d):
    """Rows that refer to the row before them: all that follow a broken link go, in a few rounds for any length of the chain."""
    order = number_rows(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 1, "id")
    before = F.when(F.col("id") == 1, F.lit(None)).when(F.col("id") % 997 == 0, -F.col("id")).otherwise(F.col("id") - 1)
    batch = order.select(F.col("id").cast("string").alias("id"), before.cast("string").alias("before"))
    empty = spark.createDataFrame([], CHAIN.storage_schema())
    return load_table(batch, CHAIN, empty, {"chain": empty}).snapshot


FLOW = TableSpec(
    name="orders_flow",
    pk=["order_id"],
    types={"order_id": "int", "cust_id": "int", "price": "float", "status": "str"},
)


def flow_table(spark, d, label):
    """A change table holding the upsert target."""
    path = scratch_path(spark, label)
    write_changes(table(spark, d, "upsert_target"), path, "start", FLOW.pk)
    return path


def arriving(spark, d, label):
    """The upsert batch as text files in an input folder."""
    folder = scratch_path(spark, label)
    rows = table(spark, d, "upsert_incoming")
    text = rows.select([F.col(c).cast("string").alias(c) for c in rows.columns])
    text.repartitionByRange(2, "order_id").write.option("parquet.block.size", ROW_GROUP).parquet(folder)
    return folder, text.schema


UPSERTED_SQL = (
    with_fixtures("upsert_target", "upsert_incoming")
    + """ SELECT * FROM upsert_incoming UNION ALL
    SELECT * FROM upsert_target WHERE order_id NOT IN (SELECT order_id FROM upsert_incoming)"""
)


@query("stream_load", UPSERTED_SQL)
def _stream_load(spark, d):
    path = flow_table(spark, d, "flow")
    folder, schema = arriving(spark, d, "flow-in")
    stream = stream_files(spark, folder, schema)
    stream_load(stream, path, FLOW, scratch_path(spark, "flow-state")).awaitTermination()
    return current_rows(spark, path, FLOW.pk)


@query("stream_two_checkpoints", UPSERTED_SQL)
def _stream_two(spark, d):
    """Two streams with checkpoints of their own into one table: nothing of either is passed over."""
    path = flow_table(spark, d, "two")
    rows = table(spark, d, "upsert_incoming")
    text = rows.select([F.col(c).cast("string").alias(c) for c in rows.columns])
    for half in (0, 1):
        folder = scratch_path(spark, f"two-in-{half}")
        text.where(F.col("order_id").cast("bigint") % 2 == half).repartition(1).write.option("parquet.block.size", ROW_GROUP).parquet(folder)
        stream = stream_files(spark, folder, text.schema)
        stream_load(stream, path, FLOW, scratch_path(spark, f"two-state-{half}")).awaitTermination()
    return current_rows(spark, path, FLOW.pk)


@query(
    "stream_replay",
    with_fixtures("upsert_incoming")
    + " SELECT 'unchanged' AS status, COUNT(*) AS n FROM upsert_incoming",
)
def _stream_replay(spark, d):
    """All files a second time through a fresh checkpoint: every row is loaded again and none changes."""
    path = flow_table(spark, d, "replay")
    folder, schema = arriving(spark, d, "replay-in")
    for attempt in ("first", "again"):
        stream = stream_files(spark, folder, schema)
        stream_load(stream, path, FLOW, scratch_path(spark, f"replay-{attempt}")).awaitTermination()
    rows = spark.read.schema(schema).parquet(folder)
    counts = upsert_batch(rows, "redelivered", path, FLOW)
    return spark.createDataFrame(list(counts.items()), "status string, n bigint")


#: Batches of the stream of many small files.
MANY = 5


@query("stream_many_batches", UPSERTED_SQL)
def _stream_many(spark, d):
    """The upsert batch in many files, one per micro-batch: each reads only the buckets of its keys."""
    path = flow_table(spark, d, "many")
    rows = table(spark, d, "upsert_incoming")
    text = rows.select([F.col(c).cast("string").alias(c) for c in rows.columns])
    folder = scratch_path(spark, "many-in")
    text.repartitionByRange(MANY, F.col("order_id").cast("bigint")).write.option("parquet.block.size", ROW_GROUP).parquet(folder)
    stream = stream_files(spark, folder, text.schema)
    stream_load(stream, path, FLOW, scratch_path(spark, "many-state")).awaitTermination()
    return current_rows(spark, path, FLOW.pk)
