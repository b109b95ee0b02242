"""Referential integrity, lookups, key comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowharbor.catalog import query
from rowharbor.catalog.fixtures import table, with_fixtures
from rowharbor.operators import keysets as K
from rowharbor.operators import lookups as L
from rowharbor.operators import references as R
from rowharbor.spec import ForeignKey

CUSTOMER_FK = ForeignKey("o_custkey", "customer", "c_custkey")
LINE_FKS = [
    ForeignKey("l_orderkey", "orders", "o_orderkey"),
    ForeignKey("l_partkey", "part", "p_partkey"),
    ForeignKey("l_suppkey", "supplier", "s_suppkey"),
]


@query(
    "fk_split_valid",
    with_fixtures("customer_subset")
    + " SELECT o.* FROM orders o WHERE o_custkey IN (SELECT c_custkey FROM customer_subset)",
)
def _fk_valid(spark, d):
    return R.fk_split(table(spark, d, "orders"), CUSTOMER_FK, table(spark, d, "customer_subset"))[0]


@query(
    "fk_split_rejected",
    with_fixtures("customer_subset")
    + """ SELECT o.*, 'Foreign key violation: o_custkey=' || CAST(o_custkey AS VARCHAR)
      || ' not found in customer.c_custkey' AS rejection_reason
    FROM orders o WHERE o_custkey NOT IN (SELECT c_custkey FROM customer_subset)""",
)
def _fk_rejected(spark, d):
    return R.fk_split(table(spark, d, "orders"), CUSTOMER_FK, table(spark, d, "customer_subset"))[1]


def line_parents(spark, d):
    return {
        "orders": table(spark, d, "orders").where("o_orderkey % 13 <> 0"),
        "part": table(spark, d, "part_subset"),
        "supplier": table(spark, d, "supplier_subset"),
    }


MANY = with_fixtures("part_subset", "supplier_subset") + """, flagged AS (
  SELECT l.*, CASE WHEN l_orderkey % 13 = 0 THEN 'Foreign key violation: l_orderkey=' || CAST(l_orderkey AS VARCHAR) || ' not found in orders.o_orderkey' END AS r1,
    CASE WHEN p.p_partkey IS NULL THEN 'Foreign key violation: l_partkey=' || CAST(l_partkey AS VARCHAR) || ' not found in part.p_partkey' END AS r2,
    CASE WHEN s.s_suppkey IS NULL THEN 'Foreign key violation: l_suppkey=' || CAST(l_suppkey AS VARCHAR) || ' not found in supplier.s_suppkey' END AS r3
  FROM lineitem l LEFT JOIN part_subset p ON l_partkey = p_partkey LEFT JOIN supplier_subset s ON l_suppkey = s_suppkey)
"""


@query(
    "fk_split_many_rejected",
    MANY
    + """ SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, COALESCE(r1, r2, r3) AS rejection_reason
    FROM flagged WHERE COALESCE(r1, r2, r3) IS NOT NULL""",
)
def _fk_many(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return R.fk_split_many(lines, LINE_FKS, line_parents(spark, d))[1]


@query(
    "fk_split_many_valid",
    MANY + " SELECT * EXCLUDE (r1, r2, r3) FROM flagged WHERE COALESCE(r1, r2, r3) IS NULL",
)
def _fk_many_valid(spark, d):
    return R.fk_split_many(table(spark, d, "lineitem"), LINE_FKS, line_parents(spark, d))[0]


@query(
    "fk_all_reasons",
    MANY
    + """ SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, COALESCE(r1, r2, r3) AS rejection_reason,
    [x FOR x IN [r1, r2, r3] IF x IS NOT NULL] AS all_reasons FROM flagged""",
)
def _fk_all(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return R.fk_flags(lines, LINE_FKS, line_parents(spark, d), all_reasons=True)


@query(
    "fk_orphan_pairs",
    MANY
    + """ SELECT 'l_orderkey' AS "column", CAST(l_orderkey AS VARCHAR) AS value FROM flagged WHERE r1 IS NOT NULL
    UNION SELECT 'l_partkey', CAST(l_partkey AS VARCHAR) FROM flagged WHERE r2 IS NOT NULL
    UNION SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR) FROM flagged WHERE r3 IS NOT NULL""",
)
def _fk_orphan_pairs(spark, d):
    """The missing values of three keys, from one scan of the line items."""
    names = F.array(*[F.lit(fk.column) for fk in LINE_FKS])
    return R.orphan_pairs(table(spark, d, "lineitem"), LINE_FKS, line_parents(spark, d)).select(F.get(names, "ref").alias("column"), "value")


@query(
    "fk_empty_parent",
    """SELECT o_orderkey, o_custkey, 'Foreign key violation: o_custkey=' || CAST(o_custkey AS VARCHAR)
    || ' not found in customer.c_custkey (reference table is empty)' AS rejection_reason FROM orders""",
)
def _fk_empty(spark, d):
    nobody = table(spark, d, "customer").where("c_custkey < 0")
    return R.fk_split(table(spark, d, "orders").select("o_orderkey", "o_custkey"), CUSTOMER_FK, nobody)[1]


@query(
    "fk_text_keys",
    with_fixtures("raw_orders", "customer_subset")
    + """ SELECT row_seq, cust_text, 'Foreign key violation: cust_text=' || cust_text || ' not found in customer.c_custkey' AS rejection_reason
    FROM raw_orders WHERE cust_text NOT IN ('', 'nan', 'None')
      AND cust_text NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer_subset)
      AND NOT COALESCE(CASE WHEN cust_text <> 'NaN' THEN TRY_CAST(TRIM(cust_text) AS DOUBLE) END
        IN (SELECT CAST(c_custkey AS DOUBLE) FROM customer_subset), FALSE)""",
)
def _fk_text(spark, d):
    fk = ForeignKey("cust_text", "customer", "c_custkey")
    raw = table(spark, d, "raw_orders").select("row_seq", "cust_text")
    return R.fk_split(raw, fk, table(spark, d, "customer_subset"))[1]


@query("fk_policy_skip", "SELECT o_orderkey, o_custkey FROM orders")
def _fk_skip(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return R.fk_split_many(rows, [CUSTOMER_FK], {"customer": table(spark, d, "customer_subset")}, policy="skip")[0]


@query(
    "fk_all_or_nothing",
    """SELECT 'orphans' AS parent, FALSE AS accepted, COUNT(*) AS n FROM orders
    UNION ALL SELECT 'complete', TRUE, COUNT(*) FROM orders""",
)
def _all_or_nothing(spark, d):
    orders = table(spark, d, "orders")
    parts = []
    for label, parent in (("orphans", "customer_subset"), ("complete", "customer")):
        judged = R.fk_all_or_nothing(orders, [CUSTOMER_FK], {"customer": table(spark, d, parent)})
        parts.append(judged.groupBy(F.lit(label).alias("parent"), "accepted").agg(F.count(F.lit(1)).alias("n")))
    return parts[0].unionByName(parts[1])


CASCADE_FKS = {
    "customer": [ForeignKey("c_nationkey", "nation", "n_nationkey")],
    "orders": [CUSTOMER_FK],
    "lineitem": [LINE_FKS[0]],
}


@query(
    "fk_cascade",
    """WITH c AS (SELECT *, c_nationkey % 5 <> 0 AS ok FROM customer),
    o AS (SELECT orders.*, c.ok FROM orders JOIN c ON o_custkey = c_custkey),
    l AS (SELECT o.ok FROM lineitem JOIN o ON l_orderkey = o_orderkey)
    SELECT 'customer' AS "table", COUNT(*) FILTER (WHERE ok) AS n_valid, COUNT(*) FILTER (WHERE NOT ok) AS n_rejected FROM c
    UNION ALL SELECT 'orders', COUNT(*) FILTER (WHERE ok), COUNT(*) FILTER (WHERE NOT ok) FROM o
    UNION ALL SELECT 'lineitem', COUNT(*) FILTER (WHERE ok), COUNT(*) FILTER (WHERE NOT ok) FROM l""",
)
def _cascade(spark, d):
    tables = [("nation", table(spark, d, "nation_subset"))] + [
        (n, table(spark, d, n)) for n in ("customer", "orders", "lineitem")
    ]
    out = None
    for name, (valid, rejected) in R.fk_cascade(tables, CASCADE_FKS).items():
        if name == "nation":
            continue
        both = valid.select(F.lit(True).alias("ok")).unionAll(rejected.select(F.lit(False).alias("ok")))
        one = both.agg(F.count_if("ok").alias("n_valid"), F.count_if(~F.col("ok")).alias("n_rejected")).select(
            F.lit(name).alias("table"), "n_valid", "n_rejected"
        )
        out = one if out is None else out.unionByName(one)
    return out


NATION_TEXT = """CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 9 = 1 THEN 'ATLANTIS'
  WHEN c_custkey % 2 = 0 THEN ' ' || n_name || ' ' ELSE CAST(c_nationkey AS STRING) END"""


def customer_nation_text(spark, d):
    """Customers whose nation is a name, a key as text, unknown or blank."""
    named = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select("c_custkey", F.expr(NATION_TEXT).alias("nation"))


def doubled_nation(spark, d):
    """Nations with an older, wrong entry for every name; the later entry wins."""
    nation = table(spark, d, "nation")
    old = nation.select("n_name", (F.col("n_nationkey") + 100).alias("n_nationkey"), F.lit(1).alias("ord"))
    return old.unionByName(nation.select("n_name", "n_nationkey", F.lit(2).alias("ord")))


NATION_SQL = f"""WITH t AS (SELECT c_custkey, {NATION_TEXT} AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def looked_up(spark, d):
    return L.lookup_id(
        customer_nation_text(spark, d), "nation", doubled_nation(spark, d), "n_name", "n_nationkey", "ord"
    )


@query(
    "lookup_id",
    NATION_SQL
    + """ SELECT c_custkey, COALESCE(TRY_CAST(TRIM(nation) AS BIGINT), n_nationkey) AS nation,
    CASE WHEN TRY_CAST(TRIM(nation) AS BIGINT) IS NOT NULL THEN 'id' WHEN n_nationkey IS NOT NULL THEN 'mapped'
      WHEN nation = '' THEN 'missing' ELSE 'unmapped' END AS lookup_status
    FROM t LEFT JOIN nation ON TRIM(t.nation) = n_name""",
)
def _lookup_id(spark, d):
    return looked_up(spark, d).drop("lookup_text")


@query(
    "lookup_id_keep",
    NATION_SQL
    + """ SELECT c_custkey, CASE WHEN nation <> '' THEN COALESCE(CAST(n_nationkey AS VARCHAR), TRIM(nation)) END AS nation
    FROM t LEFT JOIN nation ON TRIM(t.nation) = n_name""",
)
def _lookup_keep(spark, d):
    return L.lookup_id_keep(
        customer_nation_text(spark, d), "nation", doubled_nation(spark, d), "n_name", "n_nationkey", "ord"
    )


@query(
    "lookup_coverage",
    NATION_SQL
    + """ SELECT COUNT(*) FILTER (WHERE n_nationkey IS NOT NULL) AS mapped, COUNT(*) FILTER (WHERE nation = 'ATLANTIS') AS unmapped,
    COUNT(DISTINCT CASE WHEN nation = 'ATLANTIS' THEN nation END) AS distinct_unmapped
    FROM t LEFT JOIN nation ON TRIM(t.nation) = n_name""",
)
def _coverage(spark, d):
    return L.lookup_coverage(looked_up(spark, d))


@query(
    "unmapped_values",
    NATION_SQL + " SELECT nation AS value, COUNT(*) AS n_rows FROM t WHERE nation = 'ATLANTIS' GROUP BY nation",
)
def _unmapped(spark, d):
    return L.unmapped_values(looked_up(spark, d))


@query(
    "match_names",
    with_fixtures("available_names", "requested_names")
    + """, r AS (SELECT DISTINCT req FROM requested_names), pairs AS (
      SELECT req, name, ord, CASE WHEN req = name THEN 1
        WHEN TRIM(LOWER(req)) = TRIM(LOWER(name)) THEN 2
        WHEN TRIM(REPLACE(REPLACE(TRIM(LOWER(req)), '_', ' '), '-', ' ')) = TRIM(REPLACE(REPLACE(TRIM(LOWER(name)), '_', ' '), '-', ' ')) THEN 3
        WHEN LENGTH(req) > 31 AND LOWER(SUBSTR(req, 1, 31)) = LOWER(name) THEN 5
        WHEN LENGTH(req) > 31 AND LENGTH(name) <= 31 AND STARTS_WITH(LOWER(name), SUBSTR(TRIM(LOWER(req)), 1, 25)) THEN 6
      END AS tier FROM r CROSS JOIN available_names)
    SELECT req AS requested_name, name AS matched_name, tier FROM pairs WHERE tier IS NOT NULL
    QUALIFY ROW_NUMBER() OVER (PARTITION BY req ORDER BY tier, ord) = 1""",
)
def _match_names(spark, d):
    return L.match_names(
        table(spark, d, "requested_names"), "req", table(spark, d, "available_names"), "name", "ord"
    )


@query(
    "close_matches",
    with_fixtures("fragments", "part_names")
    + """, r AS (SELECT DISTINCT fragment, TRIM(LOWER(fragment)) AS low FROM fragments),
    pairs AS (SELECT fragment, name, ROW_NUMBER() OVER (PARTITION BY fragment ORDER BY ord, name) AS position
      FROM r CROSS JOIN part_names WHERE CONTAINS(LOWER(name), low) OR CONTAINS(low, LOWER(name)))
    SELECT fragment AS requested_name, CAST(position AS INTEGER) AS position, name AS close_match FROM pairs WHERE position <= 5""",
)
def _close_matches(spark, d):
    return L.close_matches(table(spark, d, "fragments"), "fragment", table(spark, d, "part_names"), "name", "ord")


@query(
    "reconcile_keys",
    with_fixtures("customer_subset")
    + """ SELECT COALESCE(c_custkey, o_custkey) AS key, c_custkey IS NOT NULL AS in_left, o_custkey IS NOT NULL AS in_right
    FROM customer_subset FULL OUTER JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey""",
)
def _reconcile(spark, d):
    return K.reconcile_keys(
        table(spark, d, "customer_subset"), "c_custkey", table(spark, d, "orders"), "o_custkey"
    )


@query(
    "missing_keys",
    with_fixtures("part_subset") + " SELECT l_partkey AS key FROM lineitem EXCEPT SELECT p_partkey FROM part_subset",
)
def _missing(spark, d):
    return K.missing_keys(table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part_subset"), "p_partkey")


@query(
    "loaded_keys",
    with_fixtures("part_subset") + " SELECT l_partkey AS key FROM lineitem INTERSECT SELECT p_partkey FROM part_subset",
)
def _loaded(spark, d):
    return K.loaded_keys(table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part_subset"), "p_partkey")


@query(
    "missing_summary",
    with_fixtures("part_subset")
    + """, m AS (SELECT l_partkey AS key FROM lineitem EXCEPT SELECT p_partkey FROM part_subset),
    b AS (SELECT l_partkey AS key FROM lineitem INTERSECT SELECT p_partkey FROM part_subset)
    SELECT (SELECT COUNT(*) FROM m) AS total_missing, (SELECT COUNT(DISTINCT p_partkey) FROM part_subset) AS existing_count,
    (SELECT COUNT(DISTINCT l_partkey) FROM lineitem) AS referenced_count, (SELECT COUNT(*) FROM b) AS loaded_count""",
)
def _missing_summary(spark, d):
    return K.missing_summary(table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part_subset"), "p_partkey")


@query(
    "missing_topk",
    with_fixtures("part_subset")
    + """, m AS (SELECT l_partkey AS key FROM lineitem EXCEPT SELECT p_partkey FROM part_subset)
    SELECT key, GREATEST((SELECT COUNT(*) FROM m) - 100, 0) AS n_more FROM m ORDER BY key LIMIT 100""",
)
def _missing_topk(spark, d):
    return K.missing_topk(table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part_subset"), "p_partkey")


@query("reference_keys", "SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL")
def _reference_keys(spark, d):
    return R.reference_keys(table(spark, d, "lineitem"), "l_suppkey")


@query(
    "delete_cascade",
    """WITH o AS (SELECT o_orderkey, o_custkey % 7 = 0 AS gone FROM orders)
    SELECT 'orders' AS "table", COUNT(*) AS n_left, SUM(o_orderkey)::BIGINT AS key_sum FROM o WHERE NOT gone
    UNION ALL SELECT 'lineitem', COUNT(*), SUM(l_orderkey)::BIGINT FROM lineitem JOIN o ON l_orderkey = o_orderkey
    WHERE NOT gone""",
)
def _delete_cascade(spark, d):
    removed = table(spark, d, "customer").where("c_custkey % 7 = 0").select("c_custkey")
    left = R.delete_cascade(
        removed,
        [
            ("orders", table(spark, d, "orders"), "o_custkey", "o_orderkey"),
            ("lineitem", table(spark, d, "lineitem"), "l_orderkey", "l_orderkey"),
        ],
    )
    out = None
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        one = left[name].agg(F.count(F.lit(1)).alias("n_left"), F.sum(key).alias("key_sum")).select(
            F.lit(name).alias("table"), "n_left", "key_sum"
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "restrict_check",
    """WITH parent AS (SELECT * FROM nation UNION ALL SELECT n_nationkey + 100, n_name, n_regionkey FROM nation)
    SELECT * FROM parent WHERE n_nationkey IN (SELECT c_nationkey FROM customer) OR n_nationkey IN (SELECT s_nationkey FROM supplier)""",
)
def _restrict(spark, d):
    nations = table(spark, d, "nation")
    return R.restrict_check(
        # Every nation is in use, so as many unused ones stand beside them.
        nations.unionByName(nations.withColumn("n_nationkey", (F.col("n_nationkey") + 100).cast("int"))),
        "n_nationkey",
        [(table(spark, d, "customer"), "c_nationkey"), (table(spark, d, "supplier"), "s_nationkey")],
    )
