"""Loads and checks where operators meet: row order, uniqueness, repeated parents, replaced tables, run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowharbor.catalog import query
from rowharbor.catalog.fixtures import table, with_fixtures
from rowharbor.operators import metrics as M
from rowharbor.operators.keys import generate_keys
from rowharbor.operators.lookups import lookup_id
from rowharbor.operators.references import fk_split
from rowharbor.plans.load import load_all, load_table
from rowharbor.session import scratch_path
from rowharbor.spec import ForeignKey, TableSpec


def nothing(spark, spec):
    return spark.createDataFrame([], spec.storage_schema())


MIXED_KEYS = """SELECT o_orderkey AS row_seq, CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN 'PM-' || CAST(o_orderkey AS STRING)
  WHEN o_orderkey % 5 = 2 THEN CAST(o_orderkey AS STRING) || '.0' WHEN o_orderkey % 5 = 3 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS id FROM {orders}"""


@query(
    "generate_text_keys",
    f"""WITH k AS ({MIXED_KEYS.format(orders="orders")}), n AS (SELECT *, COALESCE(id, '') = '' AS missing FROM k),
    m AS (SELECT MAX(row_seq) AS top FROM n WHERE row_seq % 5 IN (2, 4))
    SELECT row_seq, CASE WHEN missing THEN CAST((SELECT top FROM m) + ROW_NUMBER() OVER (PARTITION BY missing ORDER BY row_seq) AS VARCHAR)
      ELSE id END AS id FROM n""",
)
def _text_keys(spark, d):
    return generate_keys(spark.sql(MIXED_KEYS, orders=table(spark, d, "orders")), "id", seq="row_seq")


PLAIN = TableSpec("plain", ["k"], {"k": "int", "v": "str"}, lengths={"v": 1})


@query(
    "load_two_files",
    "SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'b' ELSE 'a' END AS v FROM customer",
)
def _two_files(spark, d):
    """A small file first, a large one last: of a key that both hold, the row of the later file stays."""
    folder = scratch_path(spark, "files")
    customers = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("k"))
    customers.where(F.col("k").cast("bigint") % 2 == 0).withColumn("v", F.lit("a")).coalesce(1).write.parquet(f"{folder}/a_01")
    large = customers.withColumn("v", F.when(F.col("k").cast("bigint") % 2 == 0, "b").otherwise("a"))
    large.withColumn("filler", F.repeat("k", F.lit(40))).coalesce(1).write.parquet(f"{folder}/b_02")
    batch = spark.read.schema("k string, v string").option("recursiveFileLookup", "true").parquet(folder)
    return load_table(batch, PLAIN, nothing(spark, PLAIN)).snapshot


@query("load_timestamp_order", "SELECT o_orderkey AS k, 'b' AS v FROM orders")
def _timestamps(spark, d):
    """Two rows per key within one second, the later one first in the table."""
    orders = table(spark, d, "orders")
    rows = orders.select(F.col("o_orderkey").cast("string").alias("k"), F.expr("o_orderdate + INTERVAL '0.9' SECOND").alias("at"), F.lit("b").alias("v"))
    rows = rows.unionByName(rows.withColumns({"at": F.expr("at - INTERVAL '0.8' SECOND"), "v": F.lit("a")}))
    return load_table(rows, PLAIN, nothing(spark, PLAIN), seq="at").snapshot


@query("load_constraint_after_dedupe", "SELECT o_orderkey AS k, 'b' AS v FROM orders WHERE o_orderkey % 3 <> 0")
def _constraint_last(spark, d):
    """The newer row of every third key is too long: it is rejected, and the older one does not take its place."""
    keys = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("k"))
    newer = F.when(F.col("k").cast("bigint") % 3 == 0, "too long").otherwise("b")
    rows = keys.select("k", F.lit(1).alias("n"), F.lit("a").alias("v")).unionByName(keys.select("k", F.lit(2).alias("n"), newer.alias("v")))
    return load_table(rows, PLAIN, nothing(spark, PLAIN), seq="n").snapshot


RATED = TableSpec("rated", ["c_custkey"], {"c_custkey": "int", "c_name": "str", "grade": "str"}, not_null=["grade"], defaults={"grade": "new"})


@query("load_table_initial_defaults", "SELECT c_custkey, c_name, 'new' AS grade FROM customer")
def _initial_defaults(spark, d):
    batch = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name")
    return load_table(batch, RATED, nothing(spark, RATED), mode="initial").snapshot


NAMED = TableSpec("named", ["k"], {"k": "int", "name": "str"}, uniques=[["name"]])


@query(
    "load_unique_rejects",
    """SELECT 1000000 + c_custkey AS k, 'constraint' AS reject_stage, 'Duplicate value for unique key (name)' AS rejection_reason
    FROM customer WHERE c_custkey % 4 IN (0, 1)""",
)
def _unique_rejects(spark, d):
    """A quarter of the names is stored under other keys, a quarter stands twice in the batch or is stored too."""
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    kept = customers.where("k % 4 IN (0, 1)")
    batch = customers.select((F.col("k") + 1000000).cast("string").alias("k"), "name")
    batch = batch.unionByName(kept.where("k % 4 = 1").select(F.col("k").cast("string").alias("k"), F.concat("name", F.lit(" the first")).alias("name")))
    stored = kept.unionByName(kept.where("k % 4 = 1").select((F.col("k") + 2000000).alias("k"), "name"))
    out = load_table(batch, NAMED, stored).rejected
    return out.select(F.col("k").cast("bigint").alias("k"), "reject_stage", "rejection_reason")


@query("load_range_rejects", "SELECT CAST(o_orderkey AS VARCHAR) AS k, 'Value out of range in v(int)' AS rejection_reason FROM orders WHERE o_orderkey % 2 = 0")
def _range(spark, d):
    """Numbers too large for the stored column reject their rows, not the load."""
    spec = TableSpec("wide", ["k"], {"k": "int", "v": "int"})
    batch = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("k"), F.when(F.col("o_orderkey") % 2 == 0, "9999999999").otherwise("7").alias("v")
    )
    out = load_table(batch, spec, spark.createDataFrame([], "k bigint, v int"))
    return out.rejected.select("k", "rejection_reason")


@query("fk_repeated_parent", with_fixtures("customer_subset") + " SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer_subset)")
def _repeated_parent(spark, d):
    parents = table(spark, d, "customer_subset")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return fk_split(orders, ForeignKey("o_custkey", "customer", "c_custkey"), parents.unionByName(parents))[0]


TREE = TableSpec("tree", ["k"], {"k": "int", "up": "int"}, foreign_keys=[ForeignKey("up", "tree", "k")])


@query(
    "fk_self_first_load",
    """WITH RECURSIVE t AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 97 = 5 THEN -1 WHEN p_partkey >= 2 THEN p_partkey // 2 END AS up FROM part),
    ok AS (SELECT k, up FROM t WHERE up IS NULL UNION ALL SELECT t.k, t.up FROM t JOIN ok ON t.up = ok.k)
    SELECT k, up FROM ok""",
)
def _self_load(spark, d):
    """Rows refer to rows of the same batch; an orphan takes those below it along."""
    key = F.col("p_partkey")
    up = F.when(key % 97 == 5, -1).when(key >= 2, F.floor(key / 2))
    batch = table(spark, d, "part").select(key.cast("string").alias("k"), up.cast("string").alias("up"))
    stored = nothing(spark, TREE)
    return load_table(batch, TREE, stored, {"tree": stored}).snapshot


@query(
    "lookup_id_numeric",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS code,
    CASE WHEN o_orderkey % 7 = 0 THEN 'unmapped' ELSE 'id' END AS lookup_status FROM orders""",
)
def _numeric_ids(spark, d):
    half = F.when(F.col("o_orderkey") % 7 == 0, 0.5).otherwise(0.0)
    orders = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey").cast("double") + half).alias("code"))
    out = lookup_id(orders, "code", table(spark, d, "customer"), "c_name", "c_custkey", "c_custkey")
    return out.select("o_orderkey", "code", "lookup_status")


PLACES = [
    TableSpec("region", ["r_regionkey"], {"r_regionkey": "int", "r_name": "str"}),
    TableSpec("nation", ["n_nationkey"], {"n_nationkey": "int", "n_name": "str", "n_regionkey": "int"}, foreign_keys=[ForeignKey("n_regionkey", "region", "r_regionkey")]),
    TableSpec("customer", ["c_custkey"], {"c_custkey": "int", "c_nationkey": "int"}, foreign_keys=[ForeignKey("c_nationkey", "nation", "n_nationkey")]),
]


def place_run(spark, d, **options):
    """Regions, nations without a fifth, customers; and a table that cannot be read."""
    source = {"region": "region", "nation": "nation_subset", "customer": "customer"}
    batches = {s.name: table(spark, d, source[s.name]).select([F.col(c).cast("string").alias(c) for c in s.types]) for s in PLACES}
    folder = scratch_path(spark, "unreadable")
    spark.createDataFrame([("not a parquet file",)], "value string").coalesce(1).write.text(folder)
    lost = TableSpec("lost", ["k"], {"k": "int"})
    batches["lost"] = spark.read.schema("k string").parquet(folder)
    return load_all(batches, [lost, *PLACES], {s.name: nothing(spark, s) for s in (lost, *PLACES)}, **options)


@query("load_all_initial_cascade", "SELECT 'region' AS name, COUNT(*) AS n FROM region UNION ALL SELECT 'nation', 0 UNION ALL SELECT 'customer', 0")
def _cascade(spark, d):
    """Only the regions are replaced; the tables that refer to them are emptied."""
    batches = {"region": table(spark, d, "region").select(F.col("r_regionkey").cast("string").alias("r_regionkey"), "r_name")}
    targets = {s.name: table(spark, d, s.name).select(*s.types) for s in PLACES}
    run = load_all(batches, PLACES, targets, mode="initial", only=["region"])
    out = None
    for name, df in run.snapshots().items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "load_all_records",
    """WITH c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE c_nationkey % 5 <> 0) AS good FROM customer)
    SELECT 'region' AS "table", COUNT(*) AS read_rows, COUNT(*) AS inserted, CAST(0 AS BIGINT) AS rejected_rows, '' AS notes FROM region
    UNION ALL SELECT 'nation', COUNT(*), COUNT(*), 0, '' FROM nation WHERE n_nationkey % 5 <> 0
    UNION ALL SELECT 'customer', n, good, n - good, (n - good) || ' rows rejected due to missing foreign key references' FROM c
    UNION ALL SELECT 'lost', 0, 0, 0, 'ERROR' """,
)
def _records(spark, d):
    """The records of a run in which one table cannot be read."""
    records = place_run(spark, d).records(spark)
    short = F.when(F.col("notes").startswith("ERROR"), "ERROR").otherwise(F.col("notes"))
    return records.select("table", "read_rows", "inserted", "rejected_rows", short.alias("notes"))


@query(
    "load_all_issues",
    """SELECT 'customer' AS "table", 'fk' AS reject_stage, 'Foreign key violation: c_nationkey=' || c_nationkey || ' not found in nation.n_nationkey' AS reason,
    COUNT(*) AS n FROM customer WHERE c_nationkey % 5 = 0 GROUP BY ALL""",
)
def _issues(spark, d):
    """All rejects of a run, counted by table, stage and reason."""
    rejects = place_run(spark, d).rejects()
    counted = rejects.groupBy("table", "reject_stage", F.col("rejection_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return counted


@query(
    "load_notes_of_many_values",
    """SELECT 'plain' AS "table", 'Value not allowed in v; ' || COUNT(*) || ' rows' AS notes FROM orders""",
)
def _many_values(spark, d):
    """Every row breaks the domain with a value of its own; the notes stay one line."""
    spec = TableSpec("plain", ["k"], {"k": "int", "v": "str"}, enums={"v": ["a"]})
    batch = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("k"), F.concat(F.lit("x"), F.col("o_orderkey").cast("string")).alias("v"))
    notes = load_table(batch, spec, nothing(spark, spec)).notes
    texts = notes.withColumn("reason", F.concat("reason", F.lit("; "), F.col("n").cast("string"), F.lit(" rows")))
    return M.notes(texts, "table", "seq", "reason")
