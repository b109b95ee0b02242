"""Keep-last, generated keys, upserts, whole loads, keyed tables and streams."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rowharbor.operators import keys as K
from rowharbor.operators import merge as U
from rowharbor.operators import metrics as M
from rowharbor.operators.clean import evolve_schema
from rowharbor.operators.validate import fill_defaults
from rowharbor.plans import load
from rowharbor.plans.load import error_records, load_all, load_table
from rowharbor.plans.order import load_order
from rowharbor import session
from rowharbor.operators import references
from rowharbor.session import cut_and_count, cut_lineage, scratch_path
from rowharbor.sources import changes
from rowharbor.sources.changes import current_rows, rewrite, write_changes
from rowharbor.sources.tables import read_rejects
from rowharbor.spec import ForeignKey, SpecError, TableSpec
from rowharbor.streaming import files
from rowharbor.streaming.files import stream_files, stream_load, upsert_batch


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_dedupe_last_drops_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 1, "d")], "k int, _row_seq long, v string")
    last = K.dedupe_last(df, ["k"])
    assert rows(last.select("k", "v")) == [(1, "b"), (2, "d")]
    plan = plan_of(last)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    with pytest.raises(SpecError):
        K.dedupe_last(df, ["gone"])


def test_generated_keys_restart_or_continue(spark):
    df = spark.createDataFrame([(0, None), (1, "1"), (2, "nan")], "_row_seq long, id string")
    faithful = K.generate_keys(df, "id", start="one")
    assert rows(faithful) == [(0, "1"), (1, "1"), (2, "2")]
    assert rows(K.generate_keys(df, "id")) == [(0, "2"), (1, "1"), (2, "3")]
    assert rows(K.generate_keys(df.where("id = '1'"), "id")) == [(1, "1")]
    with pytest.raises(SpecError):
        K.generate_keys(df, "id", start="two")


def test_numbering_is_gapless_over_many_partitions(spark):
    n = 20_000
    df = spark.range(0, n, 1, 16).select((F.pmod(F.col("id") * 7919, F.lit(n)) * 1000).alias("seq"))
    numbered = K.number_rows(df, "seq", 5, "num")
    bad = numbered.where(F.col("num") != F.col("seq") / 1000 + 5)
    assert bad.count() == 0 and numbered.count() == n
    assert "Window" not in plan_of(numbered)


def test_upsert_semantics(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, v double")
    batch = spark.createDataFrame([(2, None), (3, "c")], "k int, s string")
    assert rows(U.upsert(target, batch, ["k"])) == [(1, "a", 1.0), (2, None, 2.0), (3, "c", None)]
    assert rows(U.upsert(target, batch, ["k"], {"v": 9.5})) == [(1, "a", 1.0), (2, None, 2.0), (3, "c", 9.5)]
    wide = U.upsert(target, batch.withColumn("n", F.lit(1)), ["k"])
    assert wide.columns == ["k", "s", "v", "n"]
    assert rows(wide)[0] == (1, "a", 1.0, None)
    assert rows(U.upsert(target, batch.select("k"), ["k"]).select("k")) == [(1,), (2,), (3,)]


def test_upsert_against_brute_force_and_twice(spark):
    rng = random.Random(11)
    old = {k: rng.choice([None, 1, 2, 3]) for k in rng.sample(range(300), 200)}
    new = {k: rng.choice([None, 1, 2, 3]) for k in rng.sample(range(300), 150)}
    target = spark.createDataFrame(list(old.items()), "k int, v int")
    batch = spark.createDataFrame(list(new.items()), "k int, v int")
    merged = U.upsert(target, batch, ["k"])
    assert {r["k"]: r["v"] for r in merged.collect()} == {**old, **new}
    assert merged.count() == len(old.keys() | new.keys())
    counts = U.change_counts(target, batch, ["k"]).first()
    assert counts["inserted"] == len(new.keys() - old.keys())
    assert counts["unchanged"] == sum(old[k] == new[k] for k in new.keys() & old.keys())
    again = U.classify_changes(merged, batch, ["k"])
    assert {r["change"] for r in again.select("change").distinct().collect()} == {"unchanged"}


def test_small_batch_does_not_shuffle_the_target(spark):
    target = spark.range(0, 1_000_000, 1, 8).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    path = scratch_path(spark, "batch")
    spark.createDataFrame([(5, 2), (2_000_000, 3)], "k long, v int").write.parquet(path)
    merged = U.upsert(target, spark.read.parquet(path), ["k"]).where("v > 0")
    plan = plan_of(merged)
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert merged.count() == 1_000_001


def test_merge_statement_needs_a_row_level_catalog(spark):
    batch = spark.createDataFrame([(1, 2)], "k int, v int")
    batch.limit(0).write.mode("overwrite").parquet(scratch_path(spark, "plain"))
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        U.merge_into_catalog(batch, "no_such_table", ["k"])


def test_replace_keeps_the_target_when_nothing_is_left(spark):
    target = spark.createDataFrame([(1, "a")], "k int, s string")
    assert rows(U.replace(target, target.limit(0))) == [(1, "a")]
    assert rows(U.replace(target, spark.createDataFrame([(2,)], "k int"))) == [(2, None)]
    assert rows(U.replace(target, spark.createDataFrame([(2,)], "x int"))) == [(1, "a")]


def test_new_column_of_a_unit_batch(spark):
    units = spark.createDataFrame([(1, "kg")], "uom_id int, uom_name string")
    batch = spark.createDataFrame([(999, "Test Unit", "Test Value")], "uom_id int, uom_name string, new_col string")
    assert rows(evolve_schema(units, batch)) == [(1, "kg", None), (999, "Test Unit", "Test Value")]
    assert rows(U.upsert(units, batch, ["uom_id"])) == [(1, "kg", None), (999, "Test Unit", "Test Value")]


def test_defaults_only_fill_absent_columns(spark):
    df = spark.createDataFrame([(1, None)], "k int, s string")
    filled = fill_defaults(df, {"s": "x", "t": "y", "at": "now"}).first()
    assert (filled["s"], filled["t"]) == (None, "y") and filled["at"] is not None


SPEC = TableSpec(
    "item",
    ["id"],
    {"id": "int", "parent": "int", "price": "float", "tags": "dict", "since": "date"},
    renames={"ID": "id"},
    list_columns=["tags"],
    foreign_keys=[ForeignKey("parent", "group", "gid")],
)
BATCH = [
    ("1", "10", "1.5", "a,b", "2024-01-02", 0),
    ("1", "10", "2.5", "c", "31/12/2024", 1),
    ("", "10", "2.5", "c", "x", 2),
    ("2", "99", "3", "", "", 3),
    ("3", "", "bad", "", "", 4),
    ("4", "nan", "4", "", "9999-12-31", 5),
]
FIELDS = "ID string, parent string, price string, tags string, since string, n long"


def item_load(spark, target=None, **options):
    batch = spark.createDataFrame(BATCH, FIELDS)
    target = spark.createDataFrame([], SPEC.storage_schema()) if target is None else target
    parents = {"group": spark.createDataFrame([(10,)], "gid int")}
    return load_table(batch, options.pop("spec", SPEC), target, parents, seq="n", **options)


def test_load_conserves_rows(spark):
    out = item_load(spark)
    m = out.metrics().first()
    assert (m["read_rows"], m["rejected_rows"], m["deduplicated"], m["inserted"], m["valid_rows"]) == (6, 3, 1, 2, 3)
    assert m["read_rows"] == m["inserted"] + m["updated"] + m["unchanged"] + m["rejected_rows"] + m["deduplicated"]
    snapshot = {r["id"]: r for r in out.snapshot.collect()}
    assert sorted(snapshot) == [1, 4]
    assert snapshot[1]["price"] == 2.5 and snapshot[1]["tags"] == '["c"]' and str(snapshot[1]["since"]) == "2024-12-31"
    stages = sorted(r["reject_stage"] for r in out.rejected.collect()) + [r["reject_stage"] for r in out.fk_rejected.collect()]
    assert stages == ["pk", "type", "fk"]
    assert "Deduplicated 1 duplicate rows on keys ['id']" in [r["reason"] for r in out.notes.collect()]


def test_second_load_changes_nothing(spark):
    first = item_load(spark)
    second = item_load(spark, first.snapshot)
    m = second.metrics().first()
    assert (m["inserted"], m["updated"], m["unchanged"]) == (0, 0, 2)
    assert rows(second.snapshot, "id") == rows(first.snapshot, "id")


def test_modes(spark):
    target = item_load(spark).snapshot.withColumn("id", F.col("id") + 100)
    assert sorted(r["id"] for r in item_load(spark, target).snapshot.collect()) == [1, 4, 101, 104]
    assert sorted(r["id"] for r in item_load(spark, target, mode="initial").snapshot.collect()) == [1, 4]
    dry = item_load(spark, target, dry_run=True)
    assert sorted(r["id"] for r in dry.snapshot.collect()) == [101, 104]
    assert dry.metrics().first()["valid_rows"] == 3
    with pytest.raises(SpecError):
        item_load(spark, target, mode="other")


def test_skip_policy_is_all_or_nothing(spark):
    strict = TableSpec(**{**SPEC.__dict__, "fk_policy": "skip"})
    out = item_load(spark, spec=strict)
    assert out.snapshot.count() == 0
    assert out.metrics().first()["rejected_rows"] == 5


def test_constraints_and_decimals_in_a_load(spark):
    ruled = TableSpec(**{**SPEC.__dict__, "not_null": ["since"], "decimals": {"price": (4, 1)}})
    out = item_load(spark, spec=ruled)
    assert rows(out.snapshot.select("id", F.col("price").cast("string"))) == [(1, "2.5"), (4, "4.0")]
    assert {r["reject_stage"] for r in out.rejected.collect()} == {"pk", "type", "constraint"}


def test_generated_key_load(spark):
    spec = TableSpec("t", ["id"], {"id": "int", "v": "str"}, generated_key="id")
    batch = spark.createDataFrame([("", "a", 0), ("5", "b", 1), ("nan", "c", 2)], "id string, v string, n long")
    out = load_table(batch, spec, spark.createDataFrame([], spec.storage_schema()), seq="n")
    assert rows(out.snapshot) == [(5, "b"), (6, "a"), (7, "c")]


def test_columns_unknown_to_a_closed_target_are_dropped(spark):
    closed = TableSpec("t", ["id"], {"id": "int"}, evolve=False)
    batch = spark.createDataFrame([("1", "x")], "id string, extra string")
    target = spark.createDataFrame([], closed.storage_schema())
    assert load_table(batch, closed, target).snapshot.columns == ["id"]
    opened = TableSpec("t", ["id"], {"id": "int"})
    assert load_table(batch, opened, target).snapshot.columns == ["id", "extra"]


def test_spec_checks():
    with pytest.raises(SpecError, match="No primary key"):
        TableSpec("t", [], {"a": "int"})
    with pytest.raises(SpecError, match="without a type"):
        TableSpec("t", ["a"], {"A": "int"})
    with pytest.raises(SpecError, match="unknown types"):
        TableSpec("t", ["a"], {"a": "number"})


def test_failed_table_does_not_stop_the_run(spark):
    good = TableSpec("good", ["a"], {"a": "int"})
    absent = TableSpec("absent", ["a"], {"a": "int"})
    keyless = TableSpec("keyless", ["b"], {"a": "int", "b": "int"})
    batch = spark.createDataFrame([("1",)], "a string")
    empty = {s.name: spark.createDataFrame([], s.storage_schema()) for s in (good, absent, keyless)}
    run = load_all({"good": batch, "keyless": batch}, [absent, keyless, good], empty)
    assert sorted(run.errors) == ["absent", "keyless"] and sorted(run.results) == ["good"]
    assert run.metrics().first()["inserted"] == 1
    records = error_records(run, spark).collect()
    assert all(r["notes"].startswith("ERROR: ") and r["business_error"].startswith("Data Issue") for r in records)
    assert load_all({"good": batch}, [good, keyless], empty, only=["good"]).errors == {}


def test_run_of_one_category(spark):
    first = TableSpec("first", ["a"], {"a": "int"}, "masters")
    second = TableSpec("second", ["a"], {"a": "int"}, "core")
    batch = spark.createDataFrame([("1",)], "a string")
    empty = {s.name: spark.createDataFrame([], s.storage_schema()) for s in (first, second)}
    run = load_all({"first": batch, "second": batch}, [first, second], empty, category="core")
    assert list(run.results) == ["second"]
    with pytest.raises(SpecError, match="unknown category"):
        TableSpec("t", ["a"], {"a": "int"}, "other")


FLOW = TableSpec("flow", ["k"], {"k": "int", "v": "str"})


def stored(spark, label, data):
    path = scratch_path(spark, label)
    write_changes(spark.createDataFrame(data, "k long, v string"), path, "start")
    return path


def test_batches_touch_only_their_keys(spark):
    path = stored(spark, "kt", [(i, "a") for i in range(50)])
    batch = spark.createDataFrame([("7", "z", 0), ("8", "a", 0)], "k string, v string, n int")
    for _ in range(2):  # the second delivery leaves the same table
        assert upsert_batch(batch, "b1", path, FLOW, seq="n") == {"updated": 1, "unchanged": 1}
    assert spark.read.parquet(path).where("_batch = 'b1'").count() == 1
    assert current_rows(spark, path, ["k"]).count() == 50
    assert current_rows(spark, path, ["k"]).where("k = 7").first()["v"] == "z"


def test_a_batch_reads_the_buckets_of_its_keys_once(spark, monkeypatch):
    path = scratch_path(spark, "buckets")
    write_changes(spark.range(5000).selectExpr("id AS k", "'a' AS v"), path, "start", ["k"])
    held = current_rows(spark, path, ["k"], spark.createDataFrame([(7,)], "k long"))
    read = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in read and "_bucket" in read.split("PartitionFilters: [")[1].split("]")[0]
    assert held.collect() == [(7, "a")]
    buckets = spark.read.parquet(path).groupBy("_bucket").count().collect()
    assert len(buckets) == changes.BUCKETS and max(r["count"] for r in buckets) < 200

    calls = []
    monkeypatch.setattr(files, "current_rows", lambda *a, **k: calls.append(1) or current_rows(*a, **k))
    scans = []
    monkeypatch.setattr(load, "cut_and_count", lambda df, label, counts: scans.append(plan_of(df).count("FileScan parquet [k")) or cut_and_count(df, label, counts))
    assert upsert_batch(spark.createDataFrame([("7", "b"), ("9999", "c")], "k string, v string"), "b2", path, FLOW) == {"inserted": 1, "updated": 1}
    assert calls == [1] and scans == [0, 1]
    assert changes.batches(spark, path) == {"start": 1, "b2": 2}


def test_change_table_keeps_types_and_columns(spark):
    path = scratch_path(spark, "kept-types")
    write_changes(spark.createDataFrame([(1, "a", 2.5)], "k long, v string, x double"), path, "007", ["k"])
    write_changes(spark.createDataFrame([("2", "b")], "k string, v string"), path, "7", ["k"])
    assert rows(current_rows(spark, path, ["k"])) == [(1, "a", 2.5), (2, "b", None)]
    assert changes.batches(spark, path) == {"007": 1, "7": 2}
    with pytest.raises(Exception, match="k cannot hold x"):
        write_changes(spark.createDataFrame([("x", "b")], "k string, v string"), path, "8", ["k"])


def test_two_writers_do_not_meet(spark):
    path = stored(spark, "two", [(1, "a")])
    for name, key in (("x-0", "2"), ("y-0", "3")):
        upsert_batch(spark.createDataFrame([(key, name)], "k string, v string"), name, path, FLOW)
    assert rows(current_rows(spark, path, ["k"])) == [(1, "a"), (2, "x-0"), (3, "y-0")]
    again = scratch_path(spark, "rewritten")
    rewrite(spark, path, ["k"], again)
    assert rows(current_rows(spark, again, ["k"])) == rows(current_rows(spark, path, ["k"]))


def test_change_table_starts_empty_and_widens(spark):
    path = scratch_path(spark, "fresh")
    assert current_rows(spark, path, ["k"]) is None
    upsert_batch(spark.createDataFrame([("1", "a")], "k string, v string"), "1", path, FLOW)
    upsert_batch(spark.createDataFrame([("2", "b", "c")], "k string, v string, extra string"), "2", path, FLOW)
    assert rows(current_rows(spark, path, ["k"]).select("k", "v", "extra")) == [(1, "a", None), (2, "b", "c")]


def test_stream_loads_files_in_order_and_skips_reports(spark):
    folder, schema = scratch_path(spark, "in"), "k string, v string, n long"
    path = stored(spark, "st", [(1, "old"), (9, "kept")])

    def arrive(data, name):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}")

    def run(state):
        parents = lambda: {}
        stream_load(stream_files(spark, folder, schema), path, FLOW, state, parents, "n", rejects).awaitTermination()

    state, rejects = scratch_path(spark, "state"), scratch_path(spark, "rejects")
    arrive([("1", "new", 0), ("x", "bad", 1), ("2", "b", 2), ("2", "c", 3)], "f1")
    arrive([("1", "ignored", 0)], "reports/r1")
    run(state)
    arrive([("2", "d", 0)], "f2")
    run(state)
    run(state)
    assert rows(current_rows(spark, path, ["k"])) == [(1, "new"), (2, "d"), (9, "kept")]
    assert rows(read_rejects(spark, rejects).select("k", "reject_stage")) == [("x", "type")]


def test_run_record_rules(spark):
    records = spark.createDataFrame(
        [
            (0, "s", "t", 1, 0, 0, 0, "first"),
            (1, "s", "t", 0, 0, 0, 1, "second"),
            (2, "s", "t", 1, 0, 0, 0, "first"),
            (3, "s", "t", 0, 0, 0, 0, "idle"),
            (4, "s", "u", 0, 0, 0, 0, ""),
            (5, "s", "u", 5, 0, 0, 0, "more"),
        ],
        "seq long, sheet string, table string, read_rows long, inserted long, updated long, rejected_rows long, notes string",
    )
    best = {r["table"]: (r["seq"], r["notes"]) for r in M.dedupe_run_records(records, "seq").collect()}
    assert best == {"t": (0, "first; second"), "u": (5, "more")}


def test_no_window_without_a_partition(spark, sf_dir):
    df = spark.createDataFrame([(0, None)], "_row_seq long, id string")
    assert "Window" not in plan_of(K.generate_keys(df, "id"))


def test_load_order():
    spec = lambda name, *parents: TableSpec(name, ["k"], {"k": "int"}, foreign_keys=[ForeignKey("k", p, "k") for p in parents])
    names = lambda *specs: [s.name for s in load_order(specs)]
    assert names(spec("c", "b"), spec("b", "a"), spec("a")) == ["a", "b", "c"]
    assert names(spec("y"), spec("x"), spec("z", "y")) == ["y", "x", "z"]
    assert names(spec("a", "a", "elsewhere"), spec("b", "a")) == ["a", "b"]
    circle = [spec("hangs", "r"), spec("r", "q"), spec("q", "p"), spec("p", "r", "top"), spec("top")]
    assert names(*circle) == names(*reversed(circle)) == ["top", "p", "q", "r", "hangs"]
    assert names() == []


def test_a_circle_of_tables_loads_in_any_order(spark):
    a = TableSpec("a", ["k"], {"k": "int", "b": "int"}, foreign_keys=[ForeignKey("b", "b", "k")])
    b = TableSpec("b", ["k"], {"k": "int", "a": "int"}, foreign_keys=[ForeignKey("a", "a", "k")])
    batches = {"a": spark.createDataFrame([("1", "1"), ("2", "9")], "k string, b string"), "b": spark.createDataFrame([("1", "1"), ("3", "2")], "k string, a string")}
    empty = {s.name: spark.createDataFrame([], s.storage_schema()) for s in (a, b)}
    for specs in ([a, b], [b, a]):
        run = load_all(batches, specs, empty)
        assert not run.errors and rows(run.snapshots()["a"]) == [(1, 1)] and rows(run.snapshots()["b"]) == [(1, 1)]
        assert rows(run.missing_keys()) == [("a", "b", "b", "9"), ("b", "a", "a", "2")]
        assert rows(run.verification(spark).drop("warning")) == [("a", 0, 1, 1, 1), ("b", 0, 1, 1, 1)]


def test_run_lists_issues(spark):
    spec = TableSpec("t", ["k"], {"k": "int", "n": "float"})
    batch = spark.createDataFrame([("1", "x"), ("", "2"), ("3", "3")], "k string, n string")
    run = load_all({"t": batch}, [spec], {"t": spark.createDataFrame([], spec.storage_schema())})
    assert len(run.issues().collect()) == 2 and {r["table"] for r in run.issues().collect()} == {"t"}


def test_long_chain_of_own_references(spark, monkeypatch):
    chain = TableSpec("chain", ["id"], {"id": "int", "up": "int"}, foreign_keys=[ForeignKey("up", "chain", "id")])
    stored = spark.createDataFrame([(-5, None)], chain.storage_schema())
    batch = spark.range(10_000).selectExpr("CAST(id AS string) AS id", "CAST(CASE id WHEN 0 THEN -1 WHEN 9000 THEN -5 ELSE id - 1 END AS string) AS up")
    rounds = []
    monkeypatch.setattr(references, "cut_lineage", lambda df, label: rounds.append(label) or cut_lineage(df, label))
    out = load_table(batch, chain, stored, {"chain": stored})
    assert out.tally["rejected_fk"] == 9000 and out.tally["inserted"] == 1000
    assert rounds.count("references") <= 20
    assert out.fk_rejected.where("id = 8999").first()["rejection_reason"] == "Foreign key violation: up=8998 not found in chain.id"


def test_own_references_against_brute_force(spark):
    chain = TableSpec("chain", ["id"], {"id": "int", "up": "int"}, foreign_keys=[ForeignKey("up", "chain", "id")])
    two = TableSpec("chain", ["id"], {"id": "int", "up": "int", "aside": "int"}, foreign_keys=[ForeignKey("up", "chain", "id"), ForeignKey("aside", "chain", "id")])
    rng = random.Random(5)
    for spec, width in ((chain, 1), (two, 2)):
        data = [(i, *[rng.choice([None, rng.randrange(130), i, rng.randrange(100)]) for _ in range(width)]) for i in range(100)]
        held = {100, 101, 110}
        good = {r[0]: r[1:] for r in data}
        while lost := {k for k, ups in good.items() if any(u is not None and u not in held and u not in good for u in ups)}:
            good = {k: v for k, v in good.items() if k not in lost}
        batch = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in data], ", ".join(f"{c} string" for c in spec.types))
        stored = spark.createDataFrame([(k, *[None] * width) for k in held], spec.storage_schema())
        out = load_table(batch, spec, stored, {"chain": stored})
        assert {r["id"] for r in out.snapshot.collect()} == held | set(good)


def test_names_of_the_batch_do_not_clash(spark):
    names = ["_rule_reason", "_pk_reason", "_typed", "_raw", "_rn", "_hit0", "_spread", "_t_", "_i_k", "stored", "rejected", "seq", "c0"]
    spec = TableSpec("t", ["k"], {"k": "int", "p": "int"}, foreign_keys=[ForeignKey("p", "u", "k")])
    batch = spark.createDataFrame([("1", "1", *names), ("2", "9", *names), ("x", "1", *names)], ", ".join(f"`{c}` string" for c in ["k", "p", *names]))
    parent = spark.createDataFrame([(1,)], "k long")
    target = spark.createDataFrame([(1, 1, "old")], "k long, p long, _typed string")
    out = load_table(batch, spec, target, {"u": parent})
    assert out.tally["updated"] == 1 and out.tally["rejected_fk"] == 1 and out.tally["rejected_type"] == 1
    assert out.snapshot.select(names).collect() == [tuple(names)]
    assert out.rejected.select(names).collect() == out.fk_rejected.select(names).collect() == [tuple(names)]


def test_upsert_without_broadcast_reads_each_side_once(spark, conf, tmp_path):
    spark.range(100).selectExpr("id AS k", "id AS v").write.parquet(f"{tmp_path}/t")
    spark.range(50, 150).selectExpr("id AS k", "-id AS v").write.parquet(f"{tmp_path}/b")
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    target, batch = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/b")
    for df in (U.upsert(target, batch, ["k"]), U.classify_changes(target, batch, ["k"]), U.change_counts(target, batch, ["k"])):
        plan = plan_of(df)
        assert plan.count("FileScan") == 2 and plan.count("Join") == 1 and "Broadcast" not in plan
    assert U.upsert(target, batch, ["k"]).agg(F.sum("v")).first()[0] == sum(range(50)) - sum(range(50, 150))


def test_values_out_of_range_are_never_stored_as_null(spark, conf):
    target = spark.createDataFrame([(1, 5)], "k int, v int")
    for ansi in ("true", "false"):
        conf(spark__sql__ansi__enabled=ansi)
        for row in ((1, 9999999999), (9999999999, 1)):
            batch = spark.createDataFrame([row], "k long, v long")
            for load in (lambda: U.upsert(target, batch, ["k"]).collect(), lambda: U.replace(target, batch).collect()):
                with pytest.raises(Exception, match="cannot hold 9999999999"):
                    load()
            snapshot, rejected = U.upsert_or_reject(target, batch, ["k"])
            assert snapshot.collect() == [(1, 5)] and rejected.count() == 1


def test_a_load_writes_twice(spark, monkeypatch):
    spec = TableSpec("t", ["k"], {"k": "int", "v": "str"})
    written = []
    monkeypatch.setattr(load, "cut_lineage", lambda df, label: written.append(label) or session.cut_lineage(df, label))
    monkeypatch.setattr(load, "cut_and_count", lambda df, label, counts: written.append(label) or cut_and_count(df, label, counts))
    target = cut_lineage(spark.createDataFrame([(1, "a"), (5, "e")], "k long, v string"), "target")
    out = load_table(spark.createDataFrame([("1", "b"), ("2", "c"), ("2", "d"), ("x", "y")], "k string, v string"), spec, target)
    assert written == ["t-judged", "t-outcome"]
    assert {s: n for s, n in out.tally.items() if n} == {"kept": 1, "updated": 1, "inserted": 1, "deduplicated": 1, "rejected_type": 1}
    empty = load_table(target.limit(0), spec, target)
    assert {s: n for s, n in empty.tally.items() if n} == {"kept": 2} and empty.snapshot.count() == 2
