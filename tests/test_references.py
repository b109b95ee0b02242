"""Foreign keys, lookups and names against brute force; skewed keys split over tasks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rowharbor.operators import lookups as L
from rowharbor.operators import references as R
from rowharbor.operators.validate import check_unique, constraint_reason, split_pk
from rowharbor.session import cut_lineage
from rowharbor.spec import ForeignKey, SpecError, TableSpec


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


FK = ForeignKey("k", "parent", "id")


def split(child, parent, fk=FK):
    valid, rejected = R.fk_split(child, fk, parent)
    return sorted(r["i"] for r in valid.collect()), {r["i"]: r["rejection_reason"] for r in rejected.collect()}


@pytest.mark.parametrize("times", [1, 2])
def test_typed_keys(spark, times):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "i int, k int")
    parent = spark.createDataFrame([(1,), (2,), (None,)] * times, "id bigint")
    fk = ForeignKey("k", "parent", "id")
    assert split(child, parent, fk) == ([1, 3], {2: "Foreign key violation: k=9 not found in parent.id"})


def test_repeated_parent_values_do_not_multiply_rows(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b")], "i int, k string")
    parent = spark.createDataFrame([("a",), ("a",)], "id string")
    assert split(child, parent)[0] == [1]


def test_text_or_number_match(spark):
    values = ["1.0", "01", "x", "", "nan", "None", None, "1", "2", " 1 ", "1e0", "abc"]
    child = spark.createDataFrame(list(enumerate(values)), "i int, k string")
    numbers = spark.createDataFrame([(1,), (5,)], "id int")
    valid, rejected = split(child, numbers)
    assert [values[i] for i in valid] == ["1.0", "01", "", "nan", "None", None, "1", " 1 ", "1e0"]
    assert sorted(values[i] for i in rejected) == ["2", "abc", "x"]
    texts = spark.createDataFrame([("1.0",), ("abc",), ("1e2",)], "id string")
    valid, rejected = split(child, texts)
    assert sorted(values[i] for i in rejected) == ["2", "x"]


def test_text_keys_match_brute_force(spark):
    rng = random.Random(3)
    pool = ["1", "1.0", "01", "2", "2.50", "2.5", "x", "-3", "-3.0", ".5", "0.5", "1e1", "10", "nan", "", "y "]
    child_values = [rng.choice(pool) for _ in range(200)]
    parent_values = rng.sample(pool, 6)

    def number(t):
        try:
            return float(t)
        except ValueError:
            return None

    def parent_number(t):
        return float(t) if t.replace(".", "", 1).replace("-", "", 1).isdigit() else None

    refs = {p for p in parent_values}
    ref_numbers = {parent_number(p) for p in parent_values} - {None}
    expected = [
        i
        for i, v in enumerate(child_values)
        if v in ("", "nan") or v in refs or (number(v) is not None and number(v) in ref_numbers)
    ]
    child = spark.createDataFrame(list(enumerate(child_values)), "i int, k string")
    parent = spark.createDataFrame([(p,) for p in parent_values], "id string")
    assert split(child, parent)[0] == expected


def test_empty_parent_suffix(spark):
    child = spark.createDataFrame([(1, 1), (2, None)], "i int, k int")
    parent = spark.createDataFrame([(None,)], "id int")
    valid, rejected = split(child, parent)
    assert valid == [2]
    assert rejected == {1: "Foreign key violation: k=1 not found in parent.id (reference table is empty)"}


def test_first_reason_wins_and_all_reasons_are_kept(spark):
    child = spark.createDataFrame([(1, 7, 8)], "i int, a int, b int")
    parents = {"p": spark.createDataFrame([(1,)], "id int"), "q": spark.createDataFrame([(1,)], "id int")}
    fks = [ForeignKey("a", "p", "id"), ForeignKey("b", "q", "id"), ForeignKey("absent", "p", "id"), ForeignKey("a", "gone", "id")]
    row = R.fk_flags(child, fks, parents, all_reasons=True).first()
    assert row["rejection_reason"].startswith("Foreign key violation: a=7")
    assert len(row["all_reasons"]) == 2
    assert R.fk_split_many(child, fks, parents, policy="skip")[0].count() == 1
    with pytest.raises(SpecError):
        R.fk_split_many(child, fks, parents, policy="other")


def test_self_reference(spark):
    nodes = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "i int, k int")
    assert split(nodes, nodes, ForeignKey("k", "nodes", "i"))[0] == [1, 2]


def test_delete_cascade_and_restrict(spark):
    removed = spark.createDataFrame([(1,)], "id int")
    children = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "id int, parent int")
    grand = spark.createDataFrame([(100, 10), (101, 11)], "id int, child int")
    left = R.delete_cascade(removed, [("c", children, "parent", "id"), ("g", grand, "child", "id")])
    assert sorted(r["id"] for r in left["c"].collect()) == [11, 12]
    assert [r["id"] for r in left["g"].collect()] == [101]
    parents = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    assert sorted(r["id"] for r in R.restrict_check(parents, "id", [(children, "parent")]).collect()) == [1, 2]


def test_hot_and_missing_keys_are_split_in_a_sort_merge_join(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
    )
    n = 300_000
    i = F.col("id")
    child = spark.range(0, n, 1, 8).select(
        i, F.when(i % 3 == 0, 7).when(i % 3 == 1, None).otherwise(i % 1000).cast("bigint").alias("k")
    )
    parent = spark.range(0, 800, 1, 4).select(F.col("id").alias("pid"))
    valid, rejected = R.fk_split(child, ForeignKey("k", "p", "pid"), parent, mark_empty=False)
    counted = valid.groupBy((i % 2).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    total = sum(r["n"] for r in counted.collect())
    assert "SortMergeJoin(skew=true)" in plan_of(counted)
    assert total + rejected.count() == n
    assert total == n // 3 * 2 + sum(1 for x in range(2, n, 3) if x % 1000 < 800)


def test_text_key_join_has_no_nested_loop(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    child = spark.createDataFrame([(1, "1")], "i int, k string")
    valid, _ = R.fk_split(child, FK, spark.createDataFrame([(1,)], "id int"), mark_empty=False)
    assert "NestedLoop" not in plan_of(valid) and "Cartesian" not in plan_of(valid)


def test_check_unique_splits_a_hot_key(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
    )
    rows = spark.range(0, 200_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    found = check_unique(rows, ["k"])
    counted = found.groupBy((F.col("id") % 2).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    assert sum(r["n"] for r in counted.collect()) == 66667 + 1
    assert "SortMergeJoin(skew=true)" in plan_of(counted)


def test_check_unique_ignores_null(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "a")], "a int, b string")
    assert [tuple(r)[:2] for r in check_unique(rows, ["a", "b"]).collect()] == [(1, "a")] * 2


def test_lookups(spark):
    dim = spark.createDataFrame([("Raw", 1, 1), ("Raw", 2, 2), ("Semi", 3, 3), (None, 9, 4)], "d string, id int, o int")
    rows = spark.createDataFrame([("Raw",), (" Semi ",), ("7",), ("other",), (None,), ("nan",), ("7.5",)], "t string")
    got = [(r["t"], r["lookup_status"]) for r in L.lookup_id(rows, "t", dim, "d", "id", "o").collect()]
    assert sorted(got, key=repr) == sorted(
        [(2, "mapped"), (3, "mapped"), (7, "id"), (None, "unmapped"), (None, "missing"), (None, "missing"), (None, "unmapped")],
        key=repr,
    )
    texts = spark.createDataFrame([("1",), ("1.0",), ("Raw",), ("odd",), ("",)], "t string")
    ids = spark.createDataFrame([("Raw", "1.0", 1), ("Raw", "2", 2)], "d string, id string, o int")
    kept = L.lookup_id_keep(texts, "t", ids, "d", "id", "o")
    assert sorted(r["t"] or "-" for r in kept.collect()) == ["-", "1", "1.0", "2", "odd"]


AVAILABLE = [
    "Currency_Master", "UoM Master", "tile_cost_sheet_chemical_reacti", "plant-to-port", "tile_cost_sheet_chemical_REACTI",
    "supplier_master ", "tile_cost_sheet_chemical_x", "a", "",
]
REQUESTED = [
    "Currency_Master", "currency_master", "CURRENCY-MASTER", "uom_master", "uom-master", "plant to port", "plant_to_port ",
    "tile_cost_sheet_chemical_reaction_master_data", "tile_cost_sheet_chemical_reagents_of_all", "nothing at all",
    "TILE_COST_SHEET_CHEMICAL_REACTION_MASTER", "supplier master", "A", "a" + " " * 40, "tile_cost_sheet_chemical_x",
]


def resolve(name, available):
    """The tiers, stated one by one over a list."""
    low = name.lower().strip()
    spaced = low.replace("_", " ").replace("-", " ").strip()
    tests = [
        lambda a: a == name,
        lambda a: a.lower().strip() == low,
        lambda a: a.lower().strip().replace("_", " ").replace("-", " ").strip() == spaced,
        lambda a: a.lower().strip().replace(" ", "_").replace("-", "_") == spaced.replace(" ", "_"),
        lambda a: len(name) > 31 and a.lower() == name[:31].lower(),
        lambda a: len(name) > 31 and len(a) <= 31 and a.lower().startswith(low[:25]),
    ]
    for tier, test in enumerate(tests, start=1):
        for a in available:
            if test(a):
                return a, tier
    return None


def test_match_names_tiers(spark):
    wanted = spark.createDataFrame([(r,) for r in REQUESTED], "n string")
    known = spark.createDataFrame([(a, i) for i, a in enumerate(AVAILABLE)], "a string, o int")
    got = {r["requested_name"]: (r["matched_name"], r["tier"]) for r in L.match_names(wanted, "n", known, "a", "o").collect()}
    assert got == {r: m for r in REQUESTED if (m := resolve(r, AVAILABLE))}


def test_close_matches_against_brute_force(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("ab_") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    wanted, known = sorted(set(words[:30])), words[30:]
    expected = {}
    for w in wanted:
        hits = [a for a in known if w in a or a in w]
        expected[w] = list(dict.fromkeys(hits))[:5] if len(set(hits)) == len(hits) else hits[:5]
    got = {}
    result = L.close_matches(
        spark.createDataFrame([(w,) for w in wanted], "n string"),
        "n",
        spark.createDataFrame([(a, i) for i, a in enumerate(known)], "a string, o int"),
        "a",
        "o",
    )
    for r in result.orderBy("requested_name", "position").collect():
        got.setdefault(r["requested_name"], []).append(r["close_match"])
    assert {w: got.get(w, []) for w in wanted} == {w: [a for a in known if w in a or a in w][:5] for w in wanted}


def test_all_keys_are_checked_in_one_join(spark, monkeypatch):
    written = []
    monkeypatch.setattr(R, "cut_lineage", lambda df, label: written.append(df) or cut_lineage(df, label))
    child = spark.createDataFrame(
        [(1, 1, "1", "x", 5), (2, 9, "1.0", "y", 5), (3, None, "nan", None, 5), (4, 1, "2", "z", None), (5, 8, "-0", "q", 6)],
        "i int, a int, b string, c string, d long",
    )
    parents = {
        "p": spark.createDataFrame([(1,), (1,), (None,)], "id long"),
        "n": spark.createDataFrame([(1.0,), (0.0,)], "id double"),
        "t": spark.createDataFrame([("x",), ("y",)], "id string"),
    }
    fks = [ForeignKey("a", "p", "id"), ForeignKey("b", "n", "id"), ForeignKey("c", "t", "id"), ForeignKey("d", "absent", "id")]
    valid, rejected = R.fk_split_many(child, fks, parents)
    assert len(written) == 1 and plan_of(written[0]).count("Scan ExistingRDD[i#") == 1
    assert sorted(r["i"] for r in valid.collect()) == [1, 3] and valid.columns == child.columns
    reason = {r["i"]: r["rejection_reason"] for r in rejected.collect()}
    assert reason == {
        2: "Foreign key violation: a=9 not found in p.id",
        4: "Foreign key violation: b=2 not found in n.id",
        5: "Foreign key violation: a=8 not found in p.id",
    }
    lazily = R.fk_flags(child, fks, parents).where("rejection_reason IS NOT NULL").collect()
    assert {r["i"]: r["rejection_reason"] for r in lazily} == reason
    clean = R.fk_split_many(child.where("i = 1"), fks, parents)
    assert "Join" not in plan_of(clean[0]) and clean[0].count() == 1 and clean[1].count() == 0
    assert [r["accepted"] for r in R.fk_all_or_nothing(child.where("i IN (1, 3)"), fks, parents).collect()] == [True, True]
    assert not any(r["accepted"] for r in R.fk_all_or_nothing(child, fks, parents).collect())


def test_close_matches_of_long_and_odd_names(spark):
    rng = random.Random(9)
    long = ["".join(rng.choice("abcdefgh ") for _ in range(2000)) for _ in range(40)]
    known = [*long, long[0][500:900], long[1][3:7].upper(), "", " ", "a", "Ab", "abc", "zz", "zzz", "É😀x😀", "abc", "abc", "abc", "abc", "abc", "abc"]
    asked = [long[2][10:1500], long[3], "x" + long[4] + "y", "", "  ", "b", "AB ", "abc", "zzzz", "😀X", "no such", "zzz zz", long[5][:3], long[6][:4]]
    got = {}
    result = L.close_matches(spark.createDataFrame([(w,) for w in asked], "n string"), "n", spark.createDataFrame([(a, i) for i, a in enumerate(known)], "a string, o int"), "a", "o")
    for r in result.orderBy("requested_name", "position").collect():
        got.setdefault(r["requested_name"], []).append(r["close_match"])
    plain = {w: [a for a in known if w.lower().strip() in a.lower() or a.lower() in w.lower().strip()][:5] for w in asked}
    assert {w: got.get(w, []) for w in asked} == plain


def test_cascade_writes_only_keys(spark, monkeypatch):
    written = []
    monkeypatch.setattr(R, "cut_lineage", lambda df, label: written.append((label, df.columns)) or df)
    top = spark.createDataFrame([(1,)], "k long")
    middle = spark.createDataFrame([(10, 1, "a"), (20, 2, "b")], "k long, up long, v string")
    low = spark.createDataFrame([(100, 10), (200, 20), (300, None)], "k long, up long")
    fks = {"middle": [ForeignKey("up", "top", "k")], "low": [ForeignKey("up", "middle", "k")]}
    found = R.fk_cascade([("top", top), ("middle", middle), ("low", low)], fks)
    assert written == [("middle-keys", ["k"])]
    assert sorted(r["k"] for r in found["low"][0].collect()) == [100, 300] and [r["k"] for r in found["low"][1].collect()] == [200]


def test_primary_key_split(spark):
    rows = spark.createDataFrame([("1", "a"), ("", "a"), (None, "nan"), ("NaN", "b")], "x string, y string")
    valid, rejected = split_pk(rows, ["x", "y"])
    assert valid.count() == 2
    assert sorted(r["rejection_reason"] for r in rejected.collect()) == [
        "Missing required data in columns: ['x', 'y']",
        "Missing required data in columns: ['x']",
    ]
    with pytest.raises(SpecError):
        split_pk(rows, ["gone"])


def test_constraint_order(spark):
    spec = TableSpec(
        "t", ["k"], {"k": "int", "s": "str", "e": "str", "p": "float", "d": "str"},
        not_null=["s", "d"], lengths={"s": 3}, enums={"e": ["x"]}, decimals={"p": (4, 2)}, defaults={"d": "v"},
    )
    rows = spark.createDataFrame(
        [(1, None, "x", 1.0), (2, "long", "y", 1.0), (3, "ok", "y", 1.0), (4, "ok", None, 123.0), (5, "ok", "x", 99.994)],
        "k long, s string, e string, p double",
    )
    got = [r["r"] for r in rows.orderBy("k").select(constraint_reason(spec, rows.columns).alias("r")).collect()]
    assert got == [
        "Missing Required Data: s", "Value too long for s(3)", "Value not allowed in e: y", "Numeric overflow in p(4,2)", None,
    ]
