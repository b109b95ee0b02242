"""Shape of the plans: no pair-wise joins, no Python rows, pushed filters and pruned columns."""

from __future__ import annotations

import pytest

from rowharbor.catalog import QUERIES, load_catalog

load_catalog()

RUNS_JOBS = ("stream", "load_all", "load_table")
LAZY = [n for n in QUERIES if not n.startswith(RUNS_JOBS)]


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    """Plans with broadcasting off, as they are for large tables."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    out = {n: QUERIES[n](spark, sf_dir)._jdf.queryExecution().executedPlan().toString() for n in LAZY}
    for name in names:
        spark.conf.unset(name)
    return out


def test_no_pairwise_join_and_no_python(plans):
    for name, plan in plans.items():
        for node in ("NestedLoop", "CartesianProduct", "BroadcastHashJoin", "Python", "Pandas"):
            assert node not in plan, (name, node)


def test_no_window_over_everything(plans):
    for name, plan in plans.items():
        for line in plan.splitlines():
            assert not ("Window [" in line and "], []" in line), name


def test_row_operators_do_not_shuffle(plans):
    for name in ("clean", "rename", "to_int", "to_date", "coerce_valid", "split_factor", "split_pk_rejected", "check_length",
                 "check_decimal", "classify_error", "extract_html_metrics", "evolve_schema"):
        assert "Exchange" not in plans[name], name


def test_key_comparison_shuffles_once(plans):
    for name in ("reconcile_keys", "missing_keys", "loaded_keys", "missing_summary", "dup_count", "dedupe_last"):
        assert plans[name].count("Exchange hashpartitioning") == 1, name


def test_scans_are_pruned_and_filters_pushed(plans):
    assert "ReadSchema: struct<l_partkey:bigint>" in plans["missing_keys"]
    assert "IsNotNull(l_suppkey)" in plans["reference_keys"]
    assert "ReadSchema: struct<o_custkey:bigint>" in plans["reconcile_keys"]
    assert "LessThan(p_size,25)" in plans["missing_keys"]
