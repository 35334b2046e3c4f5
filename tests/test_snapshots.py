"""Which base frames of the catalogue snapshots are written before a query runs."""

import shutil

import pytest

import __spark_entry__ as entry
from tablebridge.queries.registry import QUERIES
from tablebridge.queries import snapshots


@pytest.fixture
def own(sf, tmp_path):
    """A folder that no other test has staged anything for."""
    for name in ("orders", "lineitem", "customer"):
        shutil.copy(f"{sf}/{name}.parquet", tmp_path)
    return str(tmp_path)


@pytest.mark.parametrize("name, written", [
    ("type_inventory", {"ns"}), ("to_target_types", {"ns"}), ("schema_diff", {"att", "ns"}),
    ("reflect_functions", {"sources", "ns"}), ("reflect_exclusion_constraints", {"ns"})])
def test_queries_write_only_what_they_read_twice(spark, own, name, written):
    entry.queries()[name](spark, own)
    assert set(snapshots._STAGED[spark.sparkContext.applicationId, own]) == written


@pytest.mark.parametrize("name", ["assemble_catalog_schema", "reflect_schema_scope"])
def test_a_scope_shuffles_no_large_snapshot(spark, own, name):
    """All that a scope joins has been reduced to it: no plan reads the staged base frames any more."""
    plan = QUERIES[name](spark, own)._jdf.queryExecution().optimizedPlan()
    read = [str(plan.collectLeaves().apply(i).relation().location()) for i in range(plan.collectLeaves().size()) if "Relation" in plan.collectLeaves().apply(i).nodeName()]
    assert read and not [x for x in read if any(f"/{base}-" in x for base in ("att", "k", "parents"))] and not [x for x in read if "lineitem" in x or "orders" in x]


def test_assembling_mysql_leaves_out_what_it_does_not_read(spark, own):
    entry.queries()["assemble_catalog_schema_mysql"](spark, own)
    assert set(snapshots._STAGED[spark.sparkContext.applicationId, own]) == {"att", "k", "parents"}


def test_lines_are_shuffled_once(spark, own):
    lines = snapshots._base(spark, own, {"att"}, ("att",))["att"]._jdf.queryExecution().executedPlan().toString()
    assert lines.count("Exchange hashpartitioning(l_orderkey") == 1 and "hashpartitioning(l_orderkey#" in lines
    assert "l_linenumber" not in "".join(x for x in lines.splitlines() if "Exchange" in x)


@pytest.mark.parametrize("name", ["assemble_catalog", "assemble_catalog_mysql"])
def test_parts_of_a_table_meet_before_they_are_gathered(spark, sf, name):
    """One list for each table, built where its rows meet: lists of single rows would be built and shipped before."""
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    gathered = [i for i, line in enumerate(plan.splitlines()) if "collect_list(" in line and "_rows" in line]
    assert len(gathered) == 1 and plan.splitlines()[gathered[0]].count("collect_list(") == 1
    assert "RepartitionByExpression" in plan.splitlines()[gathered[0] + 1]
