"""Every registered query against its SQL twin, and the shape of its plan."""

import pytest

import __spark_entry__ as registered
from freightlake.sources.tables import file_attributes
from verification.compare import compare
from verification.queries import ORACLE, QUERIES

@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, duck, sf_dir):
    assert compare(spark, duck, QUERIES[name], ORACLE[name], sf_dir) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_gives_truckloads(spark):
    frame = registered.entry(spark)
    assert {"vehicle_type", "annual_trucks", "status", "zed"} <= set(frame.columns)
    assert frame.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_or_python(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in plan, plan


def test_file_attributes_counts_records(spark, sf_dir):
    (row,) = file_attributes(spark.read.parquet(f"{sf_dir}/lineitem.parquet")).collect()
    assert row.file_path.endswith("lineitem.parquet")
    assert row.records == 6000 and row.file_size > 0
