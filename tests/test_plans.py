"""Plan-shape guards over every registered query (physical plan, before execution)."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


#: Queries over landed files run their loads while they are built; what they return is a scan of the loaded table.
LOADS = [n for n, q in E.queries().items() if q.__module__ == "riskfabric.catalog_loads" and n not in ("asof_population_ranged", "name_lookup_forms")]


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(LOADS)))
def test_plan_has_no_pairs_or_python(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"


def test_filters_and_columns_reach_the_scan(spark):
    df = E.queries()["kpi_global"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    lineitem_scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "lineitem" in ln][0]
    # only the columns the KPI needs are read
    assert "l_extendedprice" not in lineitem_scan and "l_tax" not in lineitem_scan
    news = E.queries()["news_monthly"](spark, SF)
    nplan = news._jdf.queryExecution().executedPlan().toString()
    assert [ln for ln in nplan.splitlines() if "FileScan parquet" in ln and "lineitem" in ln and "l_extendedprice" not in ln]
    # a date range reaches the scan; no query reads part of a table by other filters
    timeline = E.queries()["weekly_timeline"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in timeline


def test_program_lookup_moves_no_rows(spark):
    plan = E.queries()["ofac_normalise"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning" not in plan
    assert plan.count("FileScan parquet") == 1
