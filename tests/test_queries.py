"""Every registered query against its SQL check, and the shape of the plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import connect, difference
from conftest import rows
from epigrid.plans import catalogue, oracle
from epigrid.sources import binding

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    ours = contract.queries()[name](spark, FOLDER).toPandas()
    checks = contract.oracle_sql()
    assert len(ours) > 0
    if name in checks:
        assert difference(ours, duck.execute(checks[name]).df()) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 15


def test_checks_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize(
    "name",
    [
        "q02_cases_near_schools", "q04_nearest_hospital", "q05_hospital_case_load", "q09_school_case_tiers",
        "q11_school_cumulative_tiers", "q16_severity_score", "q17_fogging_score", "region_assignment", "q15_risk_zones",
        "q24_cells_in_red_zones",
    ],
)
def test_no_nested_loops(spark, name):
    plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = contract.queries()["q31_severity_mix"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "value#" not in plan


def test_shuffled_and_salted_paths_agree(spark, monkeypatch):
    """With nothing small enough to broadcast and every key hot, the answers stay the same."""
    from epigrid import constants
    from epigrid.operators import regions

    names = ("q02_cases_near_schools", "q04_nearest_hospital", "region_assignment")
    before = {n: contract.queries()[n](spark, FOLDER) for n in names}
    before = {n: rows(df, *sorted(df.columns)) for n, df in before.items()}
    monkeypatch.setattr(constants, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(regions, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(constants, "HOT_ROWS", 3)
    for n in names:
        df = contract.queries()[n](spark, FOLDER)
        assert rows(df, *sorted(df.columns)) == before[n], n


def test_selective_filters_reach_the_scan(spark):
    plan = contract.queries()["q07_one_case_buffer"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_id,42)" in plan
    # the cover of the one region is stored while the query is built; its plan has the filter in the scan
    one = binding.regions(spark, FOLDER).filter(F.col("region_name") == catalogue.ONE_REGION)
    assert f"EqualTo(n_name,{catalogue.ONE_REGION})" in one._jdf.queryExecution().executedPlan().toString()


def test_merged_areas_by_slabs(spark, duck):
    """All tiers against the slab form, which shares nothing with the operator; on larger tables it is too slow for SQL."""
    sql = oracle._with(f"SELECT region_name, risk_tier, {oracle._round('area', 3)} AS area_sq_km FROM zones", *oracle._slab_areas())
    ours = contract.queries()["q15_risk_zones"](spark, FOLDER).select("region_name", "risk_tier", "area_sq_km").toPandas()
    assert difference(ours, duck.execute(sql).df()) is None


@pytest.mark.parametrize("name", ["q24_cells_in_red_zones", "q04_nearest_hospital", "q15_risk_zones", "utm_round_trip", "hex_rollup"])
def test_generated_code_compiles(spark, name):
    """No stage falls back to interpreted rows because its code grew too large."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        contract.queries()[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
