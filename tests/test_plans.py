"""Plan shape: built-in expressions only, no cartesian products, bounded broadcasts, pushdown."""

from addrflow.plans.queries import q_shipment_contacts, q_stage_counts
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan(spark):
    df = q_shipment_contacts(spark, SF_SMALL)
    plan = _plan(df)
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad
    # dimension tables, the key export and the pincode lookup are small here: all broadcast
    assert plan.count("BroadcastHashJoin") >= 5
    # the window and status filters reach the lineitem scan
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan


def test_stage_counts_has_no_cross_join(spark):
    plan = _plan(q_stage_counts(spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_columns_pruned_at_scan(spark):
    plan = _plan(q_shipment_contacts(spark, SF_SMALL))
    # lineitem is read for 6 of its 11 columns only
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "l_orderkey" in line][0]
    assert "l_extendedprice" not in scan and "l_tax" not in scan


def test_each_column_decrypted_once(spark):
    """No filter over the contact sets is pushed below their projection (which re-decrypts)."""
    import re

    from addrflow.schema import ENCRYPTED_FIELDS

    plan = _plan(q_shipment_contacts(spark, SF_SMALL))
    calls = re.findall(r"aesDecrypt\(coalesce\(tryeval\(unbase64\(split\((\w+?)#", plan)
    assert sorted(calls) == sorted(ENCRYPTED_FIELDS), calls


def test_building_a_query_runs_no_job(spark):
    """Sizes are left to statistics and adaptive execution: nothing is counted beforehand."""
    from addrflow.plans.queries import queries

    spark.sparkContext.setJobGroup("build", "build")
    try:
        for name in ("shipment_contacts", "decrypted_rows", "stage_counts", "closed_databases", "active_servers", "pincode_checks", "key_table"):
            queries()[name](spark, SF_SMALL)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0, jobs


def test_small_tables_are_joined_before_the_large_exchanges(spark):
    """Tenants below the order side, facilities and parties below the shipment side."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        plan = _plan(q_shipment_contacts(spark, SF_SMALL))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    lines = plan.splitlines()
    at = {n: next(i for i, x in enumerate(lines) if "Join" in x and k in x) for n, k in (
        ("order", "[_shipping_package_sale_order_id#"), ("tenant", "[_sale_order_tenant_id#"),
        ("address", "[_shipping_package_shipping_address_id#"), ("facility", "[_shipping_package_facility_id#"),
    )}
    assert at["order"] < at["tenant"] and at["address"] < at["facility"]


def test_union_of_many_sources_is_planned_quickly(spark):
    import time

    from addrflow.operators.filters import union_sources

    frames = [spark.range(1).selectExpr(f"'{i}' as a", "'x' as b") for i in range(400)]
    began = time.monotonic()
    out = union_sources(frames)
    out._jdf.queryExecution().optimizedPlan()
    assert time.monotonic() - began < 20
    assert out.columns == ["a", "b"]
