"""Shuffle joins under a hot key give exactly the broadcast results, and adaptive execution splits them."""

import re

from pyspark.sql import functions as F

from addrflow.operators.assemble import assemble_shipments
from addrflow.operators.contacts import contact_rows
from addrflow.operators.decrypt import decrypt_rows
from addrflow.operators.lookup import with_pincode_check
from addrflow.plans.queries import CFG
from addrflow.sources import driver_tables as D
from tests.conftest import SF_SMALL


def _run(spark, cfg, hot: bool):
    t = D.source_tables(spark, SF_SMALL, encrypted=True)
    so = t["sale_order"]
    if hot:  # one tenant (customer 1) owns every third order
        so = so.withColumn("tenant_id", F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("tenant_id")))
    rows = assemble_shipments(t["shipping_package"], t["address_detail"], so, t["tenant"], t["facility"], t["party"], cfg)
    dec = decrypt_rows(rows, D.key_export(spark, SF_SMALL), cfg)
    return contact_rows(dec, D.pincode_lookup(spark, SF_SMALL), cfg)


def test_hot_tenant_without_broadcasts(spark):
    want = sorted(map(tuple, _run(spark, CFG, hot=True).collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = _run(spark, CFG, hot=True)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert got == want and len(got) > 0


def _hot_address_rows(spark, cfg):
    """Assembly where one address that passes the source filters receives every third shipment."""
    from addrflow.operators.filters import country_kept, phone_kept

    t = D.source_tables(spark, SF_SMALL)
    ad = t["address_detail"]
    hot = ad.filter(country_kept(F.col("country_code"), cfg) & phone_kept(F.col("phone"), cfg)).agg(F.min("id")).first()[0]
    sp = t["shipping_package"].withColumn(
        "shipping_address_id",
        F.when(F.xxhash64("code") % 3 == 0, F.lit(hot)).otherwise(F.col("shipping_address_id")),
    )
    return assemble_shipments(sp, t["address_detail"], t["sale_order"], t["tenant"], t["facility"], t["party"], cfg)


_SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
}


def _final_plan_and_rows(spark, make):
    """Run ``make()`` with broadcasts off and skew thresholds sized for the tiny test tables."""
    old = {k: spark.conf.get(k, None) for k in _SKEW_SETTINGS}
    for k, v in _SKEW_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        df = make()
        got = sorted(map(tuple, df.collect()))
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "isFinalPlan=true" in final
    return final, got


def test_hot_key_path_is_split_by_aqe(spark):
    """Every row under one alias shares one key path: AQE splits that partition, rows unchanged."""
    want = sorted(map(tuple, _run(spark, CFG, hot=False).collect()))
    final, got = _final_plan_and_rows(spark, lambda: _run(spark, CFG, hot=False))
    assert re.search(r"SortMergeJoin\(skew=true\) \[_path#\d+\], \[_kp#\d+\], LeftOuter", final), "key path not split"
    assert got == want and len(got) > 0


def test_hot_pincode_is_split_by_aqe(spark):
    """One pincode that only the lookup knows on every second row."""
    rows = spark.range(6000).selectExpr("id", "if(id % 2 = 0, 'ZZ', concat('Z', id)) as pincode", "repeat('x', 50) as pad")
    lookup = spark.range(500).selectExpr("if(id = 0, 'ZZ', concat('Z', id)) as Pincode")
    want = sorted(map(tuple, with_pincode_check(rows, lookup).collect()))
    final, got = _final_plan_and_rows(spark, lambda: with_pincode_check(rows.repartition(6), lookup))
    assert re.search(r"SortMergeJoin\(skew=true\) \[_pin_key#\d+\]", final), "hot pincode not split"
    assert got == want and sum(r[-1] for r in got) > 3000


def test_hot_address_is_split_by_aqe(spark):
    """A third of the shipments on one join key: AQE splits that partition, rows unchanged."""
    want = sorted(map(tuple, _hot_address_rows(spark, CFG).collect()))
    final, got = _final_plan_and_rows(spark, lambda: _hot_address_rows(spark, CFG))
    assert re.search(r"SortMergeJoin\(skew=true\) \[_shipping_package_shipping_address_id#\d+L?\]", final), "hot address partition not split"
    assert got == want and len(got) > 0


def _hot_order_rows(spark, cfg):
    """Assembly where one sale order (of a kept tenant) holds every third shipment."""
    t = D.source_tables(spark, SF_SMALL)
    kept_tenants = t["tenant"].filter(~F.col("code").isin(*cfg.excluded_tenants)).select(F.col("id").alias("tid"))
    so = t["sale_order"]
    hot = so.join(kept_tenants, so["tenant_id"] == kept_tenants["tid"]).agg(F.min("id")).first()[0]
    sp = t["shipping_package"].withColumn(
        "sale_order_id", F.when(F.xxhash64("code") % 3 == 0, F.lit(hot)).otherwise(F.col("sale_order_id"))
    )
    return assemble_shipments(sp, t["address_detail"], so, t["tenant"], t["facility"], t["party"], cfg)


def test_hot_sale_order_is_split_by_aqe(spark):
    """A third of the shipments on one order: AQE splits that partition of the order join."""
    want = sorted(map(tuple, _hot_order_rows(spark, CFG).collect()))
    final, got = _final_plan_and_rows(spark, lambda: _hot_order_rows(spark, CFG))
    assert re.search(r"SortMergeJoin\(skew=true\) \[_shipping_package_sale_order_id#\d+L?\]", final), "hot order partition not split"
    assert got == want and len(got) > 0


def test_hot_tenant_is_split_by_aqe(spark):
    """A third of the orders on one tenant: AQE splits that partition of the tenant join."""
    want = sorted(map(tuple, _run(spark, CFG, hot=True).collect()))
    final, got = _final_plan_and_rows(spark, lambda: _run(spark, CFG, hot=True))
    assert re.search(r"SortMergeJoin\(skew=true\) \[_sale_order_tenant_id#\d+L?\]", final), "hot tenant partition not split"
    assert got == want and len(got) > 0


def test_stage_counts_same_without_broadcasts(spark):
    """Shuffle joins leave every stage count unchanged."""
    from addrflow.operators.metrics import stage_counts
    from addrflow.plans.queries import assembled

    def counts(cfg):
        rows = assembled(spark, SF_SMALL, cfg, encrypted=True)
        return stage_counts(rows, D.key_export(spark, SF_SMALL), D.pincode_lookup(spark, SF_SMALL), cfg)

    want = dict(map(tuple, counts(CFG).collect()))
    _, got = _final_plan_and_rows(spark, lambda: counts(CFG))
    assert dict(got) == want and want["contact_rows"] > 0
