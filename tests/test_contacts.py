"""Contact explode: the four cases, row-count law, output formats, idempotent cleanup."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from addrflow.config import JobConfig
from addrflow.functions import text as TX
from addrflow.operators.contacts import clean_rows, contact_rows, explode_contacts
from addrflow.schema import CONTACT_FIELDS, SHIPMENT_FIELDS

CFG = JobConfig(from_ts="2000-01-01", till_ts="2001-01-01", run_ts="2024-01-01T00:00:00")


def _rows(spark, data):
    recs = [tuple(d.get(f, "") for f in SHIPMENT_FIELDS) for d in data]
    return spark.createDataFrame(recs, ", ".join(f"{f} string" for f in SHIPMENT_FIELDS))


def test_four_cases(spark):
    data = [
        {"shipping_package_code": "both", "mobile": "9876543210,8765432109", "email": "a@b.in", "notification_email": "c@d.in"},
        {"shipping_package_code": "mobile", "mobile": "9876543210", "email": "bad"},
        {"shipping_package_code": "email", "mobile": "123", "email": "a@b.in"},
        {"shipping_package_code": "none", "mobile": "", "email": ""},
    ]
    out = explode_contacts(_rows(spark, data), CFG)
    assert tuple(out.columns) == CONTACT_FIELDS
    got = sorted((r.shipping_package_code, r.contact_mobile, r.contact_email) for r in out.collect())
    assert got == sorted(
        [
            ("both", "+919876543210", "a@b.in"), ("both", "+919876543210", "c@d.in"),
            ("both", "+918765432109", "a@b.in"), ("both", "+918765432109", "c@d.in"),
            ("mobile", "+919876543210", ""), ("email", "", "a@b.in"),
        ]
    )
    assert all(r.enabled and r.record_created == CFG.run_ts == r.record_updated for r in out.collect())


def test_pincode_gate_and_lookup(spark):
    data = [
        {"shipping_package_code": "rule", "mobile": "9876543210", "pincode": "560 001"},
        {"shipping_package_code": "lookup", "mobile": "9876543210", "pincode": "PO1234"},
        {"shipping_package_code": "bad", "mobile": "9876543210", "pincode": "012345"},
        {"shipping_package_code": "marker", "mobile": "9876543210", "pincode": "\\N"},
    ]
    lookup = spark.createDataFrame([("PO1234",), ("PO1234",), ("\\N",), (None,)], "Pincode string")
    out = contact_rows(_rows(spark, data), lookup, CFG)
    got = sorted((r.shipping_package_code, r.pincode) for r in out.collect())
    assert got == [("lookup", "PO1234"), ("rule", "560001")]


def test_row_count_law_and_formats(spark):
    from tests.conftest import SF_SMALL
    from addrflow.plans.queries import fixture_in_window, FIXTURE_CFG
    from addrflow.functions.email import email_set
    from addrflow.functions.phone import mobile_set
    from addrflow.operators.filters import canonical_rows
    from addrflow.sources import driver_tables as D

    rows = clean_rows(canonical_rows(D.fixture_rows(fixture_in_window(spark, SF_SMALL, FIXTURE_CFG)), "yyyy-MM-dd HH:mm:ss"))
    sizes = rows.select(
        F.size(mobile_set(F.col("mobile"), F.col("notification_mobile"))).alias("m"),
        F.size(email_set(F.col("email"), F.col("notification_email"))).alias("e"),
    ).collect()
    expected = sum(max(r.m, 1) * max(r.e, 1) for r in sizes if r.m + r.e > 0)
    out = explode_contacts(rows, FIXTURE_CFG).collect()
    assert len(out) == expected
    assert all(r.contact_mobile == "" or re.fullmatch(r"\+91[6-9]\d{9}", r.contact_mobile) for r in out)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x3000), max_size=12), min_size=1, max_size=8))
def test_cleanup_is_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    once = df.select(TX.compact(F.col("v")).alias("v"))
    twice = once.select(TX.compact(F.col("v")).alias("v"))
    assert once.collect() == twice.collect()


def test_pincode_shuffle_fallback_same_result(spark):
    data = [{"shipping_package_code": str(i), "mobile": "9876543210", "pincode": p}
            for i, p in enumerate(["560001", "PO1234", "", "x", "560 001", "\\N", "PO9"] * 5)]
    lookup = spark.createDataFrame([("PO1234",), ("PO9",), ("AB",)], "Pincode string")
    df = _rows(spark, data)
    small = sorted(map(tuple, contact_rows(df, lookup, CFG).collect()))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        big = contact_rows(df, lookup, CFG)
        assert sorted(map(tuple, big.collect())) == small and len(small) == 20
        plan = big._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
