"""Semi-join reduction and bucketed sources: the same rows, and the plans they are for."""

import random

import pytest
from pyspark.sql import functions as F

from addrflow.operators.assemble import assemble_bucketed
from addrflow.operators.reduce import keep_possible, key_words
from addrflow.plans.queries import _WEEK, CFG, assembled, q_shipment_assembly_bucketed, q_shipment_assembly_week
from addrflow.sources import driver_tables as D
from addrflow.sources.bucketed import stage_bucketed
from tests.conftest import SF_SMALL

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _depth(line: str) -> int:
    return next(i for i, c in enumerate(line) if c.isalpha() or c in "(*")


def _subtree(lines: list[str], at: int) -> list[str]:
    """The lines below a node of a plan's text."""
    end = next((i for i in range(at + 1, len(lines)) if _depth(lines[i] + "x") <= _depth(lines[at])), len(lines))
    return lines[at + 1 : end]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_no_possible_row_is_dropped(spark, kind):
    rng = random.Random(5)
    keys = [rng.randrange(10_000) for _ in range(400)]
    ks = spark.createDataFrame([(k, "x") for k in keys] + [(None, "y")], "k int, word string").select(F.col("k").cast(kind), "word")
    df = spark.range(-50, 12_000).select(F.col("id").cast(kind).alias("id"), F.lit(1).alias("mask")).union(spark.createDataFrame([(None, 1)], f"id {kind}, mask int"))
    kept = {r.id for r in keep_possible(df, "id", ks, "k", words=512).collect()}
    cast = str if kind == "string" else int
    assert {cast(k) for k in keys} <= kept
    assert None not in kept
    assert len(kept) < 3000  # a few of the other rows pass


def test_no_keys_keep_nothing_and_a_full_filter_keeps_the_range(spark):
    df = spark.range(100)
    none = spark.createDataFrame([], "k long")
    assert keep_possible(df, "id", none, "k").count() == 0
    all_ = spark.range(20, 5000).withColumnRenamed("id", "k")
    assert keep_possible(df, "id", all_, "k", words=1).count() == 80


def test_the_filter_has_a_fixed_size(spark):
    for n in (0, 10, 100_000):
        words = key_words(spark.range(n).withColumnRenamed("id", "k"), "k", 256).first()["words"]
        assert len(words) == 256 and (n > 0) == any(words)


def test_history_is_reduced_below_the_exchanges(spark, no_broadcast):
    """Bounds and filter stand between the scan and the exchange of both large joins, and drop rows there."""
    df = q_shipment_assembly_week(spark, SF_SMALL)
    lines = _plan(df).split("Subqueries")[0].splitlines()
    for key in ("[_shipping_package_shipping_address_id#", "[_shipping_package_sale_order_id#"):
        join = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x and key in x)
        below = _subtree(lines, join)
        filters = [i for i, x in enumerate(below) if "Filter" in x and "xxhash64" in x]
        assert filters, key
        exchanges = [i for i, x in enumerate(below) if "Exchange hashpartitioning" in x]
        assert any(e < filters[0] for e in exchanges)


def test_reduced_and_plain_assembly_have_the_same_rows(spark):
    import dataclasses

    plain = assembled(spark, SF_SMALL, dataclasses.replace(_WEEK, reduce_history_words=None), encrypted=False)
    reduced = q_shipment_assembly_week(spark, SF_SMALL)
    assert reduced.count() == plain.count() > 0
    assert reduced.exceptAll(plain).count() == 0
    small = assembled(spark, SF_SMALL, dataclasses.replace(_WEEK, reduce_history_words=1), encrypted=False)
    assert small.exceptAll(plain).count() == 0 and small.count() == plain.count()


def test_bucketed_joins_have_no_exchange(spark, no_broadcast):
    df = q_shipment_assembly_bucketed(spark, SF_SMALL)
    lines = _plan(df).splitlines()
    join = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x and "_owner#" in x)
    below = _subtree(lines, join)
    assert sum("SortMergeJoin" in x for x in below) == 1  # orders, below the addresses
    assert not [x for x in below if "Exchange" in x]
    assert sum("Bucketed: true" in x or "SelectedBucketsCount" in x for x in below) == 3


def test_addresses_of_several_orders_and_orders_of_several_addresses(spark):
    """Neither key follows from the other; null ids join nothing."""
    rng = random.Random(2)
    t = D.source_tables(spark, SF_SMALL)
    mixed = t["shipping_package"].withColumns(
        {
            "shipping_address_id": F.when(F.col("facility_id") == 3, F.lit(None)).otherwise(F.pmod(F.xxhash64("code"), F.lit(1500)) + 1),
            "sale_order_id": F.when(F.col("facility_id") == 4, F.lit(None)).otherwise(F.pmod(F.xxhash64("code", F.lit(rng.randrange(9))), F.lit(700)) + 1),
        }
    )
    t = {**t, "shipping_package": mixed}
    from addrflow.operators.assemble import assemble_shipments

    want = assemble_shipments(**t, cfg=CFG)
    staged = stage_bucketed(t, 7, "test")
    got = assemble_bucketed(staged.tables(), CFG)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
    staged.drop()
    with pytest.raises(Exception):  # noqa: B017  the tables are gone
        staged.tables()
