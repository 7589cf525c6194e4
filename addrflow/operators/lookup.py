"""Lookup joins: the pincode check, and lookups whose keys are made unique.

No join here carries a hint. Catalyst broadcasts a side that its statistics prove small, adaptive
execution does the same with the sizes it measures, and otherwise both sides are exchanged on the
key, where adaptive execution splits a key that holds a large share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrflow.functions.pincode import clean_pincode, matches_pincode_rule, pincode_ok
from addrflow.functions.text import is_missing


def unique_by(df: DataFrame, key: str, *aggs: Column) -> DataFrame:
    """``df`` grouped by ``key``, so a join on it can never fan out.

    The extra grouping column keeps the aggregation's partitioning from serving as the join's: the
    join then exchanges both sides itself, which is the shape whose skewed partitions adaptive
    execution can split. The lookup is exchanged twice; it is the small side.
    """
    grouped = df.filter(F.col(key).isNotNull()).groupBy(F.xxhash64(key).alias("_group"), key)
    return (grouped.agg(*aggs) if aggs else grouped.agg(F.lit(True).alias("_any")).drop("_any")).drop("_group")


def pincode_lookup_set(pincodes: DataFrame, column: str = "Pincode") -> DataFrame:
    """Distinct lookup values, one row each, so the lookup join can never fan out."""
    return unique_by(pincodes.select(F.col(column).cast("string").alias("_pin_value")), "_pin_value")


def with_pincode_check(df: DataFrame, lookup: DataFrame, column: str = "pincode") -> DataFrame:
    """Clean ``column`` in place and add boolean ``_pincode_ok`` (lookup hit OR rule, and present).

    Only rows that need the lookup (present, failing the rule) carry their pincode as the join key;
    the others have a NULL key, which matches nothing.
    """
    hits = pincode_lookup_set(lookup).withColumn("_pin_hit", F.lit(True))
    pin = F.col(column)
    needs = F.when(~is_missing(pin) & ~matches_pincode_rule(pin), pin)
    cleaned = df.withColumn(column, clean_pincode(pin)).withColumn("_pin_key", needs)
    joined = cleaned.join(hits, F.col("_pin_key") == F.col("_pin_value"), "left")
    return joined.withColumn("_pincode_ok", pincode_ok(pin, F.col("_pin_hit"))).drop("_pin_key", "_pin_value", "_pin_hit")
