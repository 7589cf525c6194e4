"""Pincode rule: six digits, first 1-9, one optional space after the third."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from addrflow.functions.text import compact, is_missing

# Fixed value: the pincode pattern, matched against the whole (space-free) pincode text.
PINCODE = r"^[1-9]{1}[0-9]{2}\s{0,1}[0-9]{3}$"


def clean_pincode(c: Column) -> Column:
    return compact(c)


def matches_pincode_rule(c: Column) -> Column:
    return F.coalesce(c.rlike(PINCODE), F.lit(False))


def pincode_ok(cleaned: Column, in_lookup: Column) -> Column:
    """Valid = present and (listed in the lookup or matching the rule)."""
    return ~is_missing(cleaned) & (F.coalesce(in_lookup, F.lit(False)) | matches_pincode_rule(cleaned))
