"""Rows counted by key within one aggregate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The most keys that one observation counts.
MAX_KEYS = 99_999


def counts_by(key: Column, keys: int) -> Column:
    """Rows by key as one aggregate, so that an observation can hold it (null keys count as a key).

    A frequent-items sketch with room for more than twice ``keys`` items never drops one, so while there are
    no more distinct keys than that, its counts are exact.
    """
    if not 0 < keys <= MAX_KEYS:
        raise ValueError(f"between 1 and {MAX_KEYS} keys")
    return F.call_function("approx_top_k", key, F.lit(keys + 1), F.lit(1 << (2 * keys + 8).bit_length()))


def by_key(counted: list | None) -> dict[str, int]:
    """What ``counts_by`` found, without the null key."""
    return {r["item"]: int(r["count"]) for r in counted or [] if r["item"] is not None}
