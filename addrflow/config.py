"""Run parameters. Credentials and keys are never part of a config; they come from the caller."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the source job's for equal results.
# Shipment statuses that are read (all others are skipped):
SHIPPED_STATUSES: tuple[str, ...] = (
    "CANCELLED",
    "RETURNED",
    "RETURN_ACKNOWLEDGED",
    "RETURN_EXPECTED",
    "SHIPPED",
    "DISPATCHED",
    "MANIFESTED",
    "DELIVERED",
)
# Placeholder phone numbers; rows whose raw phone equals one of them are skipped:
PLACEHOLDER_PHONES: tuple[str, ...] = (
    "9999999999",
    "0000000000",
    "8888888888",
    "1111111111",
    "9898989898",
    "0123456789",
    "1234567890",
    "0987654321",
    "09999999999",
)
# Sync status written for every assembled row:
DEFAULT_SYNC_STATUS = "UNKNOWN"
# Country whose rows are kept, and the calling code used for E.164 output:
DEFAULT_COUNTRY = "IN"
COUNTRY_CALLING_CODE = "+91"
# System schemas that are never treated as tenant databases:
SYSTEM_SCHEMAS: tuple[str, ...] = ("information_schema", "performance_schema", "mysql", "sys")


@dataclass(frozen=True)
class KeyPathFormat:
    """How a (key alias, tenant) pair names its entry in the caller's key export.

    alias ``1``   -> ``{prefix}{tenant}{tenant_suffix}/1``
    other aliases -> ``{prefix}{alias}/{version}``
    """

    prefix: str = "keys/"
    tenant_suffix: str = "_tenant"
    version: str = "1"


@dataclass(frozen=True)
class JobConfig:
    """One run of the contact job over the half-open window ``[from_ts, till_ts)``."""

    from_ts: str
    till_ts: str
    # One timestamp text stamped on every output row (never the wall clock inside a task).
    run_ts: str
    excluded_tenants: tuple[str, ...] = ()
    statuses: tuple[str, ...] = SHIPPED_STATUSES
    placeholder_phones: tuple[str, ...] = PLACEHOLDER_PHONES
    country: str = DEFAULT_COUNTRY
    # e.g. "UTF8_LCASE" to compare the country like a case-insensitive database collation.
    country_collation: str | None = None
    recover_mobiles: bool = True
    sync_status: str = DEFAULT_SYNC_STATUS
    key_path: KeyPathFormat = field(default_factory=KeyPathFormat)
    # Reduce the address and order history to what the window can meet before it is shuffled: the words
    # of the Bloom filter (operators/reduce.py). None: no reduction. Worth it where the history is
    # much larger than the window; it costs one more narrow scan of the window's shipments.
    reduce_history_words: int | None = None
    # Optional explicit partition count before the row transform (None: leave it to AQE).
    transform_partitions: int | None = None
    # Format of timestamp columns rendered as text; None = Spark's own rendering
    # ("yyyy-MM-dd HH:mm:ss" plus a fraction only when there is one), as a typed decode gives.
    timestamp_format: str | None = None
    system_schemas: tuple[str, ...] = SYSTEM_SCHEMAS


def parse_window_arg(arg: str) -> tuple[str, str]:
    """``"from,till"`` (as passed on the command line) -> (from, till)."""
    parts = [p.strip() for p in arg.split(",")]
    if len(parts) != 2 or not all(parts):
        raise ValueError("expected 'from,till'")
    return parts[0], parts[1]
