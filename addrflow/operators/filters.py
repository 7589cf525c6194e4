"""Row filters of the source query and the shape fixes applied right after a read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrflow.config import JobConfig
from addrflow.functions.cipher import CIPHER_PREFIX
from addrflow.schema import OPTIONAL_FIELDS, SHIPMENT_FIELDS


def in_window(c: Column, dtype: T.DataType, from_ts: str, till_ts: str) -> Column:
    """Half-open window ``from <= c < till``; bounds are cast to the column's own type."""
    return (c >= F.lit(from_ts).cast(dtype)) & (c < F.lit(till_ts).cast(dtype))


def status_kept(c: Column, cfg: JobConfig) -> Column:
    return c.isin(*cfg.statuses)


def tenant_kept(c: Column, cfg: JobConfig) -> Column:
    """NOT IN the excluded tenants; a NULL tenant is dropped as in SQL."""
    kept = c.isNotNull()
    return kept & ~c.isin(*cfg.excluded_tenants) if cfg.excluded_tenants else kept


def country_kept(c: Column, cfg: JobConfig) -> Column:
    if cfg.country_collation:
        return F.collate(c, cfg.country_collation) == F.lit(cfg.country)
    return c == F.lit(cfg.country)


def phone_kept(c: Column, cfg: JobConfig) -> Column:
    """Raw phone neither masked (leading '*') nor a placeholder; NULL drops the row."""
    return ~c.like("*%") & ~c.isin(*cfg.placeholder_phones)


def is_cipher_row(mobile: Column) -> Column:
    """A row is encrypted when its mobile is ciphertext (a NULL mobile is plain)."""
    return mobile.isNotNull() & mobile.startswith(CIPHER_PREFIX)


def with_optional_columns(df: DataFrame) -> DataFrame:
    """A source without ``district`` gets '' for both district and channel_source_code."""
    if "district" in df.columns:
        return df
    return df.withColumns({c: F.lit("") for c in OPTIONAL_FIELDS})


def as_text(df: DataFrame, fmt: str | None = None) -> DataFrame:
    """Every column as a string; timestamps rendered with ``fmt`` (None: Spark's cast to string)."""
    cols = []
    for f in df.schema.fields:
        if fmt and isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            cols.append(F.date_format(F.col(f.name), fmt).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            cols.append(F.col(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*cols)


def fill_missing_text(df: DataFrame) -> DataFrame:
    """String NULLs become '' (other types untouched)."""
    return df.na.fill("")


def canonical_rows(df: DataFrame, fmt: str | None = None) -> DataFrame:
    """Canonical shipment rows: optional columns added, text typed, NULLs filled, fields ordered."""
    return fill_missing_text(as_text(with_optional_columns(df), fmt)).select(*SHIPMENT_FIELDS)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns a source lacks become '' (the same lazily built plan).

    Pairs of frames are joined level by level: a plan as deep as the logarithm of their number,
    which the analyser walks once per level instead of once per frame.
    """
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1], allowMissingColumns=True) if len(p) == 2 else p[0] for p in pairs]
    return fill_missing_text(frames[0])
