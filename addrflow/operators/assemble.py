"""Shipment assembly: shipment, address, order, tenant, facility and party joined and filtered.

Input tables use the source schema's names (``SOURCE_COLUMNS``, ``SOURCE_JOINS``); ``address_detail``
may lack ``district`` and ``channel_source_code``.

Filters are written against each input before its join, so they reach the scans. The small tables
are joined first: tenants to their orders (which drops the orders of excluded tenants) and facilities
with their parties to the shipments, so rows that go never pass the two large joins. How each join
runs is left to Catalyst and adaptive execution, which know the sizes in bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrflow.config import JobConfig
from addrflow.operators.filters import (
    canonical_rows,
    country_kept,
    in_window,
    phone_kept,
    status_kept,
    tenant_kept,
)
from addrflow.operators.reduce import keep_possible
from addrflow.schema import SOURCE_COLUMNS, SOURCE_JOINS


def _key(table: str, column: str) -> str:
    return f"_{table}_{column}"


def _side(df: DataFrame, table: str, *more: str) -> DataFrame:
    """The columns of ``table`` that the row or a join needs, under their final names, and ``more``."""
    fields = [
        (F.col(c) if c in df.columns else F.lit("")).alias(f) for f, (t, c) in SOURCE_COLUMNS.items() if t == table
    ]
    ends = [(t, c) for a, b, x, y in SOURCE_JOINS for t, c in ((a, b), (x, y)) if t == table]
    return df.select(*fields, *[F.col(c).alias(_key(t, c)) for t, c in dict.fromkeys(ends)], *more)


def _sides(
    shipping_package: DataFrame,
    address_detail: DataFrame,
    sale_order: DataFrame,
    tenant: DataFrame,
    facility: DataFrame,
    party: DataFrame,
    cfg: JobConfig,
) -> dict[str, DataFrame]:
    """The inputs, each with the filters that concern it alone."""
    created = shipping_package.schema["created"].dataType
    shipments = shipping_package.filter(
        status_kept(F.col("status_code"), cfg) & in_window(F.col("created"), created, cfg.from_ts, cfg.till_ts)
    )
    words = cfg.reduce_history_words
    if words:
        address_detail = keep_possible(address_detail, "id", shipments, "shipping_address_id", words)
        sale_order = keep_possible(sale_order, "id", shipments, "sale_order_id", words)
    return {
        "shipping_package": shipments,
        "address_detail": address_detail.filter(
            country_kept(F.col("country_code"), cfg) & phone_kept(F.col("phone"), cfg)
        ),
        "sale_order": sale_order,
        "tenant": tenant.filter(tenant_kept(F.col("code"), cfg)),
        "facility": facility,
        "party": party,
    }


def _ends() -> dict[str, Column]:
    """The join condition that brings in each table."""
    return {t: F.col(_key(t, c)) == F.col(_key(other, oc)) for t, c, other, oc in SOURCE_JOINS}


def _canonical(rows: DataFrame, cfg: JobConfig) -> DataFrame:
    return canonical_rows(rows.withColumn("sale_order_sync_status", F.lit(cfg.sync_status)), cfg.timestamp_format)


def assemble_shipments(
    shipping_package: DataFrame,
    address_detail: DataFrame,
    sale_order: DataFrame,
    tenant: DataFrame,
    facility: DataFrame,
    party: DataFrame,
    cfg: JobConfig,
) -> DataFrame:
    """Canonical shipment rows (22 strings) of the run window."""
    sides = _sides(shipping_package, address_detail, sale_order, tenant, facility, party, cfg)
    sides = {t: _side(df, t) for t, df in sides.items()}
    ends = _ends()
    places = sides["facility"].join(sides["party"], ends["party"])
    orders = sides["sale_order"].join(sides["tenant"], ends["tenant"])
    shipments = sides["shipping_package"].join(places, ends["facility"])
    rows = shipments.join(sides["address_detail"], ends["address_detail"]).join(orders, ends["sale_order"])
    return _canonical(rows, cfg)


def assemble_bucketed(tables: dict[str, DataFrame], cfg: JobConfig) -> DataFrame:
    """``assemble_shipments`` on tables of ``sources/bucketed.py``: both large joins within buckets.

    Shipments, orders and addresses lie in buckets of the order id, so the two large joins come first
    and read bucket by bucket. An order has few addresses; which of them is a shipment's is no join key
    (that would ask for an exchange by both ids) but checked on each pair of an order's rows.
    """
    sides = _sides(**{t: df for t, df in tables.items()}, cfg=cfg)
    owner = sides["address_detail"].select("*", F.col("owner_order_id").alias("_owner"))
    sides = {t: _side(df, t) for t, df in sides.items() if t != "address_detail"}
    addresses = _side(owner, "address_detail", "_owner")
    ends = _ends()
    used = F.array_contains(F.array(F.col(_key("address_detail", "id"))), F.col(_key("shipping_package", "shipping_address_id")))
    rows = sides["shipping_package"].join(sides["sale_order"], ends["sale_order"])
    rows = rows.join(addresses, (F.col(_key("shipping_package", "sale_order_id")) == F.col("_owner")) & used)
    places = sides["facility"].join(sides["party"], ends["party"])
    return _canonical(rows.join(sides["tenant"], ends["tenant"]).join(places, ends["facility"]), cfg)
