"""Source tables stored in buckets of the order id, for many windows over one history.

A run joins shipments with orders and with addresses, by two different keys, so tables stored by their
own ids leave one exchange of the shipments at least. Here an address is stored with each order that ships
to it (once for every pair of address and order, few beside the shipments), and all three large tables
lie in as many buckets of the order id, sorted within. Then both joins of every later window read bucket
by bucket, without an exchange (``operators/assemble.py:assemble_bucketed``). The exchanges are paid
once, here.

A bucket is one task of a join. Unlike a shuffled join's partition it is not split at run time, so an order
with a large share of the rows makes a large bucket; orders have few shipments, which is why they and
no tenant or address are the bucket key.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrflow.session import drop_staged, staging_path

#: Bucket key of each large table.
KEYS = {"shipping_package": "sale_order_id", "sale_order": "id", "address_detail": "owner_order_id"}


@dataclass
class BucketedSources:
    """Tables of the session's catalog, under a folder of their own."""

    spark: SparkSession
    path: str
    names: dict[str, str] = field(default_factory=dict)  # source table -> catalog table
    small: dict[str, DataFrame] = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        return {**{t: self.spark.table(n) for t, n in self.names.items()}, **self.small}

    def drop(self) -> None:
        """The catalog tables and their files (they hold personal data)."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_staged(self.spark, self.path)


def stage_bucketed(tables: dict[str, DataFrame], buckets: int, name: str = "sources") -> BucketedSources:
    """Store the large ones of the six source tables by order id; the small ones stay as they are.

    Addresses that no shipment uses are not stored. Every bucket is one file, written by one task.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    shipments = tables["shipping_package"]
    spark = shipments.sparkSession
    uses = shipments.select(F.col("sale_order_id").alias("owner_order_id"), F.col("shipping_address_id").alias("_used")).distinct()
    addresses = tables["address_detail"]
    large = {
        "shipping_package": shipments.filter(F.col("sale_order_id").isNotNull()),
        "sale_order": tables["sale_order"].filter(F.col("id").isNotNull()),
        "address_detail": addresses.join(uses, F.col("id") == F.col("_used")).drop("_used").filter(F.col("owner_order_id").isNotNull()),
    }
    out = BucketedSources(spark, staging_path(spark, f"buckets-{name}"), small={t: df for t, df in tables.items() if t not in KEYS})
    run = uuid.uuid4().hex
    for table, df in large.items():
        key = KEYS[table]
        out.names[table] = f"addrflow_{table}_{run}"
        dealt = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        dealt.option("path", f"{out.path}/{table}").format("parquet").saveAsTable(out.names[table])
    return out
