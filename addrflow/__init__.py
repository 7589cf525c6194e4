"""addrflow: shipment and delivery-address records -> clean contact records, on Spark.

Every step is a ``DataFrame -> DataFrame`` function built from Spark's own
column expressions, so Catalyst sees one plan from the source scans to the
sink and can push filters, prune columns and pick join strategies itself.
"""

from addrflow.config import JobConfig, KeyPathFormat

__all__ = ["JobConfig", "KeyPathFormat"]
