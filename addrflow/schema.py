"""Row layouts of the pipeline (all text columns are strings, as in the source job)."""

from __future__ import annotations

from pyspark.sql import types as T

# The names and their order are the data contract of the rows.
# Canonical shipment row: the order of this list is the union and output order.
SHIPMENT_FIELDS: tuple[str, ...] = (
    "name",
    "mobile",
    "notification_mobile",
    "email",
    "notification_email",
    "address_line1",
    "address_line2",
    "city",
    "district",
    "state_code",
    "country_code",
    "pincode",
    "sp_created",
    "sp_updated",
    "tenant_code",
    "facility_code",
    "shipping_package_code",
    "channel_source_code",
    "shipping_package_status",
    "sale_order_code",
    "sale_order_status",
    "sale_order_sync_status",
)

# Raw contact columns; they are replaced by one contact pair per output row.
CONTACT_INPUT_FIELDS: tuple[str, ...] = ("mobile", "notification_mobile", "email", "notification_email")

# Columns that may hold ciphertext and are decrypted with the row's key.
ENCRYPTED_FIELDS: tuple[str, ...] = (
    "name",
    "mobile",
    "notification_mobile",
    "email",
    "notification_email",
    "address_line1",
    "address_line2",
)

# Columns a source may lack; they are filled with '' (district and channel go together).
OPTIONAL_FIELDS: tuple[str, ...] = ("district", "channel_source_code")

CONTACT_HEAD: tuple[str, ...] = ("enabled", "record_created", "record_updated", "contact_mobile", "contact_email")

CONTACT_FIELDS: tuple[str, ...] = CONTACT_HEAD + tuple(f for f in SHIPMENT_FIELDS if f not in CONTACT_INPUT_FIELDS)

SHIPMENT_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in SHIPMENT_FIELDS])

# Where each field of a shipment row comes from: field -> (table, column). The names are
# the source databases' own. The statement pushed to a database and the DataFrame assembly are both
# built from this map. sale_order_sync_status is a constant of the run.
SOURCE_COLUMNS: dict[str, tuple[str, str]] = {
    "tenant_code": ("tenant", "code"),
    "facility_code": ("party", "code"),
    "sale_order_code": ("sale_order", "code"),
    "sale_order_status": ("sale_order", "status_code"),
    "notification_email": ("sale_order", "notification_email"),
    "notification_mobile": ("sale_order", "notification_mobile"),
    "shipping_package_code": ("shipping_package", "code"),
    "shipping_package_status": ("shipping_package", "status_code"),
    "sp_created": ("shipping_package", "created"),
    "sp_updated": ("shipping_package", "updated"),
    "mobile": ("address_detail", "phone"),
    **{
        c: ("address_detail", c)
        for c in ("name", "email", "address_line1", "address_line2", "city", "state_code", "country_code", "pincode")
    },
    **{c: ("address_detail", c) for c in OPTIONAL_FIELDS},
}

# (table, its column, table joined before, its column); all are inner joins from shipping_package.
SOURCE_JOINS: tuple[tuple[str, str, str, str], ...] = (
    ("facility", "id", "shipping_package", "facility_id"),
    ("party", "id", "facility", "id"),
    ("sale_order", "id", "shipping_package", "sale_order_id"),
    ("tenant", "id", "sale_order", "tenant_id"),
    ("address_detail", "id", "shipping_package", "shipping_address_id"),
)
