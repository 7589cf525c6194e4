"""The source job's tables expressed over the benchmark parquet tables.

Mapping (see FIXTURES.md): shipments are ``lineitem`` rows, sale orders and delivery addresses come
from ``orders``, tenants are ``customer`` rows (code = market segment), facilities and parties are
``supplier`` rows. Contact columns are synthesised from the keys with fixed rules so that every
case of the cleanup (prefixes, masks, placeholders, bad e-mails, pincodes with spaces, ...) occurs.
Every frame here is a projection of whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrflow.functions.cipher import encrypt_value

BACKSLASH_N = "\\N"

# Tables whose rows carry the per-row work (dimension tables are only probed or broadcast).
FACT_TABLES = frozenset({"lineitem", "orders", "documents", "events", "pages", "conversations"})


def spread_over_cores(df: DataFrame) -> DataFrame:
    """A scan with fewer splits than the session has cores, dealt over them (one round-robin shuffle).

    The test tables are one file each, hence one task; production reads have their own splits and
    don't come through here.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


@functools.lru_cache(maxsize=64)
def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One scan definition per (session, table); a fact table of few splits is spread over the cores."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_over_cores(df) if name in FACT_TABLES else df


def _lp(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _case(key: Column, mod: int, branches: list[Column], default: Column) -> Column:
    """CASE key % mod WHEN 0 THEN b0 WHEN 1 THEN b1 ... ELSE default END."""
    r = key % mod
    out = F.when(r == 0, branches[0])
    for i, b in enumerate(branches[1:], start=1):
        out = out.when(r == i, b)
    return out.otherwise(default)


def _null() -> Column:
    return F.lit(None).cast("string")


def phone_expr(ok: Column, ck: Column) -> Column:
    """Raw delivery phone: twelve variants keyed by order key."""
    return _case(
        ok,
        12,
        [
            F.concat(F.lit("9"), _lp(ck, 9)),
            F.concat(F.lit("08"), _lp(ck, 9)),
            F.concat(F.lit("+91 7"), _lp(ck, 9)),
            F.concat(F.lit("916"), _lp(ck, 9)),
            F.concat(F.lit("98765-"), _lp(ck, 5)),
            F.concat(F.lit("9"), _lp(ck, 9), F.lit(", 08"), _lp(ok, 9), F.lit(",")),
            F.concat(F.lit("*****"), _lp(ck, 5)),
            F.lit("9999999999"),
            F.lit("12345"),
            F.lit(""),
            F.concat(F.lit("Ph:9"), _lp(ck, 9), F.lit("(M)")),
        ],
        F.lit(BACKSLASH_N),
    )


def notification_mobile_expr(ok: Column, ck: Column) -> Column:
    return _case(
        ok,
        5,
        [F.concat(F.lit("9"), _lp(ck, 9)), _null(), F.concat(F.lit("7"), _lp(ok, 9))],
        F.lit("(+91)9876543210"),
    )


def email_expr(ok: Column, ck: Column) -> Column:
    return _case(
        ok,
        7,
        [
            F.concat(F.lit("c"), ck.cast("string"), F.lit("@example.com")),
            F.lit("bad@@x"),
            F.lit(""),
            F.concat(F.lit("a b"), ck.cast("string"), F.lit("@example.in")),
            F.lit("a..b@c.d"),
            F.lit("u@localhost"),
        ],
        F.lit(BACKSLASH_N),
    )


def notification_email_expr(ok: Column, ck: Column) -> Column:
    return _case(
        ok,
        13,
        [
            F.concat(F.lit("c"), ck.cast("string"), F.lit("@example.com")),
            F.lit(""),
            F.lit(""),
            F.lit("x@"),
            F.lit("a@b_c.d"),
            _null(),
            F.lit(""),
        ],
        F.concat(F.lit("n"), ok.cast("string"), F.lit("@example.org")),
    )


def pincode_expr(ok: Column, ck: Column) -> Column:
    return _case(
        ok,
        11,
        [
            F.lit("560 001"),
            F.lit("012345"),
            F.lit("5600"),
            F.concat(F.lit(" 400"), F.lit("\t"), F.lit("070 ")),
            F.lit("PO1234"),
            F.lit(BACKSLASH_N),
            _null(),
        ],
        (F.lit(100000) + ck).cast("string"),
    )


def fixture_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders ⋈ customer ⋈ nation with synthesised contact columns (FIXTURES.md §3, plus text fields)."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    return (
        o.join(c, ck == F.col("c_custkey"))
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            ok.alias("shipment_id"),
            F.col("o_orderdate").alias("created"),
            F.col("c_mktsegment").alias("tenant_code"),
            F.col("n_name").alias("city"),
            phone_expr(ok, ck).alias("mobile"),
            notification_mobile_expr(ok, ck).alias("notification_mobile"),
            email_expr(ok, ck).alias("email"),
            notification_email_expr(ok, ck).alias("notification_email"),
            pincode_expr(ok, ck).alias("pincode"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("  "), F.col("c_name"), F.lit(", ")).alias("address_line1"),
            _case(ok, 3, [F.lit("nan"), F.lit(BACKSLASH_N)], F.col("o_orderpriority")).alias("address_line2"),
            F.col("o_orderstatus").alias("sale_order_status"),
        )
    )


def fixture_rows(fixture: DataFrame) -> DataFrame:
    """Fixture -> the 22 shipment columns (no district column: the optional-column rule fills it)."""
    return fixture.select(
        "name",
        "mobile",
        "notification_mobile",
        "email",
        "notification_email",
        "address_line1",
        "address_line2",
        "city",
        F.lit("KA").alias("state_code"),
        F.lit("in").alias("country_code"),
        "pincode",
        F.col("created").alias("sp_created"),
        F.col("created").alias("sp_updated"),
        "tenant_code",
        F.col("city").alias("facility_code"),
        F.col("shipment_id").alias("shipping_package_code"),
        F.lit("DELIVERED").alias("shipping_package_status"),
        F.col("shipment_id").alias("sale_order_code"),
        "sale_order_status",
        F.lit("UNKNOWN").alias("sale_order_sync_status"),
    )


def pincode_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup table ``Pincode``: one code per region (PO1234, PO2345, ...)."""
    r = read_table(spark, sf_dir, "region")
    return r.select(F.concat(F.lit("PO"), (F.lit(1234) + F.col("r_regionkey") * 1111).cast("string")).alias("Pincode"))


# --- source tables of the assembly ---------------------------------------------------------

_STATUS = {
    ("R", "F"): "RETURNED",
    ("R", "O"): "RETURN_EXPECTED",
    ("A", "F"): "DELIVERED",
    ("A", "O"): "SHIPPED",
    ("N", "F"): "MANIFESTED",
    ("N", "O"): "CREATED",
}


def status_expr(flag: Column, status: Column) -> Column:
    out = None
    for (f, s), v in _STATUS.items():
        cond = (flag == f) & (status == s)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out.otherwise(F.lit("PENDING"))


def country_expr(ok: Column) -> Column:
    return _case(ok, 10, [F.lit("US"), F.lit("in")], F.lit("IN"))


def shipping_package(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("code"),
        F.col("l_orderkey").alias("shipping_address_id"),
        F.col("l_orderkey").alias("sale_order_id"),
        F.col("l_suppkey").alias("facility_id"),
        status_expr(F.col("l_returnflag"), F.col("l_linestatus")).alias("status_code"),
        F.col("l_shipdate").alias("created"),
        F.col("l_shipdate").alias("updated"),
    )


def address_detail(spark: SparkSession, sf_dir: str, with_district: bool = True, encrypted: bool = False) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    seal = _sealer(encrypted)
    phone = seal(phone_expr(ok, ck))
    if encrypted:
        # The assembly filters the phone. Through a plain projection, Catalyst would substitute the
        # sealing expression into that filter (twice), so each phone would be encrypted three
        # times. A stored column is read once: emit the sealed phone from a one-field generator,
        # which a filter cannot be pushed below. Other columns are sealed after the filter.
        o = o.select("*", F.inline(F.array(F.struct(phone.alias("_phone")))))
        phone = F.col("_phone")
    cols = [
        ok.alias("id"),
        seal(F.concat(F.lit("Customer#"), _lp(ck, 9))).alias("name"),
        phone.alias("phone"),
        seal(email_expr(ok, ck)).alias("email"),
        seal(F.concat(F.lit(" Plot "), (ok % 500).cast("string"), F.lit(", "))).alias("address_line1"),
        seal(_case(ok, 3, [F.lit("nan"), F.lit(BACKSLASH_N)], F.col("o_orderpriority"))).alias("address_line2"),
        F.concat(F.lit("City\u0007"), (ck % 97).cast("string")).alias("city"),
    ]
    if with_district:
        cols.append(_case(ok, 4, [F.lit(" North,"), _null()], F.lit("Central")).alias("district"))
    cols += [
        F.lit("KA").alias("state_code"),
        country_expr(ok).alias("country_code"),
        pincode_expr(ok, ck).alias("pincode"),
    ]
    if with_district:
        cols.append(F.col("o_orderpriority").alias("channel_source_code"))
    return o.select(*cols)


def sale_order(spark: SparkSession, sf_dir: str, encrypted: bool = False) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    seal = _sealer(encrypted)
    return o.select(
        ok.alias("id"),
        F.concat(F.lit("SO-"), ok.cast("string")).alias("code"),
        ck.alias("tenant_id"),
        F.col("o_orderstatus").alias("status_code"),
        seal(notification_mobile_expr(ok, ck)).alias("notification_mobile"),
        seal(notification_email_expr(ok, ck)).alias("notification_email"),
    )


def tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("code"))


def facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))


def party(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("code"))


def source_tables(
    spark: SparkSession, sf_dir: str, with_district: bool = True, encrypted: bool = False
) -> dict[str, DataFrame]:
    """The six source tables; with ``encrypted`` the contact columns are stored as ciphertext."""
    return {
        "shipping_package": shipping_package(spark, sf_dir),
        "address_detail": address_detail(spark, sf_dir, with_district, encrypted),
        "sale_order": sale_order(spark, sf_dir, encrypted),
        "tenant": tenant(spark, sf_dir),
        "facility": facility(spark, sf_dir),
        "party": party(spark, sf_dir),
    }


# --- encrypted variant: personal columns stored as ciphertext --------------------------------
# Orders of priority 1 and 2 are encrypted under per-alias keys (a short key and a 40-char one),
# priority 3 under the retired alias 2 (payload is plain base64), the rest stay plain.


def alias_expr(priority: Column) -> Column:
    p = F.substring(priority, 1, 1)
    return F.when(p.isin("1", "2"), F.concat(F.lit("k"), p)).when(p == "3", F.lit("2"))


def key_for_alias(alias: Column) -> Column:
    """Test key rule: k1 -> 'key-k1' (6 bytes), k2 -> 40 chars."""
    base = F.concat(F.lit("key-"), alias)
    return F.when(alias == "k2", F.rpad(base, 40, "z")).otherwise(base)


def key_export(spark: SparkSession, sf_dir: str, prefix: str = "keys/", version: str = "1") -> DataFrame:
    """(key_path, keys_json) for the aliases that occur in orders."""
    o = read_table(spark, sf_dir, "orders")
    a = alias_expr(F.col("o_orderpriority"))
    keyed = o.select(a.alias("alias")).filter(F.col("alias").startswith("k")).distinct()
    return keyed.select(
        F.concat(F.lit(prefix), F.col("alias"), F.lit(f"/{version}")).alias("key_path"),
        F.to_json(F.create_map(F.lit(version), key_for_alias(F.col("alias")))).alias("keys_json"),
    )


def _seal(c: Column, alias: Column) -> Column:
    """Store ``c`` as ciphertext under ``alias`` (NULL alias: plain)."""
    retired = F.concat(F.lit("cipher:2:"), F.base64(F.encode(c, "UTF-8")))
    return (
        F.when(alias.isNull() | c.isNull(), c)
        .when(alias == "2", retired)
        .otherwise(encrypt_value(c, alias, key_for_alias(alias)))
    )


def _sealer(encrypted: bool):
    if not encrypted:
        return lambda c: c
    alias = alias_expr(F.col("o_orderpriority"))
    return lambda c: _seal(c, alias)
