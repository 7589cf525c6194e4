"""DuckDB SQL text for the checks: the same rules as the Spark column functions, written as SQL.

Only used to build the reference SQL of ``oracle_sql()``; the Spark side never parses SQL text.
Patterns are shared with the Spark functions (Java regex and RE2 read them alike).
"""

from __future__ import annotations

from addrflow.functions.email import EMAIL_RE2
from addrflow.functions.phone import (
    CC_PREFIXED,
    GLUED_WORD,
    MOBILE_TEN,
    NUMBER_BREAK,
    NUMBER_TOKEN,
    PLUS_CC_PREFIXED,
    ZERO_PREFIXED,
)
from addrflow.functions.pincode import PINCODE
from addrflow.functions.text import CONTROL, JAVA_TRIM, TRAILING_COMMA, WHITESPACE

BSN = "chr(92)||'N'"  # the text \N


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def remove_space(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), {lit(WHITESPACE)}, '', 'g')"


def remove_control(x: str) -> str:
    return f"regexp_replace({x}, {lit(CONTROL)}, '', 'g')"


def compact(x: str) -> str:
    return remove_control(remove_space(x))


def is_missing(x: str) -> str:
    return f"({x} IS NULL OR {x} = {BSN} OR {remove_space(x)} = '')"


def clean_field(x: str) -> str:
    inner = f"regexp_replace(regexp_replace({x}, {lit(JAVA_TRIM)}, '', 'g'), {lit(TRAILING_COMMA)}, '')"
    return f"(CASE WHEN {x} IS NULL OR {x} IN ({BSN}, 'nan') THEN '' ELSE {remove_control(inner)} END)"


def digit_count(x: str) -> str:
    return f"length(regexp_replace({x}, '\\P{{Nd}}', '', 'g'))"


def strip_prefix(x: str) -> str:
    return (
        f"(CASE WHEN regexp_matches({x}, {lit(ZERO_PREFIXED)}) THEN substr({x}, 2)"
        f" WHEN regexp_matches({x}, {lit(PLUS_CC_PREFIXED)}) THEN substr({x}, 4)"
        f" WHEN regexp_matches({x}, {lit(CC_PREFIXED)}) THEN substr({x}, 3) ELSE {x} END)"
    )


def ten_digits(x: str) -> str:
    return f"(CASE WHEN {digit_count(x)} = 10 THEN regexp_extract({x}, {lit(MOBILE_TEN)}, 0) ELSE '' END)"


def candidates(x: str) -> str:
    return f"list_transform(string_split(replace({remove_space(x)}, '-', ''), ','), lambda p: {strip_prefix('p')})"


def recover_mobiles(x: str) -> str:
    tens = f"list_transform({candidates(x)}, lambda q: {ten_digits('q')})"
    return f"list_transform(list_filter({tens}, lambda t: t <> ''), lambda t: '+91' || t)"


def number_runs(x: str) -> str:
    tokens = f"list_transform(regexp_extract_all({x}, {lit(NUMBER_TOKEN)}), lambda t: regexp_replace(t, {lit(GLUED_WORD)}, ''))"
    return f"list_filter(flatten(list_transform({tokens}, lambda t: string_split_regex(t, {lit(NUMBER_BREAK)}))), lambda r: r <> '')"


def mobile_set(a: str, b: str, recover: bool = True) -> str:
    if not recover:
        return "CAST([] AS VARCHAR[])"
    return f"list_distinct(list_concat({recover_mobiles(a)}, {recover_mobiles(b)}))"


def email_ok(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {lit(EMAIL_RE2)}), false)"


def email_set(a: str, b: str) -> str:
    return (
        f"list_distinct(list_filter([CASE WHEN {email_ok(a)} THEN {a} END, CASE WHEN {email_ok(b)} THEN {b} END],"
        " lambda e: e IS NOT NULL))"
    )


def pincode_rule(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {lit(PINCODE)}), false)"


def sorted_join(lst: str) -> str:
    return f"array_to_string(list_sort({lst}), ',')"


def ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def lp(x: str, n: int) -> str:
    return f"lpad(cast({x} as string), {n}, '0')"


# --- synthesised source columns (the same rules as sources/driver_tables.py) ----------------


def phone_sql(ok: str = "o_orderkey", ck: str = "o_custkey") -> str:
    return f"""CASE {ok} % 12
  WHEN 0 THEN '9'||{lp(ck, 9)}
  WHEN 1 THEN '08'||{lp(ck, 9)}
  WHEN 2 THEN '+91 7'||{lp(ck, 9)}
  WHEN 3 THEN '916'||{lp(ck, 9)}
  WHEN 4 THEN '98765-'||{lp(ck, 5)}
  WHEN 5 THEN '9'||{lp(ck, 9)}||', 08'||{lp(ok, 9)}||','
  WHEN 6 THEN '*****'||{lp(ck, 5)}
  WHEN 7 THEN '9999999999'
  WHEN 8 THEN '12345'
  WHEN 9 THEN ''
  WHEN 10 THEN 'Ph:9'||{lp(ck, 9)}||'(M)'
  ELSE {BSN} END"""


def notification_mobile_sql(ok: str = "o_orderkey", ck: str = "o_custkey") -> str:
    return (
        f"CASE {ok} % 5 WHEN 0 THEN '9'||{lp(ck, 9)} WHEN 1 THEN cast(null as string)"
        f" WHEN 2 THEN '7'||{lp(ok, 9)} ELSE '(+91)9876543210' END"
    )


def email_sql(ok: str = "o_orderkey", ck: str = "o_custkey") -> str:
    return (
        f"CASE {ok} % 7 WHEN 0 THEN 'c'||cast({ck} as string)||'@example.com' WHEN 1 THEN 'bad@@x' WHEN 2 THEN ''"
        f" WHEN 3 THEN 'a b'||cast({ck} as string)||'@example.in' WHEN 4 THEN 'a..b@c.d' WHEN 5 THEN 'u@localhost'"
        f" ELSE {BSN} END"
    )


def notification_email_sql(ok: str = "o_orderkey", ck: str = "o_custkey") -> str:
    return (
        f"CASE {ok} % 13 WHEN 0 THEN 'c'||cast({ck} as string)||'@example.com' WHEN 1 THEN '' WHEN 2 THEN ''"
        f" WHEN 3 THEN 'x@' WHEN 4 THEN 'a@b_c.d' WHEN 5 THEN cast(null as string) WHEN 6 THEN ''"
        f" ELSE 'n'||cast({ok} as string)||'@example.org' END"
    )


def pincode_sql(ok: str = "o_orderkey", ck: str = "o_custkey") -> str:
    return (
        f"CASE {ok} % 11 WHEN 0 THEN '560 001' WHEN 1 THEN '012345' WHEN 2 THEN '5600'"
        f" WHEN 3 THEN ' 400'||chr(9)||'070 ' WHEN 4 THEN 'PO1234' WHEN 5 THEN {BSN}"
        f" WHEN 6 THEN cast(null as string) ELSE cast(100000+{ck} as string) END"
    )


FIXTURE_SQL = f"""SELECT o_orderkey AS shipment_id, o_orderdate AS created, c_mktsegment AS tenant_code, n_name AS city,
 {phone_sql()} AS mobile,
 {notification_mobile_sql()} AS notification_mobile,
 {email_sql()} AS email,
 {notification_email_sql()} AS notification_email,
 {pincode_sql()} AS pincode,
 c_name AS name, '  '||c_name||', ' AS address_line1,
 CASE o_orderkey % 3 WHEN 0 THEN 'nan' WHEN 1 THEN {BSN} ELSE o_orderpriority END AS address_line2,
 o_orderstatus AS sale_order_status
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey"""

PINCODE_LOOKUP_SQL = "SELECT 'PO' || cast(1234 + r_regionkey * 1111 as string) AS Pincode FROM region"


def fixture_rows_sql(fixture: str = "fx") -> str:
    """Fixture -> the 22 shipment columns, text-typed and NULL-filled (as canonical rows)."""
    cols = [
        "name", "mobile", "notification_mobile", "email", "notification_email", "address_line1", "address_line2",
        "city", "'' AS district", "'KA' AS state_code", "'in' AS country_code", "pincode",
        f"{ts_text('created')} AS sp_created", f"{ts_text('created')} AS sp_updated", "tenant_code",
        "city AS facility_code", "cast(shipment_id as string) AS shipping_package_code",
        "'' AS channel_source_code", "'DELIVERED' AS shipping_package_status",
        "cast(shipment_id as string) AS sale_order_code", "sale_order_status",
        "'UNKNOWN' AS sale_order_sync_status",
    ]
    return f"SELECT {', '.join(cols)} FROM {fixture}"


def filled(name: str) -> str:
    return f"coalesce({name}, '') AS {name}"


def contacts_sql(rows: str, run_ts: str, recover: bool = True, lookup: str = "lk") -> str:
    """Canonical shipment rows (CTE ``rows``) -> contact rows, as one SELECT."""
    cleaned = f"""SELECT remove_ctl_name AS name,
  {compact('mobile')} AS mobile, {compact('notification_mobile')} AS notification_mobile,
  {compact('email')} AS email, {compact('notification_email')} AS notification_email,
  {clean_field('address_line1')} AS address_line1, {clean_field('address_line2')} AS address_line2,
  {clean_field('city')} AS city, {clean_field('district')} AS district, {clean_field('state_code')} AS state_code,
  upper({compact('country_code')}) AS country_code, {compact('pincode')} AS pincode,
  sp_created, sp_updated, tenant_code, facility_code, shipping_package_code, channel_source_code,
  shipping_package_status, sale_order_code, sale_order_status, sale_order_sync_status
FROM (SELECT *, {remove_control('name')} AS remove_ctl_name FROM {rows})"""
    checked = f"""SELECT c.* FROM ({cleaned}) c
LEFT JOIN (SELECT DISTINCT cast(Pincode as string) AS pin_value FROM {lookup} WHERE Pincode IS NOT NULL) l
  ON c.pincode = l.pin_value
WHERE NOT {is_missing('c.pincode')} AND (l.pin_value IS NOT NULL OR {pincode_rule('c.pincode')})"""
    sets = f"""SELECT *, {mobile_set('mobile', 'notification_mobile', recover)} AS ms,
  {email_set('email', 'notification_email')} AS es FROM ({checked})"""
    return f"""SELECT true AS enabled, {lit(run_ts)} AS record_created, {lit(run_ts)} AS record_updated,
  m.contact_mobile, e.contact_email, name, address_line1, address_line2, city, district, state_code, country_code,
  pincode, sp_created, sp_updated, tenant_code, facility_code, shipping_package_code, channel_source_code,
  shipping_package_status, sale_order_code, sale_order_status, sale_order_sync_status
FROM ({sets}) s,
  unnest(CASE WHEN len(s.ms) = 0 THEN [''] ELSE s.ms END) AS m(contact_mobile),
  unnest(CASE WHEN len(s.es) = 0 THEN [''] ELSE s.es END) AS e(contact_email)
WHERE len(s.ms) + len(s.es) > 0"""


# --- assembly over lineitem/orders/customer/supplier ------------------------------------------

STATUS_SQL = (
    "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'RETURNED'"
    " WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'RETURN_EXPECTED'"
    " WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'DELIVERED'"
    " WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'SHIPPED'"
    " WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'MANIFESTED'"
    " WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'CREATED' ELSE 'PENDING' END"
)
ALIAS_SQL = (
    "CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'k' || substr(o_orderpriority, 1, 1)"
    " WHEN substr(o_orderpriority, 1, 1) = '3' THEN '2' END"
)
KEY_FOR_ALIAS_SQL = "CASE {a} WHEN 'k1' THEN 'key-k1' WHEN 'k2' THEN rpad('key-k2', 40, 'z') END"


def retired(x: str, alias: str = "_alias") -> str:
    """Value as stored (and kept) under the retired alias 2."""
    return f"(CASE WHEN {alias} = '2' AND {x} IS NOT NULL THEN 'cipher:2:' || to_base64(encode({x})) ELSE {x} END)"


def assembly_ctes(cfg, with_district: bool = True) -> str:
    district = "CASE o_orderkey % 4 WHEN 0 THEN ' North,' WHEN 1 THEN cast(null as string) ELSE 'Central' END"
    return f"""sp AS (SELECT cast(l_orderkey as string)||'-'||cast(l_linenumber as string) AS code,
  l_orderkey AS shipping_address_id, l_orderkey AS sale_order_id, l_suppkey AS facility_id,
  {STATUS_SQL} AS status_code, l_shipdate AS created, l_shipdate AS updated FROM lineitem),
ad AS (SELECT o_orderkey AS id, 'Customer#'||{lp('o_custkey', 9)} AS name, {phone_sql()} AS phone,
  {email_sql()} AS email, ' Plot '||cast(o_orderkey % 500 as string)||', ' AS address_line1,
  CASE o_orderkey % 3 WHEN 0 THEN 'nan' WHEN 1 THEN {BSN} ELSE o_orderpriority END AS address_line2,
  'City'||chr(7)||cast(o_custkey % 97 as string) AS city,
  {district if with_district else "''"} AS district, 'KA' AS state_code,
  CASE o_orderkey % 10 WHEN 0 THEN 'US' WHEN 1 THEN 'in' ELSE 'IN' END AS country_code,
  {pincode_sql()} AS pincode, {"o_orderpriority" if with_district else "''"} AS channel_source_code,
  {ALIAS_SQL} AS _alias FROM orders),
so AS (SELECT o_orderkey AS id, 'SO-'||cast(o_orderkey as string) AS code, o_custkey AS tenant_id,
  o_orderstatus AS status_code, {notification_mobile_sql()} AS notification_mobile,
  {notification_email_sql()} AS notification_email FROM orders),
tn AS (SELECT c_custkey AS id, c_mktsegment AS code FROM customer)"""


def assembly_select(cfg, encrypted: bool, decrypted: bool = True) -> str:
    """Assembled canonical rows. ``encrypted``: source contact columns are ciphertext, so the raw
    phone filters never drop an encrypted row; after decryption only alias-2 values differ."""

    def v(x: str) -> str:
        return f"coalesce({retired(x) if encrypted and decrypted else x}, '')"

    phone_ok = f"(ad.phone NOT LIKE '*%' AND ad.phone NOT IN {in_list(cfg.placeholder_phones)})"
    if encrypted:
        phone_ok = f"(ad._alias IS NOT NULL OR {phone_ok})"
    country_ok = (
        f"lower(ad.country_code) = lower({lit(cfg.country)})" if cfg.country_collation else f"ad.country_code = {lit(cfg.country)}"
    )
    tenant_ok = "tn.code IS NOT NULL" + (
        f" AND tn.code NOT IN {in_list(cfg.excluded_tenants)}" if cfg.excluded_tenants else ""
    )
    return f"""SELECT {v('ad.name')} AS name, {v('ad.phone')} AS mobile, {v('so.notification_mobile')} AS notification_mobile,
  {v('ad.email')} AS email, {v('so.notification_email')} AS notification_email,
  {v('ad.address_line1')} AS address_line1, {v('ad.address_line2')} AS address_line2,
  coalesce(ad.city, '') AS city, coalesce(ad.district, '') AS district, coalesce(ad.state_code, '') AS state_code,
  coalesce(ad.country_code, '') AS country_code, coalesce(ad.pincode, '') AS pincode,
  {ts_text('sp.created')} AS sp_created, {ts_text('sp.updated')} AS sp_updated, tn.code AS tenant_code,
  p.s_name AS facility_code, sp.code AS shipping_package_code, coalesce(ad.channel_source_code, '') AS channel_source_code,
  sp.status_code AS shipping_package_status, so.code AS sale_order_code, so.status_code AS sale_order_status,
  {lit(cfg.sync_status)} AS sale_order_sync_status, ad._alias AS _alias
FROM sp JOIN ad ON ad.id = sp.shipping_address_id JOIN so ON sp.sale_order_id = so.id
  JOIN tn ON tn.id = so.tenant_id JOIN supplier f ON f.s_suppkey = sp.facility_id
  JOIN supplier p ON f.s_suppkey = p.s_suppkey
WHERE sp.status_code IN {in_list(cfg.statuses)} AND {tenant_ok}
  AND sp.created >= TIMESTAMP {lit(cfg.from_ts)} AND sp.created < TIMESTAMP {lit(cfg.till_ts)}
  AND {country_ok} AND {phone_ok}"""


SHIPMENT_COLS = (
    "name, mobile, notification_mobile, email, notification_email, address_line1, address_line2, city, district, "
    "state_code, country_code, pincode, sp_created, sp_updated, tenant_code, facility_code, shipping_package_code, "
    "channel_source_code, shipping_package_status, sale_order_code, sale_order_status, sale_order_sync_status"
)
