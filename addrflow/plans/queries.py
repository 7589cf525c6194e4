"""Named queries over the benchmark tables, each paired with DuckDB SQL that must give the same rows.

Every query reads whole tables (no sampling, id subsets or caps) and returns a total, order-free
result with explicitly named columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from addrflow.config import JobConfig
from addrflow.functions import cipher as C
from addrflow.functions import email as EM
from addrflow.functions import phone as PH
from addrflow.functions import pincode as PC
from addrflow.functions import text as TX
from addrflow.operators import registry as R
from addrflow.operators.assemble import assemble_bucketed, assemble_shipments
from addrflow.operators.contacts import contact_rows
from addrflow.operators.decrypt import decrypt_rows, distinct_key_pairs, key_table
from addrflow.operators.filters import canonical_rows, in_window, is_cipher_row, phone_kept, union_sources
from addrflow.operators.lookup import pincode_lookup_set
from addrflow.operators.metrics import id_bounds, stage_counts
from addrflow.plans import oracle as O
from addrflow.plans.job import tagged_contacts
from addrflow.schema import SHIPMENT_SCHEMA
from addrflow.session import staging_path
from addrflow.sources import driver_tables as D
from addrflow.sources.bucketed import stage_bucketed
from addrflow.sources.files import BAD_LINE, footer_bounds, read_checked_csv

RUN_TS = "2024-01-01T00:00:00"
FROM_TS = "1996-01-01 00:00:00"
TILL_TS = "1999-01-01 00:00:00"
CFG = JobConfig(from_ts=FROM_TS, till_ts=TILL_TS, run_ts=RUN_TS, excluded_tenants=("HOUSEHOLD",))
FIXTURE_CFG = JobConfig(from_ts=FROM_TS, till_ts=TILL_TS, run_ts=RUN_TS)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


# --- fixture slice: orders ⋈ customer ⋈ nation --------------------------------------------------


def fixture_in_window(spark: SparkSession, sf_dir: str, cfg: JobConfig) -> DataFrame:
    fx = D.fixture_shipments(spark, sf_dir)
    created = F.col("created")
    return fx.filter(
        in_window(created, fx.schema["created"].dataType, cfg.from_ts, cfg.till_ts) & phone_kept(F.col("mobile"), cfg)
    )


def _fixture_window_sql(cfg: JobConfig) -> str:
    return f"""fx AS ({O.FIXTURE_SQL}),
fw AS (SELECT * FROM fx WHERE created >= TIMESTAMP {O.lit(cfg.from_ts)} AND created < TIMESTAMP {O.lit(cfg.till_ts)}
  AND mobile NOT LIKE '*%' AND mobile NOT IN {O.in_list(cfg.placeholder_phones)}),
lk AS ({O.PINCODE_LOOKUP_SQL}),
rows AS ({O.fixture_rows_sql('fw')})"""


def _contact_pairs(cfg: JobConfig) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = canonical_rows(D.fixture_rows(fixture_in_window(spark, sf_dir, cfg)), cfg.timestamp_format)
        return contact_rows(rows, D.pincode_lookup(spark, sf_dir), cfg)

    return run


register(
    "contact_pairs",
    f"WITH {_fixture_window_sql(FIXTURE_CFG)}\n{O.contacts_sql('rows', RUN_TS)}",
)(_contact_pairs(FIXTURE_CFG))

_NO_RECOVER = JobConfig(from_ts=FROM_TS, till_ts=TILL_TS, run_ts=RUN_TS, recover_mobiles=False)
register(
    "contact_pairs_no_recover",
    f"WITH {_fixture_window_sql(_NO_RECOVER)}\n{O.contacts_sql('rows', RUN_TS, recover=False)}",
)(_contact_pairs(_NO_RECOVER))


# --- assembly, decryption, end to end ------------------------------------------------------------


def assembled(spark: SparkSession, sf_dir: str, cfg: JobConfig, encrypted: bool, with_district: bool = True):
    t = D.source_tables(spark, sf_dir, with_district=with_district, encrypted=encrypted)
    return assemble_shipments(
        t["shipping_package"], t["address_detail"], t["sale_order"], t["tenant"], t["facility"], t["party"], cfg
    )


def decrypted(spark: SparkSession, sf_dir: str, cfg: JobConfig, flag_failures: bool = False) -> DataFrame:
    rows = assembled(spark, sf_dir, cfg, encrypted=True)
    return decrypt_rows(rows, D.key_export(spark, sf_dir, cfg.key_path.prefix, cfg.key_path.version), cfg, flag_failures)


def _asm_sql(encrypted: bool, decrypted_: bool = True, with_district: bool = True) -> str:
    return f"{O.assembly_ctes(CFG, with_district)},\nasm AS ({O.assembly_select(CFG, encrypted, decrypted_)})"


@register("shipment_assembly", f"WITH {_asm_sql(False)}\nSELECT {O.SHIPMENT_COLS} FROM asm")
def q_shipment_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assembled(spark, sf_dir, CFG, encrypted=False)


_CI = JobConfig(
    from_ts=FROM_TS, till_ts=TILL_TS, run_ts=RUN_TS, excluded_tenants=("HOUSEHOLD",), country_collation="UTF8_LCASE"
)


@register(
    "shipment_assembly_ci",
    f"WITH {O.assembly_ctes(_CI)},\nasm AS ({O.assembly_select(_CI, False)})\nSELECT {O.SHIPMENT_COLS} FROM asm",
)
def q_shipment_assembly_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assembly with the country compared case-insensitively (rows with 'in' are kept too)."""
    return assembled(spark, sf_dir, _CI, encrypted=False)


@register(
    "shipment_assembly_no_district",
    f"WITH {_asm_sql(False, with_district=False)}\nSELECT {O.SHIPMENT_COLS} FROM asm",
)
def q_shipment_assembly_no_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assembly from a source whose addresses lack the optional columns."""
    return assembled(spark, sf_dir, CFG, encrypted=False, with_district=False)


# A week of the history: most addresses and orders belong to no shipment of the window.
_WEEK = JobConfig(
    from_ts="1997-03-03 00:00:00", till_ts="1997-03-10 00:00:00", run_ts=RUN_TS, excluded_tenants=("HOUSEHOLD",),
    reduce_history_words=1 << 14,
)


def _assembly_sql(cfg: JobConfig) -> str:
    return f"WITH {O.assembly_ctes(cfg)},\nasm AS ({O.assembly_select(cfg, False)})\nSELECT {O.SHIPMENT_COLS} FROM asm"


@register("shipment_assembly_week", _assembly_sql(_WEEK))
def q_shipment_assembly_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short window: addresses and orders are reduced to its keys before the large joins."""
    return assembled(spark, sf_dir, _WEEK, encrypted=False)


@register("shipment_assembly_bucketed", _assembly_sql(CFG))
def q_shipment_assembly_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assembly on copies of the source tables in buckets of the order id."""
    staged = stage_bucketed(D.source_tables(spark, sf_dir), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return assemble_bucketed(staged.tables(), CFG)


@register("decrypted_rows", f"WITH {_asm_sql(True)}\nSELECT {O.SHIPMENT_COLS} FROM asm")
def q_decrypted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decrypted(spark, sf_dir, CFG)


@register(
    "shipment_contacts",
    f"WITH {_asm_sql(True)},\nlk AS ({O.PINCODE_LOOKUP_SQL}),\nrows AS (SELECT {O.SHIPMENT_COLS} FROM asm)\n"
    f"{O.contacts_sql('rows', RUN_TS)}",
)
def q_shipment_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assembled(spark, sf_dir, CFG, encrypted=True)
    keys = D.key_export(spark, sf_dir, CFG.key_path.prefix, CFG.key_path.version)
    return contact_rows(rows, D.pincode_lookup(spark, sf_dir), CFG, key_export=keys)


@register(
    "distinct_key_pairs",
    f"WITH {_asm_sql(True, decrypted_=False)}\nSELECT DISTINCT tenant_code, _alias AS key_alias FROM asm "
    "WHERE _alias IS NOT NULL",
)
def q_distinct_key_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_key_pairs(assembled(spark, sf_dir, CFG, encrypted=True))


@register(
    "key_table",
    f"WITH {_asm_sql(True, decrypted_=False)}\nSELECT tenant_code, key_alias, "
    f"{O.KEY_FOR_ALIAS_SQL.format(a='key_alias')} AS vault_key FROM "
    "(SELECT DISTINCT tenant_code, _alias AS key_alias FROM asm WHERE _alias IS NOT NULL)",
)
def q_key_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = distinct_key_pairs(assembled(spark, sf_dir, CFG, encrypted=True))
    return key_table(pairs, D.key_export(spark, sf_dir), CFG.key_path)


@register(
    "multi_source_union",
    f"WITH {_asm_sql(False)},\n{_fixture_window_sql(CFG)},\n"
    f"allrows AS (SELECT {O.SHIPMENT_COLS} FROM asm UNION ALL SELECT {O.SHIPMENT_COLS} FROM rows)\n"
    f"{O.contacts_sql('allrows', RUN_TS)}",
)
def q_multi_source_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assembled(spark, sf_dir, CFG, encrypted=False)
    # The fixture source has no district/channel columns: the union fills them with ''.
    b = canonical_rows(D.fixture_rows(fixture_in_window(spark, sf_dir, CFG)), CFG.timestamp_format)
    return contact_rows(union_sources([a, b]), D.pincode_lookup(spark, sf_dir), CFG)


@register(
    "source_counts",
    f"WITH {_asm_sql(True)},\n{_fixture_window_sql(CFG)},\n"
    f"""one AS ({O.contacts_sql(f"(SELECT {O.SHIPMENT_COLS} FROM asm)", RUN_TS)}),
two AS ({O.contacts_sql('rows', RUN_TS)}),
named AS (SELECT 'servers/main' AS source, * FROM one UNION ALL SELECT 'closed/tenant' AS source, * FROM two)
SELECT source, count(*) AS contact_rows, count(*) FILTER (contact_mobile <> '') AS with_mobile,
  count(*) FILTER (contact_email <> '') AS with_email, count(DISTINCT shipping_package_code) AS shipments FROM named GROUP BY source""",
)
def q_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many sources in one plan, counted by the source of each row; one source is empty."""
    main = assembled(spark, sf_dir, CFG, encrypted=True)
    fixture = D.fixture_rows(fixture_in_window(spark, sf_dir, CFG))
    empty = spark.createDataFrame([], SHIPMENT_SCHEMA)
    sources = {"servers/main": main, "servers/empty": empty, "closed/tenant": fixture}
    contacts = tagged_contacts(sources, D.key_export(spark, sf_dir), D.pincode_lookup(spark, sf_dir), CFG)
    return contacts.groupBy("source").agg(
        F.count("*").alias("contact_rows"),
        F.count_if(F.col("contact_mobile") != "").alias("with_mobile"),
        F.count_if(F.col("contact_email") != "").alias("with_email"),
        F.count_distinct("shipping_package_code").alias("shipments"),
    )


_DEALT = JobConfig(from_ts=FROM_TS, till_ts=TILL_TS, run_ts=RUN_TS, transform_partitions=5)
register("contact_pairs_repartitioned", f"WITH {_fixture_window_sql(_DEALT)}\n{O.contacts_sql('rows', RUN_TS)}")(_contact_pairs(_DEALT))


# --- column functions over whole tables -------------------------------------------------------


def _joined(arr) -> "F.Column":
    return F.array_join(arr, "|")


@register(
    "text_cleanup",
    f"""SELECT doc_id,
  length({O.remove_space('text')}) AS space_free_len,
  md5({O.remove_space('text')}) AS space_free_md5,
  length({O.remove_control('text')}) AS control_free_len,
  md5({O.clean_field('text')}) AS clean_md5,
  length(replace(text, '-', '')) AS hyphen_free_len,
  {O.is_missing('text')} AS is_missing,
  upper({O.compact('lang')}) AS lang_norm,
  coalesce(upper(lang) = 'EN', false) AS is_en
FROM documents""",
)
def q_text_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = D.read_table(spark, sf_dir, "documents")
    t = F.col("text")
    return d.select(
        "doc_id",
        F.length(TX.remove_space(t)).cast("long").alias("space_free_len"),
        F.md5(TX.remove_space(t)).alias("space_free_md5"),
        F.length(TX.remove_control(t)).cast("long").alias("control_free_len"),
        F.md5(TX.clean_field(t)).alias("clean_md5"),
        F.length(TX.remove_hyphen(t)).cast("long").alias("hyphen_free_len"),
        TX.is_missing(t).alias("is_missing"),
        TX.normalize_country(F.col("lang")).alias("lang_norm"),
        TX.is_country(F.col("lang"), "EN").alias("is_en"),
    )


@register(
    "field_cleanup",
    f"""WITH fx AS ({O.FIXTURE_SQL})
SELECT shipment_id, {O.clean_field('address_line1')} AS address_line1, {O.clean_field('address_line2')} AS address_line2,
  {O.clean_field('city')} AS city, {O.remove_control('name')} AS name, {O.compact('mobile')} AS mobile,
  {O.is_missing('mobile')} AS mobile_missing, {O.is_missing('email')} AS email_missing,
  {O.is_missing('pincode')} AS pincode_missing, upper({O.compact("'in'")}) AS country_code
FROM fx""",
)
def q_field_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = D.fixture_shipments(spark, sf_dir)
    return fx.select(
        "shipment_id",
        TX.clean_field(F.col("address_line1")).alias("address_line1"),
        TX.clean_field(F.col("address_line2")).alias("address_line2"),
        TX.clean_field(F.col("city")).alias("city"),
        TX.remove_control(F.col("name")).alias("name"),
        TX.compact(F.col("mobile")).alias("mobile"),
        TX.is_missing(F.col("mobile")).alias("mobile_missing"),
        TX.is_missing(F.col("email")).alias("email_missing"),
        TX.is_missing(F.col("pincode")).alias("pincode_missing"),
        TX.normalize_country(F.lit("in")).alias("country_code"),
    )


@register(
    "mobile_recovery",
    f"""WITH fx AS ({O.FIXTURE_SQL}),
c AS (SELECT shipment_id, {O.compact('mobile')} AS m, {O.compact('notification_mobile')} AS n FROM fx)
SELECT shipment_id, {O.digit_count('m')} AS mobile_digits,
  array_to_string({O.candidates('m')}, '|') AS mobile_candidates,
  array_to_string({O.recover_mobiles('m')}, '|') AS mobile_recovered,
  array_to_string({O.recover_mobiles('n')}, '|') AS notification_recovered,
  {O.sorted_join(O.mobile_set('m', 'n'))} AS mobile_set,
  {O.ten_digits(O.strip_prefix('m'))} AS mobile_ten
FROM c""",
)
def q_mobile_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = D.fixture_shipments(spark, sf_dir)
    m, n = TX.compact(F.col("mobile")), TX.compact(F.col("notification_mobile"))
    c = fx.select("shipment_id", m.alias("m"), n.alias("n"))
    m, n = F.col("m"), F.col("n")
    return c.select(
        "shipment_id",
        PH.digit_count(m).cast("long").alias("mobile_digits"),
        _joined(PH.candidates(m)).alias("mobile_candidates"),
        _joined(PH.recover_mobiles(m)).alias("mobile_recovered"),
        _joined(PH.recover_mobiles(n)).alias("notification_recovered"),
        F.array_join(F.array_sort(PH.mobile_set(m, n)), ",").alias("mobile_set"),
        PH.ten_digits(PH.strip_prefix(m)).alias("mobile_ten"),
    )


# Whitespace-delimited words: the phone candidates of a free text.
_WORD = rf"{TX.WHITESPACE[:1]}^{TX.WHITESPACE[1:]}+"
# A mobile of given columns as a whole field, in these forms by order key; the last is no mobile.
_MOBILE_FORMS = [
    # (Spark value from ten digits t, SQL value)
    (lambda t: t, "t"),
    (lambda t: F.concat(F.lit("0"), t), "'0' || t"),
    (lambda t: F.concat(F.lit("+91"), t), "'+91' || t"),
    (lambda t: F.concat(F.lit("+91 "), t), "'+91 ' || t"),
    (lambda t: F.concat(F.lit("91"), t), "'91' || t"),
    (lambda t: F.concat(F.substring(t, 1, 5), F.lit(" "), F.substring(t, 6, 5)), "substr(t, 1, 5) || ' ' || substr(t, 6, 5)"),
    (lambda t: F.concat(F.substring(t, 1, 5), F.lit("-"), F.substring(t, 6, 5)), "substr(t, 1, 5) || '-' || substr(t, 6, 5)"),
    (lambda t: F.concat(t, F.lit("123456")), "t || '123456'"),
]
_MOBILE_FORMS_SQL = "CASE o_orderkey % {n} {whens} END".format(
    n=len(_MOBILE_FORMS), whens=" ".join(f"WHEN {i} THEN {sql}" for i, (_f, sql) in enumerate(_MOBILE_FORMS))
)


@register(
    "whole_word_mobiles",
    f"""WITH o AS (SELECT o_orderkey, '9' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS t FROM orders),
w AS (
  SELECT 'document' AS kind, doc_id AS id, unnest(regexp_extract_all(text, {O.lit(_WORD)})) AS field FROM documents
  UNION ALL SELECT 'order', o_orderkey, {_MOBILE_FORMS_SQL} FROM o),
c AS (SELECT kind, id, {O.compact('field')} AS t FROM w)
SELECT DISTINCT kind, id, mobile FROM c, unnest({O.recover_mobiles('t')}) AS u(mobile)""",
)
def q_whole_word_mobiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recovery operator on whole words of the documents and on whole fields of the orders."""
    d = D.read_table(spark, sf_dir, "documents")
    words = d.select(
        F.lit("document").alias("kind"),
        F.col("doc_id").cast("long").alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(_WORD), 0)).alias("field"),
    )
    ok = F.col("o_orderkey")
    ten = F.concat(F.lit("9"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    form = F.lit(None).cast("string")
    for i, (spark_fn, _sql) in enumerate(_MOBILE_FORMS):
        form = F.when(ok % len(_MOBILE_FORMS) == i, spark_fn(ten)).otherwise(form)
    fields = D.read_table(spark, sf_dir, "orders").select(
        F.lit("order").alias("kind"), ok.cast("long").alias("id"), form.alias("field")
    )
    found = PH.recover_mobiles(TX.compact(F.col("field")))
    return words.unionByName(fields).select("kind", "id", F.explode(found).alias("mobile")).distinct()


# A note of an order: a mobile in one of the forms above, a longer number, and a code around a mobile.
_NOTE_SQL = f"'Call ' || {_MOBILE_FORMS_SQL} || '. Ref. ' || t || '123456, part a' || t || 'f; 12-34 or  ' || t || '.'"


@register(
    "documents_mobiles",
    f"""WITH o AS (SELECT o_orderkey, '7' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS t FROM orders),
w AS (SELECT 'document' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'order', o_orderkey, {_NOTE_SQL} FROM o),
r AS (SELECT kind, id, unnest({O.number_runs('text')}) AS run FROM w)
SELECT DISTINCT kind, id, mobile FROM r, unnest({O.recover_mobiles('run')}) AS u(mobile)""",
)
def q_documents_mobiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mobiles of free texts: maximal number runs, each recovered whole; documents, and notes of the orders."""
    d = D.read_table(spark, sf_dir, "documents")
    ok = F.col("o_orderkey")
    ten = F.concat(F.lit("7"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    form = F.lit(None).cast("string")
    for i, (spark_fn, _sql) in enumerate(_MOBILE_FORMS):
        form = F.when(ok % len(_MOBILE_FORMS) == i, spark_fn(ten)).otherwise(form)
    note = F.concat(
        F.lit("Call "), form, F.lit(". Ref. "), ten, F.lit("123456, part a"), ten, F.lit("f; 12-34 or  "), ten, F.lit(".")
    )
    orders = D.read_table(spark, sf_dir, "orders")
    texts = d.select(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("id"), "text").unionByName(
        orders.select(F.lit("order").alias("kind"), ok.cast("long").alias("id"), note.alias("text"))
    )
    return texts.select("kind", "id", F.explode(PH.text_mobiles(F.col("text"))).alias("mobile"))


# Whitespace-delimited words that contain '@': the e-mail candidates of a free text.
_AT_WORD = rf"{TX.WHITESPACE[:1]}^{TX.WHITESPACE[1:]}*@{TX.WHITESPACE[:1]}^{TX.WHITESPACE[1:]}*"


@register(
    "documents_emails",
    f"""WITH c AS (SELECT doc_id, regexp_extract_all({O.remove_control('text')}, {O.lit(_AT_WORD)}) AS words FROM documents)
SELECT DISTINCT doc_id, email FROM c, unnest(list_filter(words, lambda w: {O.email_ok('w')})) AS u(email)""",
)
def q_documents_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = D.read_table(spark, sf_dir, "documents")
    words = F.regexp_extract_all(TX.remove_control(F.col("text")), F.lit(_AT_WORD), 0)
    valid = F.filter(words, EM.is_valid_email)
    return d.select("doc_id", F.explode(F.array_distinct(valid)).alias("email"))


@register(
    "email_checks",
    f"""WITH fx AS ({O.FIXTURE_SQL}),
c AS (SELECT shipment_id, {O.compact('email')} AS e, {O.compact('notification_email')} AS n FROM fx)
SELECT shipment_id, e AS email, {O.email_ok('e')} AS email_ok, {O.email_ok('n')} AS notification_ok,
  {O.sorted_join(O.email_set('e', 'n'))} AS emails FROM c""",
)
def q_email_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = D.fixture_shipments(spark, sf_dir)
    c = fx.select(
        "shipment_id",
        TX.compact(F.col("email")).alias("e"),
        TX.compact(F.col("notification_email")).alias("n"),
    )
    e, n = F.col("e"), F.col("n")
    return c.select(
        "shipment_id",
        e.alias("email"),
        EM.is_valid_email(e).alias("email_ok"),
        EM.is_valid_email(n).alias("notification_ok"),
        F.array_join(F.array_sort(EM.email_set(e, n)), ",").alias("emails"),
    )


@register(
    "address_fingerprint",
    f"""WITH fx AS ({O.FIXTURE_SQL})
SELECT shipment_id, lower({O.remove_space("coalesce(mobile, '') || coalesce(name, '') || coalesce(address_line1, '') || coalesce(city, '') || coalesce(pincode, '')")}) AS fingerprint
FROM fx""",
)
def q_address_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = D.fixture_shipments(spark, sf_dir)
    fields = [F.col(c) for c in ("name", "address_line1", "city", "pincode")]
    return fx.select("shipment_id", TX.address_fingerprint(F.col("mobile"), *fields).alias("fingerprint"))


@register(
    "pincode_checks",
    f"""WITH fx AS ({O.FIXTURE_SQL}), lk AS ({O.PINCODE_LOOKUP_SQL}),
c AS (SELECT shipment_id, {O.compact('pincode')} AS pincode FROM fx)
SELECT shipment_id, c.pincode, {O.pincode_rule('c.pincode')} AS rule_ok, l.pin_value IS NOT NULL AS in_lookup,
  NOT {O.is_missing('c.pincode')} AND (l.pin_value IS NOT NULL OR {O.pincode_rule('c.pincode')}) AS pincode_ok
FROM c LEFT JOIN (SELECT DISTINCT Pincode AS pin_value FROM lk WHERE Pincode IS NOT NULL) l ON c.pincode = l.pin_value""",
)
def q_pincode_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = D.fixture_shipments(spark, sf_dir).select("shipment_id", PC.clean_pincode(F.col("pincode")).alias("pincode"))
    hits = pincode_lookup_set(D.pincode_lookup(spark, sf_dir)).withColumn("_hit", F.lit(True))
    j = fx.join(hits, F.col("pincode") == F.col("_pin_value"), "left")
    p = F.col("pincode")
    return j.select(
        "shipment_id",
        "pincode",
        PC.matches_pincode_rule(p).alias("rule_ok"),
        F.col("_hit").isNotNull().alias("in_lookup"),
        PC.pincode_ok(p, F.col("_hit")).alias("pincode_ok"),
    )


@register(
    "cipher_flags",
    f"""WITH o AS (SELECT o_orderkey, {O.ALIAS_SQL} AS _alias, {O.phone_sql()} AS phone, {O.email_sql()} AS email FROM orders),
s AS (SELECT o_orderkey AS id, _alias,
  CASE WHEN _alias IS NULL THEN phone WHEN _alias = '2' THEN 'cipher:2:' || to_base64(encode(phone))
       ELSE 'cipher:' || _alias || ':' END AS phone FROM o)
SELECT id, starts_with(phone, 'cipher:') AS is_encrypted,
  CASE WHEN starts_with(phone, 'cipher:') THEN string_split(phone, ':')[2] END AS key_alias,
  starts_with(phone, 'cipher:') AND _alias NOT IN ('1', '2') AS is_pii_encrypted,
  starts_with(phone, 'cipher:') AS is_cipher_row
FROM s""",
)
def q_cipher_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    ad = D.address_detail(spark, sf_dir, encrypted=True)
    p = F.col("phone")
    return ad.select(
        "id",
        C.is_encrypted(p).alias("is_encrypted"),
        F.when(C.is_encrypted(p), C.key_alias(p)).alias("key_alias"),
        C.is_pii_encrypted(p).alias("is_pii_encrypted"),
        is_cipher_row(p).alias("is_cipher_row"),
    )


# Key exports of several versions, from the columns of an event: the first version is the user's id.
_KEYS_JSON = """'{"' || event_type || '": "' || user_id || '", "k": "' || event_id || '", "a": 1}'"""


@register(
    "key_json_first",
    f"""WITH e AS (SELECT event_id, props, {_KEYS_JSON} AS keys FROM events)
SELECT event_id, json_extract_string(keys, '$."' || json_keys(keys)[1] || '"') AS first_value,
  json_extract_string(props, '$."' || json_keys(props)[1] || '"') AS first_prop FROM e""",
)
def q_key_json_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = D.read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        C.first_key(F.expr(_KEYS_JSON)).alias("first_value"),
        C.first_key(F.col("props")).alias("first_prop"),
    )


@register(
    "key_path",
    f"""WITH a AS (SELECT DISTINCT c_mktsegment AS tenant_code, {O.ALIAS_SQL} AS key_alias
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT tenant_code, key_alias, CASE WHEN key_alias = '2' THEN NULL
  WHEN key_alias = '1' THEN {O.lit(CFG.key_path.prefix)} || tenant_code || {O.lit(CFG.key_path.tenant_suffix + '/1')}
  ELSE {O.lit(CFG.key_path.prefix)} || key_alias || {O.lit('/' + CFG.key_path.version)} END AS key_path
FROM (SELECT tenant_code, coalesce(key_alias, '1') AS key_alias FROM a)""",
)
def q_key_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = D.read_table(spark, sf_dir, "orders")
    c = D.read_table(spark, sf_dir, "customer")
    a = (
        o.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_mktsegment").alias("tenant_code"), D.alias_expr(F.col("o_orderpriority")).alias("key_alias"))
        .distinct()
        .withColumn("key_alias", F.coalesce("key_alias", F.lit("1")))
    )
    return a.select("tenant_code", "key_alias", C.key_path(F.col("key_alias"), F.col("tenant_code"), CFG.key_path).alias("key_path"))


# --- source selection: registry and closed tenant databases -------------------------------------


def server_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry entries, one per supplier: db named by nation; flags vary (one is upper-case)."""
    s = D.read_table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("db-"), F.col("s_nationkey").cast("string")).alias("db"),
        F.when(F.col("s_acctbal") > 0, "true").otherwise("false").alias("production"),
        F.when(F.col("s_suppkey") % 4 == 0, "TRUE").otherwise("true").alias("active"),
    )


def excluded_servers(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = D.read_table(spark, sf_dir, "nation")
    return n.filter(F.col("n_regionkey") == 0).select(F.concat(F.lit("db-"), F.col("n_nationkey").cast("string")).alias("db"))


_REGISTRY_SQL = """reg AS (SELECT 'db-' || cast(s_nationkey as string) AS db,
  CASE WHEN s_acctbal > 0 THEN 'true' ELSE 'false' END AS production,
  CASE WHEN s_suppkey % 4 = 0 THEN 'TRUE' ELSE 'true' END AS active FROM supplier),
exc AS (SELECT 'db-' || cast(n_nationkey as string) AS db FROM nation WHERE n_regionkey = 0)"""


@register(
    "active_servers",
    f"""WITH {_REGISTRY_SQL}
SELECT DISTINCT db FROM reg WHERE production = 'true' AND active = 'true' AND db NOT IN (SELECT db FROM exc)""",
)
def q_active_servers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.active_servers(server_registry(spark, sf_dir), excluded_servers(spark, sf_dir))


def terminated_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One closure record per order: the tenant database, its type and closing time."""
    o = D.read_table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("tenant_"), F.col("o_custkey").cast("string")).alias("terminated_server"),
        F.when(F.col("o_orderstatus") == "F", "production").otherwise("staging").alias("type"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_orderdate")).alias("terminated_on"),
    )


def schemata(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = D.read_table(spark, sf_dir, "customer")
    return c.select(F.concat(F.lit("tenant_"), F.col("c_custkey").cast("string")).alias("SCHEMA_NAME"))


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables exist in the schemas of customers with an urgent order."""
    o = D.read_table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.concat(F.lit("tenant_"), F.col("o_custkey").cast("string")).alias("TABLE_SCHEMA"),
        F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("TABLE_NAME"),
    )


@register(
    "closed_databases",
    f"""WITH ti AS (SELECT 'tenant_' || cast(o_custkey as string) AS terminated_server,
  CASE WHEN o_orderstatus = 'F' THEN 'production' ELSE 'staging' END AS type,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END AS terminated_on FROM orders),
sc AS (SELECT 'tenant_' || cast(c_custkey as string) AS SCHEMA_NAME FROM customer),
tb AS (SELECT 'tenant_' || cast(o_custkey as string) AS TABLE_SCHEMA FROM orders WHERE o_orderpriority = '1-URGENT'),
unused AS (SELECT SCHEMA_NAME AS name FROM sc EXCEPT SELECT TABLE_SCHEMA FROM tb)
SELECT DISTINCT terminated_server AS db FROM ti
WHERE type = 'production' AND coalesce(terminated_on BETWEEN TIMESTAMP {O.lit(FROM_TS)}
    AND TIMESTAMP {O.lit(TILL_TS)} - INTERVAL 1 MICROSECOND, true)
  AND NOT list_contains({O.in_list(CFG.system_schemas).replace('(', '[').replace(')', ']')}, terminated_server)
  AND (SELECT count(*) FILTER (name IS NULL) FROM unused) = 0
  AND NOT EXISTS (SELECT 1 FROM unused WHERE name = terminated_server)""",
)
def q_closed_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.closed_databases(
        terminated_info(spark, sf_dir), schemata(spark, sf_dir), tables(spark, sf_dir), FROM_TS, TILL_TS, CFG.system_schemas
    )


@register(
    "id_bounds",
    "SELECT min(o_orderkey) AS min_id, max(o_orderkey) AS max_id FROM orders",
)
def q_id_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_bounds(D.address_detail(spark, sf_dir), "id")


@register("id_bounds_from_footers", "SELECT min(o_orderkey) AS min_id, max(o_orderkey) AS max_id FROM orders")
def q_id_bounds_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bounds from the files' statistics: no row is read."""
    return footer_bounds(spark, f"{sf_dir}/orders.parquet", "o_orderkey")


@register(
    "pincode_file",
    f"""WITH o AS (SELECT o_orderkey, {O.pincode_sql()} AS pin FROM orders),
c AS (SELECT trim(pin, ' ' || chr(9)) AS pin FROM o),
s AS (SELECT CASE WHEN coalesce(pin, '') = '' THEN 'empty' WHEN regexp_matches(pin, '^[0-9]+$') THEN 'read' ELSE 'malformed' END AS status, pin FROM c)
SELECT status, CASE WHEN status = 'read' THEN CAST(pin AS INTEGER) END AS pincode, count(*) AS lines FROM s GROUP BY ALL""",
)
def q_pincode_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pincode CSV written from the orders and read back by a schema: lines by pincode, malformed ones apart."""
    o = D.read_table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    path = staging_path(spark, "pincode-csv")
    office = F.concat(F.lit('Post, "office" '), ok.cast("string"), F.lit("\n2nd line"))
    o.select(D.pincode_expr(ok, F.col("o_custkey")).alias("Pincode"), office.alias("Office")).write.option("header", True).option("escape", '"').csv(path)
    lines = read_checked_csv(spark, path, "Pincode int, Office string")
    status = F.when(F.col(BAD_LINE).isNotNull(), "malformed").when(F.col("Pincode").isNull(), "empty").otherwise("read")
    counted = lines.groupBy(status.alias("status"), F.when(status == "read", F.col("Pincode")).alias("pincode"))
    return counted.agg(F.count("*").alias("lines"))


@register(
    "stage_counts",
    f"""WITH {_asm_sql(True)},
lk AS ({O.PINCODE_LOOKUP_SQL}),
rows AS (SELECT {O.SHIPMENT_COLS} FROM asm),
ct AS ({O.contacts_sql('rows', RUN_TS)})
SELECT stage, rows FROM (
  SELECT 'rows_read' AS stage, count(*) AS rows FROM asm
  UNION ALL SELECT 'rows_encrypted', count(*) FILTER (WHERE _alias IS NOT NULL) FROM asm
  UNION ALL SELECT 'rows_plain', count(*) FILTER (WHERE _alias IS NULL) FROM asm
  UNION ALL SELECT 'key_pairs', count(DISTINCT (tenant_code, _alias)) FILTER (WHERE _alias IS NOT NULL) FROM asm
  UNION ALL SELECT 'rows_union', count(*) FROM asm
  UNION ALL SELECT 'values_undecrypted', count(*) FROM asm LEFT JOIN (SELECT DISTINCT Pincode AS pin_value FROM lk) l
    ON {O.compact('asm.pincode')} = l.pin_value WHERE _alias IS NOT NULL AND shipping_package_code LIKE '%-3'
    AND NOT {O.is_missing(O.compact('asm.pincode'))} AND (l.pin_value IS NOT NULL OR {O.pincode_rule(O.compact('asm.pincode'))})
  UNION ALL SELECT 'contact_rows', count(*) FROM ct
  UNION ALL SELECT 'with_mobile', count(*) FILTER (WHERE contact_mobile <> '') FROM ct
  UNION ALL SELECT 'with_email', count(*) FILTER (WHERE contact_email <> '') FROM ct)""",
)
def q_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third line of an order has a name that no key opens."""
    rows = assembled(spark, sf_dir, CFG, encrypted=True)
    broken = is_cipher_row(F.col("mobile")) & F.col("shipping_package_code").endswith("-3")
    rows = rows.withColumn("name", F.when(broken, F.lit("cipher:k1:AAAA")).otherwise(F.col("name")))
    return stage_counts(rows, D.key_export(spark, sf_dir), D.pincode_lookup(spark, sf_dir), CFG)


# --- row filters with NULLs, decryption fallbacks ------------------------------------------------


def filter_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders with NULLs planted in every filtered column (one in 13, 17, 19, 23, 29 rows)."""
    li = D.read_table(spark, sf_dir, "lineitem")
    o = D.read_table(spark, sf_dir, "orders")
    ok, ck, ln = F.col("o_orderkey"), F.col("o_custkey"), F.col("l_linenumber")
    null = F.lit(None).cast("string")
    j = li.join(o, F.col("l_orderkey") == ok)
    return j.select(
        ok.alias("order_id"),
        ln.alias("line"),
        F.when((ok + ln) % 13 == 0, null).otherwise(D.status_expr(F.col("l_returnflag"), F.col("l_linestatus"))).alias("status"),
        F.when((ok + ln) % 17 == 0, F.lit(None)).otherwise(F.col("l_shipdate")).alias("created"),
        F.when((ok + ln) % 19 == 0, null).otherwise(F.col("o_orderpriority")).alias("tenant"),
        F.when((ok + ln) % 23 == 0, null).otherwise(D.country_expr(ok)).alias("country"),
        F.when((ok + ln) % 29 == 0, null).otherwise(D.phone_expr(ok, ck)).alias("phone"),
    )


_FILTER_CFG = JobConfig(from_ts=FROM_TS, till_ts=TILL_TS, run_ts=RUN_TS, excluded_tenants=("1-URGENT", "5-LOW"))


def _filter_probe_sql() -> str:
    def nul(mod: int, expr: str, typ: str = "string") -> str:
        return f"CASE WHEN (o_orderkey + l_linenumber) % {mod} = 0 THEN cast(NULL as {typ}) ELSE {expr} END"

    return f"""fp AS (SELECT o_orderkey AS order_id, l_linenumber AS line,
  {nul(13, O.STATUS_SQL)} AS status, {nul(17, 'l_shipdate', 'timestamp')} AS created,
  {nul(19, 'o_orderpriority')} AS tenant,
  {nul(23, "CASE o_orderkey % 10 WHEN 0 THEN 'US' WHEN 1 THEN 'in' ELSE 'IN' END")} AS country,
  {nul(29, O.phone_sql())} AS phone
FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@register(
    "source_filters",
    f"""WITH {_filter_probe_sql()}
SELECT order_id, line,
  coalesce(status IN {O.in_list(_FILTER_CFG.statuses)}, false) AS status_ok,
  coalesce(tenant IS NOT NULL AND tenant NOT IN {O.in_list(_FILTER_CFG.excluded_tenants)}, false) AS tenant_ok,
  coalesce(created >= TIMESTAMP {O.lit(FROM_TS)} AND created < TIMESTAMP {O.lit(TILL_TS)}, false) AS window_ok,
  coalesce(country = 'IN', false) AS country_ok,
  coalesce(phone NOT LIKE '*%' AND phone NOT IN {O.in_list(_FILTER_CFG.placeholder_phones)}, false) AS phone_ok
FROM fp""",
)
def q_source_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source filter on rows with NULLs: a NULL in a filtered column drops the row, as in SQL."""
    from addrflow.operators.filters import country_kept, status_kept, tenant_kept

    fp = filter_probe(spark, sf_dir)
    cfg = _FILTER_CFG

    def kept(c):
        return F.coalesce(c, F.lit(False))

    return fp.select(
        "order_id",
        "line",
        kept(status_kept(F.col("status"), cfg)).alias("status_ok"),
        kept(tenant_kept(F.col("tenant"), cfg)).alias("tenant_ok"),
        kept(in_window(F.col("created"), fp.schema["created"].dataType, cfg.from_ts, cfg.till_ts)).alias("window_ok"),
        kept(country_kept(F.col("country"), cfg)).alias("country_ok"),
        kept(phone_kept(F.col("phone"), cfg)).alias("phone_ok"),
    )


_FALLBACKS = [
    # (case, Spark value from clear text c, SQL value, SQL expected result)
    ("missing_key", lambda c: F.concat(F.lit("cipher:zz:"), F.base64(F.encode(c, "UTF-8"))),
     "'cipher:zz:' || to_base64(encode(c))", "to_base64(encode(c))"),
    ("legacy_alias", lambda c: F.concat(F.lit("cipher:1:"), F.base64(F.encode(c, "UTF-8"))),
     "'cipher:1:' || to_base64(encode(c))", "to_base64(encode(c))"),
    ("retired_alias", lambda c: F.concat(F.lit("cipher:2:"), F.base64(F.encode(c, "UTF-8"))),
     "'cipher:2:' || to_base64(encode(c))", "'cipher:2:' || to_base64(encode(c))"),
    ("no_payload", lambda c: F.lit("cipher:"), "'cipher:'", "'cipher:'"),
    # nothing decodable left -> AES over zero bytes -> '' (as the JCE does); else the payload
    ("junk_payload", lambda c: F.concat(F.lit("cipher:k1:*"), c, F.lit("!")),
     "'cipher:k1:*' || c || '!'", "CASE WHEN {empty} THEN '' ELSE '*' || c || '!' END"),
]
# payload '*' || c || '!' leaves at most one base64 character after lenient decoding
_EMPTY_BODY = "length(regexp_replace(split_part(translate('*' || c || '!', '-_', '+/'), '=', 1), '[^A-Za-z0-9+/]', '', 'g')) <= 1"


def _fallback_case(ok):
    r = ok % len(_FALLBACKS)
    case = F.lit(_FALLBACKS[-1][0])
    for i, (name, *_rest) in reversed(list(enumerate(_FALLBACKS[:-1]))):
        case = F.when(r == i, F.lit(name)).otherwise(case)
    return case


def _fallbacks_sql() -> str:
    n = len(_FALLBACKS)
    case = "CASE " + " ".join(f"WHEN o_orderkey % {n} = {i} THEN '{name}'" for i, (name, *_r) in enumerate(_FALLBACKS)) + " END"
    value = "CASE kase " + " ".join(f"WHEN '{name}' THEN {sql}" for name, _s, sql, _e in _FALLBACKS) + " END"
    expect = "CASE kase " + " ".join(
        f"WHEN '{name}' THEN {e.format(empty=_EMPTY_BODY)}" for name, _s, _sql, e in _FALLBACKS
    ) + " END"
    return f"""WITH b AS (SELECT o_orderkey AS id, {case} AS kase, {O.phone_sql()} AS c FROM orders)
SELECT id, kase AS fallback_case, {expect} AS mobile,
  CASE WHEN kase = 'retired_alias' OR (kase = 'junk_payload' AND {_EMPTY_BODY}) THEN 0 ELSE 1 END AS undecrypted
FROM b"""


@register("decrypt_fallbacks", _fallbacks_sql())
def q_decrypt_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every decryption fallback on whole orders: missing key, legacy and retired aliases,
    ciphertext without payload, payload that is no base64 AES block (all deterministic)."""
    from addrflow.schema import SHIPMENT_FIELDS

    o = D.read_table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    c = D.phone_expr(ok, F.col("o_custkey"))
    case = _fallback_case(ok)
    value = F.lit(None).cast("string")
    for name, spark_fn, _sql, _e in reversed(_FALLBACKS):
        value = F.when(case == name, spark_fn(c)).otherwise(value)
    rows = o.select(
        *[F.lit("").alias(f) for f in SHIPMENT_FIELDS if f not in ("mobile", "tenant_code", "shipping_package_code")],
        value.alias("mobile"),
        F.lit("t").alias("tenant_code"),
        ok.cast("string").alias("shipping_package_code"),
        case.alias("fallback_case"),
    )
    out = decrypt_rows(rows, D.key_export(spark, sf_dir), CFG, flag_failures=True)
    return out.select(
        F.col("shipping_package_code").cast("long").alias("id"), "fallback_case", "mobile",
        F.col("_undecrypted").cast("int").alias("undecrypted"),
    )
