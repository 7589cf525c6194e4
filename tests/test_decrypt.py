"""Decryption: round trips with generated keys, and every fallback path."""

import pytest
from pyspark.sql import functions as F

from addrflow.config import JobConfig, KeyPathFormat
from addrflow.functions import cipher as C
from addrflow.operators.decrypt import decrypt_rows, distinct_key_pairs, key_table
from addrflow.schema import SHIPMENT_FIELDS

FMT = KeyPathFormat(prefix="kp/", tenant_suffix="_t", version="1")
CFG = JobConfig(from_ts="2000-01-01", till_ts="2001-01-01", run_ts="r", key_path=FMT)
SHORT, LONG = "s3cr3t", "0123456789abcdefghij0123456789abcdefghij"  # 6 and 40 characters


def _rows(spark, data):
    """data: list of dicts with some shipment fields; the rest are ''."""
    recs = [tuple(d.get(f, "") for f in SHIPMENT_FIELDS) for d in data]
    return spark.createDataFrame(recs, ", ".join(f"{f} string" for f in SHIPMENT_FIELDS))


def _seal(df, cols, alias, key):
    return df.withColumns({c: C.encrypt_value(F.col(c), F.lit(alias), F.lit(key)) for c in cols})


def _export(spark, entries):
    return spark.createDataFrame([(p, '{"1": "%s"}' % k) for p, k in entries], "key_path string, keys_json string")


def test_round_trip_short_long_and_utf8(spark):
    clear = [
        {"tenant_code": "t1", "name": "Asha", "mobile": "9876543210", "email": "a@b.in", "address_line1": "MG Road"},
        {"tenant_code": "t2", "name": "Ravi ॐ", "mobile": "+91 98765-43210", "email": "", "address_line2": "x:y:z"},
    ]
    plain = _rows(spark, clear)
    cols = ["name", "mobile", "notification_mobile", "email", "notification_email", "address_line1", "address_line2"]
    a = _seal(plain.filter("tenant_code = 't1'"), cols, "a1", SHORT)
    b = _seal(plain.filter("tenant_code = 't2'"), cols, "a2", LONG)
    export = _export(spark, [("kp/a1/1", SHORT), ("kp/a2/1", LONG)])
    out = decrypt_rows(a.unionByName(b), export, CFG)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, plain.collect()))


def test_fallbacks(spark):
    base = spark.createDataFrame([("x",)], "k string")
    enc = base.select(C.encrypt_value(F.lit("9876543210"), F.lit("a1"), F.lit(SHORT)).alias("c")).first().c
    wrong_key_alias = enc.replace("cipher:a1:", "cipher:zz:")
    payload = enc.split(":", 2)[2]
    data = [
        {"tenant_code": "t", "mobile": wrong_key_alias, "name": "plain"},  # key not exported -> payload
        {"tenant_code": "t", "mobile": "cipher:2:" + payload},  # retired alias -> unchanged
        {"tenant_code": "t", "mobile": "cipher:1:" + payload},  # legacy alias -> payload
        {"tenant_code": "t", "mobile": "cipher:a1:not*base64!"},  # bad base64 -> payload
        {"tenant_code": "t", "mobile": "cipher:"},  # no payload -> kept as is
        {"tenant_code": "t", "mobile": "9876543210", "email": enc},  # plain mobile: e-mail untouched
        {"tenant_code": "t", "mobile": "cipher:bad:" + payload},  # wrong key -> payload (padding fails)
    ]
    export = _export(spark, [("kp/a1/1", SHORT), ("kp/bad/1", LONG)])
    out = decrypt_rows(_rows(spark, data), export, CFG, flag_failures=True).collect()
    mobiles = [r.mobile for r in out]
    assert mobiles[0] == payload
    assert mobiles[1] == "cipher:2:" + payload
    assert mobiles[2] == payload
    assert mobiles[3] == "not*base64!"
    assert mobiles[4] == "cipher:"
    assert out[5].email == enc and out[5].mobile == "9876543210"
    assert mobiles[6] == payload
    assert out[0].name == "plain"
    assert [r._undecrypted for r in out] == [1, 0, 1, 1, 1, 0, 1]


def test_null_key_keeps_row_and_gives_payload(spark):
    enc = spark.range(1).select(C.encrypt_value(F.lit("a@b.in"), F.lit("n1"), F.lit("k")).alias("c")).first().c
    export = spark.createDataFrame([("kp/n1/1", '{"1": null}')], "key_path string, keys_json string")
    out = decrypt_rows(_rows(spark, [{"tenant_code": "t", "mobile": enc, "email": enc}]), export, CFG).collect()
    assert len(out) == 1 and out[0].mobile == enc.split(":", 2)[2] == out[0].email


def test_key_pairs_and_table(spark):
    data = [
        {"tenant_code": "t1", "mobile": "cipher:a1:x"},
        {"tenant_code": "t1", "mobile": "cipher:a1:y"},
        {"tenant_code": "t2", "mobile": "cipher:1:x"},
        {"tenant_code": "t2", "mobile": "cipher:2:x"},
        {"tenant_code": "t3", "mobile": "9876543210"},
    ]
    pairs = distinct_key_pairs(_rows(spark, data))
    assert sorted(map(tuple, pairs.collect())) == [("t1", "a1"), ("t2", "1"), ("t2", "2")]
    export = _export(spark, [("kp/a1/1", "K1"), ("kp/t2_t/1", "K2")])
    got = sorted(map(tuple, key_table(pairs, export, FMT).collect()))
    assert got == [("t1", "a1", "K1"), ("t2", "1", "K2"), ("t2", "2", None)]


def test_only_keys_in_use_are_judged(spark):
    """An unused entry without a key, or with two, stops nothing; a used one does."""
    enc = spark.range(1).select(C.encrypt_value(F.lit("9876543210"), F.lit("a1"), F.lit(SHORT)).alias("c")).first().c
    rows = _rows(spark, [{"tenant_code": "t", "mobile": enc}] + [{"tenant_code": "t", "mobile": str(i)} for i in range(50)])
    schema = "key_path string, keys_json string"
    cfg = JobConfig(from_ts="2000-01-01", till_ts="2001-01-01", run_ts="r", key_path=FMT)

    def mobiles(entries):
        export = spark.createDataFrame(entries, schema)
        return sorted(r.mobile for r in decrypt_rows(rows, export, cfg).collect())

    good = ("kp/a1/1", '{"v1": "%s"}' % SHORT)
    unused = [("kp/zz/1", "{}"), ("kp/yy/1", '{"v": "a"}'), ("kp/yy/1", '{"v": "b"}'), (None, "{}")]
    assert "9876543210" in mobiles([good, *unused]) and len(mobiles([good, *unused])) == 51
    assert "9876543210" in mobiles([good, good])  # the same key twice
    with pytest.raises(Exception, match="different keys"):
        mobiles([good, ("kp/a1/1", '{"v1": "other"}')])
    with pytest.raises(Exception, match="holds no key"):
        mobiles([("kp/a1/1", "{}")])


def test_lenient_payloads_and_32_byte_key(spark):
    """Wrapped, URL-safe, junk-carrying and over-padded payloads still decrypt; 32-byte keys work."""
    key32 = "k" * 32
    enc = spark.range(1).select(C.encrypt_value(F.lit("Asha Rao, 12 MG Road"), F.lit("a1"), F.lit(key32)).alias("c")).first().c
    body = enc.split(":", 2)[2]
    variants = [
        body,
        body[:10] + "\r\n" + body[10:],  # line-wrapped
        body.replace("+", "-").replace("/", "_"),  # URL-safe alphabet
        body[:5] + "*#" + body[5:],  # junk characters are skipped
        body.rstrip("=") + "==" + "QUJD",  # decoding stops at the first '='
    ]
    data = [{"tenant_code": "t", "mobile": "cipher:a1:" + v, "name": "cipher:a1:" + v} for v in variants]
    export = _export(spark, [("kp/a1/1", key32)])
    out = decrypt_rows(_rows(spark, data), export, CFG).collect()
    assert [r.name for r in out] == ["Asha Rao, 12 MG Road"] * len(variants)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=20, deadline=None)
@given(
    st.lists(st.text(max_size=40), min_size=1, max_size=10),
    st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x2FFF), max_size=48),
)
def test_round_trip_property(spark, clears, key):
    """Any clear text under any key (zero-padded or cut to 32 UTF-8 bytes) decrypts back."""
    df = spark.createDataFrame([(i, c) for i, c in enumerate(clears)], "i int, c string")
    enc = df.select("i", "c", C.encrypt_value(F.col("c"), F.lit("p1"), F.lit(key)).alias("v"))
    out = enc.select("i", "c", C.decrypt_value(F.col("v"), F.lit(key)).alias("d")).collect()
    assert all(r.d == r.c for r in out)
