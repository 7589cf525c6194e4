"""Column functions against the edge tables of FIXTURES.md §4."""

import pytest
from pyspark.sql import functions as F

from addrflow.functions import cipher as C
from addrflow.functions import email as EM
from addrflow.functions import phone as PH
from addrflow.functions import pincode as PC
from addrflow.functions import text as TX
from tests.conftest import one_col

NBSP, BEL = " ", "\u0007"

MOBILES = [
    ("9876543210", ["+919876543210"]),
    ("09876543210", ["+919876543210"]),
    ("+91 98765-43210", ["+919876543210"]),
    ("919876543210", ["+919876543210"]),
    ("9198765432", ["+919198765432"]),
    ("98765 43210 ", ["+919876543210"]),
    ("Ph:9876543210(M)", ["+919876543210"]),
    ("9876543210,08765432109,", ["+919876543210", "+918765432109"]),
    ("9876543210,9876543210", ["+919876543210", "+919876543210"]),
    ("9876543210" + NBSP + BEL, ["+919876543210"]),
    ("0919876543210", []),
    ("00919876543210", []),
    ("(+91)9876543210", []),
    ("5876543210", []),
    ("98765x43210", []),
    ("9876543210/1", []),
    ("९876543210", []),
    (",", []),
    ("", []),
    (None, []),
    ("\\N", []),
]


def _map(spark, values, expr):
    df = one_col(spark, values).withColumn("i", F.monotonically_increasing_id())
    rows = df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()
    return [r.o for r in rows]


def test_recover_mobiles(spark):
    got = _map(spark, [m for m, _ in MOBILES], lambda c: PH.recover_mobiles(TX.compact(c)))
    assert got == [exp for _, exp in MOBILES]


def test_mobile_set_dedups_across_fields(spark):
    df = spark.createDataFrame([("9876543210,9876543210", "09876543210")], "a string, b string")
    assert df.select(PH.mobile_set(F.col("a"), F.col("b")).alias("s")).first().s == ["+919876543210"]
    assert df.select(PH.mobile_set(F.col("a"), F.col("b"), recover=False).alias("s")).first().s == []


def test_strip_prefix_and_digits(spark):
    vals = ["09876543210", "+919876543210", "919876543210", "9198765432", "12"]
    assert _map(spark, vals, PH.strip_prefix) == ["9876543210", "9876543210", "9876543210", "9198765432", "12"]
    assert _map(spark, ["a1१2", ""], PH.digit_count) == [3, 0]


CLEAN = [
    (None, ""),
    ("\\N", ""),
    ("nan", ""),
    (",", ""),
    ("NaN", "NaN"),
    (" nan", "nan"),
    ("  MG Road, ", "MG Road"),
    ("a ,", "a "),
    ("a,,", "a,"),
    ("a" + BEL + "b", "ab"),
    ("\ta\n", "a"),
    (NBSP + "a", NBSP + "a"),
    ("a, ", "a, "),
]


def test_clean_field(spark):
    assert _map(spark, [v for v, _ in CLEAN], TX.clean_field) == [e for _, e in CLEAN]


def test_space_control_missing(spark):
    vals = ["a b" + NBSP + "\tc　d", "x\u0085y\u009fz", None]
    assert _map(spark, vals, TX.remove_space) == ["abcd", "x\u0085y\u009fz", ""]
    assert _map(spark, vals[:2], TX.remove_control) == ["a b" + NBSP + "c　d", "xyz"]
    assert _map(spark, [None, "\\N", "", " \t", "a", "\\N "], TX.is_missing) == [True, True, True, True, False, False]
    assert _map(spark, [" i n" + BEL, None], TX.normalize_country) == ["IN", ""]
    assert _map(spark, ["in", "IN ", None], lambda c: TX.is_country(c, "IN")) == [True, False, False]


@pytest.mark.parametrize(
    "value,ok",
    [("560001", True), ("560 001", True), ("012345", False), ("56001", False), ("5600011", False),
     ("560  001", False), ("", False)],
)
def test_pincode_rule(spark, value, ok):
    assert _map(spark, [value], PC.matches_pincode_rule) == [ok]


EMAILS_OK = ["a@b.com", "a@localhost", "a@[1.2.3.4]", "x+y@z.in", "é@b.in", "a@bü.de", '"ab"@c.d', '"a\\"b"@c.d',
             "a@b.c,", ",a@b.c", "John<john@x.com>", "<a@b.c>", '"JD"<a@b.c>', "<a@b.c>x", '<"a>b"@c.d>']
EMAILS_BAD = [".a@b.c", "a..b@c.d", "a.@b.c", "a@b..c", "a@b.", "a@b_c.d", "ab", "@b.c", "a@b@c", "cipher:k:QUJD",
              "a@[1.2", "a b@c.d", None, "", '"a"b@c.d', 'a"b"@c.d', '"ab@c.d',
              "a@b.c,x", "<a@b.c", "a@b.c>", "John<a@@b>", "a<b>@c.d", "a@b.c;", "x:y<a@b.c>", "<a@b.c><d@e.f>"]


def test_email_rule(spark):
    assert _map(spark, EMAILS_OK, EM.is_valid_email) == [True] * len(EMAILS_OK)
    assert _map(spark, EMAILS_BAD, EM.is_valid_email) == [False] * len(EMAILS_BAD)


def test_email_set(spark):
    df = spark.createDataFrame([("a@b.in", "a@b.in"), ("A@b.in", "a@b.in"), ("bad", None)], "a string, b string")
    got = [sorted(r.s) for r in df.select(EM.email_set(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got == [["a@b.in"], ["A@b.in", "a@b.in"], []]


def test_cipher_parts(spark):
    vals = ["cipher:k:a:b", "cipher:", "abc", None, "cipher:2:x", "cipher:1:x"]
    assert _map(spark, vals, C.is_encrypted) == [True, True, False, False, True, True]
    assert _map(spark, vals[:3], C.key_alias) == ["k", "", None]
    assert _map(spark, vals[:3], C.payload) == ["a:b", None, None]
    assert _map(spark, vals, C.is_pii_encrypted) == [True, True, False, False, False, False]


def test_first_key(spark):
    df = one_col(spark, ['{"1": "k1", "2": "k2"}', '{"7": 69}'])
    assert [r.k for r in df.select(C.first_key(F.col("v")).alias("k")).collect()] == ["k1", "69"]
    with pytest.raises(Exception):
        one_col(spark, ["{}"]).select(C.first_key(F.col("v"))).collect()


def test_country_collation_and_fingerprint(spark):
    from addrflow.config import JobConfig
    from addrflow.operators.filters import country_kept

    strict = JobConfig(from_ts="a", till_ts="b", run_ts="r")
    loose = JobConfig(from_ts="a", till_ts="b", run_ts="r", country_collation="UTF8_LCASE")
    vals = ["IN", "in", "In ", None]
    assert _map(spark, vals, lambda c: F.coalesce(country_kept(c, strict), F.lit(False))) == [True, False, False, False]
    assert _map(spark, vals, lambda c: F.coalesce(country_kept(c, loose), F.lit(False))) == [True, True, False, False]
    df = spark.createDataFrame([("+919876543210", "MG Road ", None, "Pune")], "m string, a string, b string, c string")
    fp = df.select(TX.address_fingerprint(F.col("m"), F.col("a"), F.col("b"), F.col("c")).alias("f")).first().f
    assert fp == "+919876543210mgroadpune"


def test_long_inputs_do_not_overflow(spark):
    """Whole texts: 100k-segment inputs run through every rule without a stack overflow."""
    n = 100_000
    vals = ["a." * n + "a@b.c", "x@" + "b." * n + "c", '"' + "\\\\a" * n + '"@b.c', '"q"' * n + "<a@b.c>",
            "1," * n, "9" * n + "," + "+91" * n]
    got = _map(spark, vals, lambda c: F.struct(
        EM.is_valid_email(c).alias("e"), F.size(PH.recover_mobiles(TX.compact(c))).alias("m"),
        F.length(TX.clean_field(c)).alias("l")))
    assert [g.e for g in got] == [True, True, True, True, False, False]
    assert all(g.m == 0 for g in got)
