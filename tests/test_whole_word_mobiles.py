"""Mobiles are recovered from whole words and fields, never from a slice of a longer digit run."""

from addrflow.plans import queries as Q
from tests.conftest import SF_SMALL

FORMS = 8  # the last one is a sixteen-digit number


def test_each_form_of_a_whole_field_is_recovered_and_a_longer_number_is_not(spark):
    got = Q.queries()["whole_word_mobiles"](spark, SF_SMALL).filter("kind = 'order'")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey").collect()
    want = {(r.o_orderkey, f"+919{r.o_custkey:09d}") for r in orders if r.o_orderkey % FORMS != FORMS - 1}
    assert {r.o_orderkey % FORMS for r in orders} == set(range(FORMS))
    assert sorted((r.id, r.mobile) for r in got.collect()) == sorted(want)


def test_words_of_a_text(spark, tmp_path):
    texts = ["call 9876543210 now", "+919876543210", "09876543210\tx", "9876543210123456", "ab9876543210ff12 1", "(987) 654-3210 a", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = Q.queries()["whole_word_mobiles"](spark, str(tmp_path)).collect()
    assert sorted((r.kind, r.id, r.mobile) for r in got) == [("document", i, "+919876543210") for i in range(3)]
