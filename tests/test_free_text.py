"""Number runs of free texts, the CSV source by a schema, bounds from footers."""

import pytest
from pyspark.sql import functions as F

from addrflow.functions.phone import number_runs, text_mobiles
from addrflow.plans.queries import q_documents_mobiles, q_id_bounds, q_id_bounds_from_footers
from addrflow.sources.files import BAD_LINE, read_checked_csv
from tests.conftest import SF_SMALL, one_col

M = "+919876543210"
TEXTS = {
    "call 9876543210 now": [M],
    "9876543210": [M],
    "98765 43210.": [M],
    "98765-43210, +91 98765 43210": [M],
    "(+91)9876543210": [M],
    "09876543210/+919876543210": [M],
    "9876543210;7000000001": [M, "+917000000001"],
    "9876543210123456": [],  # a longer number
    "1239876543210": [],
    "98765 43210 98765": [],  # a longer run
    "1234 9876543210": [],
    "12 and 9876543210": [M],
    "98765  43210": [],  # two numbers
    "x  9876543210  12": [M],
    "a9876543210f": [],  # a code
    "9876543210f": [],
    "98765 43210f": [],
    "9876543210 f": [M],
    "call9876543210": [],
    "12a 9876543210": [M],
    "98765 4321\u0660": [],  # ten digits, but not ten ASCII digits
    "\u09669876543210": [],
    "98765.43210": [],
    "1 2 3 4 5 6 7 8 9": [],
    "+": [], "": [], None: [],
}


@pytest.mark.parametrize("text", list(TEXTS), ids=repr)
def test_mobiles_of_a_text(spark, text):
    row = one_col(spark, [text]).select(text_mobiles(F.col("v")).alias("m")).first()
    assert (row.m or []) == TEXTS[text]


def test_runs_are_maximal(spark):
    got = one_col(spark, ["a1 22-33  44 b 5x6 77- 8+9"]).select(number_runs(F.col("v"))).first()[0]
    assert [r.strip(" -") for r in got] == ["22-33", "44", "77", "8", "+9"]


def test_long_lists_of_numbers_do_not_overflow(spark):
    many = " ".join(["12345"] * 200_000)
    assert one_col(spark, [many + "x 9876543210"]).select(text_mobiles(F.col("v"))).first()[0] == [M]


def test_no_mobile_from_a_longer_number(spark):
    """Every mobile of the documents and notes stands in its text with no digit on either side."""
    import re

    texts = {("document", r.doc_id): r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    orders = {r.o_orderkey: r.o_custkey for r in spark.read.parquet(f"{SF_SMALL}/orders.parquet").collect()}
    found = q_documents_mobiles(spark, SF_SMALL).collect()
    for r in found:
        ten = r.mobile[3:]
        if r.kind == "document":
            alone = [re.sub(r"[ -]", "", x) for x in re.findall(r"\+?[0-9](?:[ -]?[0-9])*", texts[r.kind, r.id])]
            assert any(x.endswith(ten) and len(x.lstrip("+")) <= 12 for x in alone), r
        else:
            assert ten == f"7{orders[r.id]:09d}"
    assert {r.id for r in found if r.kind == "order"} == set(orders)


def test_csv_lines_that_do_not_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Pincode,Office\n560001,"A, ""B""\nC"\nPO1234,x\n,y\n1,2,3\n')
    got = read_checked_csv(spark, str(tmp_path), "Pincode int, Office string").collect()
    good = [(r.Pincode, r.Office) for r in got if r[BAD_LINE] is None]
    assert good == [(560001, 'A, "B"\nC'), (None, "y")]
    assert sorted(r[BAD_LINE] for r in got if r[BAD_LINE]) == ["1,2,3", "PO1234,x"]


def test_bounds_come_from_the_footers(spark):
    df = q_id_bounds_from_footers(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(o_orderkey), MAX(o_orderkey)]" in plan
    assert df.collect() == q_id_bounds(spark, SF_SMALL).collect()
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
