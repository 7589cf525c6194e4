"""JDBC source and sink on embedded Derby (in-process database: no server, no port)."""

import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from addrflow.operators.filters import canonical_rows
from addrflow.plans.queries import CFG, assembled
from addrflow.sources import driver_tables as D
from addrflow.sources.jdbc import JdbcTarget, append, has_column, probe_bounds, read_query, read_shipments
from tests.conftest import SF_SMALL

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def _target(tag: str) -> JdbcTarget:
    path = tempfile.mkdtemp(prefix=f"addrflow-derby-{tag}-")
    return JdbcTarget(f"jdbc:derby:{path}/db;create=true", {"driver": DRIVER})


def _store(df, target, table):
    """Write with upper-case names (Derby folds unquoted identifiers).

    Text columns without NULLs become VARCHAR so the pushed query can compare them; the others stay
    CLOB, because Spark binds a NULL string as CLOB on Derby.
    """
    up = df.toDF(*[c.upper() for c in df.columns])
    text = [f.name for f in up.schema.fields if f.dataType.simpleString() == "string"]
    nulls = up.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in text]).first() if text else None
    types = ", ".join(f"{c} VARCHAR(512)" for c in text if nulls[c] == 0)
    w = up.write.format("jdbc").options(**target.options()).option("dbtable", table).mode("append")
    if types:
        w = w.option("createTableColumnTypes", types)
    w.save()


@pytest.fixture(scope="module")
def source_db(spark):
    target = _target("src")
    for name, df in D.source_tables(spark, SF_SMALL).items():
        _store(df, target, name)
    return target


def test_pushed_query_equals_dataframe_assembly(spark, source_db):
    raw = read_shipments(spark, source_db, CFG, num_partitions=4)
    assert raw.rdd.getNumPartitions() == 4
    got = canonical_rows(raw, CFG.timestamp_format)
    want = assembled(spark, SF_SMALL, CFG, encrypted=False)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_bounds_and_column_probe(spark, source_db):
    lo, hi = probe_bounds(spark, source_db, "address_detail", "id")
    o = D.read_table(spark, SF_SMALL, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    assert (lo, hi) == (o[0], o[1])
    assert has_column(spark, source_db, "address_detail", "district")
    assert not has_column(spark, source_db, "address_detail", "no_such_column")


def test_source_without_district_and_empty_source(spark):
    target = _target("nodistrict")
    for name, df in D.source_tables(spark, SF_SMALL, with_district=False).items():
        _store(df, target, name)
    rows = canonical_rows(read_shipments(spark, target, CFG, num_partitions=2), CFG.timestamp_format)
    assert rows.filter((F.col("district") != "") | (F.col("channel_source_code") != "")).count() == 0
    assert rows.count() > 0

    empty = _target("empty")
    for name, df in D.source_tables(spark, SF_SMALL).items():
        _store(df.limit(0), empty, name)
    assert read_shipments(spark, empty, CFG).count() == 0


def test_append_sink(spark):
    target = _target("sink")
    df = spark.createDataFrame([(True, "a", "b"), (True, "c", "d")], "enabled boolean, x string, y string")
    append(df, target, "contacts", batch_size=1)
    append(df, target, "contacts")
    back = read_query(spark, target, "SELECT * FROM contacts")
    assert back.count() == 4


def test_multi_source_job_end_to_end(spark, source_db):
    """Two databases (one encrypted, one without district) -> one plan -> one append."""
    from addrflow.plans.job import contacts_from_sources, run_jdbc_job
    from addrflow.plans.queries import RUN_TS

    enc_db = _target("enc")
    for name, df in D.source_tables(spark, SF_SMALL, with_district=False, encrypted=True).items():
        _store(df, enc_db, name)
    sink = _target("sink-job")
    keys, pins = D.key_export(spark, SF_SMALL), D.pincode_lookup(spark, SF_SMALL)
    res = run_jdbc_job(spark, CFG, [source_db, enc_db], keys, pins, sink, "contact_rows", read_partitions=3,
                       stage_name=f"raw-test-{uuid.uuid4().hex}")
    written = read_query(spark, sink, "SELECT * FROM contact_rows")
    written = written.toDF(*[c.lower() for c in written.columns])
    assert res.rows == written.count() > 0
    # the same result straight from the DataFrame sources
    plain = assembled(spark, SF_SMALL, CFG, encrypted=False)
    enc = assembled(spark, SF_SMALL, CFG, encrypted=True, with_district=False)
    want = contacts_from_sources([plain, enc], keys, pins, CFG)
    assert want.count() == res.rows
    cols = [c for c in want.columns if c != "enabled"]
    assert written.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert all(r.record_created == RUN_TS for r in written.select("record_created").distinct().collect())


def test_window_bounds_and_adaptive_partitions(spark, source_db):
    from addrflow.sources.jdbc import window_id_bounds

    lo, hi = window_id_bounds(spark, source_db, CFG)
    li = D.read_table(spark, SF_SMALL, "lineitem")
    w = li.filter((F.col("l_shipdate") >= "1996-01-01") & (F.col("l_shipdate") < "1999-01-01"))
    exp = w.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    assert (lo, hi) == (exp[0], exp[1])
    df = read_shipments(spark, source_db, CFG, ids_per_partition=1000)
    assert df.rdd.getNumPartitions() == -(-(hi - lo + 1) // 1000)


def test_closed_databases_over_jdbc(spark):
    import datetime as dt
    from addrflow.config import JobConfig
    from addrflow.sources.jdbc import read_closed_databases

    t = _target("closed")
    _store(spark.createDataFrame(
        [("db1", "production", None), ("db2", "production", dt.datetime(2020, 1, 15)),
         ("db3", "production", dt.datetime(2020, 3, 1)), ("empty", "production", None), ("mysql", "production", None)],
        "terminated_server string, type string, terminated_on timestamp"), t, "terminated_info")
    _store(spark.createDataFrame([("db1",), ("db2",), ("db3",), ("empty",), ("mysql",)], "SCHEMA_NAME string"), t, "schemata")
    _store(spark.createDataFrame([("db1",), ("db2",), ("db3",), ("mysql",)], "TABLE_SCHEMA string"), t, "tables_list")
    cfg = JobConfig(from_ts="2020-01-01 00:00:00", till_ts="2020-02-01 00:00:00", run_ts="r")
    got = read_closed_databases(spark, t, cfg, "terminated_info", "schemata", "tables_list")
    assert sorted(r.db for r in got.collect()) == ["db1", "db2"]


def test_counts_of_the_run_equal_stage_counts(spark, source_db):
    """One pass: the run's own observations against ``stage_counts`` on the same input; one source fails."""
    from addrflow.operators.metrics import stage_counts
    from addrflow.plans.job import run_jdbc_job

    enc_db = _target("enc-counts")
    for name, df in D.source_tables(spark, SF_SMALL, encrypted=True).items():
        _store(df, enc_db, name)
    good = JdbcTarget(enc_db.url, enc_db.properties, "good")
    bad = JdbcTarget("jdbc:derby:/nowhere/at/all", {"driver": DRIVER}, "bad")
    sink = _target("sink-counts")
    keys, pins = D.key_export(spark, SF_SMALL), D.pincode_lookup(spark, SF_SMALL)
    res = run_jdbc_job(spark, CFG, [good, bad], keys, pins, sink, "contact_rows", read_partitions=2, sink_connections=3)
    want = dict(map(tuple, stage_counts(assembled(spark, SF_SMALL, CFG, encrypted=True), keys, pins, CFG).collect()))
    assert list(res.failed) == ["bad"] and res.source_rows == {"good": want["rows_read"]}
    assert (res.read, res.encrypted, res.plain) == (want["rows_read"], want["rows_encrypted"], want["rows_plain"])
    assert res.undecrypted == want["values_undecrypted"]
    assert (res.rows, res.with_mobile, res.with_email) == (want["contact_rows"], want["with_mobile"], want["with_email"])
    assert res.seconds > 0 and set(res.source_seconds) == {"good", "bad"}
    assert read_query(spark, sink, "SELECT * FROM contact_rows").count() == res.rows


def test_every_source_failing_is_an_error(spark):
    from addrflow.plans.job import run_jdbc_job

    bad = JdbcTarget("jdbc:derby:/nowhere/at/all", {"driver": DRIVER}, "bad")
    with pytest.raises(RuntimeError, match="no source"):
        run_jdbc_job(spark, CFG, [bad], D.key_export(spark, SF_SMALL), D.pincode_lookup(spark, SF_SMALL), _target("s"), "t")


def test_sink_appends_in_rounds_and_leaves_nothing_staged(spark):
    target = _target("rounds")
    df = spark.range(0, 1000, 1, 10).selectExpr("id", "concat('r', id) as t")
    append(df, target, "contacts", max_connections=3)
    assert read_query(spark, target, "SELECT * FROM contacts").count() == 1000
