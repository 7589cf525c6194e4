"""Append ledger, equal-row splits, and sources that fail while they are read (embedded Derby)."""

import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from addrflow.operators.filters import canonical_rows
from addrflow.operators.metrics import stage_counts
from addrflow.plans import job as J
from addrflow.plans.queries import CFG, assembled
from addrflow.session import ensure_checkpoint_dir
from addrflow.sources import driver_tables as D
from addrflow.sources import jdbc
from addrflow.sources.jdbc import JdbcTarget, append_by_ledger, read_query, read_shipments, window_parts
from addrflow.sources.ledger import Ledger, append_once, missing_rows, rounds_by_bytes
from addrflow.sources.splits import Part, equal_parts
from tests.conftest import SF_SMALL
from tests.test_jdbc import _store, _target


# Ledger


def _rows(spark, n=100, parts=10):
    return spark.range(0, n, 1, parts).selectExpr("cast(id % 37 as string) as a", "if(id % 5 = 0, null, concat('v', id % 11)) as b")


def _maker(df, calls):
    def make(path):
        calls.append(path)
        df.write.parquet(f"{path}/all")

    return make


def _counted(df):
    return Counter(map(tuple, df.collect()))


def test_rounds_follow_the_bytes():
    sizes = [("a", 4), ("b", 5), ("c", 20), ("d", 1), ("e", 9), ("f", 1)]
    assert rounds_by_bytes(sizes, 10) == [["a", "b"], ["c"], ["d", "e"], ["f"]]
    assert rounds_by_bytes([], 10) == []


def test_missing_rows_count_repeats(spark):
    staged = spark.createDataFrame([("x", None)] * 3 + [("y", "1")], "a string, b string")
    present = spark.createDataFrame([(None, "x"), ("9", "z")], "B string, A string")
    assert _counted(missing_rows(staged, present)) == {("x", None): 2, ("y", "1"): 1}


@pytest.mark.parametrize("fails", ["between rounds", "within a round", "after a round", "twice"])
def test_a_rerun_appends_what_is_missing(spark, tmp_path, fails):
    """Wherever a run ends, reruns leave every row as often as it was staged, and stage nothing again."""
    df, sink, calls, name = _rows(spark), f"{tmp_path}/sink", [], uuid.uuid4().hex
    want = _counted(df)
    done = {"rounds": 0, "faults": 0}
    most = 2 if fails == "twice" else 1

    def write(part):
        done["rounds"] += 1
        fault = done["rounds"] >= 3 and done["faults"] < most
        if fault and fails == "between rounds":
            done["faults"] += 1
            raise RuntimeError("lost")
        if fault and fails != "after a round":  # some transactions are in, others not
            part.filter("a < '2'").write.mode("append").parquet(sink)
            done["faults"] += 1
            raise RuntimeError("lost")
        part.write.mode("append").parquet(sink)
        if fault:
            done["faults"] += 1
            raise RuntimeError("lost")

    def present(schema):
        return spark.read.schema(schema).parquet(sink)

    for _ in range(most):
        with pytest.raises(RuntimeError):
            append_once(spark, name, _maker(df, calls), write, present, round_bytes=2500)
    assert append_once(spark, name, _maker(df, calls), write, present, round_bytes=2500) >= 1
    assert _counted(spark.read.parquet(sink)) == want
    assert len(calls) == 1
    assert append_once(spark, name, _maker(df, calls), write, present) == 0  # complete
    assert _counted(spark.read.parquet(sink)) == want
    ledger = Ledger(spark, name)
    assert ledger.complete and not ledger._has("rows")


def test_a_run_that_ends_while_staging_stages_again(spark, tmp_path):
    df, sink, name = _rows(spark), f"{tmp_path}/sink", uuid.uuid4().hex

    def half(path):
        df.limit(7).write.parquet(f"{path}/some")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        append_once(spark, name, half, lambda part: None, None)
    append_once(spark, name, _maker(df, []), lambda part: part.write.mode("append").parquet(sink), None)
    assert _counted(spark.read.parquet(sink)) == _counted(df)


def test_job_rerun_by_ledger_leaves_no_duplicate(spark, monkeypatch):
    """The job on Derby: the third round fails, the rerun reads no source and completes the table."""
    src = _target("ledger-src")
    for name, df in D.source_tables(spark, SF_SMALL).items():
        _store(df, src, name)
    src = JdbcTarget(src.url, src.properties, "src")
    keys, pins = D.key_export(spark, SF_SMALL), D.pincode_lookup(spark, SF_SMALL)
    want = J.contacts_from_sources([assembled(spark, SF_SMALL, CFG, encrypted=False)], keys, pins, CFG)
    sink, run = _target("ledger-sink"), uuid.uuid4().hex
    # Spark would make CLOB columns, which Derby can't compare.
    columns = ", ".join(f"{c} {'BOOLEAN' if c == 'enabled' else 'VARCHAR(512)'}" for c in want.columns)
    manager = spark.sparkContext._jvm.java.sql.DriverManager
    manager.getConnection(sink.url).createStatement().execute(f"CREATE TABLE contact_rows ({columns})")
    real, seen = jdbc.writer, {"n": 0}

    def faulty(*a, **b):
        write = real(*a, **b)

        def one(part):
            seen["n"] += 1
            if seen["n"] == 3:
                write(part.limit(5))
                raise RuntimeError("lost")
            write(part)

        return one

    monkeypatch.setattr(jdbc, "writer", faulty)
    call = dict(read_partitions=4, sink_connections=2, ledger=run, round_bytes=15_000)
    with pytest.raises(RuntimeError):
        J.run_jdbc_job(spark, CFG, [src], keys, pins, sink, "contact_rows", **call)
    part = read_query(spark, sink, "SELECT * FROM contact_rows").count()
    assert 0 < part < want.count()
    nowhere = JdbcTarget("jdbc:derby:/nowhere/at/all", src.properties, "src")
    res = J.run_jdbc_job(spark, CFG, [nowhere], keys, pins, sink, "contact_rows", **call)
    written = read_query(spark, sink, "SELECT * FROM contact_rows")
    written = written.toDF(*[c.lower() for c in written.columns])
    cols = [c for c in want.columns if c != "enabled"]
    assert written.count() == want.count() == res.rows
    assert written.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert J.run_jdbc_job(spark, CFG, [nowhere], keys, pins, sink, "contact_rows", **call).by_source == res.by_source
    assert read_query(spark, sink, "SELECT * FROM contact_rows").count() == res.rows


# Splits


def _counter(ids):
    rows = Counter(ids)

    def count(width, ranges):
        base, out = min(rows), Counter()
        for i, n in rows.items():
            if any(a <= i < b for a, b in ranges):
                out[i - (i - base) % width] += n
        assert len(out) <= 4096 * 64
        return dict(out)

    return count


def _reads(part, ids):
    """Rows of (id, other) that a part reads."""
    return [
        (i, o) for i, o in ids
        if (part.lo is None or i >= part.lo) and (part.hi is None or i < part.hi) and (part.ways == 1 or o % part.ways == part.way)
    ]


@pytest.mark.parametrize("seed", range(6))
def test_parts_hold_every_row_once_and_alike(seed):
    """Ids far apart, dense clusters and hot ids."""
    rng = random.Random(seed)
    ids = [rng.randrange(10**9) for _ in range(300)] + [10**12 + rng.randrange(500) for _ in range(20_000)]
    ids += [5 * 10**11] * rng.choice([0, 1, 9000]) + [10**12 + 7] * 4000 + [rng.randrange(10**12) for _ in range(3000)]
    rows = [(i, rng.randrange(10**6)) for i in ids]
    parts = equal_parts(_counter(ids), min(ids), max(ids), 1000)
    read = [len(_reads(p, rows)) for p in parts]
    assert sum(read) == len(rows) and Counter(x for p in parts for x in _reads(p, rows)) == Counter(rows)
    assert parts[0].lo is None and parts[-1].hi is None
    assert max(read) <= 1500
    plain = [n for p, q, n in zip(parts, parts[1:], read, strict=False) if p.ways == 1 and q.ways == 1]
    assert min(plain) * 2 >= max(plain)


def test_few_rows_far_apart_are_one_part():
    ids = [1, 4_000_000_000]
    assert equal_parts(_counter(ids), 1, 4_000_000_000, 1000) == [Part(None, None, 2)]
    assert equal_parts(lambda w, r: {}, 1, 9, 10) == []


def test_skewed_ids_give_tasks_of_like_size(spark):
    """Derby: shipments of ids in three far-apart clusters; every row once, tasks within twice of each other."""
    t = D.source_tables(spark, SF_SMALL)
    far = F.col("sale_order_id") % 3 * 1_000_000_007

    def moved(c):
        return F.col(c).cast("long") + F.col(c) % 3 * 1_000_000_007

    t = {
        **t,
        "shipping_package": t["shipping_package"].withColumn("shipping_address_id", (F.col("shipping_address_id") + far).cast("long")),
        "address_detail": t["address_detail"].withColumn("id", moved("id")),
    }
    db = _target("skewed")
    for name, df in t.items():
        _store(df, db, name)
    parts = window_parts(spark, db, CFG, 300)
    rows = [p.rows for p in parts[:-1]]
    assert len(parts) > 5 and max(rows) <= 2 * min(rows)
    raw = read_shipments(spark, db, CFG, rows_per_partition=300)
    assert raw.rdd.getNumPartitions() == len(parts)
    want = assembled(spark, SF_SMALL, CFG, encrypted=False)
    got = canonical_rows(raw, CFG.timestamp_format)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    bound = read_shipments(spark, db, CFG, rows_per_partition=300, max_connections=2)
    assert bound.rdd.getNumPartitions() == 2 and bound.count() == want.count()


# Sources


def test_isolated_leaves_out_what_fails_alone():
    tried = []

    def attempt(names):
        tried.append(names)
        if {"c", "f"} & set(names):
            raise ValueError("x")
        return {n: 1 for n in names}

    done, failed = J.isolated(list("abcdefgh"), attempt)
    assert {n for d in done for n in d} == set("abdegh") and failed == {"c": "ValueError", "f": "ValueError"}
    assert J.isolated(["a"], attempt) == ([{"a": 1}], {})


def test_a_source_that_fails_while_it_is_read_stands_alone(spark):
    """Unstaged: its probes work, its read does not; the others' rows and counts by source are whole."""
    frames = {
        "enc": assembled(spark, SF_SMALL, CFG, encrypted=True),
        "broken": assembled(spark, SF_SMALL, CFG, encrypted=False).withColumn("city", F.expr("raise_error('lost')").cast("string")),
        "plain": assembled(spark, SF_SMALL, CFG, encrypted=False),
        "none": assembled(spark, SF_SMALL, CFG, encrypted=False).filter("false"),
    }
    keys, pins = D.key_export(spark, SF_SMALL), D.pincode_lookup(spark, SF_SMALL)
    path = f"{ensure_checkpoint_dir(spark)}/isolated-{uuid.uuid4().hex}"
    counts, failed = J.stage_contacts(spark, frames, keys, pins, CFG, path)
    assert list(failed) == ["broken"] and set(counts) == {"enc", "plain", "none"}
    for name in counts:
        want = dict(map(tuple, stage_counts(frames[name], keys, pins, CFG).collect()))
        got = counts[name]
        assert (got["read"], got["encrypted"], got["plain"]) == (want["rows_read"], want["rows_encrypted"], want["rows_plain"])
        assert (got["undecrypted"], got["rows"]) == (want["values_undecrypted"], want["contact_rows"])
        assert (got["with_mobile"], got["with_email"]) == (want["with_mobile"], want["with_email"])
    written = spark.read.option("recursiveFileLookup", "true").parquet(path)
    want = J.contacts_from_sources([frames["enc"], frames["plain"]], keys, pins, CFG)
    assert written.count() == want.count() == sum(c["rows"] for c in counts.values())
    assert written.exceptAll(want).count() == 0


def test_a_database_that_goes_away_after_its_probes(spark):
    """The same through the whole job: the table behind one source is dropped before it is read."""
    good, bad = _target("good"), _target("gone")
    for db in (good, bad):
        for name, df in D.source_tables(spark, SF_SMALL).items():
            _store(df, db, name)
    good, bad = JdbcTarget(good.url, good.properties, "good"), JdbcTarget(bad.url, bad.properties, "bad")
    real = J.read_shipments

    def read(session, target, cfg, *a, **b):
        df = real(session, target, cfg, *a, **b)
        if target.name == "bad":
            session.sparkContext._jvm.java.sql.DriverManager.getConnection(target.url).createStatement().execute("DROP TABLE party")
        return df

    keys, pins = D.key_export(spark, SF_SMALL), D.pincode_lookup(spark, SF_SMALL)
    sink = _target("isolated-sink")
    J.read_shipments = read
    try:
        res = J.run_jdbc_job(spark, CFG, [good, bad], keys, pins, sink, "contact_rows", sink_connections=2)
    finally:
        J.read_shipments = real
    assert list(res.failed) == ["bad"] and set(res.by_source) == {"good"}
    want = J.contacts_from_sources([assembled(spark, SF_SMALL, CFG, encrypted=False)], keys, pins, CFG).count()
    assert res.rows == want == read_query(spark, sink, "SELECT * FROM contact_rows").count()
