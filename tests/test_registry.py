"""Source selection: registry flags, exclusions, NULL-aware NOT IN, window edges."""

import datetime as dt

from addrflow.operators.registry import active_servers, closed_databases

SYS = ("information_schema", "mysql")


def test_active_servers(spark):
    reg = spark.createDataFrame(
        [("a", "true", "true"), ("a", "true", "true"), ("b", "TRUE", "true"), ("c", "true", "false"), ("d", "true", "true")],
        "db string, production string, active string",
    )
    exc = spark.createDataFrame([("d",)], "db string")
    assert sorted(r.db for r in active_servers(reg, exc).collect()) == ["a"]


def _closed(spark, schemata_rows):
    ti = spark.createDataFrame(
        [
            ("db1", "production", None),
            ("db2", "production", dt.datetime(2020, 1, 1)),  # at from: kept
            ("db3", "production", dt.datetime(2020, 2, 1)),  # at till: dropped
            ("db4", "staging", None),
            ("empty", "production", None),  # schema without tables: dropped
            ("mysql", "production", None),  # system schema: dropped
            ("db1", "production", None),
        ],
        "terminated_server string, type string, terminated_on timestamp",
    )
    sc = spark.createDataFrame(schemata_rows, "SCHEMA_NAME string")
    tb = spark.createDataFrame([("db1",), ("db2",), ("db3",)], "TABLE_SCHEMA string")
    return closed_databases(ti, sc, tb, "2020-01-01 00:00:00", "2020-02-01 00:00:00", SYS)


def test_closed_databases(spark):
    got = sorted(r.db for r in _closed(spark, [("db1",), ("db2",), ("empty",)]).collect())
    assert got == ["db1", "db2"]


def test_null_in_not_in_list_empties_result(spark):
    assert _closed(spark, [("db1",), ("empty",), (None,)]).count() == 0


def test_not_in_without_broadcast_matches_sql_semantics(spark):
    from addrflow.operators.registry import not_in

    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    for values, want in (
        ([("a",)], ["b"]),
        ([("a",), (None,)], []),
        ([], ["a", "b", None]),
    ):
        lst = spark.createDataFrame(values, "w string")
        out = not_in(df, "v", lst)
        got = sorted((r.v for r in out.collect()), key=lambda x: (x is None, x))
        assert got == want, (values, got)
        assert "BroadcastNestedLoopJoin" not in out._jdf.queryExecution().executedPlan().toString()
