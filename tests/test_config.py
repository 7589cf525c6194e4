"""Run parameters, JDBC URL text and the pushed query's guards."""

import pytest

from addrflow.config import JobConfig, parse_window_arg
from addrflow.sources.jdbc import jdbc_url, shipment_query


def test_parse_window_arg():
    assert parse_window_arg("2024-01-01 00:00:00, 2024-01-02 00:00:00") == ("2024-01-01 00:00:00", "2024-01-02 00:00:00")
    for bad in ("2024-01-01", "a,b,c", ",x"):
        with pytest.raises(ValueError):
            parse_window_arg(bad)


def test_jdbc_url():
    assert jdbc_url("db1", "main") == "jdbc:mysql://db1:3306/main"
    assert jdbc_url("h", "d", 5432, "postgresql", {"ssl": "true", "a": "b"}) == "jdbc:postgresql://h:5432/d?ssl=true&a=b"


def test_shipment_query_guards():
    cfg = JobConfig(from_ts="2024-01-01 00:00:00", till_ts="2024-01-02", run_ts="r", excluded_tenants=("o'brien",))
    sql = shipment_query(cfg)
    assert "NOT IN ('o''brien')" in sql
    assert "address_detail.district AS district" in sql and "'' AS district" in shipment_query(cfg, has_district=False)
    with pytest.raises(ValueError):
        shipment_query(JobConfig(from_ts="2024-01-01'; DROP TABLE x; --", till_ts="2024-01-02", run_ts="r"))
    with pytest.raises(ValueError):
        shipment_query(JobConfig(from_ts="2024-01-01", till_ts="2024-01-02", run_ts="r", country_collation="UTF8_LCASE"))


@pytest.mark.parametrize(
    ("url", "low", "high"),
    [
        ("jdbc:mysql://h/db", "'2024-01-01 00:00:00'", "'2024-01-02'"),
        ("jdbc:mariadb://h/db", "'2024-01-01 00:00:00'", "'2024-01-02'"),
        ("jdbc:postgresql://h/db", "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-02 00:00:00'"),
        ("jdbc:derby:/x", "TIMESTAMP('2024-01-01 00:00:00')", "TIMESTAMP('2024-01-02 00:00:00')"),
    ],
)
def test_timestamps_in_the_database_dialect(url, low, high):
    cfg = JobConfig(from_ts="2024-01-01 00:00:00", till_ts="2024-01-02", run_ts="r")
    sql = shipment_query(cfg, url=url)
    assert f"shipping_package.created >= {low} AND shipping_package.created < {high} " in sql
    assert "CAST(" not in sql


def test_job_settings_are_known_or_refused():
    from addrflow.plans.main import _job_fields

    got = _job_fields({"excluded_tenants": ["a"], "key_path": {"prefix": "p/", "tenant_suffix": "_t", "version": "2"}})
    assert got["excluded_tenants"] == ("a",) and got["key_path"].prefix == "p/" and got["key_path"].version == "2"
    with pytest.raises(ValueError, match="excluded_tenant"):
        _job_fields({"excluded_tenant": ["a"]})
    with pytest.raises(ValueError, match="prefx"):
        _job_fields({"key_path": {"prefx": "p/"}})

def test_jdbc_append_refuses_speculation(spark):
    from addrflow.sources.jdbc import check_no_speculation

    check_no_speculation(spark)  # the test session does not speculate

    class _Conf:
        def get(self, key, default=None):
            return "true" if key == "spark.speculation" else default

    class _Session:
        conf = _Conf()

    with pytest.raises(ValueError, match="speculation"):
        check_no_speculation(_Session())
