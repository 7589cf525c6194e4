"""The command-line job end to end: registry + closed tenants -> many sources -> one sink."""

import datetime as dt
import json
import os
import tempfile
import uuid

from addrflow.plans.job import contacts_from_sources
from addrflow.plans.main import main, run_from_config
from addrflow.plans.queries import CFG, assembled
from addrflow.sources import driver_tables as D
from addrflow.sources.jdbc import read_query
from tests.conftest import SF_SMALL
from tests.test_jdbc import DRIVER, _store, JdbcTarget


def test_run_from_config(spark):
    root = tempfile.mkdtemp(prefix="addrflow-main-")
    template = "jdbc:derby:" + root + "/{host}_{database};create=true"
    url = lambda host, db: template.format(host=host, database=db)
    props = {"driver": DRIVER}
    # two live servers, one inactive and one excluded; one closed tenant database on server "closed"
    for host, enc, district in (("srvA", False, True), ("srvB", True, True), ("closed", True, False)):
        db = "tenant_x" if host == "closed" else "main"
        for name, df in D.source_tables(spark, SF_SMALL, with_district=district, encrypted=enc).items():
            _store(df, JdbcTarget(url(host, db), props), name)
    info = JdbcTarget(url("closed", "catalog"), props)
    _store(spark.createDataFrame([("tenant_x", "production", None), ("tenant_y", "production", dt.datetime(1990, 1, 1))],
                                 "terminated_server string, type string, terminated_on timestamp"), info, "terminated_info")
    _store(spark.createDataFrame([("tenant_x",), ("tenant_y",)], "SCHEMA_NAME string"), info, "schemata")
    _store(spark.createDataFrame([("tenant_x",), ("tenant_y",)], "TABLE_SCHEMA string"), info, "tables_list")
    with open(os.path.join(root, "registry.json"), "w") as f:
        for db, prod, act in (("srvA", "true", "true"), ("srvB", "true", "true"), ("srvC", "true", "false"), ("srvD", "true", "true")):
            f.write(json.dumps({"db": db, "production": prod, "active": act}) + "\n")
    with open(os.path.join(root, "pincodes.csv"), "w") as f:
        f.write("Pincode\n" + "\n".join(r.Pincode for r in D.pincode_lookup(spark, SF_SMALL).collect()) + "\n")
    D.key_export(spark, SF_SMALL).write.parquet(os.path.join(root, "keys"))
    sink_url = url("sink", "out")
    conf = {
        "run_ts": CFG.run_ts,
        "registry": {"path": os.path.join(root, "registry.json"), "excluded": ["srvD"]},
        "source": {"url_template": template, "database": "main", "properties": props},
        "closed": {"url": info.url, "properties": props, "host": "closed", "terminated_table": "terminated_info",
                   "schemata_table": "schemata", "tables_table": "tables_list"},
        "pincodes": os.path.join(root, "pincodes.csv"),
        "keys": {"path": os.path.join(root, "keys")},
        "sink": {"url": sink_url, "table": "contact_rows", "properties": props},
        "job": {"excluded_tenants": list(CFG.excluded_tenants)},
        "stage_name": f"main-test-{uuid.uuid4().hex}",
    }
    res = run_from_config(spark, f"{CFG.from_ts},{CFG.till_ts}", conf)
    written = read_query(spark, JdbcTarget(sink_url, props), "SELECT * FROM contact_rows")
    written = written.toDF(*[c.lower() for c in written.columns])
    want = contacts_from_sources(
        [assembled(spark, SF_SMALL, CFG, encrypted=False), assembled(spark, SF_SMALL, CFG, encrypted=True),
         assembled(spark, SF_SMALL, CFG, encrypted=True, with_district=False)],
        D.key_export(spark, SF_SMALL), D.pincode_lookup(spark, SF_SMALL), CFG,
    )
    cols = [c for c in want.columns if c != "enabled"]
    assert res.rows == written.count() == want.count() > 0
    assert set(res.source_rows) == {"srvA/main", "srvB/main", "closed/tenant_x"}
    # ciphertext phones never match the masked/placeholder filters, so the encrypted source reads more
    assert res.source_rows["srvA/main"] == assembled(spark, SF_SMALL, CFG, encrypted=False).count()
    assert res.source_rows["srvB/main"] == assembled(spark, SF_SMALL, CFG, encrypted=True).count()
    assert res.source_rows["closed/tenant_x"] == res.source_rows["srvB/main"]
    assert written.select(*cols).exceptAll(want.select(*cols)).count() == 0

    # the same through main(): window from the arguments, configuration file from the session
    conf["sink"]["table"] = "contact_rows_2"
    conf["stage_name"] = f"main-test-{uuid.uuid4().hex}"
    path = os.path.join(root, "job.json")
    with open(path, "w") as f:
        json.dump(conf, f)
    spark.conf.set("spark.addrflow.config", path)
    assert main([f"{CFG.from_ts},{CFG.till_ts}"]) == 0
    assert read_query(spark, JdbcTarget(sink_url, props), "SELECT * FROM contact_rows_2").count() == res.rows
    assert {r.record_created for r in written.select("record_created").collect()} == {CFG.run_ts}
