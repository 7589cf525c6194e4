"""CSV pincode lookup and registry file source."""

import os
import tempfile

from addrflow.config import JobConfig
from addrflow.operators.contacts import contact_rows
from addrflow.operators.registry import active_servers
from addrflow.schema import SHIPMENT_FIELDS
from addrflow.sources.files import read_pincodes, read_registry


def test_csv_lookup_no_fanout(spark):
    d = tempfile.mkdtemp(prefix="addrflow-csv-")
    with open(os.path.join(d, "pincodes.csv"), "w") as f:
        f.write("Pincode,District\nPO1234,A\nPO1234,B\n000001,C\n")
    lookup = read_pincodes(spark, d)
    assert sorted(r.Pincode for r in lookup.collect()) == ["000001", "PO1234"]
    rows = [tuple({"mobile": "9876543210", "pincode": p}.get(f, "") for f in SHIPMENT_FIELDS) for p in ("PO1234", "000001", "x")]
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in SHIPMENT_FIELDS))
    cfg = JobConfig(from_ts="2000-01-01", till_ts="2001-01-01", run_ts="r")
    out = contact_rows(df, lookup, cfg)
    assert sorted(r.pincode for r in out.collect()) == ["000001", "PO1234"]


def test_registry_json(spark):
    d = tempfile.mkdtemp(prefix="addrflow-reg-")
    with open(os.path.join(d, "r.json"), "w") as f:
        f.write('{"db": "a", "production": "true", "active": "true"}\n{"db": "b", "production": "true", "active": "no"}\n')
    assert [r.db for r in active_servers(read_registry(spark, d)).collect()] == ["a"]
