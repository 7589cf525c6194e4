"""Command-line entry: one run of the contact job for the window in ``spark.driver.args``.

    spark-submit --py-files addrflow.zip \
                 --conf spark.driver.args="2024-01-01 00:00:00,2024-01-02 00:00:00" \
                 --conf spark.addrflow.config=/path/job.json  addrflow/plans/main.py

``job.json`` (credentials stay in this file; nothing here logs them)::

    {"run_ts": "...",                       # optional, default: now (one value for the whole run)
     "registry": {"path": "...", "format": "json", "excluded": ["db-a", ...]},
     "source": {"scheme": "mysql", "port": 3306, "database": "main", "params": {...},
                "url_template": "jdbc:...{host}...{database}",   # optional, instead of scheme/port/params
                "properties": {"user": "...", "password": "...", "driver": "..."}},
     "closed": {"url": "jdbc:...", "properties": {...}, "host": "<server of the closed databases>",
                "terminated_table": "...", "schemata_table": "...", "tables_table": "..."},
     "pincodes": "/path/pincodes.csv",
     "keys": {"path": "...", "format": "parquet"},
     "sink": {"url": "jdbc:...", "table": "...", "properties": {...}, "connections": 64},
     "stage_name": null,                    # a name: raw rows are staged before the transform
     "ledger": null,                        # a name: a rerun under it appends only what is missing
     "source_connections": null,            # most connections to one source at once
     "job": {"excluded_tenants": [...], "key_path": {"prefix": "...", ...}, ...}}   # JobConfig fields
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from addrflow.config import JobConfig, KeyPathFormat, parse_window_arg
from addrflow.operators.registry import active_servers
from addrflow.plans.job import RunResult, run_jdbc_job
from addrflow.sources.files import read_pincodes, read_registry
from addrflow.sources.jdbc import JdbcTarget, jdbc_url, read_closed_databases


def source_names(active: DataFrame, closed: DataFrame | None) -> tuple[list[str], list[str]]:
    """Names of the servers and closed databases to read (small catalog lists, sorted)."""
    servers = sorted(r.db for r in active.select("db").collect())
    dbs = sorted(r.db for r in closed.select("db").collect()) if closed is not None else []
    return servers, dbs


def run_from_config(spark: SparkSession, window: str, conf: dict) -> RunResult:
    from_ts, till_ts = parse_window_arg(window)
    run_ts = conf.get("run_ts") or dt.datetime.now().isoformat(timespec="milliseconds")
    cfg = JobConfig(from_ts=from_ts, till_ts=till_ts, run_ts=run_ts, **_job_fields(conf.get("job", {})))

    reg = conf["registry"]
    excluded = spark.createDataFrame([(x,) for x in reg.get("excluded", [])], "db string")
    active = active_servers(read_registry(spark, reg["path"], reg.get("format", "json")), excluded)
    closed_conf = conf.get("closed")
    closed = None
    if closed_conf:
        closed_target = JdbcTarget(closed_conf["url"], closed_conf.get("properties", {}))
        closed = read_closed_databases(
            spark,
            closed_target,
            cfg,
            closed_conf.get("terminated_table", "terminated_info"),
            closed_conf.get("schemata_table", "INFORMATION_SCHEMA.SCHEMATA"),
            closed_conf.get("tables_table", "INFORMATION_SCHEMA.TABLES"),
        )
    servers, dbs = source_names(active, closed)

    src = conf["source"]
    props = src.get("properties", {})

    def target(host: str, database: str) -> JdbcTarget:
        name = f"{host}/{database}"
        if "url_template" in src:  # e.g. "jdbc:otherdb://{host}/{database}"
            return JdbcTarget(src["url_template"].format(host=host, database=database), props, name)
        url = jdbc_url(host, database, src.get("port", 3306), src.get("scheme", "mysql"), src.get("params"))
        return JdbcTarget(url, props, name)

    targets = [target(s, src.get("database", "")) for s in servers]
    if closed_conf:
        targets += [target(closed_conf["host"], d) for d in dbs]

    keys = conf["keys"]
    key_export = spark.read.format(keys.get("format", "parquet")).load(keys["path"])
    pincodes = read_pincodes(spark, conf["pincodes"])
    sink = conf["sink"]
    return run_jdbc_job(
        spark, cfg, targets, key_export, pincodes, JdbcTarget(sink["url"], sink.get("properties", {})), sink["table"],
        stage_name=conf.get("stage_name"), sink_connections=sink.get("connections", 64),
        ledger=conf.get("ledger"), source_connections=conf.get("source_connections"),
    )


def _job_fields(job: dict) -> dict:
    """JobConfig fields of the job file; a name that is none of them is an error."""
    allowed = set(JobConfig.__dataclass_fields__) - {"from_ts", "till_ts", "run_ts"}
    if unknown := sorted(set(job) - allowed):
        raise ValueError(f"unknown job settings: {unknown}; known: {sorted(allowed)}")
    out = {k: (tuple(v) if isinstance(v, list) else v) for k, v in job.items()}
    if "key_path" in out:
        known = set(KeyPathFormat.__dataclass_fields__)
        if unknown := sorted(set(out["key_path"]) - known):
            raise ValueError(f"unknown key_path settings: {unknown}; known: {sorted(known)}")
        out["key_path"] = KeyPathFormat(**out["key_path"])
    return out


def main(argv: list[str] | None = None) -> int:
    spark = SparkSession.builder.getOrCreate()
    argv = sys.argv[1:] if argv is None else argv
    window = argv[0] if argv else spark.conf.get("spark.driver.args")
    with open(spark.conf.get("spark.addrflow.config")) as fh:
        conf = json.load(fh)
    result = run_from_config(spark, window, conf)
    print(json.dumps(dataclasses.asdict(result)))
    return 1 if result.failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
