"""JDBC sources and sink.

Credentials are passed in by the caller (``JdbcTarget.properties``) and never logged or stored.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from addrflow.config import JobConfig
from addrflow.schema import OPTIONAL_FIELDS, SHIPMENT_SCHEMA, SOURCE_COLUMNS, SOURCE_JOINS
from addrflow.session import drop_staged, staging_path
from addrflow.sources.ledger import ROUND_BYTES, append_once, file_sizes, rounds_by_bytes
from addrflow.sources.splits import Part, equal_parts

FETCH_SIZE = 50_000
WRITE_BATCH = 50_000
_TS = re.compile(r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$")
_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_$.]*$")


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    properties: dict[str, str] = field(default_factory=dict, repr=False)  # user, password, driver, ...
    name: str = ""  # label for reports (never the URL, which may carry options)

    def options(self) -> dict[str, str]:
        return {"url": self.url, **self.properties}


def jdbc_url(host: str, database: str = "", port: int = 3306, scheme: str = "mysql", params: dict | None = None) -> str:
    """``jdbc:<scheme>://host:port/database?k=v&...``."""
    query = "&".join(f"{k}={v}" for k, v in (params or {}).items())
    return f"jdbc:{scheme}://{host}:{port}/{database}" + (f"?{query}" if query else "")


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_list(values) -> str:
    return "(" + ", ".join(_sql_text(v) for v in values) + ")"


def _checked_ts(value: str) -> str:
    if not _TS.match(value):
        raise ValueError("window bounds must look like 'YYYY-MM-DD[ HH:MM[:SS[.ffffff]]]'")
    return value


def timestamp_literal(url: str, value: str) -> str:
    """A timestamp in the SQL of the database behind ``url``.

    MySQL and MariaDB compare a column with the plain text; Derby has a function; the others take
    the standard literal.
    """
    text = _sql_text(_checked_ts(value))
    scheme = url.split(":")[1].lower() if url.lower().startswith("jdbc:") else ""
    if scheme in ("mysql", "mariadb"):
        return text
    full = value if ":" in value else f"{value} 00:00:00"
    return f"TIMESTAMP({_sql_text(full)})" if scheme == "derby" else f"TIMESTAMP {_sql_text(full)}"


def _window(column: str, cfg: JobConfig, url: str) -> list[str]:
    return [f"{column} >= {timestamp_literal(url, cfg.from_ts)}", f"{column} < {timestamp_literal(url, cfg.till_ts)}"]


def shipment_query(cfg: JobConfig, has_district: bool = True, url: str = "jdbc:mysql:") -> str:
    """The source query, pushed to the database as one statement in its own dialect.

    Built from the maps that the DataFrame assembly uses. The country is compared by the database's
    own collation; a collation asked for in the config can't be pushed and is refused.
    """
    if cfg.country_collation:
        raise ValueError("country_collation applies to DataFrame sources; a database compares by its own collation")
    columns = [
        f"{table}.{column} AS {f}" if has_district or f not in OPTIONAL_FIELDS else f"'' AS {f}"
        for f, (table, column) in SOURCE_COLUMNS.items()
    ]
    columns += [f"{_sql_text(cfg.sync_status)} AS sale_order_sync_status", "address_detail.id AS address_id"]
    columns.append("shipping_package.sale_order_id AS order_id")
    joins = [f"JOIN {t} ON {t}.{c} = {other}.{oc}" for t, c, other, oc in SOURCE_JOINS]
    kept = [
        *_window("shipping_package.created", cfg, url),
        f"shipping_package.status_code IN {_sql_list(cfg.statuses)}",
        f"address_detail.country_code = {_sql_text(cfg.country)}",
        f"address_detail.phone NOT IN {_sql_list(cfg.placeholder_phones)}",
        "address_detail.phone NOT LIKE '*%'",
    ]
    if cfg.excluded_tenants:
        kept.append(f"tenant.code NOT IN {_sql_list(cfg.excluded_tenants)}")
    return " ".join(["SELECT", ", ".join(columns), "FROM shipping_package", *joins, "WHERE", " AND ".join(kept)])


def read_query(
    spark: SparkSession,
    target: JdbcTarget,
    sql: str,
    fetch_size: int = FETCH_SIZE,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    num_partitions: int = 20,
) -> DataFrame:
    """Push ``sql`` to the database as a derived table; optionally split into range partitions.

    Bounds only shape the partition strides (rows outside them still land in the first or last
    partition); they never filter.
    """
    reader = spark.read.format("jdbc").options(**target.options()).option("dbtable", f"({sql}) src")
    reader = reader.option("fetchsize", str(fetch_size))
    if partition_column and bounds and bounds[0] is not None and bounds[1] is not None and bounds[1] > bounds[0]:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


def probe_bounds(spark: SparkSession, target: JdbcTarget, table: str, column: str = "id") -> tuple[int | None, int | None]:
    """(min, max) of ``column`` in ``table``: one row read by the driver to size a partitioned read."""
    if not (_IDENT.match(table) and _IDENT.match(column)):
        raise ValueError("table and column must be plain identifiers")
    row = read_query(spark, target, f"SELECT MIN({column}) AS min_id, MAX({column}) AS max_id FROM {table}").first()
    return (row[0], row[1]) if row is not None else (None, None)


def has_column(spark: SparkSession, target: JdbcTarget, table: str, column: str) -> bool:
    """Whether ``table`` has ``column`` (schema only; the reader resolves it with a zero-row query)."""
    cols = spark.read.format("jdbc").options(**target.options()).option("dbtable", table).load().columns
    return column.lower() in {c.lower() for c in cols}


def window_id_bounds(spark: SparkSession, target: JdbcTarget, cfg: JobConfig) -> tuple[int | None, int | None]:
    """(min, max) address id of the window's shipments: the range the partitioned read splits.

    Recent windows sit in a narrow slice of the whole id range; bounds of the whole table would
    send nearly all rows to the last partition.
    """
    kept = " AND ".join(_window("created", cfg, target.url))
    sql = (
        "SELECT MIN(shipping_address_id) AS min_id, MAX(shipping_address_id) AS max_id "
        f"FROM shipping_package WHERE {kept}"
    )
    row = read_query(spark, target, sql).first()
    return (row[0], row[1]) if row is not None else (None, None)


def window_parts(spark: SparkSession, target: JdbcTarget, cfg: JobConfig, rows_per_part: int) -> list[Part]:
    """Parts of the window's address ids with about equally many shipments, counted by the database."""
    lo, hi = window_id_bounds(spark, target, cfg)
    if lo is None:
        return []
    lo, hi, kept = int(lo), int(hi), " AND ".join(_window("created", cfg, target.url))

    def count(width: int, ranges: list[tuple[int, int]]) -> dict[int, int]:
        ids = " OR ".join(f"(shipping_address_id >= {a} AND shipping_address_id < {b})" for a, b in ranges)
        cell = f"shipping_address_id - MOD(shipping_address_id - ({lo}), {width})"
        sql = (
            f"SELECT counted.cell AS cell, COUNT(*) AS n FROM (SELECT {cell} AS cell FROM shipping_package "
            f"WHERE {kept} AND ({ids})) counted GROUP BY counted.cell"
        )
        return {int(r[0]): int(r[1]) for r in read_query(spark, target, sql).collect()}  # one row a cell

    return equal_parts(count, lo, hi, rows_per_part)


def read_parts(
    spark: SparkSession,
    target: JdbcTarget,
    sql: str,
    parts: list[Part],
    fetch_size: int = FETCH_SIZE,
    max_connections: int | None = None,
) -> DataFrame:
    """Push ``sql`` (with columns address_id and order_id) once for each part.

    With ``max_connections`` as many tasks read the parts, each one after the other: a task opens a part's
    connection when it has closed the one before, so the database never sees more of them.
    """
    properties = {**target.properties, "fetchsize": str(fetch_size)}
    predicates = [p.predicate("address_id", "order_id") for p in parts]
    df = spark.read.jdbc(target.url, f"({sql}) src", predicates=predicates, properties=properties)
    return df.coalesce(max_connections) if max_connections and len(parts) > max_connections else df


def read_shipments(
    spark: SparkSession,
    target: JdbcTarget,
    cfg: JobConfig,
    num_partitions: int | None = None,
    fetch_size: int = FETCH_SIZE,
    ids_per_partition: int | None = None,
    rows_per_partition: int = 250_000,
    max_connections: int | None = None,
) -> DataFrame:
    """One database's shipments of the window as raw rows (lower-case column names).

    A window without shipments gives an empty frame with the shipment schema (no query). The read is
    split into parts of about ``rows_per_partition`` shipments (``sources/splits.py``), however the ids are
    spread, so a source holding a large share of all rows gets as many parts; ``max_connections`` bounds how
    many are read at once. ``num_partitions`` or ``ids_per_partition`` ask for ranges of equal id span.
    """
    district = None
    if num_partitions is None and ids_per_partition is None:
        parts = window_parts(spark, target, cfg, rows_per_partition)
        if parts:
            district = has_column(spark, target, "address_detail", "district")
            df = read_parts(spark, target, shipment_query(cfg, district, target.url), parts, fetch_size, max_connections)
    else:
        lo, hi = window_id_bounds(spark, target, cfg)
        if lo is not None:
            count = num_partitions or max(1, -(-(int(hi) - int(lo) + 1) // ids_per_partition))
            district = has_column(spark, target, "address_detail", "district")
            sql = shipment_query(cfg, district, target.url)
            df = read_query(spark, target, sql, fetch_size, "address_id", (lo, hi), count)
            df = df.coalesce(max_connections) if max_connections and count > max_connections else df
    if district is None:
        return spark.createDataFrame([], SHIPMENT_SCHEMA)
    return df.toDF(*[c.lower() for c in df.columns]).drop("address_id", "order_id")


def read_closed_databases(
    spark: SparkSession,
    target: JdbcTarget,
    cfg: JobConfig,
    terminated_table: str = "terminated_info",
    schemata_table: str = "INFORMATION_SCHEMA.SCHEMATA",
    tables_table: str = "INFORMATION_SCHEMA.TABLES",
) -> DataFrame:
    """Closed tenant databases of a server, asked for in one statement (see ``closed_databases``).

    The database applies SQL's NOT IN itself: a schema without tables whose name is NULL would empty
    the result.
    """
    for t in (terminated_table, schemata_table, tables_table):
        if not _IDENT.match(t):
            raise ValueError("table names must be plain identifiers")
    dated = " AND ".join(_window("closed.terminated_on", cfg, target.url))
    unused = (
        f"SELECT known.SCHEMA_NAME FROM {schemata_table} known "
        f"WHERE NOT EXISTS (SELECT 1 FROM {tables_table} held WHERE held.TABLE_SCHEMA = known.SCHEMA_NAME)"
    )
    sql = (
        f"SELECT DISTINCT closed.terminated_server AS db FROM {terminated_table} closed "
        f"WHERE closed.type = 'production' AND (closed.terminated_on IS NULL OR ({dated})) "
        f"AND closed.terminated_server NOT IN {_sql_list(cfg.system_schemas)} "
        f"AND closed.terminated_server NOT IN ({unused})"
    )
    return read_query(spark, target, sql).toDF("db")


def check_no_speculation(spark: SparkSession) -> None:
    """Refuse speculative execution for a JDBC append.

    A JDBC sink has no commit coordination: with ``spark.speculation`` two attempts of one task
    can both commit their transaction, which appends that partition's rows twice. A retry after a
    lost executor is safe (the failed attempt's transaction rolls back, and finished partitions of
    the write stage are not run again).
    """
    if str(spark.conf.get("spark.speculation", "false")).strip().lower() == "true":
        raise ValueError("spark.speculation must be off for a JDBC append (speculative copies would both commit)")


def writer(target: JdbcTarget, table: str, batch_size: int = WRITE_BATCH, isolation: str = "READ_COMMITTED", max_connections: int | None = None):
    """A function that appends a frame to ``table``: one transaction a task, at most ``max_connections`` tasks."""

    def write(part: DataFrame) -> None:
        part = part.coalesce(max_connections) if max_connections else part
        part.write.format("jdbc").options(**target.options()).option("dbtable", table).option(
            "batchsize", str(batch_size)
        ).option("isolationLevel", isolation).mode("append").save()

    return write


def append(
    df: DataFrame,
    target: JdbcTarget,
    table: str,
    batch_size: int = WRITE_BATCH,
    isolation: str = "READ_COMMITTED",
    max_connections: int | None = None,
    round_bytes: int = ROUND_BYTES,
) -> None:
    """Batched INSERTs into ``table`` (append; re-running a window appends its rows again).

    Each partition is written in one transaction, so a task retried after an executor loss does
    not leave the rows of its failed attempt behind (``isolation="NONE"`` would).

    With ``max_connections`` the rows are staged first, in as many files as they need, and appended in
    rounds of about ``round_bytes``, each by at most so many tasks: the transactions follow the rows,
    and the database never sees more connections. The staged rows are deleted afterwards. A run that
    fails between two rounds has appended the rounds before; ``append_by_ledger`` goes on there.
    """
    spark = df.sparkSession
    check_no_speculation(spark)
    write = writer(target, table, batch_size, isolation, max_connections)
    if not max_connections:
        write(df)
        return
    path = staging_path(spark, "sink")
    try:
        df.write.parquet(path)
        append_files(spark, path, df.schema, write, round_bytes)
    finally:
        drop_staged(spark, path)


def append_files(spark: SparkSession, path: str, schema, write, round_bytes: int = ROUND_BYTES) -> None:
    """The staged rows under ``path``, round by round."""
    staged = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    for files in rounds_by_bytes(file_sizes(staged), round_bytes):
        write(spark.read.schema(schema).parquet(*files))


#: Last characters by which a read-back of the sink is divided.
DIGITS = "0123456789"


def read_back(spark: SparkSession, target: JdbcTarget, table: str, where: Column, column: str) -> DataFrame:
    """The sink's rows with ``where``, read in parts by the last digit of ``column`` (pushed as LIKE)."""
    held = spark.read.format("jdbc").options(**target.options()).option("dbtable", table).option("fetchsize", str(FETCH_SIZE)).load()
    ends = [F.col(column).endswith(d) for d in DIGITS]
    rest = F.col(column).isNull() | ~functools.reduce(lambda a, b: a | b, ends)
    return functools.reduce(DataFrame.unionAll, [held.filter(where & part) for part in [*ends, rest]])


def append_by_ledger(
    spark: SparkSession,
    name: str,
    make,
    target: JdbcTarget,
    table: str,
    where: Column,
    split_column: str,
    max_connections: int = 64,
    round_bytes: int = ROUND_BYTES,
    batch_size: int = WRITE_BATCH,
) -> int:
    """``append`` that a rerun under the same ``name`` completes without a duplicate (``sources/ledger.py``).

    ``make`` writes the rows as Parquet under the folder it is given; a rerun takes those of the first run.
    ``where`` names the rows in ``table`` that this run alone can have written (such as its time stamp).
    """
    check_no_speculation(spark)

    write = writer(target, table, batch_size, max_connections=max_connections)

    def present(schema) -> DataFrame:
        write(spark.createDataFrame([], schema))  # makes the table, if the first round never came so far
        return read_back(spark, target, table, where, split_column)

    return append_once(spark, name, make, write, present, round_bytes)
