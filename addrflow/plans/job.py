"""The contact job: many sources -> one plan -> one append.

Sources are unioned lazily, each row with the name of its source, so all databases are read, decrypted,
cleaned and exploded by one Spark job, instead of a thread and a job per database. Counts by source
come from that same pass.

A source that fails while it is read fails that job. Nothing has been appended by then, since the rows
are staged before the append: the sources are halved and each half runs again, until the failing ones
stand alone and are left out. Without a fault there is one job; k faulty ones of n sources cost about
k log n smaller jobs.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import Counter
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from addrflow.config import JobConfig
from addrflow.operators.contacts import contact_rows
from addrflow.operators.counting import by_key
from addrflow.operators.filters import canonical_rows, union_sources
from addrflow.operators.metrics import observed
from addrflow.schema import CONTACT_FIELDS
from addrflow.session import drop_staged, stage_table, staging_path
from addrflow.sources.jdbc import JdbcTarget, append_by_ledger, append_files, check_no_speculation, read_shipments, writer
from addrflow.sources.ledger import ROUND_BYTES, Ledger


def contacts_from_sources(
    sources: Iterable[DataFrame],
    key_export: DataFrame,
    pincodes: DataFrame,
    cfg: JobConfig,
    watch: tuple[Observation, Observation] | None = None,
) -> DataFrame:
    """Raw shipment rows of each source -> contact rows (one plan)."""
    rows = union_sources([canonical_rows(s, cfg.timestamp_format) for s in sources])
    return contact_rows(rows, pincodes, cfg, key_export=key_export, watch=watch)


def tagged_contacts(
    sources: dict[str, DataFrame],
    key_export: DataFrame,
    pincodes: DataFrame,
    cfg: JobConfig,
    watch: tuple[Observation, Observation] | None = None,
) -> DataFrame:
    """Raw shipment rows by source name -> contact rows with a column ``source`` (one plan)."""
    rows = [canonical_rows(df, cfg.timestamp_format).withColumn("source", F.lit(name)) for name, df in sources.items()]
    return contact_rows(union_sources(rows), pincodes, cfg, key_export=key_export, watch=watch, sources=len(sources))


#: Counts that a run holds by source, too.
COUNTS = ("read", "encrypted", "plain", "valid", "undecrypted", "rows", "with_mobile", "with_email")


@dataclass(frozen=True)
class RunResult:
    rows: int
    with_mobile: int
    with_email: int
    source_rows: dict[str, int] = field(default_factory=dict)  # raw rows read per source
    read: int = 0
    encrypted: int = 0
    plain: int = 0
    valid: int = 0  # rows behind the pincode gate
    undecrypted: int = 0  # ciphertext values of those rows that stayed unreadable
    seconds: float = 0.0
    source_seconds: dict[str, float] = field(default_factory=dict)  # probing (and staging) each source
    failed: dict[str, str] = field(default_factory=dict)  # source -> kind of error; the others ran
    by_source: dict[str, dict[str, int]] = field(default_factory=dict)  # source -> COUNTS
    run_ts: str = ""  # of the rows; a rerun by ledger appends those of the first run


def run(contacts: DataFrame, sink: Callable[[DataFrame], None], name: str = "contacts") -> RunResult:
    """Write ``contacts`` with ``sink``; counts are gathered during that same write."""
    began = time.monotonic()
    df, obs = observed(contacts, name)
    sink(df)
    m = obs.get
    return RunResult(
        int(m.get("rows", 0)),
        int(m.get("with_mobile", 0)),
        int(m.get("with_email", 0)),
        seconds=time.monotonic() - began,
    )


def read_sources(
    targets: list[JdbcTarget],
    read: Callable[[JdbcTarget], DataFrame],
    threads: int,
    stage: Callable[[DataFrame, int], DataFrame] | None = None,
) -> tuple[dict[str, DataFrame], dict[str, float], dict[str, str]]:
    """(frames, seconds, errors) by source name, sources prepared side by side.

    A source that can't be probed, or whose staging fails, is left out and reported.
    """

    def one(numbered: tuple[int, JdbcTarget]):
        i, t = numbered
        name, began = t.name or f"source-{i}", time.monotonic()
        try:
            df = read(t)
            return name, (stage(df, i) if stage else df), time.monotonic() - began, None
        except Exception as e:  # any fault of a driver or database; its text may hold the address
            return name, None, time.monotonic() - began, type(e).__name__

    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(targets)))) as pool:
        found = list(pool.map(one, enumerate(targets)))
    frames = {name: f for name, f, _, _ in found if f is not None}
    return frames, {name: s for name, _, s, _ in found}, {name: e for name, _, _, e in found if e}


def isolated(names: list[str], attempt: Callable[[list[str]], dict]) -> tuple[list[dict], dict[str, str]]:
    """What ``attempt`` returns for all names together, or for halves of them where it fails.

    Second: the names that fail alone, with the kind of their error.
    """
    try:
        return [attempt(names)], {}
    except Exception as e:
        if len(names) == 1:
            return [], {names[0]: type(e).__name__}
    half = len(names) // 2
    (some, bad), (others, worse) = isolated(names[:half], attempt), isolated(names[half:], attempt)
    return some + others, {**bad, **worse}


def stage_contacts(
    spark: SparkSession, frames: dict[str, DataFrame], key_export: DataFrame, pincodes: DataFrame, cfg: JobConfig, path: str
) -> tuple[dict[str, dict[str, int]], dict[str, str]]:
    """Write the contact rows of the sources under ``path``; counts by source, and the sources that failed."""

    def attempt(names: list[str]) -> dict[str, dict[str, int]]:
        part = f"{path}/part-{uuid.uuid4().hex}"
        watch = (Observation(f"read-{uuid.uuid4().hex}"), Observation(f"valid-{uuid.uuid4().hex}"))
        contacts = tagged_contacts({n: frames[n] for n in names}, key_export, pincodes, cfg, watch)
        out, written = observed(contacts, f"written-{uuid.uuid4().hex}", len(names))
        try:
            out.select(*CONTACT_FIELDS).write.parquet(part)
        except Exception:
            drop_staged(spark, part)
            raise
        seen = {**watch[0].get, **watch[1].get, **written.get}
        found = {c: by_key(seen.get(f"{c}_by")) for c in ("read", "encrypted", "valid", "rows", "with_mobile", "with_email")}
        unread: Counter = Counter()
        for key, n in by_key(seen.get("undecrypted_by")).items():
            values, source = key.split("\t", 1)
            unread[source] += int(values) * n
        found |= {"undecrypted": unread, "plain": {n: found["read"].get(n, 0) - found["encrypted"].get(n, 0) for n in names}}
        return {n: {c: found[c].get(n, 0) for c in COUNTS} for n in names}

    done, failed = isolated(list(frames), attempt)
    return {n: counts for part in done for n, counts in part.items()}, failed


def run_jdbc_job(
    spark: SparkSession,
    cfg: JobConfig,
    source_targets: Iterable[JdbcTarget],
    key_export: DataFrame,
    pincodes: DataFrame,
    sink_target: JdbcTarget,
    sink_table: str,
    read_partitions: int | None = None,
    stage_name: str | None = None,
    probe_threads: int = 16,
    sink_connections: int | None = 64,
    source_connections: int | None = None,
    ledger: str | None = None,
    round_bytes: int = ROUND_BYTES,
) -> RunResult:
    """Read every source database, transform, stage the contact rows, and append them to ``sink_table``.

    Each source needs a few small probes (window bounds, counts of its parts, optional column) before its
    read is planned. A source that fails there or while it is read is reported in ``failed`` and the others
    run. With ``stage_name`` the raw rows of each source are written to the shared checkpoint folder
    first (and deleted at the end), so nothing goes back to the databases, even when executors are lost.

    With ``ledger``, a name for this run, a run that failed during the append can be started again under
    the same name: it appends what is missing of the rows that the first one staged, and reads no source.
    """
    check_no_speculation(spark)
    began = time.monotonic()
    staged: list[str] = []
    sink = writer(sink_target, sink_table, max_connections=sink_connections)
    book = Ledger(spark, ledger) if ledger else None
    result = RunResult(0, 0, 0)

    def read(t: JdbcTarget) -> DataFrame:
        df = read_shipments(spark, t, cfg, read_partitions, max_connections=source_connections)
        return canonical_rows(df, cfg.timestamp_format)

    def stage(df: DataFrame, i: int) -> DataFrame:
        path = staging_path(spark, f"{stage_name}-{i}")
        staged.append(path)
        return stage_table(df, stage_name, spark, path)

    def make(path: str) -> None:
        nonlocal result
        frames, seconds, failed = read_sources(list(source_targets), read, probe_threads, stage if stage_name else None)
        counts: dict[str, dict[str, int]] = {}
        if frames:
            counts, more = stage_contacts(spark, frames, key_export, pincodes, cfg, path)
            failed = {**failed, **more}
        if failed and not counts:
            raise RuntimeError(f"no source could be read: {failed}")
        if not counts:
            spark.createDataFrame([], ", ".join(f"{f} {'boolean' if f == 'enabled' else 'string'}" for f in CONTACT_FIELDS)).write.parquet(f"{path}/none")
        total = {c: sum(n[c] for n in counts.values()) for c in COUNTS}
        source_rows = {n: c["read"] for n, c in counts.items()}
        result = RunResult(**total, source_rows=source_rows, source_seconds=seconds, failed=failed, by_source=counts, run_ts=cfg.run_ts)
        if book:
            book.note(json.dumps(asdict(result)))

    try:
        if book:
            run_ts = json.loads(book.noted())["run_ts"] if book.staged else cfg.run_ts
            append_by_ledger(
                spark, ledger, make, sink_target, sink_table, F.col("record_created") == run_ts, "contact_mobile", sink_connections or 64, round_bytes
            )
            result = RunResult(**json.loads(book.noted()))
        else:
            path = staging_path(spark, "sink")
            staged.append(path)
            make(path)
            schema = spark.read.option("recursiveFileLookup", "true").parquet(path).schema
            append_files(spark, path, schema, sink, round_bytes)
    finally:
        for path in staged:
            drop_staged(spark, path)
    return replace(result, seconds=time.monotonic() - began)
