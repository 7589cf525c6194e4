"""Append with a ledger: a run that failed half-way goes on where it stopped, without a row twice.

The rows of a run are staged once, and a manifest deals the staged files to rounds of about so many
bytes. Before a round is appended it is marked as begun, afterwards as done; marks are files beside the
rows in the shared checkpoint folder. A rerun under the same name takes the staged rows as they are,
skips what is done and appends what was never begun.

A round that was begun and not done may be in the table in part, since each of its tasks commits its own
transaction. For that case the rerun reads back what the run has in the table, and appends the rows of
all begun rounds EXCEPT ALL those: rows count as often as they occur, so whichever transactions had
been committed, the table ends with each row as often as it was staged. If the rerun fails as well, the
next one does the same.

When all rounds are done the staged rows are deleted (they hold personal data) and the ledger stays, so a
rerun appends nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from addrflow.session import drop_staged, ensure_checkpoint_dir

ROUND_BYTES = 8 << 30


def rounds_by_bytes(sizes: list[tuple[str, int]], round_bytes: int) -> list[list[str]]:
    """File names in rounds of at most ``round_bytes``, or of one file."""
    out: list[list[str]] = []
    held = 0
    for name, size in sizes:
        if not out or held + size > round_bytes:
            out.append([])
            held = 0
        out[-1].append(name)
        held += size
    return out


def file_sizes(staged: DataFrame) -> list[tuple[str, int]]:
    """(path, bytes) of the files of a staged table that hold rows, in order of their names."""
    files = staged.select("_metadata.file_path", "_metadata.file_size").distinct()
    return sorted((r["file_path"], r["file_size"]) for r in files.collect())  # one row a file


class Ledger:
    """The staged rows, manifest and marks of one run, by name."""

    def __init__(self, spark: SparkSession, name: str):
        if not name or "/" in name:
            raise ValueError("a ledger's name is one folder name")
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledger-{name}"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _has(self, mark: str) -> bool:
        return self._files.exists(self._path(f"{self.path}/{mark}"))

    def _mark(self, mark: str) -> None:
        self._files.create(self._path(f"{self.path}/{mark}"), True).close()

    @property
    def complete(self) -> bool:
        return self._has("complete")

    @property
    def staged(self) -> bool:
        return self._has("manifest/_SUCCESS")

    def rows(self, make: Callable[[str], None], round_bytes: int = ROUND_BYTES) -> tuple[DataFrame, dict[int, list[str]]]:
        """The staged rows and the files of each round; ``make`` writes them, unless they are staged already."""
        rows, manifest = f"{self.path}/rows", f"{self.path}/manifest"
        if not self.staged:
            drop_staged(self.spark, rows)  # of a run that ended while it staged
            make(rows)
            dealt = rounds_by_bytes(file_sizes(self._read(rows)), round_bytes)
            listed = [(i, f) for i, files in enumerate(dealt) for f in files]
            self.spark.createDataFrame(listed, "round int, file string").coalesce(1).write.mode("overwrite").parquet(manifest)
        found: dict[int, list[str]] = {}
        for r in self.spark.read.schema("round int, file string").parquet(manifest).orderBy("round", "file").collect():
            found.setdefault(r["round"], []).append(r["file"])
        return self._read(rows), found

    def _read(self, rows: str) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", "true").parquet(rows)

    def note(self, text: str) -> None:
        """Keep a text beside the rows; a rerun finds it."""
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/note")

    def noted(self) -> str | None:
        return self.spark.read.text(f"{self.path}/note", wholetext=True).first()[0] if self._has("note/_SUCCESS") else None

    def begun(self, number: int) -> bool:
        return self._has(f"begun-{number}")

    def done(self, number: int) -> bool:
        return self._has(f"done-{number}")

    def begin(self, number: int) -> None:
        self._mark(f"begun-{number}")

    def finish(self, number: int) -> None:
        self._mark(f"done-{number}")

    def close(self) -> None:
        self._mark("complete")
        drop_staged(self.spark, f"{self.path}/rows")


def missing_rows(staged: DataFrame, present: DataFrame) -> DataFrame:
    """Rows of ``staged`` beyond those of ``present`` (as a database gives them back), counted row by row."""
    by_name = {c.lower(): c for c in present.columns}
    alike = present.select(*[F.col(by_name[f.name.lower()]).cast(f.dataType).alias(f.name) for f in staged.schema.fields])
    return staged.exceptAll(alike)


def append_once(
    spark: SparkSession,
    name: str,
    make: Callable[[str], None],
    write: Callable[[DataFrame], None],
    present: Callable[[T.StructType], DataFrame],
    round_bytes: int = ROUND_BYTES,
) -> int:
    """Append the rows of ``make`` once under this name, whatever fails in between; the rounds written now.

    ``write`` appends a frame (in any number of transactions); ``present`` reads back the rows that this
    run may have appended, and is asked only when a round's end is unknown. They must come back as
    written, so a column that the database trims or rounds needs a type that keeps it.
    """
    ledger = Ledger(spark, name)
    if ledger.complete:
        return 0
    staged, rounds = ledger.rows(make, round_bytes)
    written = 0

    def of(numbers: list[int]) -> DataFrame:
        return spark.read.schema(staged.schema).parquet(*[f for n in numbers for f in rounds[n]])

    begun = [n for n in rounds if ledger.begun(n)]
    unknown = [n for n in begun if not ledger.done(n)]
    if unknown:
        write(missing_rows(of(begun), present(staged.schema)))
        for n in unknown:
            ledger.finish(n)
        written += 1
    for n in rounds:
        if n not in begun:
            ledger.begin(n)
            write(of([n]))
            ledger.finish(n)
            written += 1
    ledger.close()
    return written
