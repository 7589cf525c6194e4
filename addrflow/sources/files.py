"""File sources: the pincode CSV, a server registry exported as JSON lines or parquet, bounds from Parquet footers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pincodes(spark: SparkSession, path: str, column: str = "Pincode") -> DataFrame:
    """Distinct pincodes from a CSV with a header (every column read as text, no inference)."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(F.col(column).alias("Pincode")).distinct()


def read_registry(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Server registry documents with string fields db, production, active."""
    df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(c).cast("string").alias(c) for c in ("db", "production", "active")])


#: The column of a line that does not fit the schema.
BAD_LINE = "_bad_line"


def read_checked_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header, read by a schema; a line that does not fit it keeps its text in ``BAD_LINE``.

    Values may be quoted and then hold commas, line feeds and doubled quotes. A malformed line is
    neither dropped nor an error: its other columns hold what could be read of it.
    """
    reader = spark.read.schema(f"{schema}, {BAD_LINE} string").option("header", True).option("multiLine", True).option("escape", '"')
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE).csv(path)


def footer_bounds(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row: min_id and max_id of a numeric column of Parquet files, from the statistics in their footers.

    The aggregate is pushed into Spark's second Parquet reader, which a session of its own asks for; the
    given session's settings stay. Files without statistics are an error there, not a wrong row.
    """
    own = spark.newSession()
    listed = [x for x in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if x != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(listed))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.min(column).alias("min_id"), F.max(column).alias("max_id"))
