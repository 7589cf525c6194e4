"""Exact dedup that splits off the heavy hitters.

A frequent-items sketch of the Misra-Gries family (the built-in ``approx_top_k``) names the digests
that may hold a large share of the rows. Their groups are aggregated map-side, so a group of any
size reaches the shuffle as one row per task; the verified winners, at most ``HEAVY_MAX`` rows, are
broadcast and decide their rows without a shuffle. All other digests take the ordinary shuffle: by
the sketch's guarantee none of them holds more than about 7 / ``SKETCH_ITEMS`` of the rows.

Nulls and odd input: a null text is an empty one; all texts without any other character than white
space are equal. A null id loses every tie. Rows that tie in everything (repeated rows): exactly one
stays. An empty table gives an empty result. Extra columns are ignored by ``decide`` and kept by
``deduplicate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from addrflow.llm._io import stage_numbered

#: Space, tab, line feed, vertical tab, form feed, carriage return (fixed values).
WHITE = " \t\n\x0b\x0c\r"
SKETCH_ITEMS = 8192
HEAVY_MAX = 1024


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text without white space."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), WHITE, "").cast("binary"), 256)


def heavy_digests(light: DataFrame) -> list[str]:
    """At most HEAVY_MAX digests, among them all that hold a large share of the rows."""
    found = light.select(F.expr(f"approx_top_k(_h, {HEAVY_MAX}, {SKETCH_ITEMS})").alias("top"))
    return [x["h"] for x in found.select(F.explode("top").alias("x")).select(F.col("x.item").alias("h")).collect()]


def decide_numbered(light: DataFrame) -> DataFrame:
    """``light`` has _row (unique), _id, _h, _n (code points); adds _keep_row, _keep_id, _size.

    The winner of a digest is the row with the largest (_n, smaller _id, smaller _row); bitwise
    NOT turns the order of the integers round without an overflow.
    """
    spark = light.sparkSession
    best = F.max(F.struct("_n", F.bitwise_not("_id").alias("i"), F.bitwise_not("_row").alias("r")))
    heavy = heavy_digests(light)
    names = spark.createDataFrame([(h,) for h in heavy], "_h string")
    winners = (
        light.join(F.broadcast(names), "_h")
        .groupBy("_h")
        .agg(best.alias("b"), F.count("*").alias("_size"))
        .select("_h", F.bitwise_not("b.r").alias("_keep_row"), F.bitwise_not("b.i").alias("_keep_id"), "_size")
    )
    out = ["_row", "_id", "_h", "_n", "_keep_row", "_keep_id", "_size"]
    hot = light.join(F.broadcast(winners), "_h").select(out)  # at most HEAVY_MAX rows
    order = Window.partitionBy("_h").orderBy(F.desc("_n"), F.asc_nulls_last("_id"), "_row")
    whole = Window.partitionBy("_h")
    rest = (
        light.join(F.broadcast(names), "_h", "left_anti")
        .withColumn("_keep_row", F.first("_row").over(order))
        .withColumn("_keep_id", F.first("_id").over(order))
        .withColumn("_size", F.count("*").over(whole))
        .select(out)
    )
    return hot.unionByName(rest)


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    light = stage_numbered(
        docs.select(
            F.col(id_col).cast("long").alias("_id"),
            digest(F.col(text_col)).alias("_h"),
            F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("_n"),
        ),
        "_row",
        "digests",
    )
    return decide_numbered(light).select(
        F.col("_id").alias(id_col),
        F.col("_keep_id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_row") == F.col("_keep_row")).alias("kept"),
        F.col("_h").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    numbered = stage_numbered(
        docs.select(
            F.struct("*").alias("rec"),
            F.col(id_col).cast("long").alias("_id"),
            digest(F.col(text_col)).alias("_h"),
            F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("_n"),
        ),
        "_row",
        "documents",
    )
    gone = decide_numbered(numbered.drop("rec")).filter("_row <> _keep_row").select("_row")
    return numbered.join(gone, "_row", "left_anti").select("rec.*")
