"""Temperature mixing of sources, realised as budgeted block permutations.

A source with share p of the tokens gets the weight p^a / sum(p^a). The exponent a in [0, 1] is
found by repeated section of its interval: every round is one aggregation over the table of source
totals and returns one row per grid point, so the totals themselves never reach the driver. The
budget is such that the largest source is read once; every other source is read
(t_max / t)^(1 - a) times, so no document is lost. The section finds the smallest exponent (the
flattest mixture) that reads no source more than ``max_epochs`` times or, with ``target_entropy``,
the largest exponent whose weights reach that share of the highest possible entropy, unless that
breaks the repetition limit.

The weights become rows block by block: the documents of a source are dealt to blocks by a hash of
their id, every epoch orders the blocks by its own hash, and the last, partial epoch takes whole
blocks in that order while they fit, then the documents of the next block in hash order while they
fit. Only the one block at the edge is ordered document by document; whole blocks, also those of a
source that holds a third of all rows, are decided from their token totals.

Nulls and odd input: a null source is a source of its own; a null text has no tokens; a source
without tokens is read once. Null ids share a place in the order. Repeated rows are separate rows.
An empty table gives an empty result. The input row travels in one struct, so no column name can
clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from addrflow.llm._io import stage, stage_numbered

#: Letters that are written without spaces: Thai, Lao, Burmese, Khmer, kana, ideographs.
UNSPACED = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{20000}-\x{3FFFF}"
#: A token where no counts are given: one such letter, or a word (a run of anything but space, tab,
#: line feed, vertical tab, form feed, carriage return); a longer one counts by 64 characters.
TOKEN = rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]{{1,64}}"
GRID, ROUNDS, DIGITS = 16, 5, 6
BLOCK_ROWS = 4096


def tokens_of(text: Column) -> Column:
    """The tokens of the whole text, found one by one; a text without spaces has more than one, too."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN)).cast("long")


def number(*parts: Column) -> Column:
    """A non-negative 48-bit integer from the MD5 of the parts, the same in any SQL engine."""
    text = F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long")


def _first_true(sources: DataFrame, holds: Column) -> float:
    """The smallest exponent in [0, 1] from which on ``holds`` is true, rounded up (1 if nowhere).

    ``holds`` is an aggregate over the sources at the exponent _a and changes once at most.
    """
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        at = F.array([F.lit(low + (high - low) * i / GRID) for i in range(GRID + 1)])
        grid = sources.filter("_t > 0").withColumn("_a", F.explode(at))
        rows = grid.groupBy("_a").agg(holds.alias("ok")).orderBy("_a").collect()  # GRID + 1 rows
        k = next((i for i, r in enumerate(rows) if r["ok"]), len(rows) - 1)
        if k <= 0:
            return low if rows else 1.0
        low, high = rows[k - 1]["_a"], rows[k]["_a"]
    return min(1.0, math.ceil(high * 10**DIGITS) / 10**DIGITS)


def exponent(sources: DataFrame, max_epochs: float, target_entropy: float | None) -> float:
    """``sources`` has _t (tokens), _max and _sum (of all sources)."""
    limit = F.max(F.pow(F.col("_max") / F.col("_t"), 1 - F.col("_a"))) <= max_epochs + 1e-9
    a = _first_true(sources, limit)
    if target_entropy is None:
        return a
    w = F.pow(F.col("_t") / F.col("_sum"), F.col("_a"))
    entropy = F.log(F.sum(w)) - F.sum(w * F.log(w)) / F.sum(w)
    return max(a, _first_true(sources, entropy < target_entropy * F.log(F.count("*")) - 1e-12))


def mix(
    docs: DataFrame,
    max_epochs: float = 2.0,
    target_entropy: float | None = None,
    seed: int = 7,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    block_rows: int = BLOCK_ROWS,
    with_text: bool = True,
    tokens_col: str | None = None,
) -> DataFrame:
    """Columns: rec (the input row; id and source only if not ``with_text``), n_tokens, weight,
    epoch, block, place; a row for every reading of a document.

    Tokens are those of ``tokens_col`` (null: none), or else ``tokens_of`` the text.

    Sorting a source's rows by (epoch, place) gives its training order: ``place`` holds the rank
    of the block in that epoch and the hash order within the block.
    """
    source = F.col(source_col)
    tokens = tokens_of(F.col(text_col)) if tokens_col is None else F.coalesce(F.col(tokens_col).cast("long"), F.lit(0).cast("long"))
    rec = F.struct("*") if with_text else F.struct(id_col, source_col)
    numbered = stage_numbered(
        docs.select(
            rec.alias("rec"),
            F.col(id_col).alias("id"),
            F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string"))).alias("src"),
            tokens.alias("n_tokens"),
            number(F.lit(seed), F.col(id_col)).alias("at"),
        ),
        "row",
        "numbered",
    )
    totals = stage(numbered.groupBy("src").agg(F.sum("n_tokens").alias("_t"), F.count("*").alias("rows")), "sources")
    whole = totals.agg(F.max("_t").alias("top"), F.sum("_t").alias("total")).first()  # one row
    shares = totals.withColumns(
        {"_max": F.lit(whole["top"] or 0).cast("long"), "_sum": F.lit(whole["total"] or 0).cast("long")}
    )
    a = exponent(shares, max_epochs, target_entropy)
    share = F.pow(F.col("_t") / F.col("_sum"), F.lit(a))
    norm = shares.filter("_t > 0").agg(F.sum(share).alias("n")).first()["n"] or 1.0
    # Tokens to draw from a source: tokens of the largest source x weight / its weight.
    draw = F.round(F.col("_t") * F.pow(F.col("_max") / F.col("_t"), F.lit(1 - a))).cast("long")
    some = F.col("_t") > 0
    plan = stage(
        shares.select(
            "src",
            F.when(some, F.round(share / F.lit(norm), 9)).otherwise(F.lit(0.0)).alias("weight"),
            F.when(some, F.floor(draw / F.col("_t"))).otherwise(F.lit(1)).cast("long").alias("full"),
            F.when(some, draw % F.col("_t")).otherwise(F.lit(0)).cast("long").alias("left"),
            F.ceil(F.col("rows") / block_rows).cast("long").alias("blocks"),
        ),
        "plan",
    )
    placed = numbered.join(plan, "src").withColumn("block", F.col("at") % F.col("blocks"))
    rank = Window.partitionBy("src", "epoch").orderBy("shuffled", "block")
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    blocks = stage(
        placed.groupBy("src", "block", "full", "left")
        .agg(F.sum("n_tokens").alias("bt"))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full"))))
        .withColumn("shuffled", number(F.lit(seed), F.col("epoch"), F.col("src"), F.col("block")))
        .withColumns({"rank": F.row_number().over(rank) - 1, "b4": F.coalesce(F.sum("bt").over(before), F.lit(0))})
        .filter("epoch < full or b4 < left")
        .select(
            "src", "block", "epoch", "rank",
            F.when(F.expr("epoch = full and b4 + bt > left"), F.col("left") - F.col("b4")).alias("room"),
        ),
        "blocks",
    )
    place = F.concat_ws(
        "/",
        F.lpad(F.col("rank").cast("string"), 9, "0"),
        F.lpad(number(F.lit(seed), F.col("epoch"), F.col("id")).cast("string"), 15, "0"),
    )
    taken = placed.join(blocks, ["src", "block"]).withColumn("place", place)
    inside = (
        Window.partitionBy("src")
        .orderBy("place", "id", "n_tokens", "row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # One block of each source at most, without its texts. What fits is a prefix of its order, so
    # the last document that does is all that the rows have to know.
    order = F.struct("place", "id", "n_tokens", "row")
    last = (
        taken.filter("room is not null")
        .select("src", "row", "place", "id", "n_tokens", "room")
        .withColumn("run", F.sum("n_tokens").over(inside))
        .filter("run <= room")
        .groupBy("src")
        .agg(F.max(order).alias("last"))
    )
    kept = taken.join(stage(last, "edges"), "src", "left").filter(F.col("room").isNull() | (order <= F.col("last")))
    return kept.select("rec", "n_tokens", "weight", "epoch", "block", "place")
