"""Semi-join reduction: rows that cannot meet any row of the other side go before the shuffle.

A join of one day's shipments with every address and order ever stored moves the whole history. Here the
day's keys are summed up first, in a bounded form: their least and largest value, which reach the
scan as filters, and a Bloom filter of fixed size, which drops most of the rest below the exchange.
The reduction only ever drops rows that the inner join would drop; what it lets through by chance, the
join removes.

The filter is built from built-in functions: a key sets three bits of one 64-bit word. Words are or-ed
per word number (map-side first), so whatever the number of keys, ``words`` numbers at most are
shuffled, and the one-row result has ``8 * words`` bytes. With ``words`` at an eighth of the keys, about
one in thirty other keys passes; with far more keys than that the filter lets most rows through and
costs a little time, nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = 1 << 17  # 1 MB


def _typed(c: Column, dtype: T.DataType) -> Column:
    """One type for the keys of both sides, so equal keys have equal hashes."""
    return c.cast("long") if isinstance(dtype, T.IntegralType) else c.cast("string")


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _mask(key: Column) -> Column:
    """Three bits of a word, by another hash."""
    h = F.xxhash64(key, F.lit(1))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(3)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def key_words(keys: DataFrame, column: str, words: int = WORDS) -> DataFrame:
    """One row, ``words`` long: the filter of the values of ``column`` (nulls are no keys)."""
    key = _typed(F.col(column), keys.schema[column].dataType)
    held = (
        keys.filter(F.col(column).isNotNull())
        .select(_word(key, words).alias("word"), _mask(key).alias("mask"))
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
    )
    every = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("word"))
    dense = every.join(held, "word", "left").select("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "mask")))
    return dense.agg(F.transform(in_order, lambda x: x["mask"]).alias("words"))


def may_match(c: Column, dtype: T.DataType, keys: DataFrame, column: str, words: int = WORDS) -> Column:
    """Whether the value can be one of ``keys[column]``: false only where it is none."""
    key = _typed(c, dtype)
    found = F.get(key_words(keys, column, words).scalar(), _word(key, words))
    mask = _mask(key)
    return found.bitwiseAND(mask) == mask


def keep_possible(df: DataFrame, column: str, keys: DataFrame, key_column: str, words: int = WORDS) -> DataFrame:
    """``df`` without most rows whose ``column`` is no value of ``keys[key_column]``; none of the others goes.

    No job runs here: bounds and filter are scalar subqueries of the plan. Without keys no row stays.
    """
    c, dtype = F.col(column), df.schema[column].dataType
    least, most = (keys.agg(f(F.col(key_column).cast(dtype)).alias("v")).scalar() for f in (F.min, F.max))
    return df.filter((c >= least) & (c <= most)).filter(may_match(c, dtype, keys, key_column, words))
