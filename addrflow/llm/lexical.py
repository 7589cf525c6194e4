"""Ranked lexical search: item vocabulary tiles times document impact tiles as dense float64 products.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters of the whole text, A-Z
lower-cased. N documents hold a term at all, L is the number of all their terms, n that of one
document, df the documents with a term, tf its occurrences in a document. A term weighs
w = floor(1000 ln((2N + 2) / (2 df + 1))); a document's m is 25 + (75 n N) div L; its impact for a term
is w ((10^9 tf) div (1000 tf + 8 m)), and its score the sum over the item's terms, repeats included.

The items (the stated query set) are taken in passes of at most ``PASS_TERMS`` postings, so what a task
is sent is bounded; any number of items works. In a pass every document is read once and reduced to its
postings on the pass's vocabulary (columns and occurrences), which are written; N, L and df are counted
over all of them. Then each task multiplies: a dense tile of item counts (items x columns) with a dense
tile of impacts (columns x ``TILE_ROWS`` documents), both float64. Columns are tiled so that for every
item the counts of a tile times the largest impact stay under 2^53, so each product is exact whatever the
order of its additions; a term that an item repeats more often than that has several columns. Tiles are
added as 64-bit integers. Of a tile an item takes every document that reaches its k-th best score so far,
ties included; then a task holds k rows an item, and a window ranks the tasks' rows.

A product of 75 n N must stay under 2^63. Terms are 64-bit hashes.

Nulls and odd input: a null or term-less text has no terms and is no result; an item without terms has no
rows. Repeated documents are ranked one by one (equal scores by id, null ids last, then by row); repeated
items get their rows each. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from addrflow.llm._io import stage, stage_numbered
from addrflow.llm._text import U, buffers, rounds, table, word_hashes

#: ASCII digits and letters, and every byte of a non-ASCII character.
TERM = table(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))
PASS_TERMS = 1 << 20
TILE_ROWS = 512  # documents of a product
TILE_COLUMNS = 2048
EXACT = 1 << 53
POSTINGS = "row long, id long, n long, cols binary, tfs binary"
POSTINGS_ARROW = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("cols", pa.binary()), ("tfs", pa.binary())])


def _term_lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The term hashes of each text, in order."""
    data, offsets = buffers(column)
    for i, j in rounds(offsets):
        lo = offsets[i]
        terms, counts = word_hashes(data[lo : offsets[j]], offsets[i : j + 1] - lo, TERM)
        yield from np.split(terms, np.cumsum(counts)[:-1])


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [np.unique(x, return_counts=True) for x in _term_lists(b.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                b.column("item"), b.column("item_id"), pa.array([len(x) for x, _ in found], pa.int64()),
                pa.array([x.tobytes() for x, _ in found], pa.binary()), pa.array([c.astype(np.int64).tobytes() for _, c in found], pa.binary()),
            ],
            ["item", "item_id", "n", "terms", "counts"],
        )


def _postings(vocabulary: np.ndarray):
    """Texts -> their number of terms, and columns and occurrences of the terms in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ns, cols, tfs = [], [], []
            for x in _term_lists(b.column("text")):
                at = np.minimum(np.searchsorted(vocabulary, x), len(vocabulary) - 1)
                col, tf = np.unique(at[vocabulary[at] == x], return_counts=True)
                ns.append(len(x))
                cols.append(col.astype(np.int32).tobytes())
                tfs.append(tf.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("id"), pa.array(ns, pa.int64()), pa.array(cols, pa.binary()), pa.array(tfs, pa.binary())], schema=POSTINGS_ARROW
            )

    return run


def _document_counts(width: int):
    """(col, df) of a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(width, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column("cols").to_pylist()), np.int32), minlength=width)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(df[held])], ["col", "df"])

    return run


class Tiles:
    """The items of a pass as dense count tiles.

    item, col, count are its postings. A tile is (columns, counts): for no item do its counts times
    ``most``, a bound of the impacts, reach 2^53.
    """

    def __init__(self, n_items: int, item: np.ndarray, col: np.ndarray, count: np.ndarray, most: int, columns: int = TILE_COLUMNS):
        self.tiles: list[tuple[np.ndarray, np.ndarray]] = []
        limit = max(1, (EXACT - 1) // max(1, most))
        order = np.argsort(col, kind="stable")
        item, col, count = item[order], col[order], count[order].copy()
        while len(col):
            # Of every posting at most ``limit`` occurrences; what is left comes in a later round.
            now = np.minimum(count, limit)
            names, first = np.unique(col, return_index=True)
            ends = np.append(first[1:], len(col))
            used, start = np.zeros(n_items, np.int64), 0
            for k in range(len(names) + 1):
                own = slice(first[k], ends[k]) if k < len(names) else None
                if own is None or k - start == columns or (used[item[own]] + now[own] > limit).any():
                    if k > start:
                        part = slice(first[start], ends[k - 1])
                        counts = np.zeros((n_items, k - start))
                        counts[item[part], np.searchsorted(names[start:k], col[part])] = now[part]
                        self.tiles.append((names[start:k], counts))
                    used[:], start = 0, k
                if own is not None:
                    used[item[own]] += now[own]
            left = count > now
            item, col, count = item[left], col[left], (count - now)[left]

    def scores(self, impacts: np.ndarray) -> np.ndarray:
        """items x documents, as integers; ``impacts`` is documents x all columns, float64."""
        return sum((counts @ impacts[:, names].T).astype(np.int64) for names, counts in self.tiles)


def _best(k: int, item: np.ndarray, score: np.ndarray, null: np.ndarray, doc: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The places of the k best of each item: highest score, then smallest id (nulls last), then row."""
    order = np.lexsort((row, doc, null, -score, item))
    own = item[order]
    first = np.searchsorted(own, own)
    return order[np.arange(len(own)) - first < k]


def _ranked(tiles: Tiles, item_ids: list, weight: np.ndarray, n_docs: int, n_terms: int, k: int, tile_rows: int):
    """Postings -> the k best documents of each item in a task."""
    n_items, width = len(item_ids), len(weight)
    ids = pa.array(item_ids, pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64) for _ in range(5)]  # item, score, null, doc, row
        reach = np.ones(n_items, np.int64)  # a document needs it to be of interest
        for b in batches:
            b = b.filter(pa.array(b.column("n").to_numpy() > 0))
            null = np.array(b.column("id").is_null())
            doc, row, n = (b.column(x).fill_null(0).to_numpy() for x in ("id", "row", "n"))
            cols, tfs = b.column("cols").to_pylist(), b.column("tfs").to_pylist()
            for lo in range(0, len(n), tile_rows):
                hi = min(len(n), lo + tile_rows)
                col = np.frombuffer(b"".join(cols[lo:hi]), np.int32)
                tf = np.frombuffer(b"".join(tfs[lo:hi]), np.int32).astype(np.int64)
                at = np.repeat(np.arange(hi - lo), [len(x) // 4 for x in cols[lo:hi]])
                m = 25 + 75 * n[lo:hi] * n_docs // n_terms
                impacts = np.zeros((hi - lo, width))
                impacts[at, col] = weight[col] * (1_000_000_000 * tf // (1000 * tf + 8 * m[at]))
                scores = tiles.scores(impacts)
                if hi - lo > k:
                    kth = hi - lo - k
                    reach = np.maximum(reach, np.partition(scores, kth, axis=1)[:, kth])
                item, place = np.nonzero(scores >= reach[:, None])
                fresh = (item, scores[item, place], null[lo + place].astype(np.int64), doc[lo + place], row[lo + place])
                held = [np.concatenate(x) for x in zip(held, fresh, strict=True)]
                best = _best(k, *held)
                held = [x[best] for x in held]
                full = np.bincount(held[0], minlength=n_items) >= k
                least = np.full(n_items, np.iinfo(np.int64).max)
                np.minimum.at(least, held[0], held[1])
                reach[full] = np.maximum(reach, least)[full]
        item, score, null, doc, row = held
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), ids.take(pa.array(item)), pa.array(score), pa.array(doc, mask=null > 0), pa.array(row)], ["item", "item_id", "score", "id", "row"]
        )

    return run


def _search_pass(docs: DataFrame, items: list, k: int, tile_rows: int) -> DataFrame:
    """The ranked rows of the items of one pass (item, item_id, n, terms, counts)."""
    terms = np.concatenate([np.frombuffer(r["terms"], U) for r in items])
    counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in items])
    item = np.repeat(np.arange(len(items)), [r["n"] for r in items])
    vocabulary, col = np.unique(terms, return_inverse=True)

    found = stage(docs.mapInArrow(_postings(vocabulary), POSTINGS), "postings")
    total = found.agg(F.count(F.expr("if(n > 0, 1, null)")).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(len(vocabulary), np.int64)
    held = found.select("cols").mapInArrow(_document_counts(len(vocabulary)), "col int, df long").groupBy("col").agg(F.sum("df").alias("df"))
    for r in held.collect():  # a row for each column at most
        df[r["col"]] = r["df"]
    weight = np.floor(1000 * np.log((2 * total["docs"] + 2) / (2 * df + 1))).astype(np.int64)
    tiles = Tiles(len(items), item, col, counts, int(weight.max()) * 1_000_000)
    run = _ranked(tiles, [r["item_id"] for r in items], weight, total["docs"], max(1, total["terms"]), k, tile_rows)
    best = found.mapInArrow(run, "item long, item_id long, score long, id long, row long")
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return best.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", pass_terms: int = PASS_TERMS, tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: of each item's row the k highest scores above 0."""
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = stage_numbered(items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")), "item", "items")
    terms = stage(asked.mapInArrow(_item_terms, "item long, item_id long, n long, terms binary, counts binary").filter("n > 0"), "item_terms")
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    held: list = []
    size = 0
    for r in terms.toLocalIterator():  # a pass is held at a time
        if held and size + r["n"] > pass_terms:
            out = out.unionByName(stage(_search_pass(texts, held, k, tile_rows), "ranked"))
            held, size = [], 0
        held.append(r)
        size += r["n"]
    return out.unionByName(_search_pass(texts, held, k, tile_rows)) if held else out
