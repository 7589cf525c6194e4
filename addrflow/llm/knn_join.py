"""Exact top-k search by inner product as a Voronoi join.

Vectors are grouped by their nearest pivot. A group's summary is its size, the largest distance
from its pivot and the k + 1 smallest distances. For a query q and a member x of the group of pivot
p, |q.x - q.p| <= |q| |x - p|; so the summaries give every query a score that k others are sure to
reach, and every group a score that it cannot exceed. A query is replicated only to the groups that
may hold one of its k best; each group is solved locally, and the local winners are merged.

Both sides of a group are split into blocks of about ``block_rows`` by a hash of the row: its vectors
(a very common vector), and the queries that reach it, which are counted first. Every block of vectors
meets every block of queries, so no task gets an unbounded group. The number of pivots grows with the
square root of the rows, at most ``max_pivots`` and ``PIVOT_BYTES`` for each dimension; pivots and
summaries (one per pivot) are the only data that go through the driver.

Components are quantised as floor(scale * x) of the double value. Nulls and odd input: vectors that
are null, hold a null or non-finite component, or have a null id take no part. Vectors meet only
others of their dimension. A repeated id is another row: a query leaves out only its own row. Scores
beyond 64 bits are clipped. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from addrflow.llm._io import stage_numbered

EXACT = 2.0**52  # doubles hold integers exactly up to here
PIVOT_BYTES = 8 << 20  # of the pivots of a dimension
ENTRIES = 1 << 22  # of a matrix of bounds, at once
SLACK = 1e-6  # bounds are widened by this share against rounding


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), dim)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of a with all rows of b, as int64."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in a], object).reshape(a.shape)
    other = np.array([[int(x) for x in r] for r in b], object).reshape(b.shape)
    return np.clip(whole @ other.T, -(2**63), 2**63 - 1).astype(np.int64)


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row (ties: the first) and an upper bound of its distance."""
    score = (pivots**2).sum(1) - 2 * (x @ pivots.T)
    cell = score.argmin(1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1)) * (1 + SLACK)


def top_k(
    table: DataFrame,
    is_query,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    max_pivots: int = 1024,
    block_rows: int = 16384,
) -> DataFrame:
    """query_id, rank (from 1), id, score; ``is_query`` is a condition on the id column."""
    vec = F.col(vec_col)
    ok = vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = stage_numbered(
        table.filter(F.col(id_col).isNotNull() & ok).select(
            F.col(id_col).cast("long").alias("id"),
            F.coalesce(is_query, F.lit(False)).alias("q"),
            F.size(vec).alias("dim"),
            vec.cast("array<double>").alias("vec"),
        ),
        "row",
        "vectors",
    )

    # The pivots: for each dimension, the vectors that a hash puts first.
    sizes = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    wanted = {d: max(1, min(max_pivots, int(n**0.5), PIVOT_BYTES // (8 * max(1, d)))) for d, n in sizes.items()}
    first = Window.partitionBy("dim").orderBy("h", "row")
    hashed = rows.withColumn("h", F.xxhash64("vec"))
    slots = max(wanted.values(), default=1)
    chosen = (
        hashed.groupBy("dim", F.pmod("h", F.lit(slots)).alias("slot"))
        .agg(F.min(F.struct("h", "row")).alias("v"))
        .select("dim", "v.h", "v.row")
        .withColumn("nth", F.row_number().over(first))
    )
    most = F.coalesce(*[F.when(F.col("dim") == d, F.lit(n)) for d, n in wanted.items()], F.lit(0))
    kept = chosen.filter(F.col("nth") <= most).select("row", "nth")
    pivots: dict[int, np.ndarray] = {}
    found: dict[int, list] = {}
    for r in rows.join(kept, "row").select("dim", "nth", "vec").collect():  # PIVOT_BYTES a dimension at most
        found.setdefault(r["dim"], []).append((r["nth"], r["vec"]))
    for d, own in found.items():
        pivots[d] = np.floor(np.array([v for _, v in sorted(own)], float).reshape(len(own), d) * scale)

    def assign(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims):
                part = b.filter(pa.array(dims == d))
                x = np.floor(np.asarray(part.column("vec").flatten(), float).reshape(len(part), d) * scale)
                cell, dist = _nearest(x, pivots[d])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), part.column("id"), part.column("q"),
                        pa.array(np.full(len(part), d, np.int32)), pa.array(cell.astype(np.int32)), pa.array(dist),
                        pa.array([v.tobytes() for v in x], pa.binary()),
                    ],
                    ["row", "id", "q", "dim", "cell", "dist", "x"],
                )

    placed = stage_numbered(
        rows.mapInArrow(assign, "row long, id long, q boolean, dim int, cell int, dist double, x binary"), "place", "cells"
    ).drop("place")

    # Summaries; of the smallest distances every task sends k + 1 at most.
    def shortest(batches):
        found: dict = {}
        for b in batches:
            for d, c, dist in zip(*(b.column(n).to_pylist() for n in ("dim", "cell", "dist")), strict=True):
                found.setdefault((d, c), []).append(dist)
            found = {key: sorted(v)[: k + 1] for key, v in found.items()}
        out = [(d, c, x) for (d, c), v in found.items() for x in v]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(col), t) for col, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.float64()), strict=True)], ["dim", "cell", "dist"])

    near: dict = {}
    for r in placed.select("dim", "cell", "dist").mapInArrow(shortest, "dim int, cell int, dist double").groupBy("dim", "cell").agg(
        F.slice(F.array_sort(F.collect_list("dist")), 1, k + 1).alias("near")
    ).collect():
        near[r["dim"], r["cell"]] = r["near"]
    summaries: dict[int, list] = {}
    for r in placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("dist").alias("far")).collect():
        blocks = -(-r["n"] // block_rows)
        summaries.setdefault(r["dim"], []).append((r["cell"], blocks, r["far"], near[r["dim"], r["cell"]]))

    def reached(part: pa.RecordBatch, d: int):
        """(first query, queries, index of a summary) that may meet, for ranges of the queries."""
        cells = summaries[d]
        held, far = np.array([c for c, _, _, _ in cells]), np.array([s[2] for s in cells])
        step = max(1, ENTRIES // (len(cells) * (k + 1)))
        every = _matrix(part.column("x"), d)
        for lo in range(0, len(every), step):
            x = every[lo : lo + step]
            norm = np.sqrt((x**2).sum(1))
            at = x @ pivots[d][held].T
            slack = SLACK * (1 + np.abs(at))
            sure = np.concatenate([at[:, [j]] - norm[:, None] * np.array(s[3])[None, :] - slack[:, [j]] for j, s in enumerate(cells)], 1)
            # One of the k + 1 may be the query itself.
            least = -np.partition(-sure, k, 1)[:, k] if sure.shape[1] > k else np.full(len(x), -np.inf)
            q, j = np.nonzero(at + norm[:, None] * far[None, :] + slack >= least[:, None])
            yield lo + q, j

    def reach_counts(batches):
        """(dim, cell, n): the queries of a task that reach each group."""
        counts: dict = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                for _, j in reached(b.filter(pa.array(dims == d)), d):
                    counts[d] = counts.get(d, 0) + np.bincount(j, minlength=len(summaries[d]))
        out = [(d, summaries[d][j][0], n) for d, each in counts.items() for j, n in enumerate(each.tolist()) if n]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int64()), strict=True)], ["dim", "cell", "n"])

    asked = placed.filter("q")
    counted = asked.mapInArrow(reach_counts, "dim int, cell int, n long").groupBy("dim", "cell").agg(F.sum("n").alias("n"))
    query_blocks = {(r["dim"], r["cell"]): -(-r["n"] // block_rows) for r in counted.collect()}  # one row a pivot

    def replicate(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                part, cells = b.filter(pa.array(dims == d)), summaries[d]
                row = part.column("row").to_numpy()
                ways = np.array([query_blocks.get((d, s[0]), 1) for s in cells])
                for q, j in reached(part, d):
                    times = np.array([s[1] for s in cells])[j]
                    q, j = np.repeat(q, times), np.repeat(j, times)
                    block = np.concatenate([np.arange(t) for t in times]) if len(times) else np.zeros(0, int)
                    own = part.take(pa.array(q))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(q), d, np.int32)), pa.array(np.array([s[0] for s in cells], np.int32)[j]),
                            pa.array(block.astype(np.int32)), pa.array((row[q] * 2654435761 % (1 << 32) % ways[j]).astype(np.int32)),
                            own.column("row"), own.column("id"), own.column("x"),
                        ],
                        ["dim", "cell", "block", "queries", "row", "id", "x"],
                    )

    queries = asked.mapInArrow(replicate, "dim int, cell int, block int, queries int, row long, id long, x binary")
    n_blocks = table.sparkSession.createDataFrame(
        [(d, s[0], s[1], query_blocks[d, s[0]]) for d, cells in summaries.items() for s in cells if (d, s[0]) in query_blocks] or [],
        "dim int, cell int, blocks int, ways int",
    )  # one row per pivot at most
    data = placed.join(F.broadcast(n_blocks), ["dim", "cell"]).select(
        "dim", "cell", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.expr("sequence(0, ways - 1)")).alias("queries"), "row", "id", "x",
    )

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {n: [] for n in ("query_row", "query_id", "id", "row", "score")}
        if len(left) and len(right):
            d = left.column("dim")[0].as_py()
            x, y = _matrix(left.column("x").combine_chunks(), d), _matrix(right.column("x").combine_chunks(), d)
            lr, li, rr, ri = (t.column(n).to_numpy() for t in (left, right) for n in ("row", "id"))
            step = max(1, 4_000_000 // len(y))
            for i in range(0, len(x), step):
                part = _scores(x[i : i + step], y)
                for j, s in enumerate(part):
                    kept = np.flatnonzero(rr != lr[i + j])
                    if len(kept) > k:
                        kept = kept[s[kept] >= np.partition(s[kept], -k)[-k]]
                    kept = kept[np.lexsort((rr[kept], ri[kept], -s[kept]))][:k]
                    for name, v in (("query_row", np.full(len(kept), lr[i + j])), ("query_id", np.full(len(kept), li[i + j])), ("id", ri[kept]), ("row", rr[kept]), ("score", s[kept])):
                        out[name].append(v)
        return pa.table({n: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for n, v in out.items()})

    keys = ["dim", "cell", "block", "queries"]
    local = (
        queries.groupBy(keys)
        .cogroup(data.groupBy(keys))
        .applyInArrow(solve, "query_row long, query_id long, id long, row long, score long")
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    return (
        local.withColumn("rank", F.row_number().over(best).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
