"""Near-duplicate detection by min-max hashing: both ends of every permutation, in bands.

A document's set holds the distinct 5-word shingles of its whole text, as 64-bit hashes; two documents
link when 100 |A n B| >= 85 |A u B|. Documents with equal sets are one class.

Sketch. ``HASHES`` = 126 random permutations of a set's elements are evaluated, and of each both the
smallest and the largest value stay: 252 signature values from half the evaluations that 252 minima
would need. Two sets agree in either value with a probability of their Jaccard similarity, so the
share of agreeing values is unbiased; since the two ends of a permutation fall apart rather than
together, its variance is no larger than that of as many independent minima. The values are cut into
36 bands of 7. A pair at the threshold misses every band with a probability of 1e-6 (0.85^7 = 0.32 a
band), and closer pairs with less; that is the method's only loss. Found links are checked on full sets.

Links. The classes that share a band value form a group, of which no pairs are listed. First each class
is checked on the full sets against the smallest class of each of its groups, and components are built. In
groups that still lie in several components, the classes outside the group's largest component are
compared with all others. The groups are dealt in blocks of about ``BLOCK`` classes a side, so no task
gets a large group; a task has the sets of two blocks, compares a pair in the first band that it shares,
skips pairs that its own links have joined by then, and returns only links that join two components. So
what any step returns grows with the classes, not with the pairs of a group. At last the components
of components are built. Every link between different sets is either checked or inside a component.

Nulls and odd input: a null or white text has an empty set and links with nothing. Fewer than five
words: the whole sequence is the one shingle. A null id never is a component's smallest one unless all
are null. Repeated rows are separate rows of one class. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrflow.llm._graph import components
from addrflow.llm._io import stage, stage_numbered
from addrflow.llm._text import M1, M2, M3, U, mix
from addrflow.llm.near_join import _sets_of, fingerprint, shingle_sets

PERCENT = 85
HASHES = 126
BAND_ROWS = 7
BANDS = 2 * HASHES // BAND_ROWS
BLOCK = 512
CHUNK = 2048  # elements that are permuted at once
U32 = np.uint32


def _permutations(seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of x -> a x + b (mod 2^32), one of each a permutation."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 31, HASHES) * 2 + 1).astype(U32), rng.integers(0, 1 << 32, HASHES).astype(U32)


FACTORS, SUMMANDS = _permutations()
COLUMN = mix(np.arange(1, BAND_ROWS + 1).astype(U) * M1) | U(1)


def min_max(s: np.ndarray) -> np.ndarray:
    """Smallest and largest value of each permutation in turn, over a set of 64-bit hashes."""
    x = (s >> U(32)).astype(U32)
    out = np.empty((HASHES, 2), U32)
    out[:, 0], out[:, 1] = np.iinfo(U32).max, 0
    for i in range(0, len(x), CHUNK):
        moved = np.multiply.outer(FACTORS, x[i : i + CHUNK])
        moved += SUMMANDS[:, None]
        out[:, 0] = np.minimum(out[:, 0], moved.min(1))
        out[:, 1] = np.maximum(out[:, 1], moved.max(1))
    return out.reshape(-1)


def bands(values: np.ndarray) -> np.ndarray:
    """A 64-bit key for the values of each band."""
    rows = (values.astype(U).reshape(BANDS, BAND_ROWS) + U(1)) * COLUMN
    return mix(rows.sum(1, dtype=U) + np.arange(BANDS).astype(U) * M3)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row, id, n, node (fingerprint), keys (of the bands; for equal sets of a task once)."""
    seen: set = set()
    for b in batches:
        nodes, sizes, keys = [], [], []
        for s in shingle_sets(b.column("text")):
            one, two = fingerprint(s)
            sizes.append(len(s))
            nodes.append(one.to_bytes(8, "big") + two.to_bytes(8, "big") if len(s) else None)
            fresh = len(s) and (one, two) not in seen
            if fresh:
                if len(seen) > 1 << 18:
                    seen.clear()
                seen.add((one, two))
            keys.append(bands(min_max(s)).view(np.int64) if fresh else None)
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["id", "n", "node", "keys"]
        )


def alike(s: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the sorted sets link with the sorted set ``s``."""
    sizes = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(s, flat), len(s) - 1)
    both = np.add.reduceat((s[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * both >= PERCENT * (len(s) + sizes - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the pairs (a, b, items, items2) those that link."""
    for b in batches:
        ok = [bool(alike(np.frombuffer(x, "<u8"), [np.frombuffer(y, "<u8")])[0]) for x, y in zip(b.column("items").to_pylist(), b.column("items2").to_pylist(), strict=True)]
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])


def joining(key: int, left: np.ndarray, right: np.ndarray, label: np.ndarray, keys: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of labels that links between a block (left) and another (right) join, no more than needed.

    A pair is compared where ``key`` is the first of the band keys that it shares.
    """
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.get(x, x)) != x:
            x = up
        return x

    out, sizes, place = [], np.array([len(x) for x in sets]), np.arange(len(sets))
    tops = label.copy()
    for i in np.flatnonzero(left):
        fits = right & (tops != tops[i]) & ~(left & (place < i) & right[i])
        fits &= (100 * sizes >= PERCENT * sizes[i]) & (100 * sizes[i] >= PERCENT * sizes)
        other = np.flatnonzero(fits)
        if len(other):
            first = (keys[other] == keys[i]).argmax(1)
            other = other[keys[i][first] == key]
        if not len(other):
            continue
        found = False
        for j in other[alike(sets[i], [sets[j] for j in other])].tolist():
            a, b = top(int(label[i])), top(int(label[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((int(label[i]), int(label[j])))
                found = True
        if found:
            tops = np.array([top(x) for x in label.tolist()])
    return out


GROUP = ["key", "i", "j"]
TASK_ROWS = [*GROUP, "left", "right", "label", "keys", "items"]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group -> the links (a, b) of labels that join components of a group."""

    def links(rows: list[tuple]) -> pa.RecordBatch:
        key = U(rows[0][0] % (1 << 64))
        left, right, label, keys, items = zip(*(r[3:] for r in rows), strict=True)
        found = joining(key, np.array(left), np.array(right), np.array(label), np.array(keys).view(U), [np.frombuffer(x, "<u8") for x in items])
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    held: list[tuple] = []
    for b in batches:
        for r in zip(*(b.column(n).to_pylist() for n in TASK_ROWS), strict=True):
            if held and held[0][:3] != r[:3]:
                yield links(held)
                held = []
            held.append(r)
    if held:
        yield links(held)


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """Members (key, x, label) of the groups in several components, dealt in pairs of blocks (i, j).

    Rows outside the largest component of a group are block i of the left side; all are block j of the right.
    """
    parts = members.groupBy("key", "label").agg(F.count("*").alias("k"))
    largest = F.max(F.struct("k", "label")).alias("most")
    several = parts.groupBy("key").agg(F.count("*").alias("parts"), F.sum("k").alias("k"), largest).filter("parts > 1")
    sides = several.select(
        "key", F.col("most.label").alias("common"),
        F.ceil((F.col("k") - F.col("most.k")) / block).cast("int").alias("lefts"), F.ceil(F.col("k") / block).cast("int").alias("rights"),
    )
    dealt = members.join(sides, "key").select(
        "key", "x", "label", "lefts", "rights", (F.col("label") != F.col("common")).alias("apart"),
        F.expr("int(pmod(xxhash64(x, 1), lefts))").alias("i0"), F.expr("int(pmod(xxhash64(x, 2), rights))").alias("j0"),
    )
    down = F.expr("transform(sequence(0, lefts - 1), v -> named_struct('i', v, 'j', j0))")
    across = F.expr("transform(sequence(0, rights - 1), v -> named_struct('i', i0, 'j', v))")
    to = F.explode(F.when(F.col("apart"), F.array_distinct(F.concat(down, across))).otherwise(down)).alias("to")
    return dealt.select("key", "x", "label", "apart", "i0", "j0", to).select(
        "key", "x", "label", "to.i", "to.j", (F.col("apart") & (F.col("i0") == F.col("to.i"))).alias("left"), (F.col("j0") == F.col("to.j")).alias("right")
    )


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable), kept (the smallest)."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    feats = stage(plain.mapInArrow(_sketches, "id long, n long, node binary, keys array<long>"), "sketches")
    equal = feats.filter("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.max("keys").alias("keys"))
    classes = stage_numbered(equal, "x", "classes")

    # The groups of a band value that several classes share, and the smallest class of each.
    entries = classes.select("x", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.min("x").alias("p"), F.max("x").alias("q")).filter("p < q")
    members = stage(entries.join(shared.select("key", "p"), "key"), "members")
    names = classes.join(members.select("x").distinct(), "x", "left_semi")
    found = _sets_of(plain, names.select("node", "id"), "found_sets")
    sets = stage(names.join(found, "node").select("x", "keys", "items"), "sets")

    edges = members.filter("x > p").select(F.col("p").alias("a"), F.col("x").alias("b")).distinct()
    one, two = (sets.select(F.col("x").alias(x), F.col("items").alias(y)) for x, y in (("a", "items"), ("b", "items2")))
    stars = stage(edges.join(one, "a").join(two, "b").select("a", "b", "items", "items2").mapInArrow(_verify, "a long, b long"), "stars")
    labels = stage(components(stars).withColumnRenamed("node", "x"), "labels")

    named = members.select("key", "x").join(labels, "x", "left").withColumn("label", F.coalesce("label", "x"))
    tasks = _blocks(stage(named, "named"), block).join(sets, "x").select(*TASK_ROWS)
    across = stage(tasks.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(_compare, "a long, b long").distinct(), "across")
    merged = components(across).select(F.col("node").alias("label"), F.col("label").alias("top"))

    final = classes.select("x", "node", "id").join(labels, "x", "left").withColumn("label", F.coalesce("label", "x"))
    final = stage(final.join(merged, "label", "left").select("node", "id", F.coalesce("top", "label").alias("label")), "components")
    least = final.groupBy("label").agg(F.min("id").alias("least"))
    own = final.select("node", "label").join(least, "label").select("node", "least")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("least"))
    return feats.select("id", "n", "node").join(own, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )
