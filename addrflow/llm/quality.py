"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's grade is 0 (bad), 1 (well written but toxic) or 2 (well written, not toxic). The model
has one weight per hashed feature, shared by all grades, and ordered thresholds t1 < t2:
P(grade >= k) = sigmoid(score - t_k). Features are the distinct words (runs of letters, A-Z
lower-cased, as 48-bit hashes), their first 4 and 6 bytes, and binned shape statistics (shares of capitals, signs, digits and
distinct words, length of words). The expected grade and the tail probability P(grade >= 2) follow
from the thresholds; documents with a tail probability of at least ``KEEP`` are selected.

The model is fitted on at most ``MAX_RATED`` rated documents (those whose ids a hash puts first);
everything else, all texts and all documents, is scored whole. Features of the sample are made on
the executors and dealt to ``SLICES`` ranges of keys; a group each finds the features that occur in
at least ``MIN_DOCS`` documents of the sample and are graded unlike the rest by ``SIGMAS`` standard
deviations. Only those go on to the fit, which runs in one task on the sample alone. The model
(features that keep a weight) goes to the tasks that score.

Nulls and odd input: a null or empty text has no words and is scored from its shape features.
Ratings with a null in any column are left out; a document rated twice counts twice. Without
ratings, or with ratings of one grade only, every document is kept with that grade (2 without any).
Repeated rows are scored alike. An empty table gives an empty result. Extra columns are ignored by
``score`` and kept by ``select``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrflow.llm._text import LETTER, U, buffers, rounds, table, word_hashes

MAX_RATED = 20_000
MIN_DOCS = 4
SIGMAS = 4.0
KEEP = 0.5
GRADES = 3
HASH_BITS = 48
#: Ranges of keys, and documents in a batch of their features: both bound the memory of a worker.
SLICES, PART = 16, 1_000
STEPS, BATCH, RATE, SPARSE = 6000, 64, 1.0, 1e-3

PREFIXES = (4, 6)  # bytes
FEATURE = U((1 << HASH_BITS) - 1)
CAPITAL, DIGIT = table(bytes(range(65, 91))), table(b"0123456789")
SIGN = table(bytes(c for c in range(33, 127) if not (48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123) and c not in b".,"))
LEVELS = 24


def _levels(share: np.ndarray) -> np.ndarray:
    """A share in [0, 1] as one of LEVELS levels, finer towards 0."""
    return np.minimum(LEVELS - 1, np.sqrt(np.clip(share, 0, 1)) * LEVELS).astype(np.int64)


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct feature keys of each text."""
    data, offsets = buffers(column)
    for i, j in rounds(offsets):
        part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        w, counts, *short = ((x & FEATURE) | U(1 << HASH_BITS) if x.dtype == U else x for x in word_hashes(part, at, LETTER, PREFIXES))
        size = np.maximum(1, np.diff(at))
        held = [np.diff(np.concatenate([[0], np.cumsum(t[part])])[at]) for t in (CAPITAL, SIGN, DIGIT, LETTER)]
        shape = [_levels(h / size) for h in held]
        shape.append(np.minimum(LEVELS - 1, held[3] // np.maximum(1, counts)))
        lo = 0
        for n, c in enumerate(counts.tolist()):
            own = np.unique(w[lo : lo + c])
            starts = [np.unique(x[lo : lo + c]) for x in short]
            lo += c
            levels = [s[n] for s in shape] + [_levels(np.array([len(own) / max(1, c)]) ** 2)[0]]
            marks = [LEVELS * x + int(v) for x, v in enumerate(levels)]
            yield np.unique(np.concatenate([np.array(marks, U), own, *starts]))


class Model:
    """Sorted feature keys, their weights, and the thresholds."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.keys, self.weights, self.thresholds = keys, weights, thresholds
        self.maybe = np.zeros(1 << 20, bool)  # most words have no weight: a quick look
        self.maybe[(keys & U((1 << 20) - 1)).astype(np.int64)] = True

    def score(self, found: np.ndarray) -> float:
        found = found[self.maybe[(found & U((1 << 20) - 1)).astype(np.int64)]]
        if not len(self.keys) or not len(found):
            return 0.0
        at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        return float(self.weights[at[self.keys[at] == found]].sum())

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... of each score."""
        z = np.asarray(scores, float)[:, None] - self.thresholds[None, :]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _held(keys: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``wide`` its place among the sorted keys, and whether it is one of them."""
    if not len(keys):
        return np.zeros(len(wide), np.int64), np.zeros(len(wide), bool)
    place = np.minimum(np.searchsorted(keys, wide), len(keys) - 1)
    return place, keys[place] == wide


def telling(grades: np.ndarray, wide: np.ndarray, lengths: np.ndarray, sigmas: float = SIGMAS) -> np.ndarray:
    """The sorted keys in enough documents that are graded unlike the rest, by so many standard deviations.

    ``wide`` holds the keys of all documents in turn, ``lengths`` how many each of them has.
    """
    keys, docs = np.unique(wide, return_counts=True)
    keys, docs = keys[docs >= MIN_DOCS], docs[docs >= MIN_DOCS]
    unlike = np.zeros(len(keys), bool)
    if len(keys):
        place, found = _held(keys, wide)
        grade = np.repeat(grades, lengths)
        for k in range(1, GRADES):
            base = np.clip((grades >= k).mean(), 1e-3, 1 - 1e-3)
            high = np.bincount(place[found & (grade >= k)], minlength=len(keys))
            unlike |= np.abs(high - docs * base) >= sigmas * np.sqrt(docs * base * (1 - base))
    return keys[unlike]


def fit(grades: np.ndarray, rows: list[np.ndarray], sigmas: float = SIGMAS) -> Model:
    """The model of documents with these grades and keys.

    ``sigmas`` is the evidence that a feature needs, whatever the number of ratings.
    """
    wide = np.concatenate(rows) if rows else np.zeros(0, U)
    keys = telling(grades, wide, np.array([len(r) for r in rows], np.int64), sigmas)
    return learn(grades, keys, [place[held] for place, held in (_held(keys, r) for r in rows)])


def learn(grades: np.ndarray, keys: np.ndarray, at: list[np.ndarray]) -> Model:
    """Proximal AdaGrad on the ordinal likelihood; documents are processed in a fixed shuffled order.

    ``at`` holds the places of each document's features among the keys.
    """
    if not len(keys) or len(np.unique(grades)) < 2:
        only = int(grades[0]) if len(grades) else GRADES - 1
        return Model(np.zeros(0, U), np.zeros(0), np.where(np.arange(1, GRADES) <= only, -50.0, 50.0))
    share = np.array([(grades >= k).mean() for k in range(1, GRADES)]).clip(1e-3, 1 - 1e-3)
    thresholds = np.log((1 - share) / share)  # of the score 0
    for k in range(1, GRADES - 1):
        thresholds[k] = max(thresholds[k], thresholds[k - 1] + 1e-2)
    w, power = np.zeros(len(keys)), np.full(len(keys), 1e-8)
    t_power = np.full(GRADES - 1, 1e-2)
    rng = np.random.default_rng(7)
    rare = np.bincount(grades, minlength=GRADES)
    rare = np.sqrt(rare.max() / np.maximum(1, rare))  # rarer grades weigh more
    for _ in range(max(8, -(-STEPS * BATCH // len(at)))):
        order = rng.permutation(len(at))
        for lo in range(0, len(order), BATCH):
            batch = order[lo : lo + BATCH]
            cols = np.concatenate([at[i] for i in batch])
            row = np.repeat(np.arange(len(batch)), [len(at[i]) for i in batch])
            s = np.bincount(row, w[cols], len(batch))
            y = grades[batch]
            tail = 1 / (1 + np.exp(-np.clip(s[:, None] - thresholds[None, :], -30, 30)))
            tail = np.concatenate([np.ones((len(batch), 1)), tail, np.zeros((len(batch), 1))], 1)
            here, above = tail[np.arange(len(batch)), y], tail[np.arange(len(batch)), y + 1]
            slope = rare[y] * (here + above - 1) / len(batch)  # of the negative log-likelihood in the score
            seen, back = np.unique(cols, return_inverse=True)
            g = np.bincount(back, slope[row], len(seen))
            power[seen] += g * g
            step = RATE / np.sqrt(power[seen])
            moved = w[seen] - step * g
            w[seen] = np.sign(moved) * np.maximum(0, np.abs(moved) - step * SPARSE)
            chance = np.maximum(here - above, 1e-9) / rare[y]
            for k in range(1, GRADES):
                f = tail[:, k] * (1 - tail[:, k]) / chance
                g = float((f * (y == k)).sum() - (f * (y == k - 1)).sum()) / len(batch)
                t_power[k - 1] += g * g
                thresholds[k - 1] -= 0.1 * g / np.sqrt(t_power[k - 1])
            for k in range(1, GRADES - 1):
                thresholds[k] = max(thresholds[k], thresholds[k - 1] + 1e-2)
    kept = w != 0
    return Model(keys[kept], w[kept], thresholds)


#: Where the ranges of keys end: hashes are even from 1 << HASH_BITS on, shape features lie below.
ENDS = (U(1 << HASH_BITS) + np.arange(1, SLICES, dtype=U) * U((1 << HASH_BITS) // SLICES)).astype(U)
PICKED = "doc long, h long, grade int, slice int, keys binary"


def _binary(wide: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Keys as a binary column, so many in each row."""
    offsets = np.concatenate([[0], np.cumsum(8 * lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(wide.astype("<u8").tobytes())])


def _keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all rows in turn, and how many each of them has."""
    data, offsets = buffers(column)
    return data[offsets[0] : offsets[-1]].view("<u8").astype(U, copy=False), np.diff(offsets) // 8


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every document and range of keys, also where it has none."""
    for whole in batches:
        for lo in range(0, len(whole), PART):
            b = whole.slice(lo, PART)
            found = list(features(b.column("text")))
            lengths = [np.diff(np.concatenate([[0], np.searchsorted(x, ENDS), [len(x)]])) for x in found]
            each = np.repeat(np.arange(len(b)), SLICES)
            yield pa.RecordBatch.from_arrays(
                [
                    *[b.column(n).take(pa.array(each)) for n in ("doc", "h", "grade")],
                    pa.array(np.tile(np.arange(SLICES, dtype=np.int32), len(b))),
                    _binary(np.concatenate(found), np.concatenate(lengths)),
                ],
                ["doc", "h", "grade", "slice", "keys"],
            )


def _pick(t: pa.Table) -> pa.Table:
    """The rows of a range with the telling keys alone; all documents go on with the first range."""
    t = t.combine_chunks()
    wide, lengths = _keys(t["keys"].chunk(0))
    _, held = _held(telling(t["grade"].to_numpy(), wide, lengths), wide)
    ends = np.cumsum(lengths)
    kept = np.diff(np.concatenate([[0], np.cumsum(held)])[np.concatenate([[0], ends])])
    some = (kept > 0) | (t["slice"].to_numpy() == 0)
    return t.set_column(4, "keys", _binary(wide[held], kept)).filter(pa.array(some))


def _sample(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Grades, all keys, and each document's places among them; how the documents were dealt changes nothing.

    Takes the batches out of ``held``, so keys and places are not in memory together.
    """
    keys = np.zeros(0, U)
    for b in held:
        keys = np.union1d(keys, _keys(b.column("keys"))[0])
    columns, places, sizes = [], [], []
    while held:
        b = held.pop()
        wide, lengths = _keys(b.column("keys"))
        places.append(np.searchsorted(keys, wide).astype(np.int32))
        sizes.append(lengths)
        columns.append([b.column(n).to_numpy().astype(np.int64) for n in ("doc", "h", "grade", "slice")])
        del b, wide
    pa.default_memory_pool().release_unused()
    doc, h, grade, part = (np.concatenate(c) for c in zip(*columns, strict=True))
    place, ends = np.concatenate(places), np.cumsum(np.concatenate(sizes))
    del places
    starts = np.concatenate([[0], ends[:-1]])
    order = np.lexsort((part, doc))
    first = np.flatnonzero(part[order] == 0)
    at = [np.concatenate([place[starts[i] : ends[i]] for i in g]) for g in np.split(order, first[1:])]
    h, grade = h[order[first]], grade[order[first]]
    order = sorted(range(len(at)), key=lambda i: (h[i], grade[i], at[i].tobytes()))
    return grade[order], keys, [at[i] for i in order]


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if len(b)]
    if not held:
        return
    model = learn(*_sample(held))
    yield pa.RecordBatch.from_arrays(
        [pa.array([x.tobytes()], pa.binary()) for x in (model.keys.astype("<u8"), model.weights, model.thresholds)], ["keys", "weights", "thresholds"]
    )


def fit_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model of the rated documents; the labels have the id, quality and toxic."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    rated = (
        labels.filter(F.col(id_col).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
        .select(F.col(id_col).alias("id"), grade.cast("int").alias("grade"), F.xxhash64(F.col(id_col).cast("long")).alias("h"))
        .orderBy("h", "grade")
        .limit(MAX_RATED)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(rated), "id")  # MAX_RATED rows
    found = texts.select(F.monotonically_increasing_id().alias("doc"), "h", "grade", "text").mapInArrow(_rows, PICKED)
    picked = found.groupBy("slice").applyInArrow(_pick, PICKED)
    one = picked.repartition(1).mapInArrow(_fit, "keys binary, weights binary, thresholds binary").first()
    if one is None:
        return fit(np.zeros(0, np.int64), [])
    return Model(np.frombuffer(one["keys"], "<u8").astype(U), np.frombuffer(one["weights"], float), np.frombuffer(one["thresholds"], float))


def _scored(model: Model, text_col: str) -> Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]:
    def run(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        tails = model.tails(np.array([model.score(x) for x in features(b.column(text_col))]))
        return tails.sum(1), tails[:, -1]

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, expected_grade, tail_probability, kept."""
    judge = _scored(model, "text")

    def run(batches):
        for b in batches:
            grade, tail = judge(b)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(grade), pa.array(tail), pa.array(tail >= KEEP)], ["id", "grade", "tail", "kept"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, "id long, grade double, tail double, kept boolean").select(
        F.col("id").alias(id_col), F.col("grade").alias("expected_grade"), F.col("tail").alias("tail_probability"), "kept"
    )


def select(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that the model selects, with all their columns."""
    judge = _scored(model, text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(judge(b)[1] >= KEEP))

    return docs.mapInArrow(run, docs.schema)
