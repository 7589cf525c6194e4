"""N-gram Jaccard join with PartEnum signatures.

A document's set holds the distinct 5-word shingles of its whole text, as 64-bit hashes; two
documents link when 100 |A n B| >= 80 |A u B|. Then the symmetric difference is at most
(|A| + |B|) / 9.

Sizes are cut into bands in which the largest size is 5/4 of the smallest, so linked sets lie in
the same or in neighbouring bands; a set takes part in the instances of its own and the next band. In an
instance for sizes up to r linked sets differ in at most k = 2r / 9 elements. The hash domain is cut
into first-level partitions, k / 2 + 1 + t of them, so linked sets differ in at most one element in t + 1 of
them at least. Each is cut into ``RANGES`` second-level ranges, and its signatures are the hashes of the
set's contents in every subset of all ranges but one: where two sets differ in one element at most, they
agree in one of those subsets. For small k one range a partition is the better choice (k + 1 + t partitions,
of which t + 1 agree). Empty contents would be shared by many unlike sets; they are left out while at most
t partitions have any (then one without is agreed on), and kept otherwise. So linked sets share a signature
whatever they hold.

Sets that are equal form one class from the start, found map-side. Sets with a common signature
form a group, of which no pairs are listed: first each class is checked against the pivots of its
groups, their smallest classes, and components are built. A group whose classes then lie in one component has nothing left to find. In the
others, the classes outside the largest component are compared with all others, in blocks of a bounded
number of classes, by parity sketches: each element flips one bit, so the distance of two sketches never
exceeds the distance of the sets, and seldom falls far below it. A task returns only pairs that join two
components by its own pairs so far, fewer than it has classes. They are checked on the sets themselves, and
components are built again. A pair that failed may have hidden others, of which each end lies in a component
that such pairs connect: the components that failed pairs connect are compared as one group, without the pairs
that failed, until none is left. There a class also returns its nearest pairs that join nothing new, more in
each round, so that the rounds are few. So every linked pair is either checked or inside a component already.

``class_links`` lists the links between classes instead, all of them checked, and ``link_counts`` their
number a class; ``link`` and ``one_of_each`` take the cheaper way above.

Nulls and odd input: a null or white text has an empty set and links with nothing. Fewer than five
words: the whole sequence is the one shingle. A null id never is a component's smallest one unless
all are null. Repeated rows are separate rows of one class. An empty table gives an empty result.
Extra columns are ignored by ``link`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from addrflow.llm._graph import components
from addrflow.llm._io import stage, stage_numbered
from addrflow.llm._text import M1, M2, M3, SPACE, U, buffers, mix, rounds, word_hashes

WORDS = 5
ODD = np.array([M1, M2, M3, M1 ^ (M2 << U(1)), M2 ^ (M3 << U(1))], U) | U(1)
SIG_BYTES = 6  # of a class in the shuffle; a clash only adds a candidate
RANGES = 3  # second-level ranges of a partition
SMALL = 8  # up to so many differing elements, one range a partition
FEW = 12  # classes of a group that are compared one by one
SKETCH = 2  # bits of a sketch for each element, at least
#: The smallest size of each band.
BANDS = [1]
while BANDS[-1] < 1 << 40:
    BANDS.append(BANDS[-1] * 5 // 4 + 1)
BANDS = np.array(BANDS)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = buffers(column)
    for i, j in rounds(offsets):
        lo = offsets[i]
        w, counts = word_hashes(data[lo : offsets[j]], offsets[i : j + 1] - lo, SPACE_OUT)
        n = len(w)
        wide = np.zeros(n, U)
        for x in range(WORDS):
            if n > x:
                wide[: n - x] += w[x:] * ODD[x]
        wide = mix(wide + M1)
        at = 0
        for c in counts.tolist():
            if c >= WORDS:
                yield np.unique(wide[at : at + c - WORDS + 1])
            elif c:
                short = (w[at : at + c] * ODD[:c]).sum(dtype=U, keepdims=True)
                yield mix(short + np.array([c], U) * M3)
            else:
                yield np.zeros(0, U)
            at += c


SPACE_OUT = ~SPACE


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    a, b = mix(s * M1 + U(len(s))), mix(s * M3 + M2)
    return int(a.sum(dtype=U)), int(b.sum(dtype=U))


_EDGES: dict[int, np.ndarray] = {}


def _edges(n: int) -> np.ndarray:
    """The lower ends of n equal ranges of the hash domain, but the first."""
    if n not in _EDGES:
        if len(_EDGES) > 500:
            _EDGES.clear()
        _EDGES[n] = np.array([(i << 64) // n for i in range(1, n)], U)
    return _EDGES[n]


def signatures(s: np.ndarray) -> np.ndarray:
    """The signatures of a sorted set: its contents in the enumerated subsets of ranges, hashed."""
    n, out = len(s), []
    if not n:
        return s
    band = int(np.searchsorted(BANDS, n, "right")) - 1
    total = np.concatenate([np.zeros(1, U), np.cumsum(mix(s + M2), dtype=U)])
    for b in (band, band + 1):
        least, most = int(BANDS[b]), int(BANDS[b + 1]) - 1
        if 5 * n < 4 * least:
            continue
        k = 2 * most // 9
        if k == 0 or n == 1:
            continue  # equal sets only, which are one class already
        first, ranges, spare = (k // 2 + 4 + k // 32, RANGES, 3 + k // 32) if k > SMALL else (k + 7, 1, 6)
        cut = np.concatenate([[0], np.searchsorted(s, _edges(first * ranges), "left"), [n]])
        sums = (total[cut[1:]] - total[cut[:-1]]).reshape(first, ranges)
        held = np.diff(cut).reshape(first, ranges)
        if ranges > 1:  # every subset of all ranges but one
            sums, held = sums.sum(1, keepdims=True, dtype=U) - sums, held.sum(1, keepdims=True) - held
        where = np.arange(first * ranges, dtype=np.int64).astype(U).reshape(first, ranges)
        full = held > 0
        if first - int(full.all(1).sum()) <= spare:
            sums, where = sums[full], where[full]
        out.append(mix(sums.ravel() * M1 + where.ravel() * M2 + np.array([b + 1], U) * M3))
    return np.concatenate(out) if out else np.zeros(0, U)


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SIG_BYTES]).tobytes()


def _unpack(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // SIG_BYTES, 8), np.uint8)
    out[:, :SIG_BYTES] = np.frombuffer(x, np.uint8).reshape(-1, SIG_BYTES)
    return out.reshape(-1).view("<u8").astype(U)


def _gaps(sorted_: np.ndarray) -> bytes:
    """Ascending 32-bit numbers: planes of the low, middle and high byte of their gaps, then the gaps' top bytes.

    Top bytes are nearly all zero, and Spark compresses what it shuffles.
    """
    gaps = np.diff(sorted_, prepend=U(0)).astype("<u4")
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_gaps(x: bytes) -> np.ndarray:
    planes = np.frombuffer(x, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(U), dtype=U)


LOW = U((1 << (8 * SIG_BYTES)) - 1)
SHUFFLED = StructType(
    [StructField(n, t) for n, t in (("bucket", IntegerType()), ("a", BinaryType()), ("b", BinaryType()), ("row", LongType()), ("id", LongType()), ("n", LongType()))]
)
SHUFFLED_ARROW = pa.schema([("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("row", pa.int64()), ("id", pa.int64()), ("n", pa.int64())])
FILTER_BITS = 1 << 23
FLUSH = 1 << 19  # signatures that a task holds at most
BLOCK_ROWS = 512  # classes of a group that are compared in one block
WIDE_ROWS = 4096  # the same for components that failed pairs connect
MORE = 8  # so many times the spare pairs of a class in each round


def _emit(buckets: int):
    """Texts -> rows of documents (a: fingerprint, b: sketch) and blobs of signatures (a) with classes (b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        sigs: list = []
        owners: list = []
        held = 0

        def blobs() -> pa.RecordBatch:
            nonlocal held
            s, o = np.concatenate(sigs), np.concatenate(owners)
            sigs.clear(), owners.clear()
            held = 0
            to = ((s >> U(32)) % U(buckets)).astype(np.int64)
            s = s & U(0xFFFFFFFF)  # in its bucket
            order = np.lexsort((s, to))
            s, o, to = s[order], o[order], to[order]
            names, at = np.unique(to, return_index=True)
            at = np.append(at, len(to))
            n, none = len(names), pa.nulls(len(names), pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names.astype(np.int32)),
                    pa.array([_gaps(s[at[i] : at[i + 1]]) for i in range(n)], pa.binary()),
                    pa.array([_pack(o[at[i] : at[i + 1]]) for i in range(n)], pa.binary()),
                    none, none, none,
                ],
                schema=SHUFFLED_ARROW,
            )

        for b in batches:
            marks, sketches, sizes = [], [], []
            for s in shingle_sets(b.column("text")):
                one, two = fingerprint(s)
                marks.append(one.to_bytes(8, "big") + two.to_bytes(8, "big") if len(s) else None)
                sketches.append(_sketch(s).tobytes() if len(s) else None)
                sizes.append(len(s))
                if len(s) and (one, two) not in seen:  # equal sets of a task: once
                    if len(seen) > 1 << 18:
                        seen.clear()
                    seen.add((one, two))
                    own = signatures(s)
                    sigs.append(own)
                    owners.append(np.full(len(own), one, U))
                    held += len(own)
                    if held > FLUSH:
                        yield blobs()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x % buckets for x in range(len(marks))], pa.int32()), pa.array(marks, pa.binary()),
                    pa.array(sketches, pa.binary()), b.column("row"), b.column("id"), pa.array(sizes, pa.int64()),
                ],
                schema=SHUFFLED_ARROW,
            )
        if held:
            yield blobs()

    return run


def _shared(sigs: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch | None:
    """(key, x, pivot) for every class x of a signature that several classes share; pivot: the smallest.

    Signatures of the same classes give one key."""
    s, o = np.concatenate(sigs), np.concatenate(owners)
    order = np.argsort(s)
    s = s[order]
    twice = np.zeros(len(s), bool)
    same = s[1:] == s[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    s, o = s[twice], o[order][twice]
    order = np.lexsort((o, s))
    s, o = s[order], o[order]
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
    s, o = s[fresh], o[fresh]
    if not len(s):
        return None
    at = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    size = np.diff(np.append(at, len(s)))
    # Groups of the same classes are one group: their key is the hash of what they hold.
    content = mix(np.add.reduceat(mix(o + M1), at) + size.astype(U))
    _, first = np.unique(content, return_index=True)
    once = np.zeros(len(at), bool)
    once[first] = True
    kept = np.repeat(once & (size > 1), size)
    pivot = np.repeat(o[at], size)[kept]
    s, o = np.repeat(content, size)[kept], o[kept]
    n = len(s)
    if not n:
        return None
    none = pa.nulls(n, pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n, np.int32)), none, none, pa.array(s.view(np.int64)), pa.array(o.view(np.int64)), pa.array(-1 - pivot.view(np.int64))], schema=SHUFFLED_ARROW
    )


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: documents pass; of a bucket's signatures, those that classes share.

    The latter as rows (row: key, id: class, n: -1 - pivot). One bucket is held at a time.
    """
    now, sigs, owners = None, [], []
    for b in batches:
        docs = np.array(b.column("n").is_valid())
        if docs.any():
            yield b.filter(pa.array(docs))
        rest = b.filter(pa.array(~docs))
        for bucket, a, o in zip(*(rest.column(c).to_pylist() for c in ("bucket", "a", "b")), strict=True):
            if bucket != now:
                if sigs and (found := _shared(sigs, owners)):
                    yield found
                now, sigs, owners = bucket, [], []
            sigs.append(_from_gaps(a))
            owners.append(_unpack(o))
    if sigs and (found := _shared(sigs, owners)):
        yield found


def _slots(ids: pa.Array) -> np.ndarray:
    """The bit of each id in the filter."""
    known = ids.fill_null(0).to_numpy().astype(np.int64).view(U) + np.array(ids.is_null()).astype(U) * M2
    return (mix(known + M1) & U(FILTER_BITS - 1)).astype(np.int64)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = _slots(b.column("id"))
        yield pa.RecordBatch.from_arrays([pa.array((at >> 6).astype(np.int32)), pa.array((U(1) << (at & 63).astype(U)).view(np.int64))], ["word", "bits"])


def _sets(wanted: np.ndarray):
    """node and items (the set) of every text whose id has its bit in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _slots(b.column("id"))
            b = b.filter(pa.array((wanted[at >> 6] >> (at & 63).astype(U)) & U(1) == U(1)))
            out = []
            for s in shingle_sets(b.column("text")):
                if len(s):
                    one, two = fingerprint(s)
                    out.append((one.to_bytes(8, "big") + two.to_bytes(8, "big"), s.astype("<u8").tobytes()))
            if out:
                node, items = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(items, pa.binary())], ["node", "items"])

    return run


def _sets_of(docs: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """node and items of the wanted nodes (node, id); texts that can't be theirs stay where they are.

    A filter of FILTER_BITS bits holds the hashes of the ids; what it lets through by chance is
    dropped by the join, so its size matters for speed alone.
    """
    words = nodes.select("id").mapInArrow(_bits, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    wanted = np.zeros(FILTER_BITS // 64, np.int64)
    wanted[words.column("word").to_numpy()] = words.column("bits").to_numpy()  # FILTER_BITS / 64 rows at most
    found = docs.select("id", "text").mapInArrow(_sets(wanted.view(U)), "node binary, items binary")
    return stage(found.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]), name)


def _sketch(s: np.ndarray) -> np.ndarray:
    """A bit for each value of the low bits of a hash, flipped by every element with that value."""
    bits = SKETCH * max(64, 1 << (len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & U(bits - 1)).astype(np.int64), minlength=bits) % 2 == 1)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that the sketches can't tell apart."""
    for b in batches:
        ok = []
        for x, y, n in zip(b.column("sketch").to_pylist(), b.column("sketch2").to_pylist(), b.column("n").to_pylist(), strict=True):
            x, y = (np.frombuffer(v, np.uint8) for v in (x, y))
            width = min(len(x), len(y))
            x, y = (np.bitwise_xor.reduce(v.reshape(-1, width), 0) for v in (x, y))
            ok.append(9 * int(np.bitwise_count(x ^ y).sum(dtype=np.int64)) <= n)
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        a, o = ([np.frombuffer(v, "<u8") for v in b.column(n).to_pylist()] for n in ("items", "items2"))
        ok = []
        for s, t in zip(a, o, strict=True):
            both = len(s) + len(t) - len(np.union1d(s, t))
            ok.append(100 * both >= 80 * (len(s) + len(t) - both))
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) of nodes that link, checked on the whole sets."""
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("items2"))
    joined = pairs.join(sets.withColumnRenamed("node", "a"), "a").join(right, "b")
    return stage(joined.select("a", "b", "items", "items2").mapInArrow(_verify, "a binary, b binary"), name)


def _labelled(names: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``names`` with the component of each node."""
    found = names.join(components(links), "node", "left")
    return stage(found.withColumn("label", F.coalesce("label", "node")), name)


class _Parts:
    """Components of the labels of a block, by its own pairs."""

    def __init__(self):
        self.up: dict = {}

    def top(self, x):
        while (y := self.up.get(x, x)) != x:
            x = y
        return x

    def join(self, x, y) -> bool:
        x, y = self.top(x), self.top(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _distance(x: bytes, y: bytes) -> int:
    """Of two sketches, the longer one folded to the other's length."""
    if len(x) > len(y):
        x, y = y, x
    n, size = int.from_bytes(x), 8 * len(x)
    other = int.from_bytes(y)
    while other:
        n ^= other & ((1 << size) - 1)
        other >>= size
    return n.bit_count()


def spanning(left: list[bool], right: list[bool], node: list[bytes], n: list[int], label: list[bytes], sketch: list[bytes], failed: list[list[bytes] | None], spare: int = 0) -> list[tuple[bytes, bytes]]:
    """Pairs of a left and a right node that the sketches can't tell apart, no more than join the labels.

    Nearest pairs first for each left node; none of the pairs (node, one of its failed). For each left node
    ``spare`` pairs more, of different labels that the pairs before have joined.
    """
    gone = {(min(x, y), max(x, y)) for x, ys in zip(node, failed, strict=True) for y in ys or ()}
    parts, out = _Parts(), []
    if len(node) <= FEW:  # most groups
        for i in range(len(node)):
            if not left[i]:
                continue
            near = []
            for j in range(len(node)):
                if right[j] and label[i] != label[j] and not (j < i and left[j] and right[i]) and 4 * n[i] <= 5 * n[j] and 4 * n[j] <= 5 * n[i]:
                    apart = _distance(sketch[i], sketch[j])
                    if 9 * apart <= n[i] + n[j]:
                        near.append((apart, j))
            extra = spare
            for _, j in sorted(near):
                pair = (min(node[i], node[j]), max(node[i], node[j]))
                if pair in gone:
                    continue
                if parts.join(label[i], label[j]):
                    out.append(pair)
                elif extra:
                    extra -= 1
                    out.append(pair)
        return out
    names: dict[bytes, int] = {}
    number = np.array([names.setdefault(x, len(names)) for x in label])
    sizes, is_left, is_right, place = np.array(n), np.array(left), np.array(right), np.arange(len(node))
    sketches = [np.frombuffer(x, np.uint8) for x in sketch]
    width = min(map(len, sketches))
    folded = np.array([x if len(x) == width else np.bitwise_xor.reduce(x.reshape(-1, width), 0) for x in sketches])
    tops = number.copy()
    for i in np.flatnonzero(is_left):
        fits = is_right & ((number != number[i]) if spare else (tops != tops[i])) & (5 * sizes >= 4 * sizes[i]) & (4 * sizes <= 5 * sizes[i])
        other = np.flatnonzero(fits & ~(is_left & is_right[i] & (place < i)))
        if not len(other):
            continue
        apart = np.bitwise_count(folded[other] ^ folded[i]).sum(1, dtype=np.int64)
        near = 9 * apart <= sizes[other] + sizes[i]
        found, extra = False, spare
        for j in other[near][np.argsort(apart[near], kind="stable")].tolist():
            pair = (min(node[i], node[j]), max(node[i], node[j]))
            if pair in gone:
                continue
            if parts.join(int(number[i]), int(number[j])):
                out.append(pair)
                found = True
            elif extra:
                extra -= 1
                out.append(pair)
        if found and not spare:
            tops = np.array([parts.top(x) for x in number.tolist()])
    return out


GROUP = ["key", "i", "j"]
TASK_ROWS = [*GROUP, "left", "right", "node", "n", "label", "sketch", "failed"]


def _spans(spare: int):
    """Rows sorted by group -> the pairs of ``spanning``; a partition's equal pairs once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        held: list[tuple] = []

        def pairs() -> list[tuple[bytes, bytes]]:
            left, right, node, n, label, sketch, failed = zip(*(r[3:] for r in held), strict=True)
            found = [p for p in spanning(left, right, node, n, label, sketch, failed, spare) if p not in seen]
            if len(seen) > 1 << 18:
                seen.clear()
            seen.update(found)
            return found

        def out(found: list) -> pa.RecordBatch:
            a, b = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in TASK_ROWS), strict=True):
                if held and held[0][:3] != r[:3]:
                    if found := pairs():
                        yield out(found)
                    held = []
                held.append(r)
        if held and (found := pairs()):
            yield out(found)

    return run


def _open_pairs(members: DataFrame, names: DataFrame, failed: DataFrame, block_rows: int, spare: int = 0) -> DataFrame:
    """Pairs that may join components, of the groups (key, node, label) that lie in several."""
    tasks = in_blocks(members, "node", block_rows)
    wrong = failed.groupBy(F.col("b").alias("node")).agg(F.collect_set("a").alias("failed"))
    features = names.select("node", "n", "sketch").join(wrong, "node", "left")
    rows = tasks.join(features, "node").select(*TASK_ROWS)
    found = rows.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(_spans(spare), "a binary, b binary")
    return stage(found.distinct(), "across")


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents' classes (row, id, n, node, sketch), the groups (key, x, pivot), and the classes in them."""
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    signed = docs.select("row", "id", "text").mapInArrow(_emit(buckets), SHUFFLED)
    gathered = stage(signed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_gather, SHUFFLED), "signatures")
    feats = gathered.filter("n >= 0").select("row", "id", "n", F.col("a").alias("node"), F.col("b").alias("sketch"))
    keyed = gathered.filter("n < 0").select(F.col("row").alias("key"), F.col("id").alias("x"), (-1 - F.col("n")).alias("pivot"))
    groups = stage(keyed.distinct(), "groups")

    # The classes that share a signature with another.
    short = F.conv(F.hex(F.substring("node", 9 - SIG_BYTES, SIG_BYTES)), 16, 10).cast("long")
    classes = feats.filter("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.max("sketch").alias("sketch"))
    names = stage(classes.withColumn("x", short).join(groups.select("x").distinct(), "x", "left_semi"), "classes")
    return feats, groups, names


def link_numbered(docs: DataFrame, block_rows: int = BLOCK_ROWS, wide_rows: int = WIDE_ROWS) -> DataFrame:
    """``docs`` has row (unique or null), id, text; returns row, id, n, node, label of every row."""
    feats, groups, names = _grouped(docs)

    short = names.select("x", "node")
    # First each class with the pivots of its groups.
    one = names.select(F.col("node").alias("a"), "x", "n", "sketch")
    other = names.select(F.col("node").alias("b"), F.col("x").alias("pivot"), F.col("n").alias("n2"), F.col("sketch").alias("sketch2"))
    pairs = groups.filter("x <> pivot").select("x", "pivot").distinct().join(one, "x").join(other, "pivot")
    near = pairs.filter("5 * n >= 4 * n2 and 5 * n2 >= 4 * n").select("a", "b", (F.col("n") + F.col("n2")).alias("n"), "sketch", "sketch2")
    star = stage(_ordered(near.mapInArrow(_close, "a binary, b binary")).distinct(), "star")
    links = _verified(star, _sets_of(docs, _wanted(star, names), "star_sets"), "links")
    labels = _labelled(short, links, "labels")

    # Then the groups that still lie in several components. A task's pairs join what it found alike, so what it
    # left out lies in one component, or its ends lie in components that failed pairs connect.
    failed = star.join(links, ["a", "b"], "left_anti")
    members, spare = groups.join(labels, "x").select("key", "node", "label"), 0
    while not (pairs := _open_pairs(members, names, failed, block_rows if not spare else wide_rows, spare)).isEmpty():
        links = _verified(pairs, _sets_of(docs, _wanted(pairs, names), "open_sets"), "open_links")
        labels = _joined(labels, links)
        wrong = stage(pairs.join(links, ["a", "b"], "left_anti"), "wrong")
        failed = failed.unionByName(wrong)
        members = stage(_connected(wrong, labels), "connected")
        if members.isEmpty():
            break
        spare = MORE * max(1, spare)
    final = labels.select("node", "label")
    return feats.join(final, "node", "left").select("row", "id", "n", "node", F.coalesce("label", "node").alias("label"))


def _label_pairs(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labels (a, b) of the pairs' nodes."""
    one = labels.select(F.col("node").alias("a"), F.col("label").alias("l1"))
    other = labels.select(F.col("node").alias("b"), F.col("label").alias("l2"))
    return pairs.join(one, "a").join(other, "b").select(F.col("l1").alias("a"), F.col("l2").alias("b"))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links: components of the labels that these connect."""
    merged = components(_label_pairs(links, labels)).select(F.col("node").alias("label"), F.col("label").alias("top"))
    return stage(labels.join(merged, "label", "left").select("x", "node", F.coalesce("top", "label").alias("label")), "labels")


def _connected(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The members (key, node, label) of the components that the pairs connect with others."""
    key = components(_label_pairs(pairs, labels)).select(F.col("node").alias("label"), F.col("label").alias("key"))
    return labels.join(key, "label").select("key", "node", "label")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def in_blocks(members: DataFrame, member: str, block: int) -> DataFrame:
    """Members (key, ``member``, label) of the groups in several components, dealt in pairs of blocks (i, j).

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
        "key", member, "label", "lefts", "rights", (F.col("label") != F.col("common")).alias("apart"),
        F.expr(f"int(pmod(xxhash64({member}, 1), lefts))").alias("i0"), F.expr(f"int(pmod(xxhash64({member}, 2), rights))").alias("j0"),
    )
    down = F.expr("transform(sequence(0, lefts - 1), v -> named_struct('i', v, 'j', j0))")
    across = F.expr("transform(sequence(0, rights - 1), v -> named_struct('i', i0, 'j', v))")
    to = F.explode(F.when(F.col("apart"), F.array_distinct(F.concat(down, across))).otherwise(down)).alias("to")
    return dealt.select("key", member, "label", "apart", "i0", "j0", to).select(
        "key", member, "label", "to.i", "to.j", (F.col("apart") & (F.col("i0") == F.col("to.i"))).alias("left"), (F.col("j0") == F.col("to.j")).alias("right")
    )


def _between(t: pa.Table) -> pa.Table:
    """Pairs of nodes of one block, or of one block and another, that the sketches can't tell apart."""
    node, n, part = t.column("node").to_pylist(), t.column("n").to_numpy(), t.column("part").to_numpy()
    lo, hi = t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
    sketches = [np.frombuffer(x, np.uint8) for x in t.column("sketch").to_pylist()]
    width = min(map(len, sketches))
    folded = np.array([np.bitwise_xor.reduce(x.reshape(-1, width), 0) for x in sketches])
    place, out = np.arange(len(node)), []
    for i in np.flatnonzero(part == lo):
        other = np.flatnonzero(((place > i) if lo == hi else (part == hi)) & (5 * n >= 4 * n[i]) & (4 * n <= 5 * n[i]))
        apart = np.bitwise_count(folded[other] ^ folded[i]).sum(1, dtype=np.int64)
        out += [(min(node[i], node[j]), max(node[i], node[j])) for j in other[9 * apart <= n[other] + n[i]].tolist()]
    a, b = zip(*out, strict=True) if out else ((), ())
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def class_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The join itself: a row for every pair of classes (equal sets) that links, each checked on the sets.

    Columns: a, b (fingerprints, a <= b), a_id, b_id (smallest ids), a_rows, b_rows. A class of several
    rows has a row with a = b: its rows link with each other. The pairs of a group are listed in blocks
    of about ``block_rows`` classes, so no task holds a large group; their number is that of the join.
    """
    plain = docs.select(F.lit(None).cast("long").alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    feats, groups, names = _grouped(plain)
    sizes = groups.groupBy("key").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    dealt = groups.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("x", F.lit(1)), F.col("blocks")).cast("int"))
    each = dealt.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = each.select("key", "x", "part", F.least("part", "to").alias("lo"), F.greatest("part", "to").alias("hi"))
    listed = blocks.join(names.select("x", "node", "n", "sketch"), "x")
    found = listed.select("key", "lo", "hi", "part", "node", "n", "sketch").groupBy("key", "lo", "hi")
    near = stage(found.applyInArrow(_between, "a binary, b binary").distinct(), "near")
    pairs = _verified(near, _sets_of(plain, _wanted(near, names), "sets"), "class_links")
    rows = stage(feats.filter("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("rows")), "rows")
    own = rows.filter("rows > 1").select(F.col("node").alias("a"), F.col("node").alias("b"))
    one = rows.select(F.col("node").alias("a"), F.col("id").alias("a_id"), F.col("rows").alias("a_rows"))
    other = rows.select(F.col("node").alias("b"), F.col("id").alias("b_id"), F.col("rows").alias("b_rows"))
    return pairs.unionByName(own).join(one, "a").join(other, "b").select("a", "b", "a_id", "b_id", "a_rows", "b_rows")


def link_counts(links: DataFrame) -> DataFrame:
    """Of ``class_links``: node, id, rows, links (other rows that each row of the class links with).

    A class that links with nothing has no row.
    """
    one = links.select(F.col("a").alias("node"), F.col("a_id").alias("id"), F.col("a_rows").alias("rows"), F.expr("if(a = b, b_rows - 1, b_rows)").alias("k"))
    other = links.filter("a <> b").select(F.col("b").alias("node"), F.col("b_id").alias("id"), F.col("b_rows").alias("rows"), F.col("a_rows").alias("k"))
    return one.unionByName(other).groupBy("node", "id", "rows").agg(F.sum("k").alias("links"))


def _wanted(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """node and id of the nodes of the pairs."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    return nodes.join(names.select("node", "id"), "node")


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id."""
    plain = docs.select(F.lit(None).cast("long").alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    linked = stage(link_numbered(plain), "linked")
    smallest = linked.filter("label is not null").groupBy("label").agg(F.min("id").alias("least"))
    return linked.join(smallest, "label", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without all but one row (the smallest id) of each component."""
    numbered = stage_numbered(
        docs.select(F.struct("*").alias("rec"), F.col(id_col).cast("long").alias("id")),
        "row",
        "documents",
    )
    linked = stage(link_numbered(numbered.select("row", "id", F.col("rec").getField(text_col).alias("text"))), "linked")
    first = F.min(F.struct(F.col("id").isNull(), "id", "row"))
    stays = linked.filter("label is not null").groupBy("label").agg(first.alias("f")).select(F.col("f.row").alias("row"))
    gone = linked.filter("label is not null").join(stays, "row", "left_anti").select("row")
    return numbered.join(gone, "row", "left_anti").select("rec.*")
