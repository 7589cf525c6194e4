"""Conversation structure repair: faults, the cheapest edits, and the least audit among them.

Rows of a conversation are taken by turn (nulls first; equal turns by role and text). A row's first fault
counts: blank (nothing but white space), duplicate (role and text seen earlier in the conversation), or
truncated (its last character that is no white space is none of ``.!?``). A row is kept (K, 0), gets
the role user or assistant (R, 3) or is deleted (D, 4: required for blank rows and duplicates); empty user
or assistant rows are inserted anywhere (I, 3). A truncated row that is not deleted adds 3. The cheapest
edits are wanted whose result's role initials match ``(s?(ua)+)?``; of several the ASCII-least audit, the
initials of the edits in order. A row whose role starts with no s, u or a cannot be kept.

A conversation may hold a third of all rows, so none is solved as a whole. All rows are sorted by a range
shuffle and cut into chunks of at most ``CHUNK`` rows of one conversation.
1. Cost. With the four states (nothing yet, after s, after u, after a) a row is a 4 x 4 matrix of
   cheapest edits, and a chunk the min-plus product of its rows, taken by doubling. A stream over the chunks
   of a conversation, backwards, gives each chunk the costs from its end on.
2. Path ranking. With these, the nodes (place, state) of a chunk and the arcs that lie on cheapest ways to
   the end are known. Nodes are ranked by the first 1, 2, 4, ... letters of their least audit: a node's
   rank for twice the length is that of the pair (its rank, the rank of the node so far on). A node's arcs
   go by (letter, rank of their node); the least is its pointer, and pointers are doubled along with
   the ranks. The least audit of each start state is read off the doubled pointers, level by level.
3. A stream over the chunks, forwards, picks the audit of the state in which each chunk begins.

Only the SHA-256 of a whole repaired conversation is sequential: one task streams its rows and holds one
hash state.

Nulls and odd input: null roles and texts count as one space. Null turns come first and have no gap. A
null conv_id is a conversation of its own. Repeated rows are duplicates. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrflow.llm._io import stage

CHUNK = 1024
PLACES = 1 << 17  # that are solved at once
SPACE = r"\x20\x09-\x0D"

#: States: nothing yet, after s, after u, after a. Initials: s, u, a, any other.
NEXT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
#: The state after the one of user and assistant that may follow.
FORCED = np.array([2, 2, 3, 2])
ROLES = {2: "user", 3: "assistant"}
MUST, OPEN = 4, 8  # bits of a code above the initial: has to go; truncated
DELETE, REROLE, INSERT, CUT = 4, 3, 3, 3
#: Costs from a conversation's last place on: a user row still needs its assistant row.
LAST = np.array([0, 2 * INSERT, INSERT, 0])
FAR = 1 << 60
LETTERS = np.frombuffer(b"-DIKR", np.uint8)


class Repair(NamedTuple):
    """report: a row per conversation; turns: the repaired rows, in order of (at, nth)."""

    report: DataFrame
    turns: DataFrame


# Costs


def row_matrices(codes: np.ndarray) -> np.ndarray:
    """rows x 4 x 4: the cheapest edits at a row that lead from one state into another, insertions first."""
    n, states = len(codes), np.arange(4)
    must, late = codes & MUST > 0, np.where(codes & OPEN > 0, CUT, 0)
    out = np.full((n, 4, 4), FAR)
    out[:, states, states] = DELETE
    kept = NEXT[codes & 3]
    for s in range(4):
        at = np.flatnonzero(~must & (kept[:, s] >= 0))
        out[at, s, kept[at, s]] = np.minimum(out[at, s, kept[at, s]], late[at])
        at = np.flatnonzero(~must)
        out[at, s, FORCED[s]] = np.minimum(out[at, s, FORCED[s]], REROLE + late[at])
    once = INSERT + out[:, FORCED]
    twice = 2 * INSERT + out[:, FORCED[FORCED]]
    return np.minimum(np.minimum(out, once), twice)


def _then(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus products."""
    out = np.full_like(a, FAR)
    for k in range(4):
        np.minimum(out, a[:, :, k, None] + b[:, k, None, :], out=out)
    return out


def to_the_end(matrices: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """For each place the product of the rows from it to the end of its chunk (sorted numbers ``chunk``)."""
    out, step = matrices.copy(), 1
    while step < len(out):
        on = np.flatnonzero(chunk[:-step] == chunk[step:])
        if not len(on):
            break
        out[on] = _then(out[on], out[on + step])
        step *= 2
    return out


# Path ranking


def least_audits(codes: list[np.ndarray], ends: np.ndarray) -> list[tuple[list[bytes], list[int]]]:
    """For each chunk and start state the ASCII-least cheapest audit and the state at its end.

    ``ends`` (chunks x 4): costs from the chunk's end on. The last place of a chunk has no arcs: insertions
    there belong to the next chunk's first place, or to ``LAST``.
    """
    sizes = np.array([len(c) + 1 for c in codes])
    first = np.cumsum(sizes) - sizes
    chunk = np.repeat(np.arange(len(codes)), sizes)
    final = np.zeros(len(chunk), bool)
    final[first + sizes - 1] = True
    flat = np.zeros(len(chunk), np.int64)
    flat[~final] = np.concatenate(codes)

    matrices = row_matrices(flat)
    matrices[final] = np.where(np.eye(4, dtype=bool), 0, FAR)
    costs = (to_the_end(matrices, chunk) + ends[chunk][:, None, :]).min(2)  # place x state

    # Arcs by letter (D, I, K, R): their cost to the end and their node; none beside cheapest ways.
    places, states = len(flat), np.arange(4)
    must, late = (flat & MUST > 0)[:, None], np.where(flat & OPEN > 0, CUT, 0)[:, None]
    kept = NEXT[flat & 3]
    here, there = np.arange(places)[:, None], np.minimum(np.arange(places) + 1, places - 1)[:, None]
    node = np.stack([there * 4 + states, here * 4 + FORCED, there * 4 + np.maximum(kept, 0), np.broadcast_to(there * 4 + FORCED, (places, 4))], 2)
    arc = np.stack(
        [np.full((places, 4), DELETE), np.full((places, 4), INSERT), np.where(must | (kept < 0), FAR, late), np.where(must, FAR, REROLE + late) + np.zeros((1, 4), int)], 2
    )
    cheapest = (arc + costs.reshape(-1)[node] == costs[:, :, None]) & ~final[:, None, None]

    def least(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each node the letter (0 at a last place) and node of the arc with the least letter and rank."""
        order = np.where(cheapest, np.arange(1, 5) * (int(rank.max()) + 1) + rank[node], FAR).reshape(-1, 4)
        best = order.argmin(1)
        some = order[np.arange(len(best)), best] < FAR
        return np.where(some, best + 1, 0), np.where(some, node.reshape(-1, 4)[np.arange(len(best)), best], np.arange(places * 4))

    rank = np.zeros(places * 4, np.int64)
    letter, pointer = least(rank)
    rank, levels = letter, [pointer]
    while (letter[pointer] > 0).any():
        _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)
        pointer = pointer[pointer]
        levels.append(pointer)
    letter, chosen = least(rank)
    assert (chosen == levels[0]).all()  # the whole audits' ranks agree with their first letters

    starts = (first[:, None] * 4 + states).reshape(-1)
    path = starts[:, None]
    for pointer in reversed(levels):
        path = np.stack([path, pointer[path]], 2).reshape(len(starts), -1)
    marks = letter[path]
    lengths = (marks > 0).sum(1)
    stop = levels[-1][starts] % 4
    text = LETTERS[marks]
    return [([text[4 * c + s, : lengths[4 * c + s]].tobytes() for s in range(4)], stop[4 * c : 4 * c + 4].tolist()) for c in range(len(codes))]


# Streams over the chunks

CHUNKS = "conv_id long, at long, ats binary, codes binary, costs binary"
CHOSEN = "conv_id long, at long, ats binary, codes binary, audit string, state int, cost long, illegal long"


def _chunks(size: int):
    """(conv_id, at, code) in order of at -> chunks; at is that of the first row, costs the chunk's matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(done: list) -> pa.RecordBatch:
            codes = [np.array([c for _, c in rows], np.uint8) for _, rows in done]
            number = np.repeat(np.arange(len(done)), [len(c) for c in codes])
            costs = to_the_end(row_matrices(np.concatenate(codes).astype(np.int64)), number)
            first = np.searchsorted(number, np.arange(len(done)))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([conv for conv, _ in done], pa.int64()), pa.array([rows[0][0] for _, rows in done], pa.int64()),
                    pa.array([np.array([a for a, _ in rows], np.int64).tobytes() for _, rows in done], pa.binary()),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([costs[i].tobytes() for i in first], pa.binary()),
                ],
                ["conv_id", "at", "ats", "codes", "costs"],
            )

        conv, rows, done, held = None, [], [], 0
        for b in batches:
            for own, at, code in zip(*(b.column(c).to_pylist() for c in ("conv_id", "at", "code")), strict=True):
                if rows and (own != conv or len(rows) >= size):
                    done.append((conv, rows))
                    held += len(rows)
                    rows = []
                    if held > PLACES:
                        yield out(done)
                        done, held = [], 0
                conv = own
                rows.append((at, code))
        if rows:
            done.append((conv, rows))
        if done:
            yield out(done)

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of each conversation from the last one on -> (at, ends): costs from the chunk's end on."""
    now, costs = None, LAST
    for b in batches:
        out = []
        for conv, matrix in zip(b.column("conv").to_pylist(), b.column("costs").to_pylist(), strict=True):
            if conv != now:
                now, costs = conv, LAST
            out.append(costs.astype(np.int64).tobytes())
            costs = (np.frombuffer(matrix, np.int64).reshape(4, 4) + costs).min(1)
        yield pa.RecordBatch.from_arrays([b.column("at"), pa.array(out, pa.binary())], ["at", "ends"])


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with their ends -> audits and stops by start state, and the cost from the chunk on in state 0."""
    for b in batches:
        codes = [np.frombuffer(x, np.uint8).astype(np.int64) for x in b.column("codes").to_pylist()]
        ends = np.array([np.frombuffer(x, np.int64) for x in b.column("ends").to_pylist()]).reshape(-1, 4)
        sizes = np.array([len(c) for c in codes])
        found: list = [None] * len(codes)
        for scale in np.unique(np.ceil(np.log2(sizes + 1))):  # about one size at a time: paths of a round are as long as the longest
            own = np.flatnonzero(np.ceil(np.log2(sizes + 1)) == scale)
            each = max(1, PLACES >> int(scale))
            for i in range(0, len(own), each):
                part = own[i : i + each]
                for c, x in zip(part, least_audits([codes[c] for c in part], ends[part]), strict=True):
                    found[c] = x
        total = [int((np.frombuffer(m, np.int64).reshape(4, 4)[0] + e).min()) for m, e in zip(b.column("costs").to_pylist(), ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                b.column("conv"), b.column("conv_id"), b.column("at"), b.column("ats"), b.column("codes"),
                pa.array([[a.decode() for a in audits] for audits, _ in found], pa.list_(pa.string())),
                pa.array([stop for _, stop in found], pa.list_(pa.int32())), pa.array(total, pa.int64()),
            ],
            ["conv", "conv_id", "at", "ats", "codes", "audits", "stops", "cost"],
        )


SOLVED = "conv string, conv_id long, at long, ats binary, codes binary, audits array<string>, stops array<int>, cost long"


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of each conversation in order -> the audit of each, and its share of the report.

    A conversation's last insertions come as a chunk without rows, as soon as the next one begins.
    """
    names = ["conv_id", "at", "ats", "codes", "audits", "stops", "cost"]
    schema = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("ats", pa.binary()), ("codes", pa.binary()), ("audit", pa.string()), ("state", pa.int32()), ("cost", pa.int64()), ("illegal", pa.int64())])
    now = conv_id = before = None
    state = at = 0

    def tail() -> list[tuple]:
        return [(conv_id, at, b"", b"", "I" * int(LAST[state] // INSERT), state, 0, 0)] if now is not None and LAST[state] else []

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    for b in batches:
        rows: list[tuple] = []
        for conv, own, place, ats, codes, audits, stops, cost in zip(b.column("conv").to_pylist(), *(b.column(n).to_pylist() for n in names), strict=True):
            if conv != now:
                rows += tail()
                now, conv_id, before, state, total = conv, own, None, 0, cost
            else:
                total = 0
            initials = [] if before is None else [before]
            initials += (np.frombuffer(codes, np.uint8) & 3).tolist()
            wrong = sum((x, y) not in {(0, 1), (1, 2), (2, 1)} for x, y in zip(initials, initials[1:], strict=False))
            rows.append((own, place, ats, codes, audits[state], state, total, wrong))
            before, state, at = initials[-1], stops[state], int(np.frombuffer(ats[-8:], np.int64)[0])
        if rows:
            yield out(rows)
    if rows := tail():
        yield out(rows)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chosen audits -> (conv_id, at, nth, role, own): rows of the result; own: with the text of row ``at``.

    Insertions stand before the row of their ``at``, or at a conversation's end behind its last row. A
    kept row has no role here.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("nth", pa.int32()), ("role", pa.string()), ("own", pa.bool_())])
    for b in batches:
        out = []
        for conv, last, ats, codes, audit, state in zip(*(b.column(n).to_pylist() for n in ("conv_id", "at", "ats", "codes", "audit", "state")), strict=True):
            places, row = np.frombuffer(ats, np.int64).tolist(), 0
            nth = 0 if places else 4  # behind the row and the insertions before it
            for edit in audit:
                at = places[row] if places else last
                if edit in "IR":
                    state = int(FORCED[state])
                    out.append((conv, at, nth, ROLES[state], edit == "R"))
                elif edit == "K":
                    state = int(NEXT[codes[row] & 3, state])
                    out.append((conv, at, nth, None, True))
                nth, row = (nth + 1, row) if edit == "I" else (0, row + 1)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows of each conversation in order -> (conv_id, repaired_sha256)."""
    now = conv_id = digest = None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["conv_id", "repaired_sha256"])

    for b in batches:
        done = []
        for conv, own, role, text in zip(*(b.column(n).to_pylist() for n in ("conv", "conv_id", "role", "text")), strict=True):
            if conv != now:
                if digest is not None:
                    done.append((conv_id, digest.hexdigest()))
                now, conv_id, digest = conv, own, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if done:
            yield out(done)
    if digest is not None:
        yield out([(conv_id, digest.hexdigest())])


# The operator


def _name(conv_id: Column) -> Column:
    """A key of a conversation that is never null."""
    return F.coalesce(conv_id.cast("string"), F.lit("-"))


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with planted faults, by crc32(conv_id:turn) % 20; nulls are one space.

    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes it a user's.
    """
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    text, kind = F.coalesce("text", blank), F.col("kind")
    return (
        rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", blank).alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("kind"))
        .filter(kind != 0)
        .select(
            "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def _examined(rows: DataFrame) -> DataFrame:
    """Staged rows with their place ``at`` in the order of all, and their faults but for duplicates."""
    sha = F.sha2(F.concat_ws(":", _name(F.col("conv_id")), F.length("role").cast("string"), "role", "text"), 256)
    typed = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    ordered = typed.orderBy("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return stage(
        ordered.select(
            "*", F.monotonically_increasing_id().alias("at"), (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
            (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("open"), F.unhex(sha).alias("mark"),
        ),
        "turns",
    )


def repair(rows: DataFrame, chunk: int = CHUNK) -> Repair:
    """``rows``: conv_id, turn, role, text.

    report: conv_id, gaps (turns missing between the least and the largest), blank, duplicate, truncated,
    illegal (neighbours whose role initials are not su, ua or au), cost, audit, repaired_sha256 (of the
    repaired rows as role:text, joined by line feeds). turns: conv_id, at, nth, role, text.
    """
    turns = _examined(rows)
    first = turns.groupBy("mark").agg(F.min("at").alias("first"), F.count("*").alias("k")).filter("k > 1").select("mark", "first")
    seen = turns.join(first, "mark", "left").withColumn("again", F.coalesce(F.col("at") > F.col("first"), F.lit(False)))
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    duplicate, cut = ~F.col("blank") & F.col("again"), ~F.col("blank") & ~F.col("again") & F.col("open")
    must = F.when(F.col("blank") | F.col("again"), MUST).otherwise(0)
    light = seen.select(
        "conv_id", "turn", "at", (number + must + F.when(cut, OPEN).otherwise(0)).alias("code"),
        *(x.cast("long").alias(n) for n, x in (("blank", F.col("blank")), ("duplicate", duplicate), ("truncated", cut))),
    )
    light = stage(light, "faults")

    cut_up = light.select("conv_id", "at", "code").repartitionByRange("at").sortWithinPartitions("at").mapInArrow(_chunks(chunk), CHUNKS)
    chunks = stage(cut_up.withColumn("conv", _name(F.col("conv_id"))), "chunks")
    ends = chunks.select("conv", "at", "costs").repartition("conv").sortWithinPartitions("conv", F.desc("at")).mapInArrow(_ends, "at long, ends binary")
    solved = chunks.join(ends, "at").select("conv", "conv_id", "at", "ats", "codes", "costs", "ends").mapInArrow(_solve, SOLVED)
    chosen = stage(solved.repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(_choose, CHOSEN), "audits")

    edits = chosen.select("conv_id", "at", "ats", "codes", "audit", "state").mapInArrow(_edits, "conv_id long, at long, nth int, role string, own boolean")
    texts = turns.select("at", F.col("role").alias("old_role"), F.col("text").alias("old_text"))
    edited = edits.join(texts, "at").select(
        "conv_id", "at", "nth", F.coalesce("role", "old_role").alias("role"), F.when(F.col("own"), F.col("old_text")).otherwise(F.lit("")).alias("text")
    )
    repaired = stage(edited, "repaired")

    in_order = F.array_sort(F.collect_list(F.struct("at", F.length("ats").alias("size"), "audit")))
    # A conversation's last insertions have the place of its last row, and no rows.
    ordered = F.expr("array_sort(parts, (a, b) -> if(a.size = 0, 1, if(b.size = 0, -1, if(a.at < b.at, -1, if(a.at > b.at, 1, 0)))))")
    audits = (
        chosen.groupBy("conv_id").agg(in_order.alias("parts"), F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
        .select("conv_id", "cost", "illegal", F.array_join(F.transform(ordered, lambda p: p["audit"]), "").alias("audit"))
    )
    each = light.groupBy("conv_id", "turn").agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    span = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    counts = each.groupBy("conv_id").agg(span.alias("gaps"), *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    lines = repaired.withColumn("conv", _name(F.col("conv_id"))).repartition("conv").sortWithinPartitions("conv", "at", "nth")
    hashes = lines.select("conv", "conv_id", "role", "text").mapInArrow(_hashes, "conv_id long, repaired_sha256 string")

    def named(df: DataFrame) -> DataFrame:
        return df.withColumn("conv", _name(F.col("conv_id"))).drop("conv_id")

    report = counts.withColumn("conv", _name(F.col("conv_id"))).join(named(audits), "conv").join(named(hashes), "conv", "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )
    return Repair(report, repaired)


def report_all(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The report with a row for every conversation of ``rows``, also for one that has none left."""
    every = rows.select(F.col("conv_id").cast("long")).distinct().withColumn("conv", _name(F.col("conv_id")))
    found = every.join(report.withColumn("conv", _name(F.col("conv_id"))).drop("conv_id"), "conv", "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )
