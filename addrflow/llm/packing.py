"""Best-fit packing by hierarchical residual rounds.

Texts are tokenised; a document's ids end with an end mark. Only documents longer than a sequence
are cut: into full pieces, the first of which may be shorter. Full pieces are sequences of their
own. The other pieces are dealt to partitions of about ``ITEMS``; each partition packs its pieces
best-fit in decreasing order, emits the bins that are nearly full, and passes its underfull bins on
as items, to a partition that gathers ``FAN`` others. Such rounds go on until one partition is left.
Best-fit leaves at most one bin of a partition half empty or more, and two fuller ones never join;
so of the fuller bins only the ``HOSTS`` emptiest are passed on and the rest are emitted too. A
partition therefore never holds more than ITEMS pieces or FAN * (HOSTS + 1) bins, whatever the input.

Nulls and odd input: a null text is empty and becomes one piece with the end mark alone. Null ids
and repeated rows are packed like any others, each row apart. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrflow.llm._io import stage, stage_numbered
from addrflow.llm._tokens import encoder

SIZE = 1024
END_ID = 2
ITEMS, FAN, HOSTS = 50_000, 8, 2_048
NEARLY = SIZE - 2  # a bin with so many tokens is done

PIECES = "id long, piece int, start long, length long, crc long"
PIECE = np.dtype([("some", "<i1"), ("id", "<i8"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")])


def tokenise(docs: DataFrame, path: str, id_col: str, text_col: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, piece, start, length, crc."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(enc, b: pa.RecordBatch) -> pa.RecordBatch:
        ids, piece, start, length, crc = [], [], [], [], []
        for doc, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
            found = enc.ids(text or "") + end
            n = len(found) // 4
            at = 0
            stop = n % size or size
            k = 0
            while at < n:
                ids.append(doc), piece.append(k), start.append(at), length.append(stop - at)
                crc.append(zlib.crc32(found[4 * at : 4 * stop]))
                at, stop, k = stop, stop + size, k + 1
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
            ["id", "piece", "start", "length", "crc"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        try:
            for b in batches:
                yield cut(enc, b)
        finally:
            enc.forget()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def best_fit(lengths: list[int], size: int = SIZE) -> list[list[int]]:
    """The items of each bin: best-fit in decreasing order, ties in the given order."""
    bins: list[list[int]] = []
    rooms: list[list[int]] = [[] for _ in range(size + 1)]  # bins by the room left
    open_ = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fits = open_ >> n
        if fits:
            room = (fits & -fits).bit_length() - 1 + n
            k = rooms[room].pop()
            if not rooms[room]:
                open_ ^= 1 << room
            bins[k].append(i)
        else:
            k, room = len(bins), size
            bins.append([i])
        rooms[room - n].append(k)
        open_ |= 1 << (room - n)
    return bins


BINS = "done boolean, length int, members binary, node long"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
    types = (pa.bool_(), pa.int32(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["done", "length", "members", "node"])


def _pack(last: bool, size: int):
    """Items (length, members) of a whole partition -> bins; node numbers the next partition."""
    nearly = min(size, NEARLY) if size == SIZE else size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, members, nodes = [], [], []
        for b in batches:
            lengths += b.column("length").to_pylist()
            members += b.column("members").to_pylist()
            nodes += b.column("node").to_pylist()
        if not lengths:
            return
        # A partition may hold several nodes: one at a time.
        for node in sorted(set(nodes)):
            own = [i for i, x in enumerate(nodes) if x == node]
            own.sort(key=lambda i: (lengths[i], members[i]))
            found = []
            for b in best_fit([lengths[i] for i in own], size):
                found.append((sum(lengths[own[i]] for i in b), b"".join(members[own[i]] for i in b)))
            found.sort(key=lambda x: x[0])
            rows, hosts = [], 0
            for n, m in found:
                done = last or n >= nearly or (2 * n > size and hosts >= HOSTS)
                hosts += not done and 2 * n > size
                rows.append((done, n, m, node // FAN))
                if len(rows) >= 20_000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = np.zeros(len(b), PIECE)
        out["some"] = b.column("id").is_valid()
        out["id"] = b.column("id").fill_null(0)
        for n in ("piece", "start", "length", "crc"):
            out[n] = b.column(n)
        rows = [x.tobytes() for x in out]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(b), pa.bool_()), pa.array(out["length"].astype(np.int32)), pa.array(rows, pa.binary()), b.column("node")], ["done", "length", "members", "node"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        blobs = b.column("members").to_pylist()
        if not blobs:
            continue
        per = np.array([len(x) // PIECE.itemsize for x in blobs])
        rows = np.frombuffer(b"".join(blobs), PIECE)
        lengths = rows["length"].astype(np.int64)
        before = np.cumsum(lengths) - lengths
        first = np.cumsum(per) - per
        offset = before - np.repeat(before[first], per)
        seq = np.repeat(b.column("sequence_id").to_numpy(), per)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows["id"], pa.int64(), mask=rows["some"] == 0), pa.array(rows["piece"]), pa.array(rows["start"]), pa.array(lengths),
                pa.array(rows["crc"].astype(np.int64)), pa.array(seq), pa.array(offset),
            ],
            ["id", "piece", "start", "length", "crc", "sequence_id", "offset"],
        )


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, end_id: int = END_ID, items: int = ITEMS) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stage(tokenise(docs, tokenizer_path, id_col, text_col, size, end_id), "pieces")
    short = pieces.filter(F.col("length") < size)
    nodes = max(1, -(-short.count() // items))
    # Dealt by a hash of the piece, so every node sees the same mix of lengths.
    dealt = F.pmod(F.xxhash64("id", "piece", "length", "crc"), F.lit(nodes)).alias("node")
    full = pieces.filter(F.col("length") == size).withColumn("node", F.lit(0).cast("long")).mapInArrow(_members, BINS)
    level = short.select("*", dealt).mapInArrow(_members, BINS)
    done = [full.select("length", "members")]
    while True:
        bins = stage(level.repartition(nodes, "node").mapInArrow(_pack(nodes == 1, size), BINS), "bins")
        done.append(bins.filter("done").select("length", "members"))
        if nodes == 1:
            break
        nodes = -(-nodes // FAN)
        level = bins.filter("not done")
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    placed = stage_numbered(whole, "sequence_id", "sequences").mapInArrow(
        _placed, "id long, piece int, start long, length long, crc long, sequence_id long, offset long"
    )
    return placed.select(F.col("id").alias(id_col), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")
