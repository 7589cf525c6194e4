"""Token counts by counting each distinct pre-token once.

Texts are cut at white space, where the tokenizer always cuts, into units. A chunk of documents (a
task's texts, up to ``CHUNK_BYTES``) keeps a dictionary of its units and, per document, which units
it holds how often. The dictionaries are dealt by a hash of the unit: equal units of all chunks
meet, and the pieces of each are counted once (the pre-tokens inside a unit are looked up in a
second memo). The counts go back to their chunks, where every document sums frequency times count.
No list of ids is ever made, and a unit that every document holds is one entry per chunk.

Units of printable Latin characters are cut into pre-tokens here; all others, and units with a
special token's string, are left to the tokenizer as a whole.

Nulls and odd input: a null text is empty and has no tokens. Null ids and repeated rows are counted
like any others, each row apart. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrflow.llm._text import SPACE, U, word_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a Spark task has one core

CHUNK_BYTES = 16 << 20
#: Units that one round of vector operations takes.
ROUND_UNITS = 20_000
CHUNK_UNITS = 1_000_000
#: Split by str.split, but not white space to the tokenizer.
SEPARATORS = re.compile("[\x1c-\x1f]")
BLANKS = re.compile(r"[ \t\n\x0b\x0c\r]+")
OVER = 2048

ROWS = "key long, chunk long, kind int, a binary, b binary, c binary, d binary"
NAMES = ["key", "chunk", "kind", "a", "b", "c", "d"]
ASK, DOCS, REPLY = 1, 2, 0  # replies sort before the documents of their chunk


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], NAMES)


class _Numbers(dict):
    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        return n


def units(text: str) -> list[str]:
    if SEPARATORS.search(text):
        return [u for u in BLANKS.split(text) if u]
    return text.split()


class _Chunk:
    def __init__(self):
        self.numbers, self.docs, self.at, self.times, self.sizes, self.bytes = _Numbers(), [], [], [], [], 0

    def add(self, doc, n_bytes: int, text: str) -> None:
        found = units(text)
        numbers = np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found))
        at, times = np.unique(numbers, return_counts=True)
        self.docs.append((doc, n_bytes))
        self.at.append(np.diff(at, prepend=np.int32(0)))
        self.times.append(times.astype(np.uint32))
        self.sizes.append(len(at))
        self.bytes += n_bytes

    def rows(self, chunk: int, buckets: int) -> Iterator[tuple]:
        # Planes of small numbers compress: gaps between the units, and how often each occurs.
        at = np.concatenate(self.at).astype("<u4")
        times = np.concatenate(self.times).astype("<u4")
        planes = [(at & 0xFFFF).astype("<u2"), (at >> 16).astype("<u2"), (times & 0xFF).astype("u1"), (times >> 8).astype("<u4")]
        ids = np.array([d if d is not None else 0 for d, _ in self.docs], "<i8")
        known = np.array([d is not None for d, _ in self.docs], "u1")
        sizes = np.array([n for _, n in self.docs], "<i8")
        head = ids.tobytes() + sizes.tobytes() + np.array(self.sizes, "<i8").tobytes() + known.tobytes()
        yield chunk % buckets, chunk, DOCS, head, planes[0].tobytes() + planes[1].tobytes(), planes[2].tobytes(), planes[3].tobytes()
        names = list(self.numbers)
        if not names:
            return
        to = np.concatenate([_buckets(names[i : i + ROUND_UNITS], buckets) for i in range(0, len(names), ROUND_UNITS)])
        order = np.argsort(to, kind="stable")
        ends = np.cumsum(np.bincount(to, minlength=buckets))
        lo = 0
        for bucket, hi in enumerate(ends.tolist()):
            if hi > lo:
                own = order[lo:hi]
                yield bucket, chunk, ASK, "\n".join([names[i] for i in own.tolist()]).encode(), own.astype("<u4").tobytes(), b"", b""
            lo = hi


def _buckets(names: list[str], buckets: int) -> np.ndarray:
    data = "\n".join(names).encode()
    h, _ = word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]), ~SPACE)
    return ((h >> U(20)) % U(buckets)).astype(np.int64)


def _chunks(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        chunk = _Chunk()
        for b in batches:
            text = b.column("text").fill_null("")
            for doc, size, t in zip(b.column("id").to_pylist(), pc.binary_length(text).to_pylist(), text.to_pylist(), strict=True):
                chunk.add(doc, size, t)
                if chunk.bytes >= CHUNK_BYTES or len(chunk.numbers) >= CHUNK_UNITS:
                    yield _batch(list(chunk.rows((task << 32) + n, buckets)))
                    chunk, n = _Chunk(), n + 1
        if chunk.docs:
            yield _batch(list(chunk.rows((task << 32) + n, buckets)))

    return run


class _Pieces(dict):
    """pre-token -> number of pieces."""

    def __init__(self, model, letters):
        super().__init__()
        self.model, self.letters = model, letters

    def __missing__(self, pre_token: str) -> int:
        shown = pre_token if pre_token.isascii() else pre_token.encode().decode("latin-1").translate(self.letters)
        n = self[pre_token] = len(self.model.tokenize(shown))
        return n


class Counter(dict):
    """unit -> number of pieces."""

    def __init__(self, path: str):
        super().__init__()
        import regex
        from tokenizers import Tokenizer

        from addrflow.llm._tokens import byte_letters

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = _Pieces(self.tokenizer.model, byte_letters())
        # The pre-tokenizer's pattern in the tokenizer file, for lower-cased text (fixed value).
        self.cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall

    def __missing__(self, unit: str) -> int:
        if max(unit) < "ƀ" and unit.isprintable() and "<|" not in unit:
            n = sum(map(self.pieces.__getitem__, self.cut(unit.lower())))
        else:
            n = len(self.tokenizer.encode(unit, add_special_tokens=False).ids)
        self[unit] = n
        return n


def _count(path: str):
    """The units of a partition -> how many pieces each has, per chunk; documents pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for b in batches:
            out = []
            for row in zip(*(b.column(n).to_pylist() for n in NAMES), strict=True):
                if row[2] == DOCS:
                    out.append(row)
                    continue
                counter = counter or Counter(path)
                n = np.fromiter(map(counter.__getitem__, row[3].decode().split("\n")), "<u4")
                out.append((row[0], row[1], REPLY, row[4], (n & 0xFF).astype("u1").tobytes(), (n >> 8).astype("<u4").tobytes(), b""))
            if out:
                yield _batch(out)

    return run


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (chunk, kind): the counts of a chunk, then its documents."""
    now, at, n = None, [], []
    for b in batches:
        for _, chunk, kind, a, p, q, r in zip(*(b.column(x).to_pylist() for x in NAMES), strict=True):
            if chunk != now:
                now, at, n = chunk, [], []
            if kind == REPLY:
                at.append(np.frombuffer(a, "<u4"))
                n.append(np.frombuffer(p, "u1") + np.frombuffer(q, "<u4").astype(np.int64) * 256)
                continue
            docs = len(a) // 25
            ids, sizes, held = (np.frombuffer(a, "<i8", docs, 8 * docs * i) for i in range(3))
            known = np.frombuffer(a, "u1", docs, 24 * docs)
            total = len(p) // 4
            gaps = np.frombuffer(p, "<u2", total) + np.frombuffer(p, "<u2", total, 2 * total).astype(np.int64) * 65536
            times = np.frombuffer(q, "u1") + np.frombuffer(r, "<u4").astype(np.int64) * 256
            tokens = np.zeros(docs, np.int64)
            if total:
                where, value = np.concatenate(at), np.concatenate(n)
                count = np.zeros(len(where), np.int64)
                count[where] = value
                run = np.cumsum(gaps)
                first = np.cumsum(held) - held
                some = held > 0
                run -= np.repeat((run - gaps)[first[some]], held[some])  # gaps restart in each document
                tokens[some] = np.add.reduceat(count[run] * times, first[some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64(), mask=known == 0), pa.array(sizes), pa.array(tokens)], ["id", "n_bytes", "n_tokens"]
            )


def count(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = OVER) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    asked = plain.mapInArrow(_chunks(buckets), ROWS).repartition(buckets, "key")
    replied = asked.mapInArrow(_count(tokenizer_path), ROWS)
    met = replied.repartition(buckets, "chunk").sortWithinPartitions("chunk", "kind")
    return met.mapInArrow(_sum, "id long, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
