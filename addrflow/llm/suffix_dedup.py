"""Suffix-array dedup of byte strings that documents share.

Every byte that lies in a ``WIDTH``-byte string which also starts in a document with a smaller id is
removed. The suffixes of a corpus cannot be sorted in one place, so its windows are dealt first:

1. The anchor of a window is the smallest hash of its ``GRAM``-byte substrings; equal windows have
   equal anchors. Chunks of documents send the distinct anchors to buckets by hash and learn, as one
   bit each, which occur in more than one document. Windows with another anchor are unique.
2. Runs of windows with the same repeated anchor travel as one string, with their places, to the
   anchor's bucket; equal strings of a chunk travel once. In the bucket, the concatenated strings
   are suffix-sorted in two stages: suffixes smaller than their successors are sorted directly (by
   eight bytes, ties by the next eight, until WIDTH bytes are compared), the others are induced by
   scanning the first-byte buckets in order. Adjacent common prefixes of WIDTH bytes or more make
   classes of equal windows; the smallest id of a class says which places are removed.
3. The removed ranges return to their chunks, where each document is cut.

The chunks' texts are exchanged once; all three steps read that one exchange. A chunk has about
``CHUNK_BYTES`` of text, a bucket the runs of about ``BUCKET_BYTES``.

Nulls and odd input: a null text is empty. A null id counts as larger than any other; ids that are
equal (repeated rows) never remove one another. Texts shorter than WIDTH bytes lose nothing. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrflow.llm._text import M1, M2, U, buffers, rounds

WIDTH, GRAM = 50, 24
REACH = WIDTH - GRAM + 1  # substrings of a window
RUN = 64  # windows of a run at most
CHUNK_BYTES, BUCKET_BYTES = 16 << 20, 2 << 20
LAST = np.iinfo(np.int64).max  # stands for a null id
END = 0xFF  # never a byte of UTF-8
STEPS = (*range(0, WIDTH - 8, 8), WIDTH - 8)  # places of the eight-byte words that cover a window


def _power(n: int) -> np.uint64:
    return U(pow(int(M1), n, 1 << 64))


def _anchors(data: np.ndarray) -> np.ndarray:
    """The anchor of the window at each place."""
    h = data.astype(U) + U(1)
    for n in (1, 2, 4):
        h = h[:-n] * _power(n) + h[n:]
    eight = h
    for n in range(8, GRAM, 8):
        h = h[: len(eight) - n] * _power(8) + eight[n:]
    h = (h ^ (h >> U(32))) * M2
    h ^= h >> U(29)
    n = 1
    while 2 * n <= REACH:
        h = np.minimum(h[:-n], h[n:])
        n *= 2
    return np.minimum(h[: len(h) - (REACH - n)], h[REACH - n :]) if n < REACH else h


def _runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, document, start in data, windows) of the runs, round by round."""
    for i, j in rounds(offsets):
        lo, hi = offsets[i], offsets[j]
        if hi - lo < WIDTH:
            continue
        x = _anchors(data[lo:hi])
        at = offsets[i : j + 1] - lo
        stops = np.maximum(at[:-1], at[1:] - WIDTH + 1)  # behind each document's last window
        mark = np.zeros(hi - lo + 1, np.int32)
        np.add.at(mark, at[:-1], 1)
        np.add.at(mark, stops, -1)
        valid = np.cumsum(mark[: len(x)]) > 0
        fresh = np.ones(len(x), bool)
        fresh[1:] = x[1:] != x[:-1]
        fresh[at[:-1][at[:-1] < len(x)]] = True
        opens = np.flatnonzero(valid & fresh)
        if not len(opens):
            continue
        doc = np.searchsorted(at, opens, "right") - 1
        windows = np.minimum(np.append(opens[1:], len(x)), stops[doc]) - opens
        parts = -(-windows // RUN)
        if parts.max() > 1:
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            opens, doc, windows = np.repeat(opens, parts) + nth * RUN, np.repeat(doc, parts), np.repeat(windows, parts)
            windows = np.minimum(RUN, windows - nth * RUN)
            yield x[opens], doc + i, opens + lo, windows
        else:
            yield x[opens], doc + i, opens + lo, windows


def _texts(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, bytes, offsets) of a chunk in one fixed order, whatever order its rows came in."""
    t = t.sort_by([("id", "ascending"), ("text", "ascending")]).combine_chunks()
    ids = t.column("id").fill_null(LAST).to_numpy()
    text = t.column("text").cast(pa.large_string())
    data, offsets = buffers(text.chunk(0) if text.num_chunks else pa.array([], pa.large_string()))
    return ids, data, offsets


def _distinct(t: pa.Table):
    """The chunk's runs and distinct anchors, dealt: (runs, anchors, bucket order)."""
    ids, data, offsets = _texts(t)
    runs = list(_runs(data, offsets))
    cols = [np.concatenate(c) for c in zip(*runs, strict=True)] if runs else [np.zeros(0, U), *[np.zeros(0, np.int64)] * 3]
    return ids, data, offsets, cols


def _dealt(anchors: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct anchors ordered by bucket, and the end of each bucket."""
    to = ((anchors >> U(32)) % U(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    return order, np.cumsum(np.bincount(to, minlength=buckets))


def _send(buckets: int):
    def run(t: pa.Table) -> pa.Table:
        chunk = t.column("chunk")[0].as_py()
        ids, _, _, (anchor, doc, _, _) = _distinct(t)
        order = np.argsort(anchor, kind="stable")
        anchor, owner = anchor[order], ids[doc[order]]
        first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else np.zeros(0, int)
        # Also sorted by id within an anchor, as documents are: more than one id if ends differ.
        many = np.zeros(len(first), bool)
        if len(first):
            many = np.minimum.reduceat(owner, first) < np.maximum.reduceat(owner, first)
        anchor = anchor[first]
        order, ends = _dealt(anchor, buckets)
        anchor, many = anchor[order].astype("<u8"), many[order]
        lo, out = 0, []
        for b, hi in enumerate(ends.tolist()):
            if hi > lo:
                out.append((b, chunk, anchor[lo:hi].tobytes(), np.packbits(many[lo:hi]).tobytes()))
            lo = hi
        cols = list(zip(*out, strict=True)) or [()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "chunk", "a", "b"])

    return run


def _repeated(t: pa.Table) -> pa.Table:
    """For each chunk's anchors of a bucket, a bit: found in more than one document."""
    held = [np.frombuffer(a, "<u8") for a in t.column("a").to_pylist()]
    own = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(a)) > 0 for a, b in zip(held, t.column("b").to_pylist(), strict=True)]
    _, back, times = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    many = times > 1
    many[back[np.concatenate(own)]] = True
    flags, lo, out = many[back], 0, []
    for a in held:
        out.append(np.packbits(flags[lo : lo + len(a)]).tobytes())
        lo += len(a)
    return pa.table({"chunk": t.column("chunk"), "bucket": t.column("bucket"), "flags": pa.array(out, pa.binary())})


STRINGS = "bucket long, chunk long, strings binary, windows binary, which binary, doc binary, id binary, start binary"


def _strings(buckets: int):
    def run(t: pa.Table, replies: pa.Table) -> pa.Table:
        names = STRINGS.replace(" long", "").replace(" binary", "").split(", ")
        out = []
        if len(t) and len(replies):
            chunk = t.column("chunk")[0].as_py()
            ids, data, offsets, (anchor, doc, start, windows) = _distinct(t)
            every = np.unique(anchor)
            order, ends = _dealt(every, buckets)
            known = np.zeros(len(every), bool)
            for b, flags in zip(replies.column("bucket").to_pylist(), replies.column("flags").to_pylist(), strict=True):
                at = order[(ends[b - 1] if b else 0) : ends[b]]
                known[at] = np.unpackbits(np.frombuffer(flags, np.uint8), count=len(at)) > 0
            kept = known[np.searchsorted(every, anchor)]
            anchor, doc, start, windows = anchor[kept], doc[kept], start[kept], windows[kept]
            order, ends = _dealt(anchor, buckets)
            whole, lo = data.tobytes(), 0
            from_, to = start[order].tolist(), (start + windows + WIDTH - 1)[order].tolist()
            for b, hi in enumerate(ends.tolist()):
                if hi > lo:
                    numbers: dict[bytes, int] = {}
                    which = [numbers.setdefault(whole[x:y], len(numbers)) for x, y in zip(from_[lo:hi], to[lo:hi], strict=True)]
                    own = order[lo:hi]
                    d = doc[own]
                    out.append(
                        (
                            b, chunk, b"".join(numbers), np.array([len(s) - WIDTH + 1 for s in numbers], np.uint8).tobytes(),
                            np.array(which, "<u4").tobytes(), d.astype("<u4").tobytes(), ids[d].astype("<i8").tobytes(),
                            (start[own] - offsets[d]).astype("<i8").tobytes(),
                        )
                    )
                lo = hi
        cols = list(zip(*out, strict=True)) or [()] * 8
        return pa.table([pa.array(c, pa.int64() if i < 2 else pa.binary()) for i, c in enumerate(cols)], names=names)

    return run


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, in the bytes' order."""
    padded = np.concatenate([text, np.full(WIDTH + 16, END, np.uint8)])
    two = (padded[:-1].astype(np.uint16) << 8) | padded[1:]
    four = (two[:-2].astype(np.uint32) << 16) | two[2:]
    return (four[:-4].astype(U) << U(32)) | four[4:]


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether the suffix at each place is smaller than its successor (the last one is not)."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int16) - text[:-1])
    turn = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(turn[::-1])[::-1] if n > 1 else turn
    out = np.zeros(n, bool)
    found = following < n
    out[:-1][found] = step[following[found]] > 0
    return out


def suffix_array(text: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """Places of the suffixes, ordered by WIDTH bytes at least.

    The text ends with END, which never stands next to another one.
    """
    words = _words(text) if words is None else words
    small = _smaller(text)
    # Stage one: the suffixes smaller than their successors, directly.
    s = np.flatnonzero(small)
    s = s[np.argsort(words[s], kind="stable")]
    group = np.zeros(len(s), np.int64)
    key = words[s]
    tied = np.arange(len(s))
    for step in STEPS:
        if step:
            part = s[tied]
            key = words[part + step]
            order = np.lexsort((key, group[tied]))
            s[tied], key = part[order], key[order]
        own = group[tied]  # ascending; a change of group or key opens a new group
        fresh = np.ones(len(tied), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (key[1:] != key[:-1])
        opens = np.flatnonzero(fresh)
        group[tied] = np.repeat(tied[opens], np.diff(np.append(opens, len(tied)))) if len(tied) else 0
        size = np.diff(np.append(opens, len(tied)))
        tied = tied[np.repeat(size > 1, size)]
        if not len(tied):
            break
    # Stage two: the others, by scanning the first-byte buckets in order.
    ends = np.searchsorted(text[s], np.arange(257)) if len(s) else np.zeros(257, int)
    found: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        new = found[c]
        while new:
            now = np.concatenate(new)
            out.append(now)
            before = now[now > 0] - 1
            same = before[(text[before] == c) & ~small[before]]
            new = [same] if len(same) else []
            if new:
                found[c].append(same)
        scanned = np.concatenate([*found[c], s[ends[c] : ends[c + 1]]])
        out.append(s[ends[c] : ends[c + 1]])
        before = scanned[scanned > 0] - 1
        lead = text[before]
        before, lead = before[lead > c], lead[lead > c]
        if not len(lead):
            continue
        order = np.argsort(lead, kind="stable")
        before, lead = before[order], lead[order]
        opens = np.flatnonzero(np.append(True, lead[1:] != lead[:-1]))
        for o, e in zip(opens, [*opens[1:], len(lead)], strict=True):
            found[lead[o]].append(before[o:e])
    return np.concatenate([*out, [len(text) - 1]])  # the last END is followed by ENDs without end


def common_prefixes(words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether each suffix but the first shares WIDTH bytes with the one before it."""
    same = np.ones(max(0, len(order) - 1), bool)
    for step in STEPS:
        key = words[order + step]
        same &= key[1:] == key[:-1]
    return same


def _classes(strings: list[bytes], least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id of each window's class; windows are numbered string by string.

    ``least`` has the smallest id of each string. Also returned: where each string's windows begin.
    """
    sizes = np.array([len(x) for x in strings])
    text = np.frombuffer(bytes([END]).join(strings) + bytes([END]), np.uint8)
    begins = np.cumsum(sizes + 1) - sizes - 1
    windows = sizes - WIDTH + 1
    first = np.cumsum(windows) - windows
    number = np.full(len(text), -1, np.int64)  # of the window that starts at each place
    owner = np.repeat(np.arange(len(strings)), windows)
    number[np.repeat(begins - first, windows) + np.arange(windows.sum())] = np.arange(windows.sum())
    words = _words(text)
    order = suffix_array(text, words)
    order = order[number[order] >= 0]
    label = np.concatenate([[0], np.cumsum(~common_prefixes(words, order))])
    smallest = np.full(label[-1] + 1, LAST)
    np.minimum.at(smallest, label, least[owner[number[order]]])
    out = np.empty(len(order), np.int64)
    out[number[order]] = smallest[label]
    return out, first


RANGES = "chunk long, doc binary, start binary, stop binary"


def _ranges(t: pa.Table) -> pa.Table:
    """Windows of a bucket that also start in a document with a smaller id, as ranges of places."""
    numbers: dict[bytes, int] = {}
    which, doc, ids, start, chunk = [], [], [], [], []
    for row in t.to_pylist():
        windows = np.frombuffer(row["windows"], np.uint8)
        at = np.concatenate([[0], np.cumsum(windows.astype(np.int64) + WIDTH - 1)]).tolist()
        own = np.array([numbers.setdefault(row["strings"][x:y], len(numbers)) for x, y in zip(at, at[1:], strict=False)])
        w = np.frombuffer(row["which"], "<u4")
        which.append(own[w])
        doc.append(np.frombuffer(row["doc"], "<u4"))
        ids.append(np.frombuffer(row["id"], "<i8"))
        start.append(np.frombuffer(row["start"], "<i8"))
        chunk.append(np.full(len(w), row["chunk"]))
    which, doc, ids, start, chunk = (np.concatenate(x) for x in (which, doc, ids, start, chunk))
    strings = list(numbers)
    least = np.full(len(strings), LAST)
    np.minimum.at(least, which, ids)
    smallest, first = _classes(strings, least)
    count = np.array([len(s) - WIDTH + 1 for s in strings])[which]
    # Every window of every place, then ranges of those that go.
    begin = np.cumsum(count) - count
    step = np.arange(count.sum()) - np.repeat(begin, count)
    gone = smallest[np.repeat(first[which], count) + step] < np.repeat(ids, count)
    place = np.repeat(np.arange(len(which)), count)
    edge = np.ones(len(gone), bool)
    edge[1:] = (place[1:] != place[:-1]) | ~gone[:-1]
    opens = np.flatnonzero(gone & edge)
    stop = np.ones(len(gone), bool)
    stop[:-1] = (place[1:] != place[:-1]) | ~gone[1:]
    closes = np.flatnonzero(gone & stop)
    row = place[opens]
    out = []
    for c in np.unique(chunk[row]):
        at = np.flatnonzero(chunk[row] == c)
        r = row[at]
        out.append((c, doc[r].astype("<u4").tobytes(), (start[r] + step[opens[at]]).astype("<i8").tobytes(), (start[r] + step[closes[at]] + WIDTH).astype("<i8").tobytes()))
    cols = list(zip(*out, strict=True)) or [()] * 4
    return pa.table([pa.array(c, pa.int64() if i == 0 else pa.binary()) for i, c in enumerate(cols)], names=["chunk", "doc", "start", "stop"])


def _cut(t: pa.Table, ranges: pa.Table) -> pa.Table:
    """id, n_bytes, n_removed, n_spans, kept (bytes) of each document of a chunk."""
    ids, data, offsets = _texts(t)
    doc, start, stop = (
        np.concatenate([np.frombuffer(x, k) for x in ranges.column(n).to_pylist()] or [np.zeros(0, k)]).astype(np.int64)
        for n, k in (("doc", "<u4"), ("start", "<i8"), ("stop", "<i8"))
    )
    base = offsets[0] if len(offsets) else 0
    size = int(offsets[-1] - base) if len(offsets) else 0
    mark = np.zeros(size + 1, np.int32)
    np.add.at(mark, offsets[doc] - base + start, 1)
    np.add.at(mark, offsets[doc] - base + stop, -1)
    np.cumsum(mark, out=mark)  # a wider sum would be the largest array by far
    gone = mark[:size] > 0
    del mark
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    heads = offsets[:-1][offsets[:-1] < base + size] - base
    opens[heads] = gone[heads]  # spans end with their document
    whole = data[base : base + size]
    out = []
    for i, (x, y) in enumerate(zip((offsets[:-1] - base).tolist(), (offsets[1:] - base).tolist(), strict=True)):
        hit = gone[x:y]
        n = int(hit.sum())
        kept = whole[x:y] if not n else whole[x:y][~hit]
        out.append((int(ids[i]) if ids[i] != LAST else None, y - x, n, int(opens[x:y].sum()), kept.tobytes()))
    cols = list(zip(*out, strict=True)) or [()] * 5
    return pa.table([pa.array(c, pa.int64() if i < 4 else pa.binary()) for i, c in enumerate(cols)], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept (the bytes that stay)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = max(1, -(-size // CHUNK_BYTES)), max(1, -(-size // BUCKET_BYTES))
    dealt = plain.withColumn("chunk", F.pmod(F.xxhash64("id", F.octet_length("text")), F.lit(chunks)))
    by_chunk = dealt.groupBy("chunk")
    sent = by_chunk.applyInArrow(_send(buckets), "bucket long, chunk long, a binary, b binary")
    flags = sent.groupBy("bucket").applyInArrow(_repeated, "chunk long, bucket long, flags binary")
    strings = by_chunk.cogroup(flags.groupBy("chunk")).applyInArrow(_strings(buckets), STRINGS)
    ranges = strings.groupBy("bucket").applyInArrow(_ranges, RANGES)
    out = by_chunk.cogroup(ranges.groupBy("chunk")).applyInArrow(_cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")


def summary(cut_docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that ``cut`` returns, with the SHA-256 of what stays in place of it."""
    return cut_docs.select(id_col, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
