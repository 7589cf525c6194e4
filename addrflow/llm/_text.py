"""Vectorised helpers over the UTF-8 bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Odd 64-bit multipliers of the hash functions (fixed values).
M1, M2, M3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
#: Bytes of text that one round of vector operations takes, to stay in the caches.
ROUND_BYTES = 1 << 20


def table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


#: Space, tab, line feed, vertical tab, form feed, carriage return (fixed values).
SPACE = table(b" \t\n\x0b\x0c\r")
#: Bytes of words made of letters: ASCII letters and every byte of a non-ASCII character.
LETTER = table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input changes every bit of the output."""
    x = (x ^ (x >> U(30))) * M2
    x = (x ^ (x >> U(27))) * M3
    return x ^ (x >> U(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def rounds(offsets: np.ndarray, most: int = ROUND_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes, or one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def word_hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, prefixes: tuple[int, ...] = ()):
    """Hashes of the words of consecutive texts, A-Z lower-cased, and word counts per text.

    ``data`` holds the texts' bytes, ``offsets`` their places in it (from 0), ``inside`` says for
    each byte value whether it belongs to a word. For each of ``prefixes`` follow the hashes of the
    words' first so many bytes.
    """
    n_texts = len(offsets) - 1
    is_in = inside[data]
    first = is_in.copy()
    first[1:] &= ~is_in[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = is_in[edges]  # a text's first byte opens a word
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, offsets)).astype(np.int64)
    if not len(starts):
        return np.zeros(0, U), np.zeros(n_texts, np.int64), *[np.zeros(0, U) for _ in prefixes]
    kept = np.flatnonzero(is_in)
    at = np.searchsorted(kept, starts)
    lengths = np.diff(np.append(at, len(kept)))
    place = np.arange(len(kept), dtype=np.int64) - np.repeat(at, lengths)
    x = (LOWER[data[kept]].astype(U) + U(1)) * M1 + place.astype(U) * M2
    x = (x ^ (x >> U(32))) * M3
    x ^= x >> U(29)
    short = [mix(np.add.reduceat(np.where(place < p, x, U(0)), at) + U(p)) for p in prefixes]
    return mix(np.add.reduceat(x, at) + lengths.astype(U) * M1), counts, *short
