"""Splits of a database read into parts of about equally many rows.

Ranges of equal id span follow the ids, not the rows: a source with old and new ids far apart gives
thousands of empty queries and a few full ones. Here the database counts the window's rows by cell of
the id range (one pushed aggregation, at most ``CELLS`` rows back), cells with too many rows are counted
again in ``FINER`` parts each until none is too large, and the cells are cut into ranges. The rows of
a single id that is too large by itself are divided by their order id.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

CELLS = 4096
FINER = 64
QUERY_RANGES = 256  # ranges that one statement names

#: (width, ranges) -> rows by the first id of each cell of so many ids; ranges are half-open.
Counter = Callable[[int, list[tuple[int, int]]], dict[int, int]]


@dataclass(frozen=True)
class Part:
    """Ids from lo up to hi (None: no bound); with ``ways``, one of so many divisions of a single id's rows."""

    lo: int | None
    hi: int | None
    rows: int
    ways: int = 1
    way: int = 0

    def predicate(self, id_column: str, other: str) -> str:
        kept = [f"{id_column} >= {self.lo}"] if self.lo is not None else []
        kept += [f"{id_column} < {self.hi}"] if self.hi is not None else []
        kept += [f"MOD({other}, {self.ways}) IN ({self.way}, {-self.way})"] if self.ways > 1 else []
        return " AND ".join(kept) or "1 = 1"


def _cells(count: Counter, lo: int, hi: int, rows: int) -> list[tuple[int, int, int]]:
    """(first id, ids, rows) of cells in order, of which only those of one id may exceed ``rows`` / 4."""
    width = 1
    while width * CELLS <= hi - lo:
        width *= 2
    found = [(at, width, n) for at, n in count(width, [(lo, hi + 1)]).items()]
    out = []
    while found:
        large = [c for c in found if c[1] > 1 and 4 * c[2] > rows]
        out += [c for c in found if c[1] == 1 or 4 * c[2] <= rows]
        found = []
        by_width: dict[int, list[tuple[int, int]]] = {}
        for at, w, _ in large:
            by_width.setdefault(w, []).append((at, at + w))
        for w, ranges in by_width.items():
            finer = max(1, w // FINER)
            for i in range(0, len(ranges), QUERY_RANGES):
                found += [(at, finer, n) for at, n in count(finer, ranges[i : i + QUERY_RANGES]).items()]
    return sorted(out)


def equal_parts(count: Counter, lo: int, hi: int, rows_per_part: int) -> list[Part]:
    """Parts of the ids lo..hi that together hold every row once, most with about ``rows_per_part`` rows.

    No part but the last, and those beside a single large id, has under half of the rows of another. The
    first and last parts have no bound, so rows that appear meanwhile are read too.
    """
    cells = _cells(count, lo, hi, rows_per_part)
    total = sum(n for _, _, n in cells)
    if not total:
        return []
    wanted = total / -(-total // rows_per_part)
    parts: list[Part] = []
    start, held = None, 0
    for at, width, n in cells:
        if width == 1 and n > 1.25 * wanted:  # one id: its rows are divided by another column
            if start is None or start < at:
                parts.append(Part(start, at, held))
            ways = -(-n // max(1, int(wanted)))
            parts += [Part(at, at + 1, n // ways, ways, way) for way in range(ways)]
            start, held = at + 1, 0
            continue
        if held and held + n > 1.25 * wanted:
            parts.append(Part(start, at, held))
            start, held = at, 0
        held += n
        if held >= wanted and (at, width, n) != cells[-1]:
            parts.append(Part(start, at + width, held))
            start, held = at + width, 0
    parts.append(Part(start, None, held))
    return parts
