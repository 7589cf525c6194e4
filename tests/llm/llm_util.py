"""Small tables with odd rows, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, rec string, id string, n_tokens int, label string, chunk string"


def sentence(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}x" for _ in range(n))


def odd_texts(seed: int = 3) -> list[str | None]:
    """Null, empty, white, short, long, equal, nearly equal and overlapping texts."""
    rng = random.Random(seed)
    base = sentence(rng, 120)
    near = base.split(" ")
    near[60] = "Other"
    near2 = base.split(" ")
    near2[10] = "Else"
    passage = sentence(rng, 40)
    long = sentence(rng, 6000, 50_000)
    return [
        None, "", "  \n\t", "a", "one two three four", "One two  three four", "one two three four five",
        base, base, base.upper().lower(), " ".join(near), " ".join(near2), base + " tail",
        sentence(rng, 60) + " " + passage + " " + sentence(rng, 50), passage + "\n" + sentence(rng, 80), passage,
        long, long + " end", "aaaa" * 400, "aaaa" * 500, "é" * 80, "ÀÉ日本語🙂 " * 30, "x<|endoftext|>y  z   q \n k", "don't I'LL 1234 ½ ﬁ ΣΑΣ",
        *[sentence(rng, rng.randrange(1, 200)) for _ in range(20)],
    ]


def odd_docs(spark, seed: int = 3):
    """(rows, DataFrame): odd texts, a null id, a repeated row, clashing extra columns."""
    texts = odd_texts(seed)
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts)]
    rows += [(None, texts[7]), (None, "one two three four"), rows[9], rows[16]]
    full = [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else f"src{k % 3}", None, k % 2, "r", "i", 5, None, "c") for k, (i, t) in enumerate(rows)]
    return rows, spark.createDataFrame(full, DOCS).repartition(4)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text: str | None) -> frozenset:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_classes(rows) -> list[tuple]:
    """(id, n_shingles, component_id) of each row."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                up[top(i)] = top(j)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [(d, len(sets[i]), least.get(top(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def suffix_cut(rows, width: int = 50) -> Counter:
    """(id, n_bytes, n_removed, n_spans, kept) of each row."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    least: dict = {}
    big = 1 << 62
    for d, b in texts:
        for i in range(len(b) - width + 1):
            s = b[i : i + width]
            least[s] = min(least.get(s, big), big if d is None else d)
    out: Counter = Counter()
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if least[b[i : i + width]] < (big if d is None else d):
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out[d, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)] += 1
    return out
