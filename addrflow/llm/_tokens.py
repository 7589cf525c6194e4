"""Token ids of whole texts, with a memo of the space-separated units that recur.

The byte-level pre-tokenizer never joins characters across a space that follows a character other
than white space, nor across the last space of a run that a character other than white space
follows. So unless some space has white space before it and white space or the end behind it, a text
may be cut before each of its spaces and every unit encoded alone. Other texts, and texts that hold
a special token's string, are encoded whole. Units of printable Latin characters are cut into
pre-tokens here, which the memo shares; other units are left to the tokenizer. Units of more than
``MEMO_CHARS`` characters (texts without spaces) are not kept.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a Spark task has one core

WHOLE = re.compile(r" (?=\s|\Z)(?<=\s )")
#: The byte-level pre-tokenizer's pattern (fixed value).
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A word of Latin letters and the marks behind it: two pre-tokens. (No apostrophe, which may open one.)
WORD = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u017F]+)([!-&(-/:-@\[-`{-~]+)").fullmatch
MEMO_UNITS = 500_000  # two generations of so many units at most
MEMO_CHARS = 256
SPACE = "\u0120"  # how byte-level BPE shows a space


class Units(dict):
    """unit -> the little-endian 32-bit ids of ``lead`` + unit, as bytes."""

    def __init__(self, encode, lead: str):
        super().__init__()
        self.encode, self.lead, self.older = encode, lead, {}

    def __missing__(self, unit: str) -> bytes:
        found = self.older.get(unit)
        if found is None:
            found = self.encode(self.lead + unit)
            if len(unit) > MEMO_CHARS:
                return found
        if len(self) >= MEMO_UNITS:
            self.older = dict(self)
            self.clear()
        self[unit] = found
        return found


class Encoder:
    """Encodes as the tokenizer file at ``path`` does, without added special tokens."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.cut = regex.compile(PRE_TOKENS).findall
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.first, self.later = Units(self._unit, ""), Units(self._unit, " ")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _pre_token(self, unit: str) -> bytes:
        body = unit[1:] if unit[0] == " " else unit
        if body.isascii() and body.isalnum():
            shown = unit if body is unit else SPACE + body
        else:
            shown = unit.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()

    def _unit(self, unit: str) -> bytes:
        body = unit[1:] if unit[0] == " " else unit
        if body.isalpha():
            return self._pre_token(unit)  # letters only, behind a space or not
        found = WORD(body)
        if found:
            word, marks = found.groups()
            return (self.first if body is unit else self.later)[word] + self.first[marks]
        if max(unit) < "\u0180" and body.replace("\n", "").isprintable():
            parts = self.cut(unit)
            if len(parts) == 1:
                return self._pre_token(unit)
            return b"".join([self.later[x[1:]] if x[0] == " " and len(x) > 1 else self.first[x] for x in parts])
        return self._whole(unit)

    def forget(self) -> None:
        """Empty the memo: worker processes live on after a task, and other work needs their memory."""
        for memo in (self.first, self.later):
            memo.clear()
            memo.older = {}

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if WHOLE.search(text) or any(s in text for s in self.special):
            return self._whole(text)
        head, *rest = text.split(" ")
        return (self.first[head] if head else b"") + b"".join(map(self.later.__getitem__, rest))


def byte_letters() -> dict[int, int]:
    """Byte-level BPE shows printable Latin-1 bytes as themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in set(shown))}


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file; a task empties its memo when it ends (``forget``)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
