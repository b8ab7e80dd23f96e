"""Whole-text byte-level BPE in bulk: texts -> distinct words -> ids -> texts.

Texts share most of their words, so a task encodes each distinct word once and
keeps the result in a memo.  Most words are found without running the
pattern: a text is cut at single spaces, and a piece with no white space at
either end, together with the space before it, is tokenised alike wherever it
stands (every alternative of the pattern either takes a leading space or stops
at one).  All other stretches go through the pattern.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable


def _shared() -> types.ModuleType:
    """A place that outlives a task, as Python workers are reused."""
    return sys.modules.setdefault("_quarry_llm_memo", types.ModuleType("_quarry_llm_memo"))


def remembered(key, make: Callable):
    """``make()`` once per worker process and key."""
    store = _shared().__dict__.setdefault("store", {})
    if key not in store:
        store[key] = make()
    return store[key]


def newest(slot: str, key, make: Callable):
    """Like :func:`remembered`, but a worker keeps one value a slot: that of the last key asked for."""
    store = _shared().__dict__.setdefault("slots", {})
    if store.get(slot, (None,))[0] != key:
        store.pop(slot, None)
        store[slot] = (key, make())
    return store[slot][1]


def _classes(props: tuple[str, ...]) -> list[str]:
    """Each Unicode property as a plain character class, from the ``regex`` library's tables."""
    import regex
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    out = []
    for p in props:
        spans = [m.span() for m in regex.finditer(f"(?:{p})+", every)]
        at = lambda i: i if i < 0xD800 else i + 0x800  # noqa: E731  the surrogates are not in ``every``
        out.append("".join(f"\\U{at(a):08x}-\\U{at(b - 1):08x}" for a, b in spans))
    return out


def compiled(pattern: str):
    """The pattern for Python's ``re``, with explicit classes; same matches as with ``regex``."""
    letters, numbers, spaces = _classes((r"\p{L}", r"\p{N}", r"\s"))
    body = (pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]").replace(r"\p{L}", f"[{letters}]")
            .replace(r"\p{N}", f"[{numbers}]").replace(r"\S", f"[^{spaces}]").replace(r"\s", f"[{spaces}]"))
    return re.compile(body)


class _Memo(dict):
    """A dict that computes what it lacks and keeps up to ``limit`` results.

    Frequent keys come early, so a full memo keeps what it has; after ``limit``
    more misses it starts anew, as the texts have changed.  No result depends on it.
    """

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self.make, self.limit, self.passed = make, limit, 0

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) < self.limit:
            self[key] = value
        else:
            self.passed += 1
            if self.passed >= self.limit:
                self.clear()
                self.passed = 0
        return value


class _OddSpace(Exception):
    """White space that a piece may not hold."""


class WordEncoder:
    """Whole texts to ids through memos; ``encode_word`` gives the ids of one match of
    the pattern as little-endian bytes, and so does :meth:`encode` for a text."""

    def __init__(self, pattern: str, encode_word: Callable[[str], bytes], limit: int = 1_000_000):
        find = compiled(pattern).findall
        self.encode_word = encode_word
        word = self.word = _Memo(encode_word, limit // 4)
        self.pattern_ids = lambda t: b"".join(map(word.__getitem__, find(t)))
        self.pieces = _Memo(self._piece, limit)
        self.heads = _Memo(lambda p: self._checked(p, ""), 10_000)

    def _checked(self, piece: str, lead: str) -> bytes:
        """A piece with the white space before it; letters are one match, and so is a mark after letters."""
        if piece.isalpha():
            return self.encode_word(lead + piece)
        if piece.split() != [piece]:
            raise _OddSpace
        if lead and piece[-1] in ".,;:!?" and piece[:-1].isalpha():
            return self.pieces[piece[:-1]] + self.word[piece[-1]]
        return self.pattern_ids(lead + piece)

    def _piece(self, piece: str) -> bytes:
        if piece[:1] == "\n":  # the first piece of a line
            return self.word["\n"] + self._checked(piece[1:], "")
        return self._checked(piece, " ")

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        head, *rest = text.replace("\n", " \n").split(" ")
        try:
            return self.heads[head] + b"".join(map(self.pieces.__getitem__, rest))
        except _OddSpace:
            return self.pattern_ids(text)
