"""Words of whole texts, as lists or as arrays of 64-bit hashes.

A word is a run of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z.  On UTF-8 bytes
``bytes.split`` and ``bytes.lower`` do exactly that.  Texts of any length are
handled in pieces cut at white space, so memory depends on the piece only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

PIECE = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def pieces(text: str | None, limit: int = PIECE) -> Iterator[bytes]:
    """UTF-8 of ``text`` in pieces of about ``limit`` bytes that end at white
    space or at the text's end.  A longer word makes a longer piece."""
    data = (text or "").encode("utf-8")
    start = 0
    while len(data) - start > limit:
        cut = start + limit
        while cut < len(data) and data[cut] not in SPACES:
            cut += 1
        yield data[start:cut]
        start = cut
    yield data[start:]


def word_lists(text: str | None, lower: bool = True) -> Iterator[list[bytes]]:
    """Lists of successive words; together all words of ``text``."""
    for p in pieces(text):
        yield (p.lower() if lower else p).split()


def _grow(n: int) -> None:
    global _powers, _inverse
    if len(_powers) < n:
        n = max(n, 2 * len(_powers))
        for name, base in (("_powers", _BASE), ("_inverse", np.uint64(pow(int(_BASE), -1, 1 << 64)))):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            globals()[name] = np.cumprod(p, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of one block of bytes: ``hash``, ``start`` and ``end`` arrays."""

    def __init__(self, data: bytes, hashed: bool = True):
        self.data = np.frombuffer(data, np.uint8)
        space = np.ones(len(data) + 2, np.int8)
        space[1:-1] = _IS_SPACE[self.data]
        edge = np.diff(space)
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        if hashed:
            self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Polynomial hashes by prefix sums: no Python object per word."""
        if not len(self.start):
            return np.empty(0, np.uint64)
        _grow(len(self.data) + 1)
        sums = np.empty(len(self.data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers[:len(self.data)],
                  out=sums[1:])
        h = (sums[self.end] - sums[self.start]) * _inverse[self.start]
        return mix(h ^ (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hashed_blocks(texts: Iterable[str | None], lower: bool = True,
                  limit: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, Words]]:
    """Blocks of about ``limit`` bytes over many texts, short ones together.

    Yields ``(piece_text, word_text, words)``: the text's number of each piece in
    the block (pieces end at ``words.piece_ends``) and of each word.  A long text
    spans several blocks, in order.
    """
    held, owners, size = [], [], 0
    for k, text in enumerate(texts):
        for p in pieces(text, limit):
            if size and size + len(p) > limit:
                yield _block(held, owners, lower)
                held, owners, size = [], [], 0
            held.append(p)
            owners.append(k)
            size += len(p) + 1
    if held:
        yield _block(held, owners, lower)


def _block(held: list[bytes], owners: list[int], lower: bool):
    data = b"\n".join(held)
    words = Words(data.lower() if lower else data)
    words.piece_ends = np.cumsum([len(p) + 1 for p in held])
    owner = np.array(owners)
    return owner, owner[np.searchsorted(words.piece_ends, words.start, side="right")], words
