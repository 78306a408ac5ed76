"""Words of letters and digits for counting and fingerprints, in flat arrays.

A-Z is lower-cased; a word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``:
ASCII digits and letters and everything beyond ASCII.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

MAX_KNOWN_WORDS = 150_000   # remembered words per worker
PIECE_BYTES = 1 << 20       # a long text is taken apart in pieces of about this size

_LOWER = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def _pieces(text: str) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece; pieces end between words."""
    data, at = text.encode("utf-8", "surrogatepass").translate(_LOWER), 0
    while len(data) - at > PIECE_BYTES:
        end = data.find(b" ", at + PIECE_BYTES)
        if end < 0:
            break
        yield data[at:end].split()
        at = end
    yield data[at:].split() if at else data.split()


class _Places(dict):
    """Word -> row of the table; new words queue up."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place


class WordTable:
    """Properties of words, made once per distinct word; a full table starts anew."""

    def __init__(self, make: Callable[[list[bytes]], np.ndarray]):
        self.make = make                     # words -> one row of numbers each
        self.places, self.rows = _Places(), make([])

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of all words of the texts one after the other, and the number of words per text."""
        found, sizes = [self.rows[:0]], []
        for text in texts:
            n = 0
            for words in _pieces(text):
                if len(self.places) > MAX_KNOWN_WORDS:
                    self.places, self.rows = _Places(), self.rows[:0]
                at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
                if self.places.new:
                    self.rows = np.concatenate([self.rows, self.make(self.places.new)])
                    self.places.new = []
                found.append(self.rows[at])
                n += len(words)
            sizes.append(n)
        return np.concatenate(found), np.array(sizes, np.int64)
