"""Word and shingle hashes inside tasks: ASCII lower case, words between ASCII white space, 64 bits."""

from __future__ import annotations

import re

import numpy as np
import xxhash

#: Words whose hashes a task remembers before it starts afresh.
REMEMBERED = 500_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word (bytes) to 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: bytes) -> np.ndarray:
        """Hashes of the words of ``text``, in order; A-Z counts as a-z."""
        if len(self) > REMEMBERED:
            self.clear()
        words = text.lower().split()  # on bytes: only A-Z, only ASCII white space
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Finalise: every input bit reaches every output bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


#: Bytes of a text that are hashed at a time.
PART = 1 << 20
BLANK = re.compile(rb"[\x09-\x0D ]")
_PLACES, _CODES = 64, 257
#: 0 for white space, else one more than the byte, A-Z as a-z.
CODES = np.array([0 if b in b"\t\n\v\f\r " else 1 + bytes([b]).lower()[0] for b in range(256)], dtype=np.uint16)
LETTERS = mixed(np.arange(_PLACES * _CODES, dtype=np.uint64) * FACTOR)


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of ``text``, in order, without a look at each word: sums over its letters and places."""
    parts, at = [], 0
    while len(text) - at > PART:
        found = BLANK.search(text, at + PART)
        end = found.start() if found else len(text)
        parts.append(_hashes(text[at:end]))
        at = end
    parts.append(_hashes(text[at:] if at else text))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def _hashes(text: bytes) -> np.ndarray:
    codes = CODES[np.frombuffer(text, dtype=np.uint8)]
    inside = np.flatnonzero(codes)
    if not len(inside):
        return np.zeros(0, dtype=np.uint64)
    starts = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
    lengths = np.diff(starts, append=len(inside))
    letters = (np.arange(len(inside)) - np.repeat(starts, lengths)) * _CODES + codes[inside]
    known = lengths.max() <= _PLACES
    return mixed(np.add.reduceat(LETTERS[letters] if known else mixed(letters.astype(np.uint64) * FACTOR), starts))


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order; fewer words are one shingle, none are none."""
    if not len(words):
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    total = np.full(count, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        total = total * FACTOR + words[i : i + count]
    return mixed(total)
