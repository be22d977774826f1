"""Hashes of words and of word shingles, for whole batches of texts at once.

A word is a run of characters other than space, tab, newline, vertical tab, form feed
and carriage return. Words and shingles are named by 64-bit hashes; two different
shingles of a pair of texts share one with a probability below 1e-12.
"""

from __future__ import annotations

import numpy as np

from sessionlens.llm.texts import mixed, starts_of

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE_VALUES = mixed(np.arange(256, dtype=np.uint64))
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def utf8(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of `texts`, with a newline behind each, and where each one starts."""
    parts = [text.encode("utf-8", "replace") + b"\n" for text in texts]
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.frombuffer(b"".join(parts), np.uint8), starts_of(lengths)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and the number of words of each text."""
    flat, text_starts = utf8(texts)
    letter = ~_SPACES[flat]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    per_text = np.add.reduceat(first, text_starts[:-1], dtype=np.int64) if texts else first[:0]
    starts, places = np.flatnonzero(first), np.flatnonzero(letter)
    if not len(starts):
        return np.empty(0, np.uint64), per_text
    begins = np.searchsorted(places, starts)
    offset = np.arange(len(places)) - np.repeat(begins, np.diff(np.append(begins, len(places))))
    powers = np.full(int(offset.max()) + 1, _BASE, np.uint64)
    powers[0] = 1
    terms = _BYTE_VALUES[flat[places]] * np.cumprod(powers)[offset]
    return mixed(np.add.reduceat(terms, begins)), per_text


def shingle_sets(texts: list[str], width: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of `width` words.

    A shorter text has one shingle, that of all its words; one without words has none.
    """
    hashes, counts = word_hashes(texts)
    factor = np.uint64(0xD6E8FEB86659FD93)
    rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        rolled = rolled * factor + hashes[k:k + len(rolled)]
    rolled = mixed(rolled)
    sets = []
    starts = starts_of(counts)
    for start, count in zip(starts[:-1].tolist(), counts.tolist()):
        if count >= width:
            sets.append(np.unique(rolled[start:start + count - width + 1]))
        elif count:
            short = np.uint64(count)
            with np.errstate(over="ignore"):
                for word in hashes[start:start + count]:
                    short = short * factor + word
            sets.append(mixed(np.array([short], np.uint64)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
