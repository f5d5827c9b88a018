"""Word shingles of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from .common import SHINGLE

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Words hashed together in one array.
BLOCK_WORDS = 100_000


class _WordHashes(dict):
    """Hash of a word, computed on first use."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(text: str | None) -> list[bytes]:
    """The words of a text; bytes are split at exactly the six ASCII blanks of the word pattern."""
    return text.encode().split() if text else []


def blocks(texts: list, limit: int = BLOCK_WORDS) -> Iterator[tuple[int, int, list[bytes], np.ndarray]]:
    """(first text, last text + 1, their words in a row, words of each) with at most ``limit`` words, or one text."""
    begin, flat, counts = 0, [], []
    for k, text in enumerate(texts):
        w = split_words(text)
        if counts and len(flat) + len(w) > limit:
            yield begin, k, flat, np.array(counts, dtype=np.int64)
            begin, flat, counts = k, [], []
        flat += w
        counts.append(len(w))
    if counts:
        yield begin, len(texts), flat, np.array(counts, dtype=np.int64)


def shingle_hashes(flat: list[bytes], counts: np.ndarray, cache: dict, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, hash) of every shingle of ``k`` words, repeats included.

    A text of one to ``k - 1`` words has one shingle, its whole word list; a
    text without words has none.
    """
    if not flat:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    word = np.fromiter(map(cache.__getitem__, flat), dtype=np.uint64, count=len(flat))
    doc = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(word))    # words from here to the end of the text
    starts = np.flatnonzero((left >= k) | ((left == counts[doc]) & (counts[doc] < k)))
    value = np.zeros(len(starts), dtype=np.uint64)
    padded = np.concatenate((word, np.zeros(k, dtype=np.uint64)))
    for i in range(k):
        part = np.where(left[starts] > i, padded[starts + i], np.uint64(0))
        value = mix(value * np.uint64(31) + part + _GOLDEN)
    return doc[starts], value


def occurrences(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shingles sorted by (text, hash): (text, hash, number of this occurrence from 0, occurrences in all)."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    n = len(doc)
    if not n:
        return doc, value, doc, doc
    first = np.concatenate(([True], (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])))
    at = np.flatnonzero(first)
    group = np.cumsum(first) - 1
    return doc, value, np.arange(n) - at[group], np.diff(np.concatenate((at, [n])))[group]
