"""Words and hashes of texts, in numpy, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import xxhash

MIX = np.uint64(0x9E3779B97F4A7C15)
A, B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
S30, S27, S31 = np.uint64(30), np.uint64(27), np.uint64(31)
CHARS = 1_000_000  # of texts handled at once in a task; a longer text goes alone
KNOWN = 100_000  # words whose hash a task remembers


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> S30)) * A
    x = (x ^ (x >> S27)) * B
    return x ^ (x >> S31)


def seed(i: int) -> np.uint64:
    """The i-th of a row of unlike 64-bit numbers."""
    return np.uint64(int(i) * int(MIX) % 2**64)


def slices(texts: list[str | None]) -> Iterator[slice]:
    """Consecutive slices of about CHARS characters."""
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text or "") > CHARS:
            yield slice(start, i)
            start, total = i, 0
        total += len(text or "")
    if start < len(texts):
        yield slice(start, len(texts))


def words(text: str | None) -> list[bytes]:
    """The words [^\\x20\\x09-\\x0D]+ of a text, with A-Z in lower case, in UTF-8."""
    return (text or "").encode("utf-8", "replace").lower().split()


class WordHashes(dict):
    """64-bit hashes by word; forgets all when it holds KNOWN words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in a row, and the number of words of each document."""
        counts = np.fromiter(map(len, docs), np.int64, len(docs))
        return np.fromiter(map(self.__getitem__, chain.from_iterable(docs)), np.uint64, int(counts.sum())), counts


def shingle_sets(hashes: np.ndarray, counts: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each document's k-word shingles; the whole sequence is one if it has fewer words."""
    n = len(hashes)
    rolled = hashes * MIX
    for i in range(1, k):
        rolled[: n - i] = mix(rolled[: n - i] + hashes[i:])
    out, at = [], 0
    for c in counts.tolist():
        if c >= k:
            out.append(np.unique(rolled[at : at + c - k + 1]))
        elif c:
            h = np.uint64(c)
            with np.errstate(over="ignore"):
                for w in hashes[at : at + c]:
                    h = mix(np.array([h * MIX + w]))[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        at += c
    return out
