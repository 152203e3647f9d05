"""Hashed word shingles of texts, by batches in numpy."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

#: Words kept by a worker; about 100 MB.
CACHE_WORDS = 400_000
_MIX = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64
)
_SHIFT = np.uint64(29)


class WordHashes(dict):
    """64-bit hashes by word; emptied when full, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str) -> list[bytes]:
    """Words between U+0020 and U+0009 to U+000D, A-Z lower-cased, in UTF-8."""
    # Of bytes, split() and lower() know just these white-space and upper-case characters.
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_sets(texts: list[str], size: int, cache: WordHashes, together: int = 1 << 20) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; the whole sequence if it has fewer words, none without words.

    Texts are taken `together` up to about so many characters, which bounds the words held at a time.
    """
    sets, some, held = [], [], 0
    for text in texts:
        some.append(text)
        held += len(text)
        if held >= together:
            sets += _sets(some, size, cache)
            some, held = [], 0
    return sets + _sets(some, size, cache)


def _sets(texts: list[str], size: int, cache: WordHashes) -> list[np.ndarray]:
    words = list(map(words_of, texts))
    counts = list(map(len, words))
    hashes = np.fromiter(map(cache.__getitem__, chain.from_iterable(words)), np.uint64, sum(counts))
    mixed = np.full(max(0, len(hashes) - size + 1), size, dtype=np.uint64)
    for i in range(size):
        mixed = (mixed ^ hashes[i : i + len(mixed)]) * _MIX[i % len(_MIX)]
        mixed ^= mixed >> _SHIFT
    sets, start = [], 0
    for own, n in zip(words, counts, strict=True):
        if n >= size:
            found = np.sort(mixed[start : start + n - size + 1])
            first = np.empty(len(found), dtype=bool)
            first[0] = True
            np.not_equal(found[1:], found[:-1], out=first[1:])
            sets.append(found[first])
        elif n:
            sets.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(own), seed=n)], dtype=np.uint64))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
        start += n
    return sets
