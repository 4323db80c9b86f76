"""Sets of five-word shingles as sorted 64-bit hashes, for a batch of texts at a time."""

from __future__ import annotations

import numpy as np
import xxhash

from roadpulse.llm.common import words_of

WIDTH = 5
#: Word hashes remembered per worker, then forgotten together, and the longest words among them.
REMEMBERED = 400_000
LONGEST = 64
_known: dict[bytes, int] = {}
_TURN = [np.uint64(pow(0x9E3779B97F4A7C15, k, 2**64)) for k in range(1, WIDTH + 1)]


def _hashes(words: list[bytes]) -> np.ndarray:
    if len(_known) > REMEMBERED:
        _known.clear()
    once = []
    for w in set(words).difference(_known):
        _known[w] = xxhash.xxh3_64_intdigest(w) - 2**63
        if len(w) > LONGEST:
            once.append(w)
    found = np.fromiter(map(_known.__getitem__, words), np.int64, len(words)).view(np.uint64)
    for w in once:
        del _known[w]
    return found


def forget_words() -> None:
    _known.clear()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct shingles of the lower-cased words, sorted; fewer words are one shingle, none are none."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    hashes = _hashes(words)
    width = min(WIDTH, len(words))
    size = len(words) - width + 1
    total = np.full(size, width, np.uint64)
    for k in range(width):
        total += hashes[k : k + size] * _TURN[k]
    return np.unique(_mixed(total))
