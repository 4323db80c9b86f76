"""What a worker remembers of the words it has encoded, and the texts it encodes together."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each span, one after another."""
    upto = np.cumsum(size)
    return np.repeat(first - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)


class Words:
    """The words that a worker remembers, at most ``most``: their ids one after another in one array. When it is full, the
    half that was used last stays, but for words of more than ``longest`` signs."""

    def __init__(self, most: int, longest: int):
        self.most, self.longest, self.turn = most, longest, 0
        self.place: dict[bytes | str, int] = {}
        self.ids = np.zeros(0, "<u4")
        # Per word: where its ids are and how many, whether it ends a sentence, when it was used last.
        self.first, self.size, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.stops = np.zeros(0, bool)

    def find(self, words: list[bytes] | list[str]) -> np.ndarray:
        """The number of each word, -1 for those not remembered."""
        self.turn += 1
        found = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        self.used[found[found >= 0]] = self.turn
        return found

    def learn(self, words: list[bytes] | list[str], ids: list[bytes], stops: list[bool] | None = None) -> None:
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start = len(self.place)
        self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.used = np.concatenate([self.used, np.full(len(size), self.turn)])
        self.stops = np.concatenate([self.stops, np.zeros(len(size), bool) if stops is None else np.array(stops, bool)])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4")])
        self.place.update(zip(words, range(start, start + len(words))))

    def shrink(self) -> None:
        """Forgets words once they are too many; numbers change, so this comes when none is held."""
        if len(self.place) <= self.most:
            return
        words = [w if len(w) <= self.longest else None for w in self.place]
        recent = np.argsort(-self.used, kind="stable")[: self.most // 2]
        kept = np.array([k for k in np.sort(recent).tolist() if words[k] is not None], np.int64)
        size = self.size[kept]
        self.ids = self.ids[spans(self.first[kept], size)]
        self.first, self.size, self.used, self.stops = np.cumsum(size) - size, size, self.used[kept], self.stops[kept]
        self.place = {words[k]: n for n, k in enumerate(kept.tolist())}


def blocks(batches: Iterable[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in batches of about ``size`` bytes of ``column``: small ones are put together,
    large ones cut. A longer text is a batch of its own."""
    held, bytes_held = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = upto[start - 1] if start else 0
            end = max(int(np.searchsorted(upto, before + size - bytes_held, "right")), start + (not held))
            if end > start:
                held.append(batch.slice(start, end - start))
                bytes_held += int(upto[end - 1] - before)
            if end < batch.num_rows:
                yield _one(held)
                held, bytes_held = [], 0
            start = end
    if held:
        yield _one(held)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
