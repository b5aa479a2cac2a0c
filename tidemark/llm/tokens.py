"""Words as 64-bit hashes in numpy arrays, inside tasks. No Spark here."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# Characters taken from a batch at a time (a longer text comes alone), bytes hashed at a time.
AT_ONCE, HASHED = 1 << 19, 1 << 21
_ODD = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# An odd number and its inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.array([[int(BASE)], [pow(int(BASE), -1, 1 << 64)]], np.uint64)


_held: dict = {}


def held(key: tuple, make: Callable[[], object]) -> object:
    """An object that a Python worker keeps from task to task: the last one asked for, and no other."""
    if _held.get("key") != key:
        _held.clear()
        _held.update(key=key, value=make())
    return _held["value"]


def release() -> None:
    """Let go of what an earlier operator's tasks have left in this Python worker."""
    _held.clear()


class Powers:
    """Powers of BASE and of its inverse, as far as they were needed."""

    held = np.ones((2, 1), np.uint64)

    @classmethod
    def upto(cls, n: int) -> np.ndarray:
        if cls.held.shape[1] <= n:
            more = np.repeat(_STEPS, max(n, 1 << 16), axis=1)
            more[:, :1] = cls.held[:, -1:] * _STEPS
            cls.held = np.concatenate([cls.held, np.multiply.accumulate(more, axis=1)], axis=1)
        return cls.held


def stretch_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch of bytes, in ascending order of start.

    Differences of a running sum of a polynomial, shifted to power 0: no loop over stretches.
    """
    found, done = np.zeros(len(start), np.uint64), 0
    while done < len(start):
        low = int(start[done])
        upto = max(done + 1, int(np.searchsorted(end, low + HASHED, side="right")))
        a, b = start[done:upto] - low, end[done:upto] - low
        n = int(b.max())
        powers, total = Powers.upto(n), np.zeros(n + 1, np.uint64)
        np.cumsum((data[low : low + n].astype(np.uint64) + np.uint64(1)) * powers[0, :n], out=total[1:])
        found[done:upto] = mixed((total[b] - total[a]) * powers[1, a] + (b - a).astype(np.uint64) * BASE)
        done = upto
    return found


def word_hashes(texts: list[str], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after the other, and where each text's words end.

    Words lie between ASCII white space; `lower` turns A-Z into a-z and nothing else.
    """
    coded = [text.encode("utf-8", "replace") for text in texts]
    whole = b"\n".join(coded) + b"\n"
    data = np.frombuffer(whole.lower() if lower else whole, np.uint8)
    white = (data == 32) | ((data > 8) & (data < 14))
    edges = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edges = np.concatenate([[0], edges])
    start, end = edges[::2], edges[1::2]
    hashes = stretch_hashes(data, start, end)
    return hashes, np.searchsorted(start, np.cumsum([len(c) + 1 for c in coded]))


class HashTable:
    """Places of 64-bit keys other than 0, found for many keys at once by open addressing."""

    def __init__(self, slots: int):
        self.slots, self.n = slots, 0
        self.keys, self.place = np.zeros(slots, np.uint64), np.zeros(slots, np.int32)

    @classmethod
    def of(cls, keys: np.ndarray) -> HashTable:
        made = cls(1 << max(4, (2 * len(keys) - 1).bit_length()))
        made.add(keys)
        return made

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _ODD[0]) >> np.uint64(32)).astype(np.int64) & (self.slots - 1)

    def add(self, keys: np.ndarray) -> None:
        """Distinct new keys get the next places."""
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):  # of several for a free slot the first takes it
            slots, which = np.unique(slot, return_index=True)
            which = which[self.keys[slots] == 0]
            self.keys[slot[which]], self.place[slot[which]] = keys[left[which]], self.n + left[which]
            on = np.ones(len(left), bool)
            on[which] = False
            left, slot = left[on], (slot[on] + 1) & (self.slots - 1)
        self.n += len(keys)

    def in_order(self) -> np.ndarray:
        """All keys by their place."""
        used, keys = np.flatnonzero(self.keys), np.zeros(self.n, np.uint64)
        keys[self.place[used]] = self.keys[used]
        return keys

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 without."""
        found, left, slot = np.full(len(keys), -1, np.int64), np.arange(len(keys)), self._slot(keys)
        while len(left):
            there = self.keys[slot]
            hit = there == keys[left]
            found[left[hit]] = self.place[slot[hit]]
            on = ~hit & (there != 0)
            left, slot = left[on], (slot[on] + 1) & (self.slots - 1)
        return found


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Words between ASCII white space; `lower` turns A-Z into a-z and nothing else."""
    data = (text or "").encode("utf-8", "replace")
    return (data.lower() if lower else data).split()


def bites(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of batches with their texts, NULL as empty, of at most AT_ONCE characters or one row."""
    for batch in batches:
        column = batch.column(text)
        begin, size, texts = 0, 0, []
        for row in range(batch.num_rows):
            value = column[row].as_py() or ""
            if texts and size + len(value) > AT_ONCE:
                yield batch.slice(begin, len(texts)), texts
                begin, size, texts = row, 0, []
            texts.append(value)
            size += len(value)
        if texts:
            yield batch.slice(begin, len(texts)), texts


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` words; one fewer than words for each word more."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        factor = _ODD[k] if k < len(_ODD) else mixed(_ODD[k % 64 : k % 64 + 1] + np.uint64(k))[0] | np.uint64(1)
        total += hashes[k : k + n] * factor
    return mixed(total)


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Hashes of a text's shingles, in order and with repeats: its runs of `width` words, or all of a shorter text."""
    if 0 < len(hashes) < width:
        return grams(hashes, len(hashes)) + np.uint64(len(hashes))
    return grams(hashes, width)
