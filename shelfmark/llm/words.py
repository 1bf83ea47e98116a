"""Words of a batch of texts as arrays: where they are, and a key for each.

Work per word is done on whole arrays. A table from word keys to values lets Python
see a word only when it is new to the worker.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

# Words of more bytes than this are hashed one by one.
SHORT = 64
# New words are worked out in groups of this size, which bounds what that takes.
AT_ONCE = 1 << 13
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))


def word_spans(data: np.ndarray, offsets: np.ndarray, lead: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``, and the number of words before each text (and in all).

    A word is a run of bytes without ASCII white space and lies in one text. With
    ``lead``, a word takes the white space before it along, and white space that
    ends a text is a word.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = SPACE[data]
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    before = np.empty(len(data), bool)
    before[0] = True
    before[1:] = space[:-1]
    if lead:
        starts = np.flatnonzero((space & ~before) | first)
        ends = np.append(starts[1:], len(data))
    else:
        starts = np.flatnonzero(~space & (before | first))
        closing = np.ones(len(data), bool)
        closing[:-1] = space[1:] | first[1:]
        ends = np.flatnonzero(~space & closing) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all others, one to one."""
    h = h ^ (h >> np.uint64(32))
    h *= M3
    h ^= h >> np.uint64(29)
    h *= M2
    h ^= h >> np.uint64(32)
    return h


def keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    eights = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    sizes = ends - starts
    a = sizes.astype(np.uint64) * M1
    b = sizes.astype(np.uint64) * M2
    left, at, rows = sizes, starts, None
    for _ in range(SHORT // 8):
        w = eights[at] & MASKS[np.minimum(left, 8)]
        if rows is None:
            a = mix(a ^ w)
            b = mix(b + w * M1)
        else:
            a[rows] = mix(a[rows] ^ w)
            b[rows] = mix(b[rows] + w * M1)
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        rows = more if rows is None else rows[more]
        left, at = left[more] - 8, at[more] + 8
    for i in np.flatnonzero(sizes > SHORT):
        digest = hashlib.blake2b(data[starts[i]:ends[i]], digest_size=16).digest()
        a[i], b[i] = np.frombuffer(digest, "<u8")
    return a, b


class WordTable:
    """An open-addressed table from pairs of word keys to places, in flat arrays."""

    def __init__(self, bits: int):
        self.mask = np.uint64((1 << bits) - 1)
        self.a = np.zeros(1 << bits, np.uint64)
        self.b = np.zeros(1 << bits, np.uint64)
        self.place = np.full(1 << bits, -1, np.int32)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The place of each pair, -1 where it is not in the table."""
        out = np.full(len(a), -1, np.int32)
        slot = (a & self.mask).astype(np.int64)
        rows = None
        while True:
            there = self.place[slot]
            x, y = (a, b) if rows is None else (a[rows], b[rows])
            used = there >= 0
            same = used & (self.a[slot] == x) & (self.b[slot] == y)
            if rows is None:
                out[same] = there[same]
            else:
                out[rows[same]] = there[same]
            more = np.flatnonzero(used & ~same)
            if not len(more):
                return out
            rows = more if rows is None else rows[more]
            slot = (slot[more] + 1) & int(self.mask)

    def add(self, a: np.ndarray, b: np.ndarray, place: np.ndarray) -> None:
        """Enter pairs that differ from each other and from all in the table."""
        rows = np.arange(len(a))
        slot = (a & self.mask).astype(np.int64)
        while len(rows):
            free = self.place[slot] < 0
            claimed, first = np.unique(slot[free], return_index=True)
            winners = rows[free][first]
            self.a[claimed], self.b[claimed], self.place[claimed] = a[winners], b[winners], place[winners]
            lost = np.ones(len(rows), bool)
            lost[np.flatnonzero(free)[first]] = False
            rows = rows[lost]
            slot = (slot[lost] + 1) & int(self.mask)


class Memory:
    """Values of words, each a run of integers, worked out once while they are remembered.

    When ``limit`` words are held the memory starts afresh, so its size is bounded
    whatever the number of different words.
    """

    def __init__(self, work_out: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], dtype, limit: int = 1 << 19):
        self.work_out, self.dtype, self.limit = work_out, dtype, limit
        self._clear()

    def _clear(self) -> None:
        self.table = WordTable((2 * self.limit - 1).bit_length())
        self.count = 0
        self.ends = np.zeros(1, np.int64)
        self.values = np.zeros(0, self.dtype)

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of all words, one word after the other, and how many each has."""
        a, b = keys(data, starts, ends)
        found = self.table.find(a, b)
        new = np.flatnonzero(found < 0)
        if len(new):
            _, first = np.unique(a[new] ^ (b[new] << np.uint64(1)), return_index=True)
            first = new[first]
            if self.count + len(first) > self.limit and self.count:
                self._clear()
                return self.look_up(data, starts, ends)
            whole = data.tobytes()
            for at in range(0, len(first), AT_ONCE):
                some = first[at:at + AT_ONCE]
                values, sizes = self.work_out([whole[i:j] for i, j in zip(starts[some], ends[some], strict=True)])
                self._enter(a[some], b[some], values, sizes)
            found = self.table.find(a, b)
        sizes = np.diff(self.ends)[found]
        return ragged(self.values, self.ends[found], sizes), sizes

    def _enter(self, a: np.ndarray, b: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> None:
        while 2 * (self.count + len(a)) > len(self.table.place):  # one batch may hold more words than the limit
            old, grown = self.table, WordTable(int(self.table.mask).bit_length() + 1)
            used = np.flatnonzero(old.place >= 0)
            grown.add(old.a[used], old.b[used], old.place[used])
            self.table = grown
        self.table.add(a, b, np.arange(self.count, self.count + len(a), dtype=np.int32))
        self.count += len(a)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.values = np.concatenate([self.values, values.astype(self.dtype)])


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs values[start:start + size], one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return values[:0]
    return values[np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values``; an empty run sums to 0."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
