"""Blockwise suffix sorting with a difference cover, over rows of equal length.

Of any two places there is a distance below PERIOD after which both are in the sample
(their remainders are in COVER). The ranks of all sampled suffixes are worked out
beforehand, by doubling. Suffixes are then sorted one bucket at a time: a few leading
bytes up to the next sampled place, and its rank, decide, however long the tie; no
bucket needs more memory than its own keys.

Rows are laid out so that what can be equal stands at the same place of its row. A
bucket is one place, so its suffixes have one remainder and one distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PERIOD = 7
COVER = (0, 1, 3)
# For each remainder, the distance to the next sampled place.
AHEAD = [min(d for d in range(PERIOD) if (r + d) % PERIOD in COVER) for r in range(PERIOD)]


def _dense(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the different ones."""
    order = np.argsort(keys)
    ordered = keys[order]
    ranks = np.empty(len(keys), np.uint32)
    ranks[order] = np.append(0, np.cumsum(ordered[1:] != ordered[:-1]))[:len(keys)]
    return ranks


class CoverRanks:
    """Ranks, among all rows, of the sampled suffixes at each place, by at least ``depth`` bytes."""

    def __init__(self, rows: np.ndarray, places: int, depth: int):
        width = rows.shape[1]
        self.rows = rows
        wanted = sorted({p + AHEAD[p % PERIOD] for p in range(places)})
        steps = [PERIOD]
        while steps[-1] < depth:
            steps.append(2 * steps[-1])
        # The places whose ranks each doubling needs, from the last one back.
        needs = [set(wanted)]
        for size in reversed(steps[:-1]):
            needs.append(needs[-1] | {p + size for p in needs[-1]})
        needs.reverse()
        ranks = {p: _dense(self._seven(p)) for p in needs[0] if p < width}
        nothing = np.zeros(len(rows), np.uint32)
        for size, after in zip(steps[:-1], needs[1:], strict=True):
            # From the first place on, so that each rank can take the place of the one before.
            for p in sorted(p for p in after if p < width):
                ranks[p] = _dense(ranks[p].astype(np.uint64) << np.uint64(32) | ranks.get(p + size, nothing))
            for p in ranks.keys() - after:
                del ranks[p]
        self.ranks = ranks

    def _seven(self, place: int) -> np.ndarray:
        """The bytes of one period from a place on as a number; beyond the row, zeros."""
        out = np.zeros(len(self.rows), np.uint64)
        for i in range(PERIOD):
            out <<= np.uint64(8)
            if place + i < self.rows.shape[1]:
                out |= self.rows[:, place + i].astype(np.uint64)
        return out

    def keys(self, members: np.ndarray, place: int) -> np.ndarray:
        """What the suffixes at ``place`` of the rows ``members`` are sorted by."""
        ahead = AHEAD[place % PERIOD]
        lead = np.zeros(len(members), np.uint64)
        for i in range(ahead):
            lead = lead << np.uint64(8) | self.rows[members, place + i].astype(np.uint64)
        return lead << np.uint64(32) | self.ranks[place + ahead][members]


def buckets(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, places: int, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per place: the rows with lo <= place < hi in suffix order, and which of them begin a class.

    A class is a run of suffixes whose first ``depth`` bytes are the same.
    """
    ranks = CoverRanks(rows, places, depth)
    for place in range(places):
        members = np.flatnonzero((lo <= place) & (place < hi))
        if not len(members):
            continue
        members = members[np.argsort(ranks.keys(members, place), kind="stable")]
        here = rows[members, place:place + depth]
        begins = np.ones(len(members), bool)
        begins[1:] = (here[1:] != here[:-1]).any(axis=1)
        yield place, members, begins
