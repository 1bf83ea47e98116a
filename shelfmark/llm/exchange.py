"""Which keys occur in more than one place, asked of owners in compressed messages.

A part sends its distinct keys, sorted and Golomb-coded, each to the owner of the
range it falls into, with a bitmap of those that occur twice in the part itself. An
owner answers each message with a bitmap. So a key costs a part a few bytes, however
often it occurs there, and an owner a row per part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from shelfmark.llm.golomb import bitmap, decode, encode, unbitmap
from shelfmark.llm.parts import binary

MESSAGE = "part int, owner int, keys binary, twice binary"
ANSWER = "part int, owner int, marks binary"


def owner_of(keys: np.ndarray, owners: int, bits: int) -> np.ndarray:
    """The owner of each key of ``bits`` bits: equal ranges, in order."""
    return ((keys >> np.uint64(bits - 32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)


def messages(part: int, distinct: np.ndarray, twice: np.ndarray, owners: int, bits: int) -> pa.Table:
    """A part's messages: its sorted distinct keys and which of them occur twice."""
    cuts = np.searchsorted(owner_of(distinct, owners, bits), np.arange(owners + 1))
    here = np.flatnonzero(cuts[:-1] < cuts[1:])
    return pa.table({
        "part": pa.array(np.full(len(here), part, np.int32)), "owner": pa.array(here.astype(np.int32)),
        "keys": binary([encode(distinct[cuts[o]:cuts[o + 1]]) for o in here]),
        "twice": binary([bitmap(twice[cuts[o]:cuts[o + 1]]) for o in here])})


def judge(received: pa.Table) -> pa.Table:
    """For each message, which of its keys occur in another one or twice in its own part."""
    lists = [decode(b) for b in received.column("keys").to_pylist()]
    seen, counts = np.unique(np.concatenate(lists), return_counts=True)
    shared = seen[counts > 1]
    marks = []
    for keys, twice in zip(lists, received.column("twice").to_pylist(), strict=True):
        at = np.searchsorted(shared, keys)
        hit = shared[np.minimum(at, len(shared) - 1)] == keys if len(shared) else np.zeros(len(keys), bool)
        marks.append(bitmap(hit | unbitmap(twice, len(keys))))
    return pa.table({"part": received.column("part"), "owner": received.column("owner"), "marks": binary(marks)})


def marked(distinct: np.ndarray, answers: pa.Table, owners: int, bits: int) -> np.ndarray:
    """Which of a part's sorted distinct keys its answers name."""
    sizes = np.bincount(owner_of(distinct, owners, bits), minlength=owners)
    by_owner = dict(zip(answers.column("owner").to_pylist(), answers.column("marks").to_pylist(), strict=True))
    marks = [unbitmap(by_owner[o], int(sizes[o])) for o in np.flatnonzero(sizes)]
    return np.concatenate(marks) if marks else np.zeros(0, bool)
