"""Runs of repeated words, found on a grammar of each text.

Re-Pair replaces the most frequent pair of neighbouring symbols by a new one until no
pair repeats. A run lies across the boundary of one node of the derivation tree: the
smallest node that holds it. All copies of a nonterminal derive the same words, so the
runs across its boundary are worked out once, at its first copy, and carried to the
others by their positions. What is left of the text, the axiom, is hung under a
balanced tree of its own. A node other than the smallest one gives a part of a run, so
of the intervals of one period only those that lie in no other stay.

The texts of a batch are worked on together, as arrays; the words of different texts are
different symbols. Pairs that do not touch each other are replaced in the same round.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import compress
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.parts import small_batches, spans, texts_of, tidy
from shelfmark.llm.words import mix, ragged

MIN_LENGTH = 12
# Periods looked at together, which bounds the memory a long text takes.
AT_ONCE = 1 << 20
# Two prime moduli below 2**31 and a base for each: stretches of words are compared by 62-bit polynomials.
MODULI = ((2147483647, 1103515245), (2147483629, 1664525021))


def grammar(words: np.ndarray, text: np.ndarray) -> tuple[list[tuple], tuple[np.ndarray, np.ndarray]]:
    """Re-Pair of all texts: the rules and the axiom.

    ``text`` names the text of each word; equal words of different texts are different.
    A rule is (size of its left side, size, positions of its copies, first of them the
    leftmost); a round gives arrays of sizes and the copies of all its rules, cut by
    their number. The axiom is where its symbols begin, and the text of each.
    """
    seq, at = words.astype(np.int64), np.arange(len(words))
    size = np.ones(int(words.max()) + 1 if len(words) else 0, np.int64)
    rounds, done = [], []
    while len(seq) > 1:
        n, symbols = len(seq), len(size)
        often = np.bincount(seq, minlength=symbols)[seq] > 1
        left, right = seq[:-1], seq[1:]
        # A run of one symbol has a pair at every second place.
        equal = left == right
        first = np.maximum.accumulate(np.where(np.append(True, ~equal), np.arange(n), 0))[:-1]
        ok = often[:-1] & often[1:] & (text[at[:-1]] == text[at[1:]]) & ~(equal & ((np.arange(n - 1) - first) % 2 == 1))
        place = np.flatnonzero(ok)
        pair, kind, count = np.unique(left[place] << 32 | right[place], return_inverse=True, return_counts=True)
        rank = np.empty(len(pair), np.int64)
        rank[np.lexsort((-np.arange(len(pair)), count))] = np.arange(len(pair))
        rank[count < 2] = -1
        wins = np.full(n + 1, -1)
        wins[place + 1] = rank[kind]
        ahead, behind = np.append(wins[2:], -1), wins[:-1]
        here = wins[1:][place]
        won = (here >= 0) & (here > behind[place]) & (here > ahead[place])
        again = np.bincount(kind[won], minlength=len(pair)) > 1
        won &= again[kind]
        place, kind = place[won], kind[won]
        # Texts without a repeated pair are finished.
        busy = np.zeros(int(text[-1]) + 1, bool)
        busy[text[at[place]]] = True
        still = busy[text[at]]
        done.append(at[~still])
        if not len(place):
            seq, at = seq[still], at[still]
            break
        new = np.cumsum(again) - 1
        order = np.argsort(kind, kind="stable")
        copies = np.bincount(new[kind], minlength=int(again.sum()))
        lefts, rights = (pair[again] >> 32), pair[again] & 0xFFFFFFFF
        rounds.append((size[lefts], size[lefts] + size[rights], at[place[order]], copies))
        seq = seq.copy()
        seq[place] = symbols + new[kind]
        size = np.concatenate([size, size[lefts] + size[rights]])
        still[place + 1] = False
        seq, at = seq[still], at[still]
        # Symbols are numbered anew, so that counting them costs what is left.
        used, seq = np.unique(seq, return_inverse=True)
        size = size[used]
    axiom = np.sort(np.concatenate([*done, at]))
    return rounds, (axiom, text[axiom])


class Stretches:
    """How far the words from two places on, or before them, are the same."""

    def __init__(self, words: np.ndarray):
        self.sums, self.powers = [], []
        for prime, base in MODULI:
            powers = np.ones(1, np.int64)
            while len(powers) <= len(words):
                powers = np.concatenate([powers, powers * pow(base, len(powers), prime) % prime])
            terms = (words + 1) * powers[:len(words)] % prime
            self.sums.append(np.append(0, np.cumsum(terms) % prime))
            self.powers.append(powers)

    def _same(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for (prime, _), sums, powers in zip(MODULI, self.sums, self.powers, strict=True):
            out &= ((sums[x + n] - sums[x]) % prime * powers[y - x] - (sums[y + n] - sums[y])) % prime == 0
        return out

    def _most(self, limit: np.ndarray, same) -> np.ndarray:
        low, high = np.zeros(len(limit), np.int64), limit.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_] + 1) // 2
            yes = same(open_, middle)
            low[open_[yes]] = middle[yes]
            high[open_[~yes]] = middle[~yes] - 1

    def after(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Words from x and from y (x < y) on that are the same, ``limit`` at most."""
        return self._most(limit, lambda i, n: self._same(x[i], y[i], n))

    def before(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Words up to x and up to y that are the same, ``limit`` at most."""
        return self._most(limit, lambda i, n: self._same(x[i] - n, y[i] - n, n))


def crossing(threes: np.ndarray, stretches: Stretches, lo: np.ndarray, cut: np.ndarray, hi: np.ndarray) -> tuple:
    """Runs of the words [lo, hi) that touch both sides of ``cut``: node, start, end, period.

    A run with period p is p words shorter a stretch in which each word is the one p
    before; of MIN_LENGTH words and two periods at least, the stretch has
    MIN_LENGTH / 2 words or more. It meets either ``cut`` or ``cut + p``, with three
    words before or behind, whose hashes are compared first.
    """
    found: list[list[np.ndarray]] = [[], [], [], []]
    for ahead in (False, True):
        most = np.minimum(hi - cut if ahead else cut - lo, (hi - lo) // 2)
        ends = np.cumsum(most)
        for base in range(0, int(ends[-1]) if len(ends) else 0, AT_ONCE):
            index = np.arange(base, min(base + AT_ONCE, int(ends[-1])))
            node = np.searchsorted(ends, index, side="right")
            p = index - (ends[node] - most[node]) + 1
            y = cut[node] + p if ahead else cut[node]
            x = y - p
            behind, front = threes[np.minimum(y, len(threes) - 1)], threes[x]
            like = (front == behind) & (y + 3 <= hi[node])
            back = np.maximum(x - 3, 0)
            like |= (threes[back] == threes[back + p]) & (x - 3 >= lo[node])
            i = np.flatnonzero(like)
            node, p, x, y = node[i], p[i], x[i], y[i]
            right = stretches.after(x, y, hi[node] - y)
            left = stretches.before(x, y, x - lo[node])
            start, end = x - left, y + right
            good = end - start >= np.maximum(MIN_LENGTH, 2 * p)
            for out, values in zip(found, (node, start, end, p), strict=True):
                out.append(values[good])
    return tuple(np.concatenate(v) if v else np.zeros(0, np.int64) for v in found)


def _primitive(*columns: np.ndarray) -> np.ndarray:
    """Of rows equal in all columns but the last, the period, the row with the least."""
    order = np.lexsort(columns[::-1])
    differs = np.zeros(len(order), bool)
    for c in columns[:-1]:
        differs[1:] |= c[order][1:] != c[order][:-1]
    differs[:1] = True
    return order[differs]


def _tree(axiom: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nodes of balanced trees over the symbols of each text: begin, cut and end as places of words."""
    at = np.append(axiom, size)
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.zeros(0, np.int64)
    i, j = first, np.append(first[1:], len(axiom))
    nodes: list[tuple] = []
    while True:
        some = (j - i > 1) & (at[j] - at[i] >= MIN_LENGTH)
        i, j = i[some], j[some]
        if not len(i):
            break
        m = (i + j) // 2
        nodes.append((at[i], at[m], at[j]))
        i, j = np.concatenate([i, m]), np.concatenate([m, j])
    return tuple(np.concatenate(v) for v in zip(*nodes, strict=True)) if nodes else (np.zeros(0, np.int64),) * 3


def runs(words: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of all texts (starts, ends and periods, as places of words), by start, then period."""
    if len(words) < MIN_LENGTH:
        return (np.zeros(0, np.int64),) * 3
    rules, (axiom, of) = grammar(words, text)
    stretches = Stretches(words)
    coded = mix(words.astype(np.uint64) + np.uint64(1))
    threes = coded.copy()
    threes[:-1] = mix(threes[:-1] + coded[1:] * np.uint64(3))
    threes[:-2] = mix(threes[:-2] + coded[2:] * np.uint64(5))
    _, start, end, period = crossing(threes, stretches, *_tree(axiom, of, len(words)))
    parts = [(start, end, period)]
    for left, size, copies, count in rules:
        begins = np.append(0, np.cumsum(count))
        long = np.flatnonzero(size >= MIN_LENGTH)
        if not len(long):
            continue
        lo = copies[begins[long]]
        node, start, end, period = crossing(threes, stretches, lo, lo + left[long], lo + size[long])
        one = _primitive(node, start, end, period)
        node, start, end, period = (v[one] for v in (node, start, end, period))
        number = count[long[node]]
        moved = ragged(copies, begins[long[node]], number) - np.repeat(lo[node], number)
        parts.append((np.repeat(start, number) + moved, np.repeat(end, number) + moved, np.repeat(period, number)))
    start, end, period = (np.concatenate(v) for v in zip(*parts, strict=True))
    # Per period, what lies in no other interval.
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    reach = np.maximum.accumulate(period * (len(words) + 1) + end)
    whole = np.append(True, period[1:] * (len(words) + 1) + end[1:] > reach[:-1]) if len(end) else np.zeros(0, bool)
    start, end, period = start[whole], end[whole], period[whole]
    one = _primitive(start, end, period)
    start, end, period = start[one], end[one], period[one]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def repeat_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a text, its tail made periodic for a tenth of the ids (a stated rule of the query)."""
    if doc_id is None or not words:
        return words
    h = crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


RESULT = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
    "spans array<struct<start:long,length:long,period:long>>, collapsed string")


def _spans_of(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of lists of words, and the place of each list's first word."""
    number: list[int] = []
    base = 0
    for words in lists:
        own: dict[bytes, int] = {}
        number.extend([own.setdefault(w, base + len(own)) for w in words])
        base += len(own)
    sizes = np.array([len(w) for w in lists], np.int64)
    text = np.repeat(np.arange(len(lists)), sizes)
    return *runs(np.array(number, np.int64), text), np.append(0, np.cumsum(sizes))


def _result(words: list[bytes], start: np.ndarray, end: np.ndarray, period: np.ndarray, whole: bool) -> dict:
    length = end - start
    named = "".join(f"{s},{n},{q}\n" for s, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
    kept = words
    best: tuple = (None, None, None, None)
    if len(start):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, start + period, 1)
        np.add.at(edge, end, -1)
        kept = list(compress(words, (np.cumsum(edge)[:-1] == 0).tolist()))
        i = np.lexsort((period, start, -length))[0]
        best = (int(start[i]), int(length[i]), int(period[i]), int(1000 * length[i] // period[i]))
    text = b" ".join(kept)
    out = dict(zip(("start", "length", "period", "exponent_milli"), best, strict=True), n_runs=len(start),
               runs_sha256=sha256(named.encode()).hexdigest(), collapsed_sha256=sha256(text).hexdigest())
    if whole:
        out["spans"] = [dict(start=int(s), length=int(n), period=int(q)) for s, n, q in zip(start, length, period, strict=True)]
        out["collapsed"] = text.decode()
    return out


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", texts: str = "text", whole: bool = True,
                  edit=None) -> DataFrame:
    """One row per row of ``docs``: doc_id, what its runs are, and with ``whole`` all of them and the text without repeats.

    Words are runs of bytes without ASCII white space, numbered from 0. A run is a
    stretch of words with least period q, of at least MIN_LENGTH words and 2 q, that no
    neighbouring word continues; ``start``, ``length``, ``period`` and
    ``exponent_milli`` tell of the longest (of several the first, then the one of least
    period), and are null without any. ``collapsed`` keeps of each run its first q
    words. ``edit`` changes the list of words of a text, given its doc_id, before.

    Null and empty texts have no word and no run; texts of any length are worked on
    whole; repeated rows and rows without doc_id have results of their own; other
    columns are not read. An empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    kind = docs.select(F.col(f"`{doc_id}`")).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, " + (RESULT if whole else RESULT.partition(", spans")[0])
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{texts}`").alias("text"))
    names = [c.split()[0] for c in RESULT.split(", ")][:9 if whole else 7]

    def find(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            text = texts_of(batch.column("text")).cast(pa.binary())
            for i, j in spans(text):
                lists = [t.split() for t in text.slice(i, j - i).to_pylist()]
                if edit is not None:
                    lists = [edit(w, d) for w, d in zip(lists, ids.slice(i, j - i).to_pylist(), strict=True)]
                start, end, period, first = _spans_of(lists)
                cuts = np.searchsorted(start, first)
                out = [
                    _result(w, start[a:b] - at, end[a:b] - at, period[a:b], whole)
                    for w, a, b, at in zip(lists, cuts[:-1], cuts[1:], first[:-1], strict=True)]
                columns = [pa.array([r[n] for r in out], _ARROW[n]) for n in names]
                yield pa.record_batch([ids.slice(i, j - i), *columns], ["doc_id", *names])

    return rows.mapInArrow(tidy(find), schema)


_ARROW = {n: pa.int64() for n in ("n_runs", "start", "length", "period", "exponent_milli")} | {
    n: pa.string() for n in ("runs_sha256", "collapsed_sha256", "collapsed")} | {
    "spans": pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))}
