"""Runs of repeated words against their definition, tried period by period."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from plain import TEXTS, no_docs, odd_docs  # noqa: F401

from shelfmark.llm.periodic import periodic_runs, repeat_tail, runs
from shelfmark.llm.queries import QUERIES


def plain_runs(words):
    """(start, length, period) of every run, by start and period; for each period, stretches of equal words that far apart."""
    least = {}
    for q in range(1, len(words) // 2 + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                least.setdefault((i - q, j), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in least.items())


def plain_result(words):
    found = plain_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    named = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(found), *top, sha256(named.encode()).hexdigest(), sha256(kept).hexdigest())


def plain_tail(words, doc_id):
    h = crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def word_lists(rng):
    for _ in range(60):
        kinds, n = rng.choice([1, 2, 3, 5, 50]), rng.randrange(0, 130)
        words = [rng.randrange(kinds) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randrange(2, 9)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        yield words
    fib, other = [0], [0, 1]
    while len(other) < 150:
        fib, other = other, other + fib
    yield other
    yield [0] * 300
    yield ([1] * 5 + [2]) * 20
    yield list(range(40)) * 2


@pytest.mark.parametrize("seed", range(8))
def test_runs_of_many_texts_at_once(seed):
    rng = random.Random(seed)
    lists = list(word_lists(rng))
    rng.shuffle(lists)
    number, base = [], 0
    for words in lists:
        number += [base + w for w in words]
        base += max(words, default=0) + 1
    first = np.append(0, np.cumsum([len(w) for w in lists]))
    start, end, period = runs(np.array(number, np.int64), np.repeat(np.arange(len(lists)), np.diff(first)))
    for k, words in enumerate(lists):
        own = (start >= first[k]) & (start < first[k + 1])
        got = zip(start[own] - first[k], (end - start)[own], period[own], strict=True)
        assert [tuple(map(int, r)) for r in got] == plain_runs(words)


COLUMNS = "n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def test_odd_rows(odd_docs, no_docs):
    got = sorted((tuple(r[c] for c in COLUMNS) for r in periodic_runs(odd_docs).collect()), key=repr)
    wanted = [plain_result((r.text or "").encode().split()) for r in odd_docs.select("text").collect()
              if len(r.text or "") < 60_000 or " " not in r.text]
    assert set(wanted) <= set(got) and len(got) == len(TEXTS) + 2
    assert periodic_runs(no_docs).count() == 0


def test_spans_and_text(spark):
    docs = spark.createDataFrame([(1, "x " + "a b " * 10 + "y"), (2, "a\x85b\tc")], "doc_id long, text string")
    one, two = periodic_runs(docs).orderBy("doc_id").collect()
    assert [tuple(s) for s in one.spans] == [(1, 20, 2)] and one.collapsed == "x a b y"
    assert two.spans == [] and two.collapsed == "a\x85b c" and two.start is None


def test_long_texts(spark):
    docs = spark.createDataFrame([(1, "ab " * 100_000), (2, " ".join(str(i % 1000) for i in range(100_000)))], "doc_id long, text string")
    rows = {r.doc_id: r for r in periodic_runs(docs).collect()}
    assert (rows[1].length, rows[1].period, rows[1].n_runs, rows[1].collapsed) == (100_000, 1, 1, "ab")
    assert (rows[2].length, rows[2].period, rows[2].n_runs) == (100_000, 1000, 1)


def test_tails():
    words = [str(i).encode() for i in range(50)]
    assert all(repeat_tail(words[:n], d) == plain_tail(words[:n], d) for d in range(300) for n in (0, 1, 7, 50))
    assert repeat_tail(words, None) == words


def test_query_over_all_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: plain_tail((r.text or "").encode().split(), r.doc_id) for r in docs}
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_periodic_runs"](spark, folder).collect()}
    assert got.keys() == short.keys()
    wrong = [d for d, words in short.items() if len(words) < 3000 and got[d] != plain_result(words)]
    assert not wrong
