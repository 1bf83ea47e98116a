"""Collocations against their definition in plain Python; the given documents are compared with SQL in test_queries."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfmark.llm import collocations as co


def plain(rows, least, top):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, *words[i:i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    often = {p: a for p, a in counts.items() if a >= least and len(p) > 2}

    def inside(short, long):
        return any(long[1 + i:1 + i + len(short) - 1] == short[1:] for i in range(len(long) - len(short) + 1))

    found = []
    for p, a in often.items():
        if any(q[0] == p[0] and len(q) > len(p) and b >= a and inside(p, q) for q, b in often.items()):
            continue
        cuts = []
        for k in range(1, len(p) - 1):
            left, right = counts[p[:k + 1]], counts[(p[0], *p[k + 1:])]
            cuts.append((1000 * a * total[p[0]] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.append((p[0], -score, -a, " ".join(p[1:]).encode(), left, right))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return out


def texts(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "B", "c\x01", "c", "é", "der", "😀", "word" * 30]
    rows = []
    for _ in range(120):
        words = [rng.choice(vocabulary[:rng.randrange(2, 10)]) for _ in range(rng.randrange(40))]
        rows.append((rng.choice(["en", "de", None, "", "und"]), "".join(w + rng.choice([" "] * 6 + ["\t", "  ", ". ", "\n", ",", "\x0b"]) for w in words)))
    return [*rows, ("en", None), (None, ""), ("en", " . "), ("fr", "only words here"), *[("en", "new york city hall")] * 9]


@pytest.mark.parametrize("seed,least,top,split", [(1, 5, 2000, 1 << 16), (2, 9, 7, 2), (3, 3, 40, 5)])
def test_as_defined(spark, monkeypatch, seed, least, top, split):
    monkeypatch.setattr(co, "SPLIT_FROM", split)
    rows = texts(seed)
    docs = spark.createDataFrame([(lang, t, "x", 1) for lang, t in rows], "lang string, text string, phrase string, n int").repartition(3)
    got = sorted(tuple(r) for r in co.collocations(docs, least=least, top=top).collect())
    assert got == sorted(plain(rows, least, top))


def test_crowded_bitmaps_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(co, "LEAST_BITS", 3)
    monkeypatch.setattr(co, "MOST_BITS", 3)
    rows = texts(4)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in co.collocations(docs, least=6).collect()) == sorted(plain(rows, 6, 2000))


def test_products_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("100000000000L as a", "9000000000000L as n", "100000000000L as l", "70000000001L as r")
    got = row.select(co._quotient(
        co.F.lit(1000).cast("decimal(4,0)") * co._whole(co.F.col("a")) * co._whole(co.F.col("n")),
        co._whole(co.F.col("l")) * co._whole(co.F.col("r")))).first()[0]
    assert got == 1000 * 10**11 * 9 * 10**12 // (10**11 * 70000000001)


def test_empty_and_rare(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert co.collocations(empty).count() == 0
    few = spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")
    assert co.collocations(few).count() == 0


def test_long_text_and_one_hot_word(spark):
    docs = spark.createDataFrame([("en", "la " * 200_000), ("en", "la di " * 50_000)], "lang string, text string")
    got = [(r.phrase, r.a, r.l, r.r, r.n) for r in co.collocations(docs).orderBy("rank").collect()]
    assert ("la la la la la", 199_996, 200_000 + 50_000, 199_997, 300_000) in got


def test_hashes_that_meet_are_told_apart():
    a, b = np.array([1, 1, 1, 2], np.uint64), np.array([5, 6, 5, 5], np.uint64)
    first, count = co._grouped(a, b)
    assert sorted(zip(first.tolist(), count.tolist())) == [(0, 2), (1, 1), (3, 1)]


def test_words_and_pieces():
    w = co.Words(pa.array(["Ab  c.d", "", "e\x0bf g"]), np.array([1, 1, 1], np.uint64))
    assert [w.phrase(i, 1) for i in range(len(w.starts))] == [b"ab", b"c", b"d", b"e", b"f", b"g"]
    assert w.whole(2).tolist() == [True, False, False, False, True] and w.phrase(0, 2) == b"ab c"
