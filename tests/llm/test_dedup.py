"""Exact, near and passage duplicates against their plain definitions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import no_docs, odd_docs, shingled  # noqa: F401
from pyspark.sql import functions as F

from shelfmark.llm import cover, golomb, minhash, suffix_dedup
from shelfmark.llm.components import components
from shelfmark.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from shelfmark.llm.parts import PartTable
from shelfmark.llm.suffix_dedup import LENGTH, drop_repeats, suffix_duplicates
from shelfmark.sources.staging import scope, stage



def low(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=300))
def test_golomb_round_trip(keys):
    keys = np.array(sorted(keys), np.uint64)
    assert (golomb.decode(golomb.encode(keys)) == keys).all()


def test_golomb_is_small():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**63, 10_000, np.uint64))
    # 63 bits, less the 13 of the number of keys, and two for the code
    assert len(golomb.encode(keys)) * 8 / len(keys) < 63 - 13 + 2.5


def test_exact(odd_docs):
    texts = {(r.doc_id, low(r.text)) for r in odd_docs.collect()}
    groups = Counter(low(r.text) for r in odd_docs.collect())
    rows = exact_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for _, t in texts}
    for r in rows:
        t = sha[r.text_sha256]
        assert (r.doc_id, t) in texts and r.group_size == groups[t]
        assert r.keep_id == max((d for d, x in texts if x == t and d is not None), default=None)
    kept = [r for r in rows if r.kept]
    assert Counter(r.text_sha256 for r in kept) == dict.fromkeys(sha, 1)


def test_exact_keeps_whole_rows(odd_docs, no_docs):
    out = drop_exact_duplicates(odd_docs)
    assert out.schema.simpleString() == odd_docs.schema.simpleString()
    assert out.count() == len({low(r.text) for r in odd_docs.collect()})
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in odd_docs.collect()}
    assert exact_duplicates(no_docs).count() == 0 and drop_exact_duplicates(no_docs).columns == no_docs.columns


def plain_classes(rows, n, percent):
    sets = [(d, shingled(t, n)) for d, t in rows]
    parent = list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[top(i)] = top(j)
    out = []
    for i, (d, s) in enumerate(sets):
        ids = [e for j, (e, _) in enumerate(sets) if top(j) == top(i)]
        out.append((d, len(s), min((x for x in ids if x is not None), default=None)))
    return sorted(out, key=str)


def test_near(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for n, percent in ((3, 85), (5, 80)):
        found = minhash.near_duplicates(odd_docs, n, percent).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == plain_classes(rows, n, percent)
        assert all(r.kept == (r.doc_id == r.component_id) for r in found )
    assert minhash.near_duplicates(no_docs).count() == 0


def test_near_finds_all_links_around_the_threshold(spark):
    """Groups around a base text, chains of small changes, and pairs just above and below the bound."""
    r = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    rows = []
    for _ in range(12):
        base = [r.choice(words) for _ in range(150)]
        chain = list(base)
        for k in range(12):
            copy = list(base)
            for _ in range(r.randint(0, 9)):
                copy[r.randrange(150)] = r.choice(words)
            rows.append(" ".join(copy))
            chain[(12 * k) % 150] = r.choice(words)
            rows.append(" ".join(chain))
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = minhash.near_duplicates(docs, 3, 85).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in found), key=str) == plain_classes(rows, 3, 85)


def test_sketches_bound_similar_pairs():
    """The exclusive or of sketches has at most two ones per differing sample."""
    r = np.random.default_rng(3)
    a = np.unique(r.integers(0, 2**63, 400, np.uint64))
    b = np.unique(np.concatenate([a[:370], r.integers(0, 2**63, 30, np.uint64)]))
    found = minhash.samples([a, b], 100)
    sketch = minhash.odd_sketches(found).view(np.uint8)
    ones = int(np.unpackbits(sketch[0] ^ sketch[1]).sum())
    assert ones <= 2 * int((found[0] != found[1]).sum())
    assert minhash.bands_for(0.85, 1e-8) * minhash.ROWS >= 96


def test_near_keeps_one_of_each(odd_docs):
    out = minhash.drop_near_duplicates(odd_docs, 5, 80)
    assert out.schema.simpleString() == odd_docs.schema.simpleString()
    ids = sorted((r.doc_id for r in out.collect()), key=str)
    classes = plain_classes([(r.doc_id, r.text) for r in odd_docs.collect()], 5, 80)
    alone = [d for d, n, _ in classes if n == 0]
    assert ids == sorted([*alone, *{c for _, n, c in classes if n}], key=str)


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 9), (9, 8), (5, 5), (7, 3)] + [(100 + i, 101 + i) for i in range(40)] + [(200, i) for i in range(201, 260)]
    out = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(out[n] == 1 for n in (1, 2, 3, 7)) and all(out[n] == 8 for n in (8, 9, 10))
    assert all(out[n] == 100 for n in range(100, 141)) and all(out[n] == 200 for n in range(200, 260))
    assert len(out) == 4 + 3 + 41 + 60
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=84, max_size=84), min_size=1, max_size=30), st.integers(0, 2**32))
def test_cover_sorts_suffixes(rows, seed):
    r = np.random.default_rng(seed)
    rows = np.array(rows, np.uint8)
    rows[:, r.integers(0, 84):] = rows[0, r.integers(0, 84)]  # long ties
    lo, hi = r.integers(0, 35, len(rows)), r.integers(0, 36, len(rows))
    for place, members, begins in cover.buckets(rows, lo, hi, 35, 50):
        assert sorted(members) == [i for i in range(len(rows)) if lo[i] <= place < hi[i]]
        strings = [rows[i, place:place + 50].tobytes() for i in members]
        assert strings == sorted(strings)
        assert list(begins) == [i == 0 or strings[i] != strings[i - 1] for i in range(len(strings))]


def plain_repeats(rows):
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - LENGTH + 1):
            s = raw[i:i + LENGTH]
            first[s] = min(first.get(s, d), d)
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - LENGTH + 1):
            if first[raw[i:i + LENGTH]] < d:
                gone[i:i + LENGTH] = True
        left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(gone) else 0
        out.append((d, len(raw), int(gone.sum()), runs, left))
    return sorted(out)


def test_repeats(odd_docs, no_docs):
    docs = odd_docs.where("doc_id is not null")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_duplicates(docs).collect())
    assert found == plain_repeats(rows)
    assert suffix_duplicates(no_docs).count() == 0


def test_repeats_on_shuffled_passages(spark):
    r = random.Random(9)
    passages = ["".join(r.choice("abcé \n") for _ in range(r.randint(20, 140))) for _ in range(12)]
    rows = [(i, "".join(r.choice(passages + ["q%d " % i]) for _ in range(r.randint(0, 8)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffix_duplicates(docs).collect())
    assert found == plain_repeats(rows)
    cut = {x.doc_id: x.text for x in drop_repeats(docs).collect()}
    assert cut == {d: left.decode("utf-8", "ignore") if n else dict(rows)[d] for d, _, n, _, left in found}


def test_null_id_counts_as_smallest(spark):
    text = "a passage of more than fifty bytes that both of the documents hold in full"
    rows = {r.doc_id: r.n_removed for r in suffix_duplicates(spark.createDataFrame([(None, text), (3, text)], "doc_id long, text string")).collect()}
    assert rows == {None: 0, 3: len(text)}


def test_repeats_leave_other_columns(odd_docs):
    out = drop_repeats(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert out.where(F.col("n_chars").isNotNull() & (F.col("n_chars") != F.char_length("text"))).count() == 0


def test_parts_of_a_large_partition(spark):
    with scope():
        table = PartTable(spark.range(100, numPartitions=1).toDF("doc_id"), "some", 16)
        sizes = {r.part: r["count"] for r in table.rows.groupBy("part").count().collect()}
        assert sorted(sizes.values()) == [4] + [16] * 6
        kept = table.keep(stage(table.pick(["doc_id"]).where("doc_id % 3 = 0").select("row"), "chosen"))
        assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 100, 3))


def test_repeats_in_one_large_partition(spark, monkeypatch):
    most = []

    class Seen(PartTable):
        def __init__(self, *args):
            super().__init__(*args)
            most.append(self.rows.groupBy("part").count().agg(F.max("count")).first()[0])

    monkeypatch.setattr(suffix_dedup, "PartTable", Seen)
    monkeypatch.setattr(suffix_dedup, "PART_ROWS", 8)
    r = random.Random(4)
    passages = ["".join(r.choice("abcé \n") for _ in range(r.randint(40, 140))) for _ in range(9)]
    rows = [(i % 50, "".join(r.choice(passages + ["q%d " % i]) for _ in range(r.randint(0, 8)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = sorted((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in suffix_duplicates(docs).collect())
    assert found == plain_repeats(rows)
    assert len(drop_repeats(docs).collect()) == 60
    assert most == [8, 8]


def test_rows_are_sorted_by_groups_of_anchors(monkeypatch):
    r = np.random.default_rng(3)
    texts = ["".join(r.choice(list("ab "), 300)) for _ in range(6)]
    texts = pa.array([t[k:] + texts[(i + k) % 6][:200 - k] for k in range(0, 60, 4) for i, t in enumerate(texts)])
    whole, text, place, key = suffix_dedup._rows_of(texts, np.unique(suffix_dedup.anchors(texts)[4]))
    order = np.lexsort((text, key))
    received = suffix_dedup._record(0, whole[order], np.zeros(len(order), np.int64), text[order], place[order], text[order])
    rows = whole[order][:, :suffix_dedup.ROW]
    groups = suffix_dedup._by_anchor(rows, 64)
    assert len(groups) > 10 and sorted(np.concatenate(groups)) == list(range(len(rows)))
    grams = [{rows[i, suffix_dedup.BEFORE:suffix_dedup.BEFORE + suffix_dedup.GRAM].tobytes() for i in g} for g in groups]
    assert sum(map(len, grams)) == len(set().union(*grams))
    at_once = suffix_dedup._sort_rows(received)
    monkeypatch.setattr(suffix_dedup, "SORT_ROWS", 64)
    assert at_once.num_rows and suffix_dedup._sort_rows(received).equals(at_once)
