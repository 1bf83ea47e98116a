"""Tokens, packing, chat, scores, search and site lines against libraries and plain definitions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import TEXTS, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfmark.llm import bpe, chat, packing, quality, templates, token_counts, topk, words
from shelfmark.llm.line_dedup import drop_boilerplate, host_of, lines_of
from shelfmark.llm.parts import spans, texts_of

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
BITS = [*"abcdeé'12 .,!\n\t\u00a0\u2003\u0301ΣİßÅ中😀", "<|endoftext|>", "the ", "'s", "  "]
ANY = st.lists(st.sampled_from(BITS), max_size=60).map("".join)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


@settings(max_examples=150, deadline=None)
@given(st.lists(ANY, max_size=5))
def test_encodes_as_the_library(word_library, texts):
    own = bpe.codec(WORD)
    ids, at = own.encode(texts_of(pa.array(texts, pa.string())))
    decoded = [bytes(t).decode() for t in own.decode(ids, at)]
    for i, t in enumerate(texts):
        expected = word_library.encode(t, add_special_tokens=False).ids
        assert ids[at[i]:at[i + 1]].tolist() == expected
        assert decoded[i] == word_library.decode(expected, skip_special_tokens=False)


def test_encodes_every_latin_code_point_as_the_library(word_library):
    texts = [p for c in map(chr, range(0x250)) for p in (c, c + "bc", "bc" + c, "b" + c + "c", c + "'s")] + ["Əli", "Ɓoye"]
    ids, at = bpe.codec(WORD).encode(texts_of(pa.array(texts, pa.string())))
    wrong = [t for i, t in enumerate(texts) if ids[at[i]:at[i + 1]].tolist() != word_library.encode(t, add_special_tokens=False).ids]
    assert wrong == []


def plain_merge(symbols, ranks):
    symbols = list(symbols)
    while True:
        found = min(((ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks), default=None)
        if found is None:
            return symbols
        i = found[1]
        symbols[i:i + 2] = [100 + found[0]]


@settings(deadline=None)
@given(st.lists(st.tuples(st.integers(0, 106), st.integers(0, 106)), min_size=1, max_size=12, unique=True),
       st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=40), min_size=1, max_size=8))
def test_tree_merges_the_leftmost_lowest_pair(pairs, rows):
    table = bpe.Pairs([a for a, _ in pairs], [b for _, b in pairs], [100 + i for i in range(len(pairs))])
    width = max(map(len, rows))
    block = np.full((len(rows), width), -1, np.int64)
    for i, r in enumerate(rows):
        block[i, :len(r)] = r
    out = bpe.merge(block, table)
    ranks = {p: i for i, p in enumerate(pairs)}
    for i, r in enumerate(rows):
        assert out[i][out[i] >= 0].tolist() == plain_merge(r, ranks)


def test_round_trip_query(odd_docs, no_docs, word_library):
    rows = {r.doc_id: r for r in bpe.encode_digests(odd_docs, WORD).collect()}
    for d, t in TEXTS.items():
        ids = word_library.encode(t or "", add_special_tokens=False).ids
        assert rows[d].n_tokens == len(ids)
        assert rows[d].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[d].decoded_sha256 == hashlib.sha256(word_library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_digests(odd_docs, WORD).count() == odd_docs.count()
    assert bpe.encode_texts(no_docs, WORD).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(ANY, max_size=5))
def test_counts_as_the_library(byte_library, texts):
    own = token_counts.counter(BYTE)
    empty = words.WordTable(4), np.zeros(1, np.uint16)
    found = own.count(texts_of(pa.array(texts, pa.string())), empty)
    assert found.tolist() == [len(byte_library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_count_query(odd_docs, no_docs, byte_library):
    for sample, most in ((4096, 1 << 14), (2, 8)):  # the table decides no count
        rows = token_counts.count_tokens(odd_docs, BYTE, 1024, sample=sample, most=most).collect()
        assert len(rows) == odd_docs.count()
        for r in rows:
            if r.doc_id in TEXTS:
                t = TEXTS[r.doc_id] or ""
                n = len(byte_library.encode(t, add_special_tokens=False).ids)
                assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 1024)
    assert token_counts.count_tokens(no_docs, BYTE).count() == 0


def test_memory_is_bounded_and_right():
    memory = words.Memory(lambda ws: (np.array([len(w) for w in ws]), np.ones(len(ws), np.int64)), np.int32, limit=64)
    r = random.Random(2)
    for _ in range(30):
        ws = [("%d" % r.randint(0, 400)).encode() * r.choice([1, 30]) for _ in range(90)]
        data = np.frombuffer(b"".join(ws), np.uint8)
        ends = np.cumsum([len(w) for w in ws])
        values, _ = memory.look_up(data, ends - [len(w) for w in ws], ends)
        assert values.tolist() == [len(w) for w in ws]
        assert memory.count <= 64 + 90


def check_pieces(rows, expected, window):
    """Every id lies in one piece, sequences are gapless and full; returns tokens per sequence and source."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert r.length > 0 and len(r.ids) == 4 * r.length
    got = Counter()
    for d, pieces in by_doc.items():
        for start, group in groups_of(pieces):
            got[d, b"".join(group)] += 1
            assert start == 0
    assert got == expected
    for s, pieces in by_seq.items():
        end = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        assert end == window or s == max(by_seq)
    assert sorted(by_seq) == list(range(len(by_seq)))
    return {s: Counter({}) + sum((Counter({p.source: p.length}) for p in pieces), Counter()) for s, pieces in by_seq.items()}


def groups_of(pieces):
    """Pieces of one doc_id as whole documents (repeated rows come several times)."""
    pieces = sorted(pieces, key=lambda p: p.start)
    copies = len([p for p in pieces if p.start == 0])
    if copies == 1:
        end = 0
        for p in pieces:
            assert p.start == end
            end += p.length
        assert end == pieces[0].doc_tokens
        yield 0, [bytes(p.ids) for p in pieces]
        return
    raw = {}
    for p in pieces:  # copies are the same ids, cut differently
        for i in range(p.length):
            raw.setdefault(p.start + i, []).append(bytes(p.ids)[4 * i:4 * i + 4])
    assert sorted(raw) == list(range(pieces[0].doc_tokens)) and all(len(x) == copies and len(set(x)) == 1 for x in raw.values())
    yield from [(0, [raw[i][0] for i in sorted(raw)])] * copies


def test_packing(odd_docs, no_docs, word_library):
    rows = odd_docs.select("doc_id", "text").collect()
    expected = Counter((r.doc_id, np.array(word_library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for r in rows)
    docs = odd_docs.withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("s"), F.col("doc_id") % 3)))
    for window, queues in ((4096, 256), (128, 256), (512, 2)):
        packed = packing.pack(docs, WORD, window=window, max_queues=queues)
        check_pieces(packed.collect(), expected, window)
    joined = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in joined) == sum(len(ids) * n for (_, ids), n in expected.items())
    assert packing.pack(no_docs.withColumn("source", F.lit("a")), WORD).count() == 0


def test_packing_holds_the_mix(spark, word_library):
    r = random.Random(4)
    rows = [(i, "cat " * r.randint(1, 900), s) for i, s in enumerate(["a"] * 300 + ["b"] * 100 + ["c"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    total = Counter()
    for _, t, s in rows:
        total[s] += len(t) // 4 + 1
    share = {s: n / total.total() for s, n in total.items()}
    expected = Counter((i, np.array([*word_library.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t, _ in rows)
    by_window = check_pieces(packing.pack(docs, WORD, window=2048).collect(), expected, 2048)
    for w in sorted(by_window)[:-3]:
        assert all(abs(by_window[w][s] - 2048 * share[s]) <= 3 * 64 for s in share)
    # Another mix: the named sources have their weights while all last, and nothing is lost afterwards.
    by_window = check_pieces(packing.pack(docs, WORD, window=2048, weights={"a": 1, "b": 1, "c": 2}).collect(), expected, 2048)
    assert all(abs(by_window[w]["c"] - 1024) <= 3 * 64 for w in range(total["c"] // 1024 - 1))


def test_packing_mixes_sources_without_a_queue_of_their_own(spark, word_library):
    r = random.Random(5)
    named = ["a"] * 60 + ["b"] * 50 + [f"t{i}" for i in range(30) for _ in range(1 + i % 4)] + [None] * 3
    rows = [(i, "cat " * r.randint(100, 900), s) for i, s in enumerate(named)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    total = Counter()
    for _, t, s in rows:
        total[s] += len(t) // 4 + 1
    tail = [s for s in total if s not in ("a", "b")]
    expected = Counter((i, np.array([*word_library.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t, _ in rows)
    by_window = check_pieces(packing.pack(docs, WORD, window=2048, max_queues=3).collect(), expected, 2048)
    done, all_of = Counter(), sum(total[s] for s in tail)
    for w in sorted(by_window):
        done += by_window[w]
        part = sum(done[s] for s in tail) / all_of
        assert all(abs(done[s] - part * total[s]) <= 4 * 64 for s in tail)
    # A source that weights names has its weight, however small it is.
    packed = packing.pack(docs, WORD, window=2048, max_queues=3, weights={"t7": 1.0, None: 0.5, "absent": 3}).collect()
    by_window = check_pieces(packed, expected, 2048)
    mix = {"t7": 1.0, None: 0.5}
    whole = sum(mix.values()) + sum(n for s, n in total.items() if s not in mix) / total.total()
    for s, w in mix.items():
        assert all(abs(by_window[i][s] - 2048 * w / whole) <= 3 * 64 for i in range(int(min(total[x] / (2048 * y / whole) for x, y in mix.items())) - 1))


def test_schedule_is_one_round_robin():
    """The closed form gives what playing the rounds gives."""
    schedule = packing.Schedule.of(256, [5, 3, 0.01], [9000, 2000, 130])
    used, order = [0, 0, 0], []
    for r in range(1, 100_000):
        for q in range(3):
            earned = (r * int(schedule.earned[q]) >> schedule.SHIFT) << packing.UNIT_BITS
            while used[q] < min(earned, int(schedule.total[q])):
                order.append((q, used[q]))
                used[q] += 1
        if used == [9000, 2000, 130]:
            break
    place = {qx: i for i, qx in enumerate(order)}
    for q, total in enumerate([9000, 2000, 130]):
        cuts = sorted({0, total, *random.Random(q).sample(range(1, total), 30)})
        begin, sizes = np.array(cuts[:-1]), np.diff(cuts)
        doc, start, length, sequence, offset = schedule.pieces(np.full(len(begin), q), begin, sizes)
        for d, s, n, w, o in zip(doc, start, length, sequence, offset):
            assert [place[q, begin[d] + s + i] for i in range(n)] == list(range(w * 256 + o, w * 256 + o + n))


@settings(deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "[TEXT] </s>"]), st.lists(
    st.sampled_from([*"\\[]</s> >aé\n", *chat.CONTROL]), max_size=12).map("".join)), max_size=6))
def test_chat_reads_back(said):
    pieces = list(chat.renderer(chat.TEMPLATE)(messages=iter([{"role": r, "text": t} for r, t in said])))
    text = "".join(p for p, _ in pieces)
    assert list(chat.turns(text)) == said
    assert [chat.unescape(p) for p, g in pieces if g] == [t for r, t in said if r == "assistant"]
    assert not any(c in chat.escape(t) for _, t in said for c in chat.CONTROL)


def test_chat_digests(spark):
    rows = [(1, 2, "assistant", None), (1, 1, "user", "hi"), (1, 3, None, "x"), (1, 3, "user", "b"), (1, 3, "user", "a"),
            (None, 1, "user", "n"), (2, None, "assistant", "é" * 3000), (2, 1, "assistant", "</s>"), (2, 1, "assistant", "</s>")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, spans string")
    whole = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    small = {r.conv_id: r for r in chat.read_back(chat.format_chats(df, chunk=10)).collect()}
    assert whole == small and set(whole) == {1, 2, None}

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert whole[1].turns_sha256 == digest("user\nhi\nassistant\n\n\nx\nuser\na\nuser\nb\n") and whole[1].n_turns == 5
    assert whole[1].loss_chars == 0 and whole[1].loss_sha256 == digest("")
    assert whole[2].loss_sha256 == digest("é" * 3000 + "</s></s>") and whole[2].loss_chars == 3008
    assert chat.chat_digests(df.limit(0)).count() == 0


def test_templates():
    def render(source, **values):
        return "".join(p for p, _ in templates.compile_template(source)(**values))

    assert render("{{ 'a' + 'b' | upper }}{% if 1 == 2 %}x{% elif not false %}y{% else %}z{% endif %}") == "aBy"
    assert render("{% for m in ms %}{{ m['x'] }}{% if not loop.last %},{% endif %}{% endfor %}", ms=[{"x": 1}, {"x": None}]) == "1,"
    tree = templates.fold(templates.parse("a{{ 'b' }}{% if 'x' == 'x' %}c{% endif %}{{ m.y }}"))
    assert tree[0] == templates.Text("abc") and len(tree) == 2
    pieces = list(templates.compile_template("a{% generation %}{{ x }}b{% endgeneration %}c")(x="1"))
    assert pieces == [("a", False), ("1", True), ("b", True), ("c", False)]
    for bad in ("{% for %}", "{{ a( }}", "{{ x.__class__() }}", "{% if a %}", "{{ a | nothing }}", "{% import os %}", "{{ }}"):
        with pytest.raises(templates.TemplateError):
            render(bad, a=1, x="")
    for bad in ("{{ x.__class__ }}", "{{ absent }}", "{{ 1 + 'a' }}"):
        with pytest.raises(templates.TemplateError):
            render(bad, x="text")


def test_quality(spark, folder):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    weights = quality.fit(docs, labels)
    scored = quality.score(docs, weights).withColumn("held_out", quality.held_out(F.col("doc_id")))
    rows = scored.join(labels, "doc_id").select("doc_id", "quality", "score", "predicted", "held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in unseen]) >= 0.9
    # The held-out labels change nothing.
    other = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality.fit(docs, other) == weights).all()


def test_quality_of_odd_rows(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(6, 1), (11, 0), (11, 0), (11, 1), (None, 1), (99, 0), (4, None)], "doc_id long, quality int")
    weights = quality.fit(odd_docs, labels)
    scored = quality.score(odd_docs, weights)
    assert scored.columns == [*[c for c in odd_docs.columns if c != "score"], "score", "predicted"]
    assert scored.select("score").where("score between 0 and 1").count() == odd_docs.count()
    assert quality.keep_good(odd_docs, weights).columns == odd_docs.columns
    assert quality.score(no_docs, quality.fit(odd_docs, labels.limit(0))).count() == 0


def plain_ftrl(texts, labels, alpha=0.3, beta=1.0, l1=0.02, l2=0.2, epochs=3):
    """Follow the regularised leader one weight at a time."""
    z, n, rows, bias = Counter(), Counter(), [], 1 << quality.BITS
    for text in texts:
        index, at = quality.features(pa.array([text]))
        counts = Counter(index.tolist())
        rows.append({**{i: c / max(1, len(index)) ** 0.5 for i, c in counts.items()}, bias: 1.0})

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return ((l1 if z[i] > 0 else -l1) - z[i]) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for row, label in zip(rows, labels, strict=True):
            w = {i: weight(i) for i in row}
            p = 1 / (1 + np.exp(-sum(w[i] * x for i, x in row.items())))
            for i, x in row.items():
                g = (p - label) * x
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}, rows


def test_training_and_scores_as_a_plain_loop():
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["good", "Bad!", "x1", "word", "été,", "WORD"]) for _ in range(rng.randrange(30))) for _ in range(60)]
    labels = np.array([rng.randrange(2) for _ in texts])
    weights, rows = plain_ftrl(texts, labels)
    found = quality.train(pa.array(texts), labels)
    assert {i: found[i] for i in np.flatnonzero(found)} == pytest.approx({i: w for i, w in weights.items() if w}, rel=1e-9)
    wanted = [1 / (1 + np.exp(-sum(weights[i] * x for i, x in row.items()))) for row in rows]
    assert quality.scores(pa.array(texts), found) == pytest.approx(wanted, rel=1e-9)


@pytest.mark.parametrize("kind", ["smallint", "decimal(5,1)", "date", "string"])
def test_chats_of_ids_of_any_kind(spark, kind):
    value = "date'2024-01-01'" if kind == "date" else "7"
    rows = spark.range(2).selectExpr(f"cast({value} as {kind}) as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role", "concat('t', id) as text")
    got = chat.chat_digests(rows)
    assert got.schema["conv_id"].dataType.simpleString() == kind
    assert [(r.n_turns, r.loss_chars) for r in got.collect()] == [(2, 2)]


def plain_top(rows, k):
    v = {i: [int(np.floor(256 * float(x))) for x in e] for i, e in rows if e and all(x is not None and np.isfinite(x) for x in e)}
    out = []
    for q in v:
        if q % 5 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q and len(v[c]) == len(v[q]))
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k(spark, monkeypatch):
    r = random.Random(8)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    rows += [(i, [0.5] * 8) for i in range(400, 520)] + [(520, None), (521, []), (522, [1.0, None] + [0.0] * 6),
            (525, [float("nan")] * 8), (530, [float("inf")] + [0.0] * 7), (535, [0.0] * 8), (540, [1.0, 2.0]), (541, [1.0, 3.0])]
    df = spark.createDataFrame([(*x, "c") for x in rows], "vec_id long, embedding array<float>, rank string").repartition(3)
    rounded = [(i, e and [None if x is None else float(np.float32(x)) for x in e]) for i, e in rows]
    for size in (64, 1 << 14):
        monkeypatch.setattr(topk, "BLOCK", size)
        monkeypatch.setattr(topk, "QUERY_BLOCK", size)
        monkeypatch.setattr(topk, "ANNULUS", 16)
        found = topk.top_k(df, df.where("vec_id % 5 = 0"), 5).collect()
        assert sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in found) == plain_top(rounded, 5)
    assert topk.top_k(df.where("vec_id < 0"), df.where("vec_id = 0"), 5).count() == 0


def test_site_lines(spark):
    html = "<html><body><nav>Menu</nav><p>{} text</p><!-- x\n --><script>Menu</script><div>Menu</div><br/>\t<b>own</b> {}</body></html>"
    rows = [(i, "HTTP://u:p@Site.org:80/x" if i < 20 else f"https://s{i % 2}.net/", html.format(i, i)) for i in range(30)]
    rows += [(30, None, "<p>Menu</p>"), (31, "no address", None), (32, "https://s9.net", "<p>Menu</p>"), (5, "https://site.org/", html.format(5, 5))]
    pages = spark.createDataFrame([(*r, "h", 7) for r in rows], "page_id long, url string, html string, host string, n_lines int").repartition(4)
    out = drop_boilerplate(pages, host_of(F.col("url")), lines_of(F.col("html"))).collect()
    assert len(out) == len(rows) and set(out[0].asDict()) == {"page_id", "url", "html", "host", "lines", "n_lines", "n_dropped"}
    for r in out:
        if r.page_id < 20:
            assert r.host == "site.org" and r.lines == [f"{r.page_id} text", f"own {r.page_id}"] and (r.n_lines, r.n_dropped) == (4, 2)
        elif r.page_id < 30:
            assert r.n_dropped == 2 and "Menu" not in r.lines
        else:
            assert r.n_dropped == 0 and r.lines == ([] if r.page_id == 31 else ["Menu"])
    assert drop_boilerplate(pages.limit(0), F.col("url"), lines_of(F.col("html"))).count() == 0
    texts = F.array(F.lit("a"), F.lit(None).cast("string"), F.lit("a"), F.col("page_id").cast("string"))
    some = drop_boilerplate(pages.where("page_id < 10"), F.lit("one"), texts, ratio=0.5).collect()
    assert all(r.lines == [str(r.page_id)] and r.n_dropped == 2 for r in some)


def test_hosts_of_one_and_two_pages(spark):
    rows = [(1, "https://two.org/a", "<p>foot</p><p>one</p>"), (2, "https://two.org/b", "<p>foot</p><p>two</p>"), (3, "https://one.org", "<p>foot</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = drop_boilerplate(pages, host_of(F.col("url")), lines_of(F.col("html"))).collect()
    assert {r.page_id: r.lines for r in out} == {1: ["one"], 2: ["two"], 3: ["foot"]}


def test_spans_cover_all():
    texts = pa.array(["a" * 10, "", "b" * 100, "c"])
    assert spans(texts, 12) == [(0, 2), (2, 3), (3, 4)] and spans(texts.slice(0, 0)) == []
    assert re.fullmatch(r"(\(\d+, \d+\),? ?)+", ", ".join(map(str, spans(texts))))
