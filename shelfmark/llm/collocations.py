"""Phrases whose words keep together, from streams of counts in two orders.

Counting takes four passes over the texts. The first three count words, pairs and
triples of words by a hash and leave a bitmap of fixed size each, in which all that are
frequent have their bits; a phrase with a rare word, pair or triple is rare itself. The
last one counts what the bitmaps leave, phrases of up to five words, by the phrases
themselves, so the counts are exact whatever the hashes do.

The counts of all orders are then one stream in prefix order: a phrase comes right after
those it begins with, so one stack holds the counts of all its beginnings, and of its
extensions to the right the most frequent. The same stream in suffix order gives the
counts of all its endings and the extensions to the left. No table is looked up. A word
that begins or ends very many phrases is split by the word next to it, and its own count
is repeated for each part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.parts import small_batches, spans, text_bytes, texts_of, tidy
from shelfmark.llm.quality import LOWER
from shelfmark.llm.words import keys, mix
from shelfmark.sources.staging import stage

MOST_WORDS = 5
# Words of the longest phrases that are counted by a hash first.
HASHED = 3
# Bits of a bitmap: 32 a frequent phrase, between these bounds (128 KB and 32 MB).
LEAST_BITS, MOST_BITS = 20, 28
# Texts are counted in groups of about this many bytes.
GROUP_BYTES = 2 << 20
# A first or last word with more phrases than this is split.
SPLIT_FROM = 1 << 16

STEP = np.uint64(0x9E3779B97F4A7C15)
KIND = np.zeros(256, np.uint8)
KIND[[9, 32]] = 1
KIND[[10, 11, 12, 13, *b".,;:!?"]] = 2


class Words:
    """The words of some texts as arrays: bytes, where each word is, its piece, and two hash chains over following words."""

    def __init__(self, texts: pa.Array, langs: np.ndarray):
        data, offsets = text_bytes(texts)
        self.data = LOWER[data]
        kind = KIND[data]
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        apart = np.append(True, kind[:-1] > 0) | begins[:-1] if len(data) else np.zeros(0, bool)
        self.starts = np.flatnonzero((kind == 0) & apart)
        closes = np.append(kind[1:] > 0, True) | begins[1:] if len(data) else np.zeros(0, bool)
        self.ends = np.flatnonzero((kind == 0) & closes) + 1
        self.text = np.searchsorted(offsets, self.starts, side="right") - 1
        cuts = np.append(0, np.cumsum(kind == 2))
        new = np.ones(len(self.starts), bool)
        new[1:] = (self.text[1:] != self.text[:-1]) | (cuts[self.starts[1:]] > cuts[self.ends[:-1]])
        self.piece = np.cumsum(new)
        a, b = keys(self.data, self.starts, self.ends)
        own = langs[self.text]
        self.words, self.chains = (a, b), [(mix(a ^ own), mix(b + own))]

    def chain(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the ``k`` words from each place on, with their language; the last k - 1 places have none."""
        while len(self.chains) < k:
            done = len(self.chains)
            self.chains.append(tuple(
                mix(c[:-1] * STEP + w[done:]) if len(c) else c for c, w in zip(self.chains[-1], self.words, strict=True)))
        return self.chains[k - 1]

    def whole(self, k: int) -> np.ndarray:
        """From which places on ``k`` words lie in one piece."""
        return self.piece[:max(0, len(self.piece) - k + 1)] == self.piece[k - 1:]

    def phrase(self, i: int, k: int) -> bytes:
        return b" ".join(self.data[self.starts[i]:self.ends[i + k - 1]].tobytes().split())


def lang_key(lang: str) -> int:
    a, _ = keys(np.frombuffer(lang.encode(), np.uint8), np.array([0]), np.array([len(lang.encode())]))
    return int(a[0])


class Bitmap:
    """A bit for each of some hashes, by its leading bits; others may share it."""

    def __init__(self, hashes: DataFrame, column: str = "h"):
        count = hashes.count()
        self.bits = int(min(max(LEAST_BITS, (32 * count).bit_length()), MOST_BITS))
        place = F.shiftrightunsigned(column, 64 - self.bits) + 1
        # At most 2**MOST_BITS / 32768 rows of 4 KB.
        rows = hashes.groupBy(F.bitmap_bucket_number(place).alias("at")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
        self.bytes = np.zeros(1 << self.bits - 3, np.uint8)
        for row in rows:
            start, held = (row["at"] - 1) * 4096, np.frombuffer(bytes(row["bits"]), np.uint8)[:len(self.bytes)]
            self.bytes[start:start + len(held)] = held

    def has(self, h: np.ndarray) -> np.ndarray:
        place = h >> np.uint64(64 - self.bits)
        return (self.bytes[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _grouped(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct pair of hashes is first, and how often it is there."""
    _, first, inverse, count = np.unique(a, return_index=True, return_inverse=True, return_counts=True)
    if (b != b[first][inverse]).any():
        pairs = np.empty(len(a), "<u8,<u8")
        pairs["f0"], pairs["f1"] = a, b
        _, first, count = np.unique(pairs, return_index=True, return_counts=True)
    return first, count


def _word_groups(batches) -> Iterator[tuple[Words, list[str]]]:
    for batch in batches:
        texts = texts_of(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        known = {lang: lang_key(lang) for lang in set(langs)}
        for i, j in spans(texts, GROUP_BYTES):
            own = langs[i:j]
            yield Words(texts.slice(i, j - i), np.array([known[x] for x in own], np.uint64)), own


def _count_hashes(k: int, shorter):
    """Hashes of ``k`` words and how often each occurs in a group of texts, where both its parts of k - 1 words are in a bitmap."""

    def run(batches):
        for words, _ in _word_groups(batches):
            ok = words.whole(k)
            if shorter is not None:
                frequent = shorter.value.has(words.chain(k - 1)[0])
                ok = ok & frequent[:-1] & frequent[1:]
            h, count = np.unique(words.chain(k)[0][ok], return_counts=True)
            yield pa.record_batch({"h": pa.array(h.view(np.int64)), "n": pa.array(count)})

    return run


def _count_phrases(bitmaps):
    """Phrases that no bitmap rules out with their counts in a group of texts; the empty phrase counts all words."""

    def run(batches):
        for words, langs in _word_groups(batches):
            total = np.bincount(words.text, minlength=len(langs))
            out_lang, out_phrase, out_count = list(langs), [b""] * len(langs), total.tolist()
            ok = words.whole(1)
            for k in range(1, MOST_WORDS + 1):
                if k > 1:
                    ok = ok[:-1] & ok[1:]
                if k == 2:
                    ok = ok & words.whole(2)
                if k <= len(bitmaps):
                    ok = ok & bitmaps[k - 1].value.has(words.chain(k)[0])
                place = np.flatnonzero(ok)
                if not len(place):
                    break
                a, b = words.chain(k)
                first, count = _grouped(a[place], b[place])
                first = place[first]
                out_lang += [langs[t] for t in words.text[first].tolist()]
                out_phrase += [words.phrase(i, k) for i in first.tolist()]
                out_count += count.tolist()
            yield pa.record_batch({
                "lang": pa.array(out_lang, pa.string()), "phrase": pa.array(out_phrase, pa.binary()).cast(pa.string()),
                "n": pa.array(out_count, pa.int64())})

    return run


def phrase_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of every phrase of up to MOST_WORDS words that occurs ``least`` times, and all words under ''."""
    spark = docs.sparkSession
    small_batches(spark)

    def frequent(k: int, shorter) -> Bitmap:
        hashes = docs.mapInArrow(tidy(_count_hashes(k, shorter)), "h long, n long")
        return Bitmap(stage(hashes.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h"), "frequent"))

    bitmaps: list = []
    for k in range(1, HASHED + 1):
        bitmaps.append(spark.sparkContext.broadcast(frequent(k, bitmaps[-1] if bitmaps else None)))
    counted = docs.mapInArrow(tidy(_count_phrases(bitmaps)), "lang string, phrase string, n long")
    found = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return stage(found.where((F.col("n") >= least) | (F.col("phrase") == "")), "counts")


def _in_order(rows: DataFrame, reverse: bool) -> DataFrame:
    """``rows`` (lang, phrase, n, ...) partitioned by language and first (last) word, sorted by words from that end on.

    ``copy`` marks the counts of single words that are repeated for further parts.
    """
    words = F.split("phrase", " ")
    rows = rows.withColumn("words", F.reverse(words) if reverse else words).withColumn("head", F.col("words")[0])
    rows = rows.withColumn("second", F.get("words", F.lit(1)))
    hot = stage(
        rows.where("second is not null").groupBy("lang", "head").agg(F.count(F.lit(1)).alias("of"))
        .where(F.col("of") >= SPLIT_FROM)
        .select("lang", "head", (F.col("of") / SPLIT_FROM).cast("int").alias("parts")), "hot")
    placed = rows.join(hot, ["lang", "head"], "left").withColumn("parts", F.coalesce("parts", F.lit(0)) + 1)
    part = F.when(F.col("second").isNotNull(), F.array(F.pmod(F.xxhash64("second"), "parts").cast("int"))).otherwise(
        F.sequence(F.lit(0), F.col("parts") - 1))
    placed = placed.withColumn("part", F.explode(part)).withColumn(
        "copy", F.col("second").isNull() & (F.col("part") > 0))
    order = ["lang", "head", "part", "words"]
    return placed.repartition("lang", "head", "part").sortWithinPartitions(*order).drop("head", "second", "parts", "part")


def _walk(carried: list[str], ends: str, longest: str):
    """For each phrase of a stream in order, the counts of its beginnings and its most frequent extension.

    A phrase leaves the stack when the next one does not begin with it.
    """

    def run(batches):
        stack: list[dict] = []
        out: list[dict] = []

        def leave():
            row = stack.pop()
            if not row.pop("copy"):
                out.append(row)

        def begins(lang, words):
            top = stack[-1]
            return top["lang"] == lang and len(top["words"]) < len(words) and words[:len(top["words"])] == top["words"]

        def flush():
            made = {c: [r[c] for r in out] for c in ["lang", "phrase", "n", *carried, ends, longest]}
            out.clear()
            kinds = {"lang": pa.string(), "phrase": pa.string(), "n": pa.int64(), longest: pa.int64()}
            return pa.record_batch({c: pa.array(v, kinds.get(c, LISTS.get(c))) for c, v in made.items()})

        for batch in batches:
            for row in batch.to_pylist():
                words = row.pop("words")
                while stack and not begins(row["lang"], words):
                    leave()
                row["words"], row[longest] = words, 0
                row[ends] = [*stack[-1][ends], stack[-1]["n"]] if stack else []
                if stack:
                    stack[-1][longest] = max(stack[-1][longest], row["n"])
                stack.append(row)
            if out:
                yield flush()
        while stack:
            leave()
        if out:
            yield flush()

    return run


LISTS = {"lefts": pa.list_(pa.int64()), "rights": pa.list_(pa.int64()), "right_most": pa.int64()}


def _whole(value: Column) -> Column:
    return value.cast("decimal(17,0)")


def collocations(
    docs: DataFrame, least: int = 100, top: int = 2000, lang: str = "lang", texts: str = "text", default: str = "und",
) -> DataFrame:
    """Per language its ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut at marks and line ends into pieces, and those at
    blanks and tabs into words. A phrase of two to MOST_WORDS words that occurs a >=
    ``least`` times has for each cut into two parts, which occur l and r times, the score
    1000 a n / (l r), rounded down, n being all words of the language; the lowest counts,
    of equal ones that of the shortest first part. Phrases inside a longer one that
    occurs as often are left out. Ranks are by score, then a, downwards, then by the
    phrase in byte order.

    Null texts are empty, a null language is ``default``; texts of any length are whole,
    repeated rows count each, other columns are not read. An empty table gives an empty
    one.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(default)).alias("lang"), F.col(f"`{texts}`").alias("text"))
    counts = phrase_counts(rows, least)
    phrases = counts.where("phrase <> ''")
    totals = counts.where("phrase = ''").select("lang", F.col("n").alias("all_words"))
    kinds = "lang string, phrase string, n long"
    forward = _in_order(phrases, False).mapInArrow(
        tidy(_walk([], "lefts", "right_most")), f"{kinds}, lefts array<long>, right_most long")
    forward = stage(forward, "prefixes")
    both = _in_order(forward, True).mapInArrow(
        tidy(_walk(["lefts", "right_most"], "rights", "left_most")),
        f"{kinds}, lefts array<long>, right_most long, rights array<long>, left_most long")
    kept = both.where((F.size("lefts") > 0) & (F.col("right_most") < F.col("n")) & (F.col("left_most") < F.col("n")))
    # One row a language; its size is known when the join is planned.
    kept = stage(kept, "phrases").join(stage(totals, "totals"), "lang")

    def cut(k: Column) -> Column:
        left, right = F.element_at("lefts", k), F.element_at("rights", F.size("lefts") + 1 - k)
        over = F.lit(1000).cast("decimal(4,0)") * _whole(F.col("n"))
        return F.struct(_quotient(over * _whole(F.col("all_words")), _whole(left) * _whole(right)).alias("score"),
                        k.alias("k"), left.alias("l"), right.alias("r"))

    scored = kept.withColumn("cut", F.array_min(F.transform(F.sequence(F.lit(1), F.size("lefts")), cut)))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("n").desc(), "phrase")
    return (
        scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("n").alias("a"), "cut.l", "cut.r",
                F.col("all_words").alias("n"), "cut.score")
    )


def _quotient(over: Column, under: Column) -> Column:
    """The quotient of two whole decimals, rounded down."""
    return F.call_function("div", over, under)
