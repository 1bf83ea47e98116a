"""Byte-pair encoding with a segment tree over the ranks of adjacent pairs.

The leaves hold the rank and place of each adjacent pair, every inner node the
smaller of its two children, so the root is the leftmost pair of the lowest rank.
A merge changes at most three leaves, each in as many steps as the tree is high: a
word of n symbols takes O(n log n), and words of any length are whole.

Words are found as the tokenizer's file says (normalizer, patterns, added tokens);
each different word is merged once per worker.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.parts import small_batches, spans, text_bytes, texts_of, tidy
from shelfmark.llm.words import Memory, ragged, sums, word_spans

NONE = np.int64(1) << np.int64(62)
# Words of up to this many symbols are merged side by side, longer ones one by one.
SIDE_BY_SIDE = 64


class Pairs:
    """The ranks of all pairs that merge, and the symbol each becomes."""

    def __init__(self, left: list[int], right: list[int], merged: list[int]):
        keys = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array(merged, np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE where it does not merge (symbols below 0 never do)."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)


def merge(symbols: np.ndarray, pairs: Pairs) -> np.ndarray:
    """Merge each row of ``symbols`` (filled up with -1) to its end, all rows side by side.

    Every row has its own tree. A round takes the root of each row that still has a
    pair, merges there and puts up to three leaves right, from the leaf to the root.
    """
    rows, n = symbols.shape
    width = 1 << max(0, n - 2).bit_length() if n > 1 else 1
    high = width.bit_length() - 1
    sym = np.full((rows, width + 2), -1, np.int64)
    sym[:, :n] = symbols
    places = np.arange(width, dtype=np.int64)
    ranks = pairs.rank(sym[:, :width], sym[:, 1:width + 1])
    tree = np.full((rows, 2 * width), NONE, np.int64)
    tree[:, width:] = np.where(ranks == NONE, NONE, ranks << 32 | places)
    for level in range(high - 1, -1, -1):
        lo = 1 << level
        tree[:, lo:2 * lo] = np.minimum(tree[:, 2 * lo:4 * lo:2], tree[:, 2 * lo + 1:4 * lo:2])
    after = np.tile(np.arange(1, width + 3, dtype=np.int64), (rows, 1))
    before = np.tile(np.arange(-1, width + 1, dtype=np.int64), (rows, 1))

    def put(at: np.ndarray, place: np.ndarray, value: np.ndarray) -> None:
        node = width + place
        tree[at, node] = value
        for _ in range(high):
            node >>= 1
            tree[at, node] = np.minimum(tree[at, 2 * node], tree[at, 2 * node + 1])

    def leaf(at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        rank = pairs.rank(sym[at, left], sym[at, right])
        return np.where(rank == NONE, NONE, rank << 32 | left)

    live = np.flatnonzero(tree[:, 1] != NONE)
    while len(live):
        root = tree[live, 1]
        i = root & 0xFFFFFFFF
        j = after[live, i]
        k = np.minimum(after[live, j], width + 1)
        sym[live, i] = pairs.merged[root >> 32]
        sym[live, j] = -1
        after[live, i] = k
        before[live, k] = i
        inner = np.flatnonzero(j < width)
        put(live[inner], j[inner], np.full(len(inner), NONE))
        put(live, i, leaf(live, i, k))
        h = before[live, i]
        inner = np.flatnonzero(h >= 0)
        put(live[inner], h[inner], leaf(live[inner], h[inner], i[inner]))
        live = live[tree[live, 1] != NONE]
    return sym


class WordCodec:
    """Encodes words as the tokenizer in a file does, merging by the segment tree.

    For tokenizers whose words never reach across ASCII white space and whose
    normalizer drops it: then the tokens of a text are those of its words.
    """

    # What the file's pattern finds in lower-cased text of code points below LATIN_END: letters and numbers as
    # Unicode has them there, which no later version has changed; such text is in its normal form.
    LATIN_END = "\u0250"
    LETTERS = "".join(chr(c) for c in range(0xA1, 0x250) if category(chr(c)).startswith("L"))
    NUMBERS = "".join(chr(c) for c in range(0xA1, 0x250) if category(chr(c)).startswith("N"))
    LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LETTERS}]+|[0-9{NUMBERS}]|[^\x09-\x0d\x20a-z0-9{LETTERS}{NUMBERS}]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # The library's tables of Unicode normalisation and letter classes; without words it does not merge.
        library = Tokenizer.from_str(json.dumps({**spec, "model": {**spec["model"], "vocab": {}, "merges": []}, "added_tokens": []}))
        self.normal, self.words = library.normalizer, library.pre_tokenizer
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        suffix = model["end_of_word_suffix"] or ""
        # The alphabet names bytes by characters: most printable ones by themselves, the others from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.to_byte = {ord(c): b for b, c in names.items()}
        self.inner = np.array([vocab[names[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[names[b] + suffix] for b in range(256)], np.int64)
        merges = model["merges"]
        self.pairs = Pairs([vocab[a] for a, _ in merges], [vocab[b] for _, b in merges],
                           [vocab[a + b] for a, b in merges])
        strings = {i: s for s, i in (vocab | self.added).items()}
        self.size = max(strings) + 1
        self.strings = pa.array([(strings.get(i, "") + " ").encode() for i in range(self.size)], pa.large_binary())
        self.memory = Memory(self._encode, np.int32)

    def pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one piece after the other, and how many each has."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(sizes)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.last[raw[ends - 1]]
        width = np.maximum(1, 1 << np.ceil(np.log2(np.maximum(1, sizes - 1))).astype(np.int64)) + 1
        width[sizes > SIDE_BY_SIDE] = 0
        owners, found, counts = [], [], []
        for w in np.unique(width):
            group = np.flatnonzero(width == w)
            step = 4096 if w else 1
            for rows in (group[i:i + step] for i in range(0, len(group), step)):
                at = np.arange(sizes[rows].max())
                inside = at < sizes[rows][:, None]
                block = np.full(inside.shape, -1, np.int64)
                block[inside] = symbols[((ends - sizes)[rows][:, None] + at)[inside]]
                merged = merge(block, self.pairs)
                left = merged >= 0
                owners.append(rows)
                found.append(merged[left])
                counts.append(left.sum(axis=1))
        order = np.argsort(np.concatenate(owners))
        counts = np.concatenate(counts)
        starts = np.cumsum(counts) - counts
        return ragged(np.concatenate(found), starts[order], counts[order]), counts[order]

    def _found(self, word: str) -> list[bytes]:
        low = word.lower()
        # Some capitals below LATIN_END become letters above it.
        if word.isprintable() and max(word) < self.LATIN_END and max(low) < self.LATIN_END and "\u0130" not in word:
            return [p.encode() for p in self.LATIN.findall(low)]
        found = self.words.pre_tokenize_str(self.normal.normalize_str(word))
        return [w.translate(self.to_byte).encode("latin-1") for w, _ in found]

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one word after the other, and how many each has."""
        # Added tokens come first; their place in the list of pieces is below that of all others.
        special = {s: i for i, s in enumerate(self.added)}
        index: dict[bytes, int] = {}
        flat: list[int] = []
        counts = np.zeros(len(words), np.int64)
        for n, raw in enumerate(words):
            word = raw.decode()
            if self.cut is not None and "<|" in word:
                plan = []
                for run in filter(None, self.cut.split(word)):
                    if run in special:
                        plan.append(special[run])
                    else:
                        plan += [index.setdefault(p, len(special) + len(index)) for p in self._found(run)]
            else:
                plan = [index.setdefault(p, len(special) + len(index)) for p in self._found(word)]
            flat += plan
            counts[n] = len(plan)
        values, sizes = self.pieces(list(index)) if index else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        values = np.concatenate([np.array(list(self.added.values()), np.int64), values])
        sizes = np.concatenate([np.ones(len(special), np.int64), sizes])
        at = np.array(flat, np.int64)
        ids = ragged(values, (np.cumsum(sizes) - sizes)[at], sizes[at])
        return ids, sums(sizes[at], np.concatenate([[0], np.cumsum(counts)]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and where each text's ids begin and the last end."""
        data, offsets = text_bytes(texts)
        starts, ends, at = word_spans(data, offsets)
        ids, sizes = self.memory.look_up(data, starts, ends)
        return ids.astype("<u4"), np.concatenate([[0], np.cumsum(sizes)])[at]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> Iterator[memoryview]:
        """Each text's tokens with a blank between, as the library does where a file names no decoder."""
        picked = self.strings.take(pa.array(ids))
        ends = np.frombuffer(picked.buffers()[1], np.int64)[:len(ids) + 1]
        data = picked.buffers()[2] or b""
        view = memoryview(data)
        for i, j in zip(ends[offsets[:-1]], ends[offsets[1:]], strict=True):
            yield view[i:max(i, j - 1)]


@functools.lru_cache(maxsize=2)
def codec(path: str) -> WordCodec:
    return WordCodec(path)


def encode_texts(docs: DataFrame, path: str, doc_id: str = "doc_id", texts: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit, binary) and decoded text of each row of ``docs``.

    Null counts as empty and has no ids; rows are independent of each other, so
    repeated rows give repeated results and an empty table an empty one.
    """
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        own = codec(path)
        for batch in batches:
            column = texts_of(batch.column(1))
            for i, j in spans(column):
                ids, at = own.encode(column.slice(i, j - i))
                raw = memoryview(ids).cast("B")
                yield pa.record_batch({
                    "doc_id": batch.column(0).slice(i, j - i),
                    "ids": pa.array([raw[4 * a:4 * b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
                    "decoded": pa.array([bytes(t) for t in own.decode(ids, at)], pa.binary()).cast(pa.string()),
                })

    small_batches(docs.sparkSession)
    picked = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{texts}`"))
    return picked.mapInArrow(tidy(run), f"doc_id {id_type}, ids binary, decoded string")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of ``encode_texts``, hashed where they are made."""
    return encode_texts(docs, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
