"""Token counts from two tables of lengths, without a shuffle of pre-tokens.

A compact hash table of the lengths of frequent pre-tokens is fitted on a bounded
sample of documents and broadcast. What it does not hold is encoded once per worker
and remembered there, within a bound. The sample only decides what is looked up
first: every text is counted whole.

A pre-token is here a run of white space with the word that follows it. The
pattern of the tokenizer cuts finer, but never across the border of two of them.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.parts import small_batches, spans, text_bytes, texts_of, tidy
from shelfmark.llm.words import Memory, WordTable, keys, sums, word_spans

SAMPLE_DOCUMENTS = 4096
FREQUENT = 1 << 14
# White space of the pattern that is not ASCII; where it occurs, words are cut by UNIT.
WIDE = "\u0085   -     　"
UNIT = re.compile(f"[\t-\r {WIDE}]*[^\t-\r {WIDE}]+|[\t-\r {WIDE}]+")


class TokenCounter:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        odd = [re.escape(s) for s in self.special] + [f"[{WIDE}]"]
        self.odd = "|".join(odd)
        self.cut = re.compile("|".join(odd[:-1])) if self.special else None
        self.memory = Memory(self._encode, np.int32)

    def _encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        coded = self.library.encode_batch_fast([u.decode() for u in units], add_special_tokens=False)
        return np.fromiter((len(c) for c in coded), np.int64, len(units)), np.ones(len(units), np.int64)

    def lengths(self, data, starts, ends, frequent) -> np.ndarray:
        """Tokens of each unit: from the broadcast table, else from the worker's memory."""
        table, sizes = frequent
        found = table.find(*keys(data, starts, ends))
        out = sizes[found].astype(np.int64)
        miss = np.flatnonzero(found < 0)
        if len(miss):
            out[miss] = self.memory.look_up(data, starts[miss], ends[miss])[0]
        return out

    def _plain(self, texts: pa.Array, frequent) -> np.ndarray:
        data, offsets = text_bytes(texts)
        starts, ends, at = word_spans(data, offsets, lead=True)
        return sums(self.lengths(data, starts, ends, frequent), at)

    def count(self, texts: pa.Array, frequent) -> np.ndarray:
        """Tokens of each text."""
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        out = np.zeros(len(texts), np.int64)
        out[~odd] = self._plain(texts.filter(pa.array(~odd)), frequent)
        for i in np.flatnonzero(odd):
            runs = self.cut.split(texts[i].as_py()) if self.cut else [texts[i].as_py()]
            units = [u for run in runs for u in UNIT.findall(run)]
            raw = b"".join(coded := [u.encode() for u in units])
            ends = np.cumsum([len(c) for c in coded], dtype=np.int64)
            if len(ends):
                starts = np.append(0, ends[:-1])
                out[i] = self.lengths(np.frombuffer(raw, np.uint8), starts, ends, frequent).sum()
            out[i] += len(runs) - 1
        return out


@functools.lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def fit_frequent(docs: DataFrame, path: str, texts: str = "text", sample: int = SAMPLE_DOCUMENTS, most: int = FREQUENT):
    """The hash table and lengths of at most ``most`` frequent units of about ``sample`` documents.

    Documents are drawn by a hash of their text and read whole. Each of eight tasks
    gives its most frequent units; nothing else reaches the driver.
    """
    text = F.col(f"`{texts}`")
    share = min(1.0, sample / max(1, docs.count()))
    drawn = docs.select(text.alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def frequent(batches):
        from collections import Counter

        seen: Counter = Counter()
        for batch in batches:
            column = texts_of(batch.column(0))
            for i, j in spans(column):
                data, offsets = text_bytes(column.slice(i, j - i))
                starts, ends, _ = word_spans(data, offsets, lead=True)
                whole = data.tobytes()
                seen.update(whole[a:b] for a, b in zip(starts, ends, strict=True) if b - a <= 64)
                if len(seen) > 64 * most:
                    seen = Counter(dict(seen.most_common(16 * most)))
        top = seen.most_common(most)
        yield pa.record_batch({"unit": pa.array([u for u, _ in top], pa.binary()),
                               "n": pa.array([n for _, n in top], pa.int64())})

    tops = drawn.repartition(8).mapInArrow(tidy(frequent), "unit binary, n long")
    total: dict[bytes, int] = {}
    for row in tops.collect():
        total[bytes(row.unit)] = total.get(bytes(row.unit), 0) + row.n
    units = sorted(total, key=lambda u: (-total[u], u))[:most]
    table = WordTable((2 * most - 1).bit_length())
    if not units:
        return table, np.zeros(1, np.uint16)
    ends = np.cumsum([len(u) for u in units], dtype=np.int64)
    a, b = keys(np.frombuffer(b"".join(units), np.uint8), np.append(0, ends[:-1]), ends)
    lengths, _ = counter(path)._encode(units)
    table.add(a, b, np.arange(len(units), dtype=np.int32))
    return table, lengths.astype(np.uint16)


def count_tokens(
    docs: DataFrame, path: str, limit: int = 1024, doc_id: str = "doc_id", texts: str = "text",
    sample: int = SAMPLE_DOCUMENTS, most: int = FREQUENT,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row of ``docs``, in the rows' own partitions.

    Null counts as an empty text and has no tokens; special strings of the file count
    as one token each, as the library counts them. Repeated rows are counted each,
    and an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[doc_id].dataType.simpleString()
    frequent = docs.sparkSession.sparkContext.broadcast(fit_frequent(docs, path, texts, sample, most))

    def run(batches):
        own = counter(path)
        for batch in batches:
            column = texts_of(batch.column(1))
            for i, j in spans(column):
                part = column.slice(i, j - i)
                n = own.count(part, frequent.value)
                yield pa.record_batch({
                    "doc_id": batch.column(0).slice(i, j - i), "n_bytes": pc.binary_length(part).cast(pa.int64()),
                    "n_tokens": pa.array(n, pa.int64()), "over_limit": pa.array(n > limit)})

    picked = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{texts}`"))
    return picked.mapInArrow(tidy(run), f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
