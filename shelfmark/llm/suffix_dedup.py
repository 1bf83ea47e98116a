"""Repeated passages across documents, by blockwise suffix sorting.

Every string of LENGTH bytes has an anchor, the gram of least hash in it, so equal
strings have equal anchors at equal places. Parts exchange the hashes of their
anchors, compressed; what occurs once in the corpus is done with. Around each shared
anchor a part cuts out a row of bytes that holds all strings it is the anchor of, sends
each different row once, and the suffixes of the rows that share anchors are sorted
block by block (see ``cover``): strings that are the same become neighbours, and the
smallest doc_id among them decides. Texts themselves stay where they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import cover, exchange
from shelfmark.llm.parts import PartTable, binary, spans, text_bytes, texts_of, tidy
from shelfmark.llm.words import mix
from shelfmark.sources.staging import hand_out, scope, stage

LENGTH = 50
GRAM = 16
PLACES = LENGTH - GRAM + 1
BEFORE = PLACES - 1
ROW = BEFORE + LENGTH
KEY_BITS = 48
BYTES_PER_OWNER = 1 << 23
# Documents of a part, and rows whose suffixes are sorted at a time (more only if they share one anchor):
# the memory of a task follows them, and neither partitions of the input nor the share of text that is repeated.
PART_ROWS = 1 << 12
SORT_ROWS = 1 << 16
# Rows of this much text are cut out and reduced at a time.
BLOCK_BYTES = 1 << 20
RECORD = "part int, owner int, rows binary, lo binary, hi binary, least binary, sizes binary, at binary, place binary, later binary"
REPLY = "part int, at binary, place binary, mask binary"


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on."""
    eights = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data).data, strides=(1,))
    n = len(data) - GRAM + 1
    h = eights[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h += eights[8:8 + n]
    return mix(h)


def anchors(texts: pa.Array):
    """The anchors of a run of texts: text, place, first and end of the strings it is the anchor of, key.

    Places count within the text. Texts shorter than LENGTH have none.
    """
    data, offsets = text_bytes(texts)
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none.astype(np.uint64)
    hashes = _gram_hashes(data)
    # Hash and place in one number, so that the least one names its place; ties go to the first.
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= PLACES:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    more = PLACES - width
    least = np.minimum(least[:len(least) - more], least[more:])
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))[:len(least)]
    start = np.arange(len(least))
    inside = start + LENGTH <= offsets[owner + 1]
    start, owner = start[inside], owner[inside]
    place = (least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(start):
        return none, none, none, none, none.astype(np.uint64)
    new = np.append(True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    text, p = owner[first], place[first]
    base = offsets[text]
    # Anchors have small hashes; mixed again they are spread evenly over the owners.
    key = mix(hashes[p] + np.uint64(1)) >> np.uint64(64 - KEY_BITS)
    return text, p - base, start[first] - base, start[last] + 1 - base, key


def _active(part: pa.Table, other: pa.Table) -> pa.Table:
    """The rows of a part that are not copies of a document with a smaller doc_id."""
    return part.filter(pa.array(~np.isin(part.column("row").to_numpy(), other.column("row").to_numpy())))


def _send_keys(owners: int):
    def send(part: pa.Table, copies: pa.Table) -> pa.Table:
        own = part.column("part")[0].as_py() if part.num_rows else 0
        texts = texts_of(_active(part, copies).column("text"))
        distinct, twice = np.zeros(0, np.uint64), np.zeros(0, bool)
        held = []
        for i, j in spans(texts):
            text, _, _, _, key = anchors(texts.slice(i, j - i))
            order = np.lexsort((text, key))
            key, text = key[order], text[order]
            new = np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1])) if len(key) else np.zeros(0, bool)
            held.append(key[new])  # once per text
        if held:
            distinct, counts = np.unique(np.concatenate(held), return_counts=True)
            twice = counts > 1
        return exchange.messages(own, distinct, twice, owners, KEY_BITS)

    return send


def _rows_of(texts: pa.Array, shared: np.ndarray):
    """Per shared anchor of some texts: the row around it with its first and last string's places, text, place, key."""
    text, p, first, end, key = anchors(texts)
    at = np.minimum(np.searchsorted(shared, key), max(0, len(shared) - 1))
    hit = np.flatnonzero(shared[at] == key) if len(shared) else at[:0]
    if not len(hit):
        return None
    data, offsets = text_bytes(texts)
    padded = np.concatenate([np.zeros(BEFORE, np.uint8), data, np.zeros(LENGTH, np.uint8)])
    text, p, first, end = text[hit], p[hit], first[hit], end[hit]
    whole = np.empty((len(hit), ROW + 2), np.uint8)
    whole[:, :ROW] = np.lib.stride_tricks.sliding_window_view(padded, ROW)[offsets[text] + p]
    # Only the bytes of the strings it is the anchor of count.
    left, last = first - p + BEFORE, end - p + BEFORE
    column = np.arange(ROW)
    whole[:, :ROW][(column < left[:, None]) | (column >= last[:, None] - 1 + LENGTH)] = 0
    whole[:, ROW], whole[:, ROW + 1] = left, last
    return whole, text, p, key[hit]


def _send_rows(owners: int):
    """Each different row around the shared anchors of a block of texts, with the places it stands at."""

    def send(part: pa.Table, answers: pa.Table) -> pa.Table:
        own = part.column("part")[0].as_py() if part.num_rows else 0
        ids = part.column("doc_id").to_numpy()
        copied = answers.column("row").drop_null().to_numpy()
        index = np.flatnonzero(~np.isin(part.column("row").to_numpy(), copied))
        texts = texts_of(part.column("text").take(pa.array(index)))
        distinct = np.unique(np.concatenate(
            [np.zeros(0, np.uint64), *[np.unique(anchors(texts.slice(i, j - i))[4]) for i, j in spans(texts)]]))
        told = answers.filter(answers.column("owner").is_valid())
        shared = distinct[exchange.marked(distinct, told, owners, KEY_BITS)]
        out = [_record(own, *[np.zeros((0, ROW + 2) if i == 0 else 0, np.int64) for i in range(5)])]
        for i, j in spans(texts, BLOCK_BYTES):
            found = _rows_of(texts.slice(i, j - i), shared)
            if found is not None:
                whole, text, place, key = found
                at = index[i + text]
                # Rows that are the same, with the same strings, are sent once with their smallest doc_id.
                _, same = np.unique(whole.view(f"V{ROW + 2}").ravel(), return_inverse=True)
                owner = exchange.owner_of(key, owners, KEY_BITS)
                order = np.lexsort((ids[at], same, owner))
                out.append(_record(own, whole[order], owner[order], at[order], place[order], ids[at][order]))
        return pa.concat_tables(out)

    return send


def _record(part: int, whole, owner, at, place, doc) -> pa.Table:
    new = np.append(True, (whole[1:] != whole[:-1]).any(axis=1) | (owner[1:] != owner[:-1]))[:len(whole)]
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(whole)))
    later = (doc > np.repeat(doc[first], sizes)).astype(np.uint8)
    out = []
    edges = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[:len(whole)])
    ends = np.append(edges, len(owner))[1:]
    for a, b, c, d in zip(edges, ends, np.searchsorted(first, edges), np.searchsorted(first, ends), strict=True):
        u = first[c:d]
        out.append((
            int(owner[a]), whole[u, :ROW].tobytes(), whole[u, ROW].tobytes(), whole[u, ROW + 1].tobytes(), doc[u].astype("<i8").tobytes(),
            sizes[c:d].astype("<u4").tobytes(), at[a:b].astype("<u4").tobytes(),
            place[a:b].astype("<u4").tobytes(), later[a:b].tobytes()))
    names = ["rows", "lo", "hi", "least", "sizes", "at", "place", "later"]
    return pa.table({"part": pa.array([part] * len(out), pa.int32()), "owner": pa.array([o[0] for o in out], pa.int32()),
                     **{c: binary([o[i + 1] for o in out]) for i, c in enumerate(names)}})


def _by_anchor(rows: np.ndarray, most: int) -> list[np.ndarray]:
    """The places of the rows in groups of about ``most``; rows around the same anchor are in one group."""
    if len(rows) <= most:
        return [np.arange(len(rows))]
    grams = np.ascontiguousarray(rows[:, BEFORE:BEFORE + GRAM]).view("<u8")
    code = mix(grams[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ mix(grams[:, 1] + np.uint64(1)))
    group = exchange.owner_of(code, -(-len(rows) // most), 64)
    order = np.argsort(group, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(group[order])) + 1)


def _sort_rows(received: pa.Table) -> pa.Table:
    """Per message, the places of its rows and which of their strings stand in a smaller document."""
    def joined(name, dtype):
        return [np.frombuffer(b, dtype) for b in received.column(name).to_pylist()]

    counts = [len(x) for x in joined("lo", np.uint8)]
    rows = np.concatenate([r.reshape(-1, ROW) for r in joined("rows", np.uint8)])
    lo, hi = np.concatenate(joined("lo", np.uint8)), np.concatenate(joined("hi", np.uint8))
    least = np.concatenate(joined("least", "<i8"))
    earlier = np.zeros(len(rows), np.uint64)
    # Strings that are the same have the same anchor, so each group of anchors is sorted by itself.
    for some in _by_anchor(rows, SORT_ROWS):
        for at, members, begins in cover.buckets(rows[some], lo[some], hi[some], PLACES, LENGTH):
            members = some[members]
            classes = np.cumsum(begins) - 1
            smallest = np.minimum.reduceat(least[members], np.flatnonzero(begins))[classes]
            earlier[members] |= (smallest < least[members]).astype(np.uint64) << np.uint64(at)
    full = (np.uint64(1) << hi.astype(np.uint64)) - (np.uint64(1) << lo.astype(np.uint64))
    out = []
    ends = np.cumsum(counts)
    for part, a, b, sizes, at, place, later in zip(
            received.column("part").to_pylist(), ends - counts, ends, joined("sizes", "<u4"), joined("at", "<u4"),
            joined("place", "<u4"), joined("later", np.uint8), strict=True):
        # What a row's smallest document does not have from a smaller one, its other documents have from it.
        mask = np.where(later > 0, np.repeat(full[a:b], sizes), np.repeat(earlier[a:b], sizes))
        hit = mask > 0
        if hit.any():
            out.append((part, at[hit].tobytes(), place[hit].tobytes(), mask[hit].astype("<u8").tobytes()))
    return pa.table({"part": pa.array([o[0] for o in out], pa.int32()),
                     **{c: binary([o[i + 1] for o in out]) for i, c in enumerate(["at", "place", "mask"])}})


def _remove(part: pa.Table, replies: pa.Table) -> pa.Table:
    """Each text without the bytes that are covered."""
    texts = texts_of(part.column("text"))
    copied = set(replies.filter(replies.column("mask").is_null()).column("row").to_pylist())
    told = replies.filter(replies.column("mask").is_valid())
    at = np.concatenate([np.zeros(0, "<u4"), *[np.frombuffer(b, "<u4") for b in told.column("at").to_pylist()]]).astype(np.int64)
    place = np.concatenate([np.zeros(0, "<u4"), *[np.frombuffer(b, "<u4") for b in told.column("place").to_pylist()]]).astype(np.int64)
    mask = np.concatenate([np.zeros(0, "<u8"), *[np.frombuffer(b, "<u8") for b in told.column("mask").to_pylist()]])
    order = np.argsort(at, kind="stable")
    at, place, mask = at[order], place[order], mask[order]
    cuts = np.searchsorted(at, np.arange(len(texts) + 1))
    sizes, removed, runs, kept = [], [], [], []
    for i, (row, raw) in enumerate(zip(part.column("row").to_pylist(), texts.cast(pa.binary()), strict=True)):
        data = np.frombuffer(raw.as_buffer(), np.uint8)
        sizes.append(len(data))
        a, b = cuts[i], cuts[i + 1]
        if row in copied and len(data) >= LENGTH:
            removed.append(len(data))
            runs.append(1)
            kept.append(b"")
        elif a == b:
            removed.append(0)
            runs.append(0)
            kept.append(raw.as_py())
        else:
            bits = (mask[a:b, None] >> np.arange(PLACES, dtype=np.uint64)) & np.uint64(1)
            j, o = np.nonzero(bits)
            starts = place[a:b][j] + o - BEFORE
            delta = np.zeros(len(data) + 1, np.int64)
            np.add.at(delta, starts, 1)
            np.add.at(delta, starts + LENGTH, -1)
            gone = np.cumsum(delta[:-1]) > 0
            removed.append(int(gone.sum()))
            runs.append(int((gone[1:] & ~gone[:-1]).sum() + gone[0]))
            kept.append(data[~gone].tobytes())
    return pa.table({"row": part.column("row"), "n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                     "n_spans": pa.array(runs, pa.int64()), "kept": binary(kept)})


def _digests(part: pa.Table) -> pa.Table:
    raw = texts_of(part.column("text")).cast(pa.binary())
    return pa.table({"row": part.column("row"), "part": part.column("part"), "doc_id": part.column("doc_id"),
                     "size": pa.array([len(t.as_buffer()) for t in raw], pa.int64()),
                     "digest": binary([hashlib.sha256(t.as_buffer()).digest() for t in raw])})


def remove_repeats(table: PartTable) -> DataFrame:
    """Per row of ``table`` (doc_id, text): row, n_bytes, n_removed, n_spans, kept (the bytes left)."""
    least = -(1 << 63)
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(least))
    kind = f"row long, part int, doc_id {table.kind('doc_id')}, size long, digest binary"
    signed = stage(table.each(["doc_id", "text"], _digests, kind).withColumn("doc_id", number), "digests")
    # Whole copies need no suffixes: all their strings start in the smallest document as well.
    firsts = stage(signed.groupBy("digest").agg(F.min("doc_id").alias("first")), "firsts")
    copies = stage(signed.join(firsts, "digest").where("doc_id > first").select("part", "row"), "copies")
    owners = max(1, -(-(signed.agg(F.sum("size")).first()[0] or 0) // BYTES_PER_OWNER))
    keys = table.each_with(["doc_id", "text"], copies, _send_keys(owners), exchange.MESSAGE)
    answers = stage(keys.groupBy("owner").applyInArrow(tidy(exchange.judge), exchange.ANSWER), "marks")
    nothing = F.lit(None).cast("binary")
    told = answers.withColumn("row", F.lit(None).cast("long")).unionByName(
        copies.select("part", F.lit(None).cast("int").alias("owner"), nothing.alias("marks"), "row"))
    rows = table.each_with(["doc_id", "text"], told, _send_rows_of(owners, least), RECORD)
    replies = stage(rows.groupBy("owner").applyInArrow(tidy(_sort_rows), REPLY), "masks")
    said = replies.withColumn("row", F.lit(None).cast("long")).unionByName(
        copies.select("part", nothing.alias("at"), nothing.alias("place"), nothing.alias("mask"), "row"))
    return table.each_with(["text"], said, _remove, "row long, n_bytes long, n_removed long, n_spans long, kept binary")


def _send_rows_of(owners: int, least: int):
    send = _send_rows(owners)

    def run(part: pa.Table, answers: pa.Table) -> pa.Table:
        at = part.schema.get_field_index("doc_id")
        return send(part.set_column(at, "doc_id", part.column("doc_id").cast(pa.int64()).fill_null(least)), answers)

    return run


def suffix_duplicates(docs: DataFrame, doc_id: str = "doc_id", texts: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (binary).

    Each byte goes that a string of LENGTH bytes covers which also starts in a document
    with a smaller doc_id (a whole number; null counts as the smallest). Strings are
    judged on the texts as they came. Null and empty texts have no bytes; rows of one
    doc_id do not count against each other; an empty table gives an empty result.
    """
    with scope():
        table = PartTable(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{texts}`").alias("text")), "suffix", PART_ROWS)
        with scope():
            cut = hand_out(remove_repeats(table), "cut")
        return hand_out(table.pick(["doc_id"]).select("row", "doc_id").join(cut, "row").drop("row"), "suffix")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, any others) with the repeats cut out of text; a character cut in two goes whole.

    Where there is a column n_chars, it is set anew. Documents keep their rows, also with nothing left.
    """
    with scope():
        table = PartTable(docs, "suffix", PART_ROWS)
        with scope():
            cut = hand_out(remove_repeats(table).where("n_removed > 0").select("row", "kept"), "cut")
        place = f"c{table.columns.index('text')}"

        def put(part: pa.Table, changed: pa.Table) -> pa.Table:
            new = dict(zip(changed.column("row").to_pylist(), changed.column("kept").to_pylist(), strict=True))
            texts = [new[r].decode("utf-8", "ignore") if r in new else t
                     for r, t in zip(part.column("row").to_pylist(), part.column(place).to_pylist(), strict=True)]
            return part.set_column(part.schema.get_field_index(place), place, pa.array(texts, pa.string()))

        out = table.rewrite(cut.withColumn("part", table.part_of("row")), put)
        if "n_chars" in table.columns:
            out = out.withColumn("n_chars", F.char_length("text").cast(table.kind("n_chars")))
        return hand_out(out, "cut", "zstd")
