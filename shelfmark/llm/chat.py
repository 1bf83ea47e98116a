"""Conversations as training text: rendered by a template, with the spans to learn."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfmark.llm.templates import compile_template

TEMPLATE = (
    "{% for m in messages %}{% if m.role == 'user' %}[INST] {{ m.text | escape }} [/INST]"
    "{% elif m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE] {{ m.role | escape }} [TEXT] {{ m.text | escape }} [/ROLE]{% endif %}{% endfor %}")
CONTROL = ("[INST]", "[/INST]", "</s>", "<s>", "[ROLE]", "[TEXT]", "[/ROLE]")
# A backslash goes behind the first character of a control string, and each backslash becomes two:
# then no control string is left in the text, and taking the marks away gives the text back.
_INSIDE = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL) + r"|\\")
_MARKED = re.compile(r"\\(.?)", re.DOTALL)
_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]|\[ROLE\] (?P<role>.*?) \[TEXT\] (?P<other>.*?) \[/ROLE\]|(?P<assistant>.*?)</s>",
    re.DOTALL)
CHUNK = 1 << 20


def escape(text: str | None) -> str:
    return _INSIDE.sub(lambda m: m[0] + "\\", text or "")


def unescape(text: str) -> str:
    # A doubled backslash is one; any other stands behind a character that stays.
    return _MARKED.sub(lambda m: "\\" if m[1] == "\\" else m[1], text)


@functools.lru_cache(maxsize=8)
def renderer(template: str):
    return compile_template(template, {"escape": escape})


def turns(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn, read back from what TEMPLATE made of whole turns."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError("this is not what the template makes")
        at = m.end()
        if m["user"] is not None:
            yield "user", unescape(m["user"])
        elif m["role"] is not None:
            yield unescape(m["role"]), unescape(m["other"])
        else:
            yield "assistant", unescape(m["assistant"])


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def format_chats(rows: DataFrame, template: str = TEMPLATE, chunk: int = CHUNK) -> DataFrame:
    """conv_id, chunk, text, spans: the rendered conversations of rows (conv_id, turn, role, text).

    Rows are taken by turn, ties by role and text; null texts are empty, a null role is
    the empty role, null turns come first, and rows without conv_id are one
    conversation; a conv_id may be a number of any kind, a text or a date. Repeated
    rows are turns of their own; an empty table gives no row.
    Other columns do not matter.

    ``spans`` are the code points [begin, end) of the conversation that lie under
    {% generation %}. A conversation of more than ``chunk`` characters comes in several
    rows, cut between turns; they follow one another in a partition. So a conversation
    of any length streams through its task turn by turn.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    sorted_rows = (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text"))

    def chunks(conversation, messages):
        """Pieces gathered into chunks that begin with a turn: ``fed`` counts the messages taken."""
        fed = 0

        def feed():
            nonlocal fed
            for _, r, t in messages:
                fed += 1
                yield {"role": r, "text": t}

        number, done, size, pieces, spans, seen = 0, 0, 0, [], [], 0
        for piece, generated in renderer(template)(messages=feed()):
            if fed != seen:
                seen = fed
                if size >= chunk:
                    yield conversation, number, "".join(pieces), spans
                    number, done, size, pieces, spans = number + 1, done + size, 0, [], []
            if generated:
                spans.append((done + size, done + size + len(piece)))
            pieces.append(piece)
            size += len(piece)
        yield conversation, number, "".join(pieces), spans

    def run(batches):
        held: list[tuple] = []
        for conversation, messages in groupby(_rows(batches), key=itemgetter(0)):
            for row in chunks(conversation, messages):
                held.append(row)
                if len(held) >= 512 or len(row[2]) >= chunk:
                    yield _batch(held)
                    held = []
        if held:
            yield _batch(held)

    id_type = to_arrow_type(rows.schema["conv_id"].dataType)

    def _batch(held):
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.record_batch({
            "conv_id": pa.array([h[0] for h in held], id_type), "chunk": pa.array([h[1] for h in held], pa.int32()),
            "text": pa.array([h[2] for h in held], pa.string()),
            "spans": pa.array([[{"begin": a, "end": b} for a, b in h[3]] for h in held], span)})

    return sorted_rows.mapInArrow(run, f"conv_id {kind}, chunk int, text string, spans array<struct<begin: bigint, end: bigint>>")


def read_back(chats: DataFrame) -> DataFrame:
    """Digests of what ``format_chats`` made with TEMPLATE, all read from the rendered text and its spans.

    conv_id, n_turns, turns_sha256 (role, line feed, text, line feed per turn),
    loss_chars and loss_sha256 (the text under the spans), formatted_chars.
    """
    kind = chats.schema["conv_id"].dataType.simpleString()

    def run(batches):
        out = []
        for conversation, rows in groupby(_rows(batches), key=itemgetter(0)):
            n, loss_chars, done, all_turns, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            for _, _, text, spans in rows:
                for role, said in turns(text):
                    n += 1
                    all_turns.update(f"{role}\n{said}\n".encode())
                for span in spans:
                    learnt = unescape(text[span["begin"] - done:span["end"] - done])
                    loss_chars += len(learnt)
                    loss.update(learnt.encode())
                done += len(text)
            out.append((conversation, n, all_turns.hexdigest(), loss_chars, loss.hexdigest(), done))
        if out:
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    id_type = to_arrow_type(chats.schema["conv_id"].dataType)
    return chats.mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chat_digests(rows: DataFrame) -> DataFrame:
    return read_back(format_chats(rows))
