"""Texts of every awkward kind, and definitions in their plainest form."""

import re

import pytest

BASE = " ".join(f"word{i}" for i in range(120))


def shingled(text, n):
    """The distinct n-word shingles of a text, fewer words as one; the plain definition."""
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(w) >= n:
        return frozenset(zip(*(w[i:] for i in range(n))))
    return frozenset([tuple(w)] if w else [])


TEXTS = {
    1: None, 2: "", 3: " \t\n ", 4: "one", 5: "One", 6: BASE, 7: BASE.upper(), 8: BASE.replace("word60", "other"),
    9: BASE + " tail", 10: "é" * 40 + " ß ñandú İ Σ", 11: "x" * 70_000, 12: "ab " * 30_000,
    13: "<|endoftext|> and </s>[INST] \\ [/INST]", 14: "a  b  \n\nc\r\n", 15: BASE, 16: "one two", 17: "ONE TWO",
    18: "\n".join(["short line", BASE[:200], "last"]), 19: "😀 中文 العربية", 20: "pre " + BASE[:300] + " post",
}

SCHEMA = "doc_id long, text string, row string, part string, score string, n_chars long"

@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, a repeated row, and columns named like those used inside."""
    rows = [(d, t, "r", "p", "s", None) for d, t in TEXTS.items()] + [(15, BASE, "r", "p", "s", 1), (None, BASE, "r", "p", "s", 2)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
