"""The stages of the corpus pipeline, each against its plain definition on its own input."""

from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest
from plain import TEXTS, no_docs, odd_docs, shingled  # noqa: F401
from pyspark.sql import functions as F

from shelfmark.sources.staging import scratch_path, stage


@pytest.fixture(scope="module")
def steps(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [("documents", docs)]
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, folder), name)
        out.append((name, docs))
    return dict(out)


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_columns_stay(steps):
    assert all(df.columns == steps["documents"].columns for n, df in steps.items() if n != "packing")


def test_quality(spark, folder, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = texts(steps["quality"])
    before = texts(steps["documents"])
    assert kept.items() <= before.items()
    right = [(d in kept) == (labels[d] == 1) for d in before if d in labels]
    assert np.mean(right) >= 0.97
    assert np.mean([d in kept for d in before if labels.get(d) == 1]) >= 0.99


def plain_exact(before):
    last = {}
    for d, t in before:
        t = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        last[t] = max(last.get(t, d), d, key=lambda x: -1 if x is None else x)
    return set(last.values())


def plain_near(before):
    sets = {d: shingled(t, 5) for d, t in before.items()}
    by_shingle = {}
    for d, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, set()).add(d)
    near = {d: {e for x in s for e in by_shingle[x] if e != d and 100 * len(s & sets[e]) >= 80 * len(s | sets[e])} for d, s in sets.items()}
    seen, wanted = set(), set()
    for d in sorted(sets):
        if d not in seen:
            wanted.add(d)
            group = {d}
            while group:
                e = group.pop()
                seen.add(e)
                group |= near[e] - seen
    return wanted


def test_exact(steps):
    assert set(texts(steps["exact_dedup"])) == plain_exact(texts(steps["quality"]).items())


def test_near(steps):
    assert set(texts(steps["near_dedup"])) == plain_near(texts(steps["exact_dedup"]))


def test_passages(steps):
    first, expected = {}, {}
    before = texts(steps["near_dedup"])
    for d in sorted(before):
        raw = (before[d] or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49):
            if first.setdefault(raw[i:i + 50], d) < d:
                gone[i:i + 50] = True
        expected[d] = before[d] if not gone.any() else np.frombuffer(raw, np.uint8)[~gone].tobytes().decode("utf-8", "ignore")
    assert texts(steps["suffix_dedup"]) == expected
    assert steps["suffix_dedup"].where(F.col("n_chars") != F.char_length("text")).count() == 0


def test_packing(steps):
    pieces = steps["packing"].collect()
    assert {p.doc_id for p in pieces} == set(texts(steps["suffix_dedup"]))
    lengths = {}
    for p in pieces:
        lengths[p.sequence_id] = lengths.get(p.sequence_id, 0) + p.length
    assert sorted(lengths) == list(range(len(lengths)))
    assert all(n == 4096 for s, n in lengths.items() if s < max(lengths))


def test_run_gives_the_stages_rows(spark, folder, steps):
    assert sorted(corpus_pipeline.run(spark, folder).collect()) == sorted(steps["packing"].collect())


def scratch(spark):
    folder = Path(scratch_path(spark, "x")).parent
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


def test_run_over_odd_rows_leaves_nothing_behind(spark, odd_docs, tmp_path):
    docs = odd_docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.when(F.col("doc_id") > 9, "web"), "predicted": F.lit(1)})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    # Without labels every document scores one half and stays.
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    before, tables = scratch(spark), {t.name for t in spark.catalog.listTables()}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    alone = plain_exact((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    left = {d: TEXTS[d] for d in alone}
    assert {p.doc_id for p in pieces} == plain_near(left)
    assert sum(p.length for p in pieces if p.doc_id == 2) == 1  # an empty text is its end id
    assert [n.split("-")[0] for n in scratch(spark) - before] == ["packing"]
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_run_over_no_rows(spark, no_docs, tmp_path):
    no_docs.withColumns({"lang": F.lit("en"), "source": F.lit("web")}).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
