import pytest
from pyspark.sql import functions as F

from shelfmark.sources.staging import scratch_path
from shelfmark.streaming import history as hs

from conftest import rows


def _events(spark, n=200):
    ts = (F.lit("2024-01-01 00:00:00").cast("timestamp").cast("long") + F.col("id") * 600).cast("timestamp")
    return spark.range(n).select(F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 3).alias("k"))


def test_append_never_truncates(spark, tmp_path):
    path = str(tmp_path / "h")
    df = _events(spark)
    hs.append_history(df.where("event_id < 50"), path, "ts")
    hs.append_history(df.where("event_id >= 50"), path, "ts")
    hs.append_history(df.where("event_id < 5"), path, "ts")
    assert hs.read_history(spark, path).count() == 205
    recent = hs.read_history(spark, path, since="2024-01-02")
    assert recent.count() == 56
    assert "PartitionFilters: [isnotnull(collected_day" in recent._jdf.queryExecution().toString()


def test_latest_snapshot(spark):
    df = _events(spark)
    assert sorted(rows(hs.latest_snapshot(df, ["k"], "ts").select("k", "event_id"))) == [(0, 198), (1, 199), (2, 197)]


def test_period_delta_skips_empty_periods(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:10:00", 1.0), ("2024-01-01 00:50:00", 2.0), ("2024-01-01 05:00:00", 4.0)],
        "t string, v double").withColumn("t", F.to_timestamp("t"))
    got = hs.period_delta(df, "t", "1 hour", value="v").orderBy("period_start").select("n", "total", "delta", "total_delta")
    assert rows(got) == [(2, 3.0, None, None), (1, 4.0, -1, 1.0)]


def test_period_delta_across_stretches(spark, monkeypatch):
    monkeypatch.setattr(hs, "STRETCH", 3)
    df = _events(spark, 120).where("event_id % 24 < 15")
    got = hs.period_delta(df, "ts", "1 hour", ["k"], value="event_id").orderBy("k", "period_start").collect()
    for before, now in zip([None, *got], got):
        first = before is None or before["k"] != now["k"]
        assert now["delta"] == (None if first else now["n"] - before["n"])
        assert now["total_delta"] == (None if first else now["total"] - before["total"])


@pytest.mark.parametrize("stretch", [1, 2, 3, 5, 1000])
def test_period_delta_of_null_sums_in_any_stretch(spark, monkeypatch, stretch):
    monkeypatch.setattr(hs, "STRETCH", stretch)
    df = _events(spark, 240).withColumn("v", F.when((F.col("event_id") / 6).cast("int") % 4 != 1, F.col("event_id") * F.col("event_id")))
    got = hs.period_delta(df, "ts", "1 hour", ["k"], value="v").orderBy("k", "period_start").collect()
    assert any(r["total"] is None for r in got)
    for before, now in zip([None, *got], got):
        first = before is None or before["k"] != now["k"]
        none = first or before["total"] is None or now["total"] is None
        assert now["delta"] == (None if first else now["n"] - before["n"])
        assert now["total_delta"] == (None if none else now["total"] - before["total"])


def test_files_do_not_grow_with_tasks(spark, tmp_path):
    path = str(tmp_path / "h")
    hs.append_history(_events(spark, 2000).repartition(40), path, "ts")
    days = spark.read.parquet(path).select("collected_day").distinct().count()
    assert len(list((tmp_path / "h").glob("*/*.parquet"))) <= 2 * days


@pytest.fixture()
def arriving(spark, tmp_path):
    """A folder that gets files in three goes, with repeats."""
    folder = str(tmp_path / "in")
    df = _events(spark)

    def arrive(go):
        df.where(F.col("event_id").between(go * 60, go * 60 + 79)).coalesce(1).write.mode("append").parquet(folder)

    arrive(0)
    return folder, df.schema, arrive


def _run(stream, path, state):
    hs.append_stream(stream, path, state).awaitTermination()


def test_stream_windows_equal_the_batch(spark, arriving, tmp_path):
    folder, schema, arrive = arriving
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for go in (None, 1, 2):
        if go:
            arrive(go)
        stream = hs.stream_periods(hs.read_stream(spark, folder, schema), "ts", "1 hour", "30 minutes", ["k"])
        _run(stream, out, state)
    got = spark.read.parquet(out)
    batch = hs.period_counts(spark.read.parquet(folder), "ts", "1 hour", ["k"])
    closed = batch.where(F.col("period_end") <= F.lit("2024-01-02 08:40:00").cast("timestamp"))
    assert sorted(rows(got.select("period_start", "k"))) == sorted(rows(closed.select("period_start", "k")))
    # Rows later than the watermark are left out of their windows, all others are in.
    # The second and the third file each begin with twelve events of windows that were closed before they came.
    assert got.agg(F.sum("n")).first()[0] == closed.agg(F.sum("n")).first()[0] - 24


def test_stream_restart_appends_only_new_rows(spark, arriving, tmp_path):
    folder, schema, arrive = arriving
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for go in (None, 1, None):
        if go:
            arrive(go)
        _run(hs.read_stream(spark, folder, schema), out, state)
    assert spark.read.parquet(out).count() == 160


def test_backlog_in_several_batches(spark, arriving, tmp_path):
    folder, schema, arrive = arriving
    arrive(1)
    arrive(2)
    stream = hs.read_stream(spark, folder, schema, files_per_batch=1)
    query = hs.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "state"), day_of="ts", name="backlog")
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 240


def test_stream_dedup_within_the_delay(spark, arriving, tmp_path):
    folder, schema, arrive = arriving
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for go in (None, 1, 2):
        if go:
            arrive(go)
        stream = hs.stream_dedup(hs.read_stream(spark, folder, schema), ["event_id"], "ts", "1 day")
        _run(stream, out, state)
    ids = [r[0] for r in rows(spark.read.parquet(out).select("event_id"))]
    assert sorted(ids) == list(range(200))


def test_scratch_paths_are_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(named) and first != second
