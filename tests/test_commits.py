"""Writes count once they are finished, and once."""

import pytest
from pyspark.sql import functions as F

from shelfmark.sources.commits import Commits, publish, publish_all, read_published
from shelfmark.streaming.runs import append_run, read_runs, runs_of

from conftest import rows


def _broken(df):
    return df.withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))


def _table(spark, begin, end):
    day = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 43_200)
    return spark.range(begin, end, 1, 3).select("id", (F.col("id") * 2).alias("v"), day.alias("collected_at"))


def test_a_commit_is_made_once(spark, tmp_path):
    log = Commits(spark, str(tmp_path / "t"))
    assert log.names() == [] and log.get("a/b %") is None
    assert log.put("a/b %", {"x": [1, "é"]}) and not log.put("a/b %", {"x": 2})
    assert log.names() == ["a/b %"] and log.get("a/b %") == {"x": [1, "é"]}


def test_failed_and_repeated_runs_count_once(spark, tmp_path):
    path = str(tmp_path / "h")
    with pytest.raises(FileNotFoundError):
        read_runs(spark, path)
    with pytest.raises(Exception, match="lost"):
        append_run(_broken(_table(spark, 0, 10)), path, "monday")
    assert runs_of(spark, path) == []
    assert append_run(_table(spark, 0, 10), path, "monday")
    assert not append_run(_table(spark, 0, 10), path, "monday")
    assert append_run(_table(spark, 10, 13).withColumn("note", F.lit("new")), path, "tuesday/1")
    got = read_runs(spark, path)
    assert got.columns == ["id", "v", "collected_at", "note", "collected_day"]
    assert sorted(rows(got.select("id", "v", "note"))) == [(i, 2 * i, None) for i in range(10)] + [(i, 2 * i, "new") for i in range(10, 13)]
    assert sorted(r.id for r in read_runs(spark, path, runs=["monday"]).collect()) == list(range(10))
    recent = read_runs(spark, path, since="2024-01-05")
    assert sorted(r.id for r in recent.collect()) == [8, 9, 10, 11, 12]
    assert "PartitionFilters: [isnotnull(collected_day" in recent._jdf.queryExecution().toString()


def test_readers_see_the_old_or_the_new_table(spark, tmp_path):
    path = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    assert publish(_table(spark, 0, 5), path) == 0
    old = read_published(spark, path)
    with pytest.raises(Exception, match="lost"):
        publish(_broken(_table(spark, 0, 9)), path)
    assert read_published(spark, path).count() == 5
    seen = []
    # A task of the new version's write is what reads the table: it still is the old one.
    publish(_table(spark, 0, 8).crossJoin(F.broadcast(read_published(spark, path).agg(F.count("*").alias("n")))), path)
    seen = [r[0] for r in read_published(spark, path).select("n").distinct().collect()]
    assert seen == [5] and old.count() == 5 and read_published(spark, path).count() == 8
    assert read_published(spark, path, version=0).count() == 5
    publish(_table(spark, 0, 2), path)
    assert len(list((tmp_path / "s").glob("version=*/_SUCCESS"))) <= 3  # a failed write leaves no finished folder
    assert read_published(spark, path).columns == ["id", "v", "collected_at"]
    with pytest.raises(Exception):
        old.count()


def test_one_table_at_many_places(spark, tmp_path):
    paths = [str(tmp_path / "a"), str(tmp_path / "b")]
    publish_all(_table(spark, 0, 4), paths)
    assert [sorted(rows(read_published(spark, p))) for p in paths] == [sorted(rows(_table(spark, 0, 4)))] * 2
