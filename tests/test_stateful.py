"""Streams that remember give what the batch operators give over all that has come."""

import pytest
from pyspark.sql import functions as F

from shelfmark.sources.commits import Commits
from shelfmark.streaming import history as hs
from shelfmark.streaming import stateful as sf

from conftest import rows


def _events(spark, n=600):
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 300)
    kind = F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 3).cast("string"))
    value = F.when((F.col("id") / 40).cast("int") % 3 != 1, F.col("id") * 0.5)
    return spark.range(n).select(F.col("id").alias("event_id"), ts.alias("ts"), kind.alias("k"), value.alias("v"))


@pytest.mark.parametrize("keys", [["k"], []])
def test_deltas_of_closed_windows_across_restarts(spark, tmp_path, keys):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    events = _events(spark)
    for go in range(3):
        events.where(F.col("event_id").between(go * 200, go * 200 + 199)).coalesce(1).write.mode("append").parquet(folder)
        stream = sf.stream_delta(hs.read_stream(spark, folder, events.schema), "ts", "1 hour", "1 hour", keys, "v")
        before = spark.conf.get(sf._PROVIDER)
        with sf.rocksdb_state(spark):
            query = hs.append_stream(stream, out, state)
        assert spark.conf.get(sf._PROVIDER) == before
        query.awaitTermination()
    last = events.agg(F.max("ts")).first()[0]
    wanted = hs.period_delta(events, "ts", "1 hour", keys, "v").where(
        F.col("period_end") <= F.lit(last).cast("timestamp") - F.expr("interval 1 hour"))
    got = spark.read.parquet(out)
    assert got.columns == wanted.columns and got.schema.simpleString() == wanted.schema.simpleString()
    assert sorted(rows(got), key=repr) == sorted(rows(wanted), key=repr) and got.count() > 40
    assert got.where("total is null").count() and got.where("delta is null").count() == (4 if keys else 1)


def test_decimal_sums_are_refused(spark, tmp_path):
    folder = str(tmp_path / "in")
    df = _events(spark, 3).withColumn("v", F.col("v").cast("decimal(10,2)"))
    df.write.parquet(folder)
    with pytest.raises(ValueError, match="cast v"):
        sf.stream_delta(hs.read_stream(spark, folder, df.schema), "ts", "1 hour", "1 hour", ["k"], "v")


def test_latest_rows_over_batches_and_a_replay(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    # Later files hold older rows too.
    events = _events(spark, 300).withColumn("part", F.pmod(F.hash("event_id"), F.lit(4)))
    for part in range(4):
        events.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(folder)
    schema = events.drop("part").schema
    stream = hs.read_stream(spark, folder, schema, files_per_batch=1)
    query = sf.stream_latest(stream, out, state, ["k"], "ts", buckets=3)
    query.awaitTermination()
    assert len(query.recentProgress) >= 4
    whole = events.drop("part")
    wanted = sorted(rows(hs.latest_snapshot(whole, ["k"], "ts")), key=repr)
    assert sorted(rows(sf.read_latest(spark, out)), key=repr) == wanted
    reading = sf.read_latest(spark, out)
    # A batch that comes again changes nothing; another source's does; a reader keeps what it began with.
    late = whole.where("event_id < 4").withColumn("ts", F.timestamp_seconds(F.lit(1_800_000_000) + F.col("event_id")))
    assert not sf.upsert_latest(late, out, ["k"], "ts", "stream", 3)
    assert sorted(rows(sf.read_latest(spark, out)), key=repr) == wanted
    assert sf.upsert_latest(late, out, ["k"], "ts", "other", 0)
    assert sorted(rows(reading), key=repr) == wanted
    now = sorted(rows(hs.latest_snapshot(whole.unionByName(late), ["k"], "ts")), key=repr)
    assert sorted(rows(sf.read_latest(spark, out)), key=repr) == now != wanted


def test_only_touched_buckets_are_written(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.range(1000).select("id", F.timestamp_seconds("id").alias("ts"))
    assert sf.upsert_latest(df, out, ["id"], "ts", "s", 0, buckets=16)
    assert sf.upsert_latest(df.where("id = 5").withColumn("ts", F.timestamp_seconds(F.lit(5000))), out, ["id"], "ts", "s", 1)
    log = Commits(spark, out)
    first, second = (log.get(n)["folders"] for n in log.names())
    assert len(first) == 16 and sum(first[b] != second[b] for b in first) == 1
    assert sf.read_latest(spark, out).count() == 1000
    assert sf.upsert_latest(df.limit(0), out, ["id"], "ts", "s", 2) and sf.read_latest(spark, out).count() == 1000
    for n in range(3, 6):
        sf.upsert_latest(df.where("id = 5"), out, ["id"], "ts", "s", n)
    assert sf.read_latest(spark, out).count() == 1000
    assert sf.read_latest(spark, out).where("id = 5").select(F.unix_seconds("ts")).first()[0] == 5000
    held = [p for p in (tmp_path / "out").glob("version=*/_bucket=*")]
    assert len(held) <= 16 + 2
