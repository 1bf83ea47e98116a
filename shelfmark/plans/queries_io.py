"""Queries that write, read back, append and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators import aggregate as ag
from shelfmark.operators import evaluate as ev
from shelfmark.plans import bindings as b
from shelfmark.plans.cleaning import clean
from shelfmark.plans.oracle_tables import ENTITY, RAW, on
from shelfmark.plans.registry import query
from shelfmark.sources import commits as cm
from shelfmark.sources import readers as rd
from shelfmark.sources import writers as wr
from shelfmark.sources.staging import scratch_path
from shelfmark.streaming import history as hs
from shelfmark.streaming import runs as rn
from shelfmark.streaming import sketches as sk
from shelfmark.streaming import stateful as sf

_CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("csv_round_trip", "select * from customer")
def _(spark, folder):
    path = scratch_path(spark, "customer-csv")
    wr.write_csv(b.table(spark, folder, "customer"), path)
    return rd.read_csv(spark, path, _CUSTOMER)


@query("csv_multiline_round_trip", "select doc_id, md5(text) as text_md5, n_chars from documents")
def _(spark, folder):
    path = scratch_path(spark, "documents-csv")
    wr.write_csv(b.table(spark, folder, "documents"), path)
    back = rd.read_csv(
        spark, path, "doc_id bigint, text string, lang string, source string, n_chars bigint",
        multiline=True, escape='"')
    return back.select("doc_id", F.md5("text").alias("text_md5"), "n_chars")


@query("clean_from_csv", on(ENTITY, "select * from entity"))
def _(spark, folder):
    path = scratch_path(spark, "raw-csv")
    raw = b.raw(spark, folder)
    wr.write_csv(raw, path)
    return clean(rd.read_csv(spark, path, raw.schema, multiline=True, escape='"'), b.entity_spec(), staged=True)


@query("csv_inferred", "select * from part")
def _(spark, folder):
    path = scratch_path(spark, "part-csv")
    wr.write_csv(b.table(spark, folder, "part"), path)
    return rd.read_csv_inferred(spark, path, {
        "p_partkey": "bigint", "p_size": "int", "p_retailprice": "double"})


@query("lenient_read", "select c_custkey::double as c_custkey, c_name, try_cast(c_mktsegment as double) as c_mktsegment "
       "from customer")
def _(spark, folder):
    path = scratch_path(spark, "broken-csv")
    line = F.concat_ws(",", "c_custkey", "c_name", "c_mktsegment")
    broken = F.concat_ws(",", "c_custkey", "c_name", "c_mktsegment", F.lit("one field too many"))
    rows = b.table(spark, folder, "customer").select(F.explode(F.array(line, broken)).alias("value"))
    rows.write.text(path)
    return rd.read_lenient(
        spark, path, "c_custkey string, c_name string, c_mktsegment string",
        numeric=["c_custkey", "c_mktsegment"], header=False)


@query("parquet_round_trip", "select * from orders")
def _(spark, folder):
    path = scratch_path(spark, "orders")
    wr.write_parquet(b.table(spark, folder, "orders"), path)
    return rd.read_parquet(spark, path)


@query("snapshot_copies", "select * from supplier union all select * from supplier")
def _(spark, folder):
    paths = [scratch_path(spark, "supplier"), scratch_path(spark, "supplier")]
    wr.write_snapshot(b.table(spark, folder, "supplier"), paths)
    return rd.read_parquet(spark, paths[0]).unionByName(rd.read_parquet(spark, paths[1]))


@query("metrics_json", """
select round(sqrt(avg((l_discount - l_tax) * (l_discount - l_tax))), 6) as rmse, round(avg(abs(l_tax - l_discount)), 6) as mae
from lineitem""")
def _(spark, folder):
    path = scratch_path(spark, "metrics")
    lines = b.table(spark, folder, "lineitem")
    wr.write_metrics(ev.rating_error(lines, "l_discount", "l_tax").select(F.struct("rmse", "mae").alias("errors")), path)
    return spark.read.schema("errors struct<rmse: double, mae: double>").json(path).select("errors.*")


@query("named_results", on(ENTITY, """
select category as label, count(*) as n from entity group by category
union all select district, count(*) from entity group by district"""))
def _(spark, folder):
    path = scratch_path(spark, "results")
    df = b.entity(spark, folder)
    wr.write_results({"category": ag.count_by(df, "category"), "district": ag.count_by(df, "district")}, path)
    parts = [rd.read_csv(spark, f"{path}/{c}", f"{c} string, n bigint").toDF("label", "n")
             for c in ("category", "district")]
    return parts[0].unionByName(parts[1])


def _events(spark, folder) -> DataFrame:
    return b.table(spark, folder, "events")


_FIRST_LAST = "(select min(ts) + (max(ts) - min(ts)) / 2 from events)"


@query("append_history", "select event_id, ts, user_id, value, ts::date as collected_day from events")
def _(spark, folder):
    # Two runs: the events before and after a point in time.
    path = scratch_path(spark, "history")
    events = _events(spark, folder).select("event_id", "ts", "user_id", "value")
    early = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    hs.append_history(events.where(early), path, "ts")
    hs.append_history(events.where(~early), path, "ts")
    return hs.read_history(spark, path)


@query("history_since", "select event_id, ts::date as collected_day from events where ts >= date '2024-01-20'")
def _(spark, folder):
    path = scratch_path(spark, "history")
    hs.append_history(_events(spark, folder).select("event_id", "ts"), path, "ts")
    return hs.read_history(spark, path, since="2024-01-20").select("event_id", hs.DAY)


@query("latest_snapshot", """
select * exclude (rn) from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events)
where rn = 1""")
def _(spark, folder):
    return hs.latest_snapshot(_events(spark, folder), ["user_id"], "ts")


@query("latest_items", on(RAW, "select * exclude (rn) from (select *, row_number() over "
       "(partition by item_id order by collected_at desc) as rn from raw) where rn = 1"))
def _(spark, folder):
    return hs.latest_snapshot(b.raw(spark, folder), ["item_id"], "collected_at")


@query("hourly_delta", """
with c as (select date_trunc('hour', ts) as period_start, event_type, count(*) as n from events group by all)
select period_start, period_start + interval 1 hour as period_end, event_type, n,
  n - lag(n) over (partition by event_type order by period_start) as delta from c""")
def _(spark, folder):
    return hs.period_delta(_events(spark, folder), "ts", "1 hour", ["event_type"])


@query("daily_delta", """
with c as (select date_trunc('day', ts)::timestamp as period_start, count(*) as n, round(sum(value), 4) as total
           from events group by all)
select period_start, period_start + interval 1 day as period_end, n, total,
  n - lag(n) over (order by period_start) as delta,
  round(total - lag(total) over (order by period_start), 2) as total_delta from c""")
def _(spark, folder):
    days = hs.period_delta(_events(spark, folder), "ts", "1 day", value="value")
    return days.withColumns({"total": F.round("total", 4), "total_delta": F.round("total_delta", 2)})


def _stream(spark, folder) -> DataFrame:
    return hs.read_stream(spark, folder, _events(spark, folder).schema, "events.parquet")


def _run(spark, stream: DataFrame, day_of: str | None = None) -> DataFrame:
    path = scratch_path(spark, "stream")
    hs.append_stream(stream, path, scratch_path(spark, "stream-state"), day_of).awaitTermination()
    return spark.read.parquet(path)


def _plain_time(df: DataFrame, *cols: str) -> DataFrame:
    """Zoned timestamps as the plain UTC ones of the tables."""
    return df.withColumns({c: F.to_timestamp_ntz(F.col(c).cast("string")) for c in cols})


@query("stream_hourly", """
with c as (select date_trunc('hour', ts) as period_start, event_type, count(*) as n, round(sum(value), 4) as total
           from events group by 1, 2)
select period_start, period_start + interval 1 hour as period_end, event_type, n, total from c
where period_start + interval 1 hour <= (select max(ts) - interval 1 hour from events)""")
def _(spark, folder):
    closed = hs.stream_periods(_stream(spark, folder), "ts", "1 hour", "1 hour", ["event_type"], "value")
    return _plain_time(_run(spark, closed), "period_start", "period_end").withColumn("total", F.round("total", 4))


@query("stream_dedup", "select * from events")
def _(spark, folder):
    events = _stream(spark, folder)
    twice = events.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    return _plain_time(_run(spark, hs.stream_dedup(twice, ["event_id"], "ts", "1 hour")), "ts")


@query("stream_append", "select *, ts::date as collected_day from events")
def _(spark, folder):
    return _run(spark, _stream(spark, folder), day_of="ts")


@query("append_runs", "select event_id, ts, user_id, value, ts::date as collected_day from events")
def _(spark, folder):
    # Two runs. The second one fails half-way, is repeated, and then comes once more.
    path = scratch_path(spark, "runs")
    events = _events(spark, folder).select("event_id", "ts", "user_id", "value")
    early = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    rn.append_run(events.where(early), path, "first", "ts")
    late = events.where(~early)
    broken = late.withColumn("value", F.when(
        F.col("ts") > F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), F.raise_error(F.lit("cut off"))).otherwise(F.col("value")))
    try:
        rn.append_run(broken, path, "second", "ts")
    except Exception as error:
        if "cut off" not in str(error):
            raise
    rn.append_run(late, path, "second", "ts")
    rn.append_run(late, path, "second", "ts")
    return rn.read_runs(spark, path)


@query("published_snapshot", "select c_custkey, c_name, c_acctbal, (select count(*) from customer where c_acctbal >= 0) as seen from customer")
def _(spark, folder):
    # The second version is made of what readers see while it is being written: the first one.
    path = scratch_path(spark, "customers")
    customers = b.table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    cm.publish(customers.where("c_acctbal >= 0"), path)
    before = cm.read_published(spark, path).agg(F.count(F.lit(1))).scalar()
    cm.publish(customers.select("*", before.alias("seen")), path)
    return cm.read_published(spark, path)


def _arriving(spark, folder, parts: int) -> tuple[str, list[DataFrame]]:
    """A folder and the events that come to it one part after the other, by time."""
    events = _events(spark, folder)
    at = F.dayofmonth("ts") * parts / 31
    return scratch_path(spark, "arriving"), [events.where(F.floor(at) == i) for i in range(parts)]


@query("stream_delta", """
with c as (select date_trunc('hour', ts) as period_start, event_type, count(*) as n, round(sum(value), 4) as total
           from events group by 1, 2)
select period_start, period_start + interval 1 hour as period_end, event_type, n, total,
  n - lag(n) over w as delta, round(total - lag(total) over w, 2) as total_delta
from c where period_start + interval 1 hour <= (select max(ts) - interval 1 hour from events)
window w as (partition by event_type order by period_start)""")
def _(spark, folder):
    # The stream is stopped and started again from its checkpoint after each part.
    arriving, parts = _arriving(spark, folder, 3)
    out, state = scratch_path(spark, "deltas"), scratch_path(spark, "deltas-state")
    for part in parts:
        part.write.mode("append").parquet(arriving)
        stream = sf.stream_delta(
            hs.read_stream(spark, arriving, part.schema), "ts", "1 hour", "1 hour", ["event_type"], "value")
        with sf.rocksdb_state(spark):
            running = hs.append_stream(stream, out, state)
        running.awaitTermination()
    deltas = _plain_time(spark.read.parquet(out), "period_start", "period_end")
    return deltas.withColumns({"total": F.round("total", 4), "total_delta": F.round("total_delta", 2)})


@query("stream_latest", """
select * exclude (rn) from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events)
where rn = 1""")
def _(spark, folder):
    # The last part comes first; then a batch that has been seen comes again with other rows, which must not count.
    arriving, parts = _arriving(spark, folder, 3)
    path, state = scratch_path(spark, "latest"), scratch_path(spark, "latest-state")
    for part in reversed(parts):
        part.write.mode("append").parquet(arriving)
        sf.stream_latest(hs.read_stream(spark, arriving, part.schema), path, state, ["user_id"], "ts", buckets=8).awaitTermination()
    changed = parts[0].withColumn("ts", F.col("ts") + F.expr("interval 1 year"))
    sf.upsert_latest(changed, path, ["user_id"], "ts", "stream", 0)
    return sf.read_latest(spark, path)


_RANGES = [("2024-01-01", "2024-01-07"), ("2024-01-10", "2024-01-10"), ("2024-01-05", "2024-01-30")]


@query("distinct_over_days", "select * from (" + " union all ".join(
    f"select '{since}' as since, '{until}' as until, event_type, count(distinct user_id) as exact, true as close from events "
    f"where ts::date between date '{since}' and date '{until}' group by event_type" for since, until in _RANGES) + ")")
def _(spark, folder):
    # Days are added one by one, each as a run of its own; an estimate is close within four standard errors.
    path = scratch_path(spark, "sketches")
    events = _events(spark, folder).select("ts", "event_type", "user_id")
    for day in range(1, 31):
        own = events.where(F.to_date("ts") == F.lit(f"2024-01-{day:02d}").cast("date"))
        sk.append_sketches(own, path, f"day {day:02d}", "ts", ["user_id"], ["event_type"])
    parts = []
    for since, until in _RANGES:
        estimated = sk.distinct_between(spark, path, {"user_id": "estimate"}, ["event_type"], since, until)
        day = F.to_date("ts").cast("string")
        exact = events.where((day >= since) & (day <= until)).groupBy("event_type").agg(F.countDistinct("user_id").alias("exact"))
        # One row per type of event on both sides.
        parts.append(exact.join(F.broadcast(estimated), "event_type", "full").select(
            F.lit(since).alias("since"), F.lit(until).alias("until"), "event_type", "exact",
            (F.abs(F.col("estimate") - F.col("exact")) <= 4 * 1.04 / 2 ** (sk.LOG_K / 2) * F.col("exact") + 0.5).alias("close")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
