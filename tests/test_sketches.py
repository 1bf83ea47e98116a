"""Sketches of days, added one by one and twice, give the distinct counts of any stretch; bucketed joins move no row."""

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import recommend as rc
from shelfmark.sources.bucketed import write_bucketed
from shelfmark.streaming import sketches as sk

from conftest import rows


def _visits(spark):
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60)
    return spark.range(14_400).select(
        ts.alias("ts"), (F.col("id") * 7919 % 3001).alias("user"), F.when(F.col("id") % 5 > 0, (F.col("id") % 3).cast("string")).alias("kind"))


@pytest.fixture()
def path(spark, tmp_path):
    path, visits = str(tmp_path / "s"), _visits(spark)
    for day in range(1, 11):
        own = visits.where(F.dayofmonth("ts") == day)
        assert sk.append_sketches(own, path, f"day {day}", "ts", ["user"], ["kind"])
    assert not sk.append_sketches(visits.where("user < 0"), path, "day 3", "ts", ["user"], ["kind"])
    # The same rows under another name change no count.
    assert sk.append_sketches(visits.where(F.dayofmonth("ts") == 4), path, "day 4 again", "ts", ["user"], ["kind"])
    return path


def test_any_stretch_of_days(spark, path):
    visits = _visits(spark)
    for since, until in [(None, None), ("2024-01-03", "2024-01-05"), ("2024-01-09", None), (None, "2024-01-01")]:
        part = visits
        if since:
            part = part.where(F.to_date("ts") >= F.lit(since).cast("date"))
        if until:
            part = part.where(F.to_date("ts") <= F.lit(until).cast("date"))
        exact = {r[0]: r[1] for r in rows(part.groupBy("kind").agg(F.countDistinct("user")))}
        got = {r[0]: r[1] for r in rows(sk.distinct_between(spark, path, {"user": "n"}, ["kind"], since, until))}
        assert got == {k: pytest.approx(n, rel=4 * 1.04 / 128) for k, n in exact.items()}
        mean = rows(sk.mean_distinct_between(spark, path, "user", ["kind"], since, until))[0][0]
        assert mean == pytest.approx(sum(exact.values()) / len(exact), rel=0.03)
    assert rows(sk.distinct_between(spark, path, {"user": "n"}, since="2025-01-01")) == [(0,)]


def test_coverage_of_sketches(spark, path, tmp_path):
    few = str(tmp_path / "few")
    sk.append_sketches(_visits(spark).where("user < 750"), few, "all", "ts", ["user"])
    got = sk.coverage_between(
        sk.merged_sketches(spark, few, ["user"]), sk.merged_sketches(spark, path, ["user"], ["kind"]), "user").first()
    assert got.coverage_percent == pytest.approx(100 * 750 / 3001, rel=0.05)


def test_bucketed_join_moves_no_row(spark, tmp_path):
    recs = spark.range(500).selectExpr("id % 40 as item", "id as user", "1.0D as predicted_score")
    details = spark.range(30).selectExpr("id as item", "concat('name ', id) as name")
    left = write_bucketed(recs, "t_recs_bucketed", "item", 4, str(tmp_path / "recs"))
    right = write_bucketed(details, "t_details_bucketed", "item", 4, str(tmp_path / "details"))
    out = rc.enrich_bucketed(left, right, "item", ["user", "item", "name"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert sorted(rows(out), key=repr) == sorted(rows(rc.enrich(recs, details, "item", ["user", "item", "name"])), key=repr)
    assert len(list((tmp_path / "recs").glob("*.parquet"))) <= 4
    for name in ("t_recs_bucketed", "t_details_bucketed"):
        spark.sql(f"DROP TABLE {name}")
