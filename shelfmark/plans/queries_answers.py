"""Queries that count, rank, correlate and prepare charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions.derive import bucketize, load_score, ordinal_label
from shelfmark.functions.presets import HOUR_WEIGHTS, PRICE_REPORT_LABELS, RATING_EDGES, RATING_LABELS
from shelfmark.operators import aggregate as ag
from shelfmark.operators import charts as ch
from shelfmark.operators import rank as rk
from shelfmark.plans import analyses as an
from shelfmark.plans import bindings as b
from shelfmark.plans.oracle_tables import ENTITY, RAW, on
from shelfmark.plans.queries_clean import LOAD_SQL
from shelfmark.plans.registry import query


def _count(col: str, where: str = "") -> str:
    return on(ENTITY, f"select {col}, count(*) as n from entity {where} group by {col}")


def _avg(key: str, value: str, name: str, digits: int) -> str:
    return on(ENTITY, f"select {key}, round(avg({value}), {digits}) as {name}, count(*) as n from entity group by {key}")


def _corr(x: str, y: str, table: str = "entity") -> str:
    return f"select round(corr({x}, {y}), 6) as corr from {table}"


_BUCKET = """case when rating >= 1 and rating < 2 then 'Poor (1–2)' when rating >= 2 and rating < 3 then 'Average (2–3)'
  when rating >= 3 and rating < 4 then 'Good (3–4)' when rating >= 4 and rating <= 5 then 'Excellent (4–5)'
  else 'Unknown' end"""

_ANALYSES = {
    "category_count": _count("category"),
    "district_count": _count("district"),
    "avg_rating_by_category": _avg("category", "rating", "avg_rating", 3),
    "avg_rating_by_district": _avg("district", "rating", "avg_rating", 3),
    "avg_price_by_category": on(ENTITY, "select category, round(avg(price_level), 2) as avg_price_level "
                                "from entity where price_level is not null group by category"),
    "price_label_count": _count("price_label"),
    "top10_rated": on(ENTITY, "select item_id, name, category, district, rating, total_ratings, price_label "
                      "from entity order by rating desc, total_ratings desc, item_id limit 10"),
    "top10_reviewed": on(ENTITY, "select item_id, name, category, district, rating, total_ratings "
                         "from entity order by total_ratings desc, item_id limit 10"),
    "corr_count_rating": on(ENTITY, _corr("total_ratings", "rating")),
    "corr_price_rating": on(ENTITY, _corr("price_level", "rating")),
    "open_now_count": _count("open_now"),
    "avg_popularity_by_district": _avg("district", "popularity", "avg_popularity", 4),
    "avg_popularity_by_category": _avg("category", "popularity", "avg_popularity", 4),
    "rating_bucket_count": on(ENTITY, f"select {_BUCKET} as rating_bucket, count(*) as n from entity group by 1"),
    "luxury_top5_districts": on(ENTITY, "select district, count(*) as n from entity where price_label = 'Luxury' "
                                "group by district order by n desc, district limit 5"),
}

_BOX = """
limits as (
  select {g} as g, quantile_cont({v}, 0.25) as q1, quantile_cont({v}, 0.5) as median, quantile_cont({v}, 0.75) as q3
  from {t} where {v} is not null group by {g}),
fenced as (
  select g, q1, median, q3, {v} as v, {v} >= q1 - 1.5 * (q3 - q1) and {v} <= q3 + 1.5 * (q3 - q1) as inside
  from {t} join limits on {g} is not distinct from g where {v} is not null)"""
_BOX_STATS = """
select g as {g}, count(*) as n, round(max(q1), 6) as q1, round(max(median), 6) as median, round(max(q3), 6) as q3,
  min(v) filter (where inside) as whisker_low, max(v) filter (where inside) as whisker_high,
  count(*) filter (where not inside) as outliers from fenced group by g"""


def _rounded_box(df):
    return df.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


_CHARTS = {
    "bars_category": _count("category"),
    "bars_district": _count("district"),
    "bars_top10_reviewed": on(ENTITY, "select item_id, name, total_ratings from entity "
                              "order by total_ratings desc, item_id limit 10"),
    "box_rating_by_category": on(
        ENTITY + "," + _BOX.format(g="category", v="rating", t="entity"), _BOX_STATS.format(g="category")),
    "scatter_count_rating": on(ENTITY, "select total_ratings as x, rating as y, price_label as label "
                               "from entity where total_ratings > 0"),
    "price_share": on(ENTITY, "select price_label, count(*) as n, "
                      "round(count(*) * 100.0::double / (select count(*) from entity), 1) as percent "
                      "from entity group by price_label"),
    "heat_rating": on(ENTITY + """,
cells as (select district, category, round(round(avg(rating), 8)::decimal(18, 8), 2)::double as mean
          from entity group by all),
wide as (select category from cells group by category having count(*) >= 2)""",
                      "select district, category, mean from cells semi join wide using (category)"),
    "histogram_rating": on(ENTITY + """,
r as (select min(rating) as lo, max(rating) as hi from entity),
c as (select least(floor((rating - lo) / ((hi - lo) / 20::double)), 19)::int as bin, count(*) as n from entity, r group by 1)""",
                           """select bin, round(lo + bin * ((hi - lo) / 20::double), 6) as "from",
  round(case when bin = 19 then hi else lo + (bin + 1) * ((hi - lo) / 20::double) end, 6) as "to", coalesce(n, 0) as n
from (select unnest(range(20))::int as bin) left join c using (bin), r"""),
    "bars_popularity_by_district": on(ENTITY, "select district, round(avg(popularity), 6) as avg_popularity "
                                      "from entity group by district"),
    "rating_bucket_bars": on(ENTITY, f"""
select list_position(['Poor (1–2)', 'Average (2–3)', 'Good (3–4)', 'Excellent (4–5)', 'Unknown'], bucket)::int as position,
  bucket, n from (select {_BUCKET} as bucket, count(*) as n from entity group by 1)"""),
}

_FINISH = {
    "box_rating_by_category": _rounded_box,
    "histogram_rating": lambda df: df.withColumns({c: F.round(c, 6) for c in ("from", "to")}),
    "bars_popularity_by_district": lambda df: df.withColumn("avg_popularity", F.round("avg_popularity", 6)),
}


def _add(name, sql, answer):
    finish = _FINISH.get(name, lambda df: df)
    query(name, sql)(lambda spark, folder: finish(answer(b.entity(spark, folder))))


for _name, _sql in _ANALYSES.items():
    _add(_name, _sql, an.ANALYSES[_name])
for _name, _sql in _CHARTS.items():
    # Halves of the second digit are common in the heat map; its SQL rounds as ``steady_round`` does.
    _add(_name, _sql, an.CHARTS[_name])


@query("sql_category_count", _count("category"))
def _(spark, folder):
    return an.sql_summary(b.entity(spark, folder))["category_count"]


@query("sql_district_count", _count("district"))
def _(spark, folder):
    return an.sql_summary(b.entity(spark, folder))["district_count"]


_OVERALL = on(ENTITY, "select round(avg(rating), 4) as overall_avg_rating, "
              "round(avg(popularity), 4) as overall_avg_popularity from entity")


@query("sql_overall", _OVERALL)
def _(spark, folder):
    return an.sql_summary(b.entity(spark, folder))["overall"]


@query("global_averages", _OVERALL)
def _(spark, folder):
    return ag.global_averages(b.entity(spark, folder), {
        "rating": "overall_avg_rating", "popularity": "overall_avg_popularity"})


@query("price_report", on(ENTITY, """
select price_level, count(*) as n, case price_level when 0 then 'Budget' when 1 then 'Inexpensive' when 2 then 'Moderate'
  when 3 then 'Expensive' when 4 then 'Very Expensive' else 'Unknown' end as label from entity group by price_level"""))
def _(spark, folder):
    return an.price_report(b.entity(spark, folder), PRICE_REPORT_LABELS)


@query("count_by_brand", "select p_brand, count(*) as n from part group by p_brand")
def _(spark, folder):
    return ag.count_by(b.table(spark, folder, "part"), "p_brand")


@query("open_now_known", on(ENTITY, "select open_now, count(*) as n from entity where open_now is not null group by open_now"))
def _(spark, folder):
    return ag.count_by(b.entity(spark, folder), "open_now", skip_null=True)


@query("avg_price_by_flag", "select l_returnflag, round(avg(l_extendedprice), 4) as avg_price, count(*) as n "
       "from lineitem group by l_returnflag")
def _(spark, folder):
    return ag.avg_by(b.table(spark, folder, "lineitem"), "l_returnflag", "l_extendedprice", "avg_price")


@query("corr_lineitem", _corr("l_quantity", "l_extendedprice", "lineitem"))
def _(spark, folder):
    return ag.correlation(b.table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")


@query("raw_rating_buckets", on(RAW, f"select {_BUCKET} as bucket, count(*) as n from raw group by 1"))
def _(spark, folder):
    return ag.distribution(b.raw(spark, folder), bucketize("rating", RATING_EDGES, RATING_LABELS))


@query("top5_min_support", on(ENTITY, "select item_id, name, rating, total_ratings, address from entity "
       "where total_ratings >= 30 order by rating desc, item_id limit 5"))
def _(spark, folder):
    return rk.top_n_min_support(
        b.entity(spark, folder), [F.col("rating").desc(), F.col("item_id")], 5, "total_ratings", 30,
        ["item_id", "name", "rating", "total_ratings", "address"])


@query("top5_load", on("scored as (" + LOAD_SQL + ")", """
select event_id, load_score from scored order by load_score desc, event_id limit 5"""))
def _(spark, folder):
    scored = b.table(spark, folder, "events").select(
        "event_id", load_score("event_id", "value", "ts", HOUR_WEIGHTS).alias("load_score"))
    return rk.top_n(scored, [F.col("load_score").desc(), F.col("event_id")], 5)


@query("total_sort", on(ENTITY, "select item_id, district, rating from entity"))
def _(spark, folder):
    return rk.total_sort(
        b.entity(spark, folder).select("item_id", "district", "rating"),
        [F.col("district"), F.col("rating").desc(), F.col("item_id")])


@query("top3_orders_per_customer", """
select o_custkey, o_orderkey, o_totalprice, rank from (
  select o_custkey, o_orderkey, o_totalprice,
         (row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey))::int as rank from orders)
where rank <= 3""")
def _(spark, folder):
    orders = b.table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rk.top_n_per_group(orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)


@query("distinct_items", "select count(distinct l_partkey) as items from lineitem")
def _(spark, folder):
    return ag.distinct_count(b.table(spark, folder, "lineitem"), "l_partkey", "items")


@query("distinct_items_approx", "select true as within_bound")
def _(spark, folder):
    # Within three times the sketch's standard error of 5 percent.
    lines = b.table(spark, folder, "lineitem")
    exact = ag.distinct_count(lines, "l_partkey", "items").select("items").scalar()
    guess = ag.distinct_count(lines, "l_partkey", "items", approx=True)
    return guess.select((F.abs(F.col("items") - exact) <= exact * 0.15).alias("within_bound"))


@query("clipped_buckets", """
select list_position(['Poor (1–2)', 'Average (2–3)', 'Good (3–4)', 'Excellent (4–5)', 'Unknown'], bucket)::int as position,
  bucket, n from (select case when v < 2 then 'Poor (1–2)' when v < 3 then 'Average (2–3)' when v < 4 then 'Good (3–4)'
    else 'Excellent (4–5)' end as bucket, count(*) as n from (select l_quantity / 8 as v from lineitem) group by 1)""")
def _(spark, folder):
    # An eighth of a quantity runs from 0.125 to 6.25, so both end buckets take values from outside 1..5.
    lines = b.table(spark, folder, "lineitem").select((F.col("l_quantity") / 8).alias("v"))
    bucket = bucketize("v", RATING_EDGES, RATING_LABELS, clip=True)
    return ch.ordered_counts(lines, bucket, [*RATING_LABELS, "Unknown"])


@query("heatmap", """
select n_name, round(round(avg(c_acctbal) filter (where c_mktsegment = 'AUTOMOBILE'), 8)::decimal(18, 8), 2)::double as "AUTOMOBILE",
  round(round(avg(c_acctbal) filter (where c_mktsegment = 'BUILDING'), 8)::decimal(18, 8), 2)::double as "BUILDING",
  round(round(avg(c_acctbal) filter (where c_mktsegment = 'FURNITURE'), 8)::decimal(18, 8), 2)::double as "FURNITURE",
  round(round(avg(c_acctbal) filter (where c_mktsegment = 'HOUSEHOLD'), 8)::decimal(18, 8), 2)::double as "HOUSEHOLD",
  round(round(avg(c_acctbal) filter (where c_mktsegment = 'MACHINERY'), 8)::decimal(18, 8), 2)::double as "MACHINERY"
from customer join nation on c_nationkey = n_nationkey group by n_name""")
def _(spark, folder):
    nation = b.table(spark, folder, "nation")
    customers = b.table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return ch.pivot_mean(customers, "n_name", "c_mktsegment", "c_acctbal",
                         ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])


@query("box_price_by_type", "with " + _BOX.format(g="p_type", v="p_retailprice", t="part").strip()
       + _BOX_STATS.format(g="p_type"))
def _(spark, folder):
    return _rounded_box(ch.box_stats(b.table(spark, folder, "part"), "p_type", "p_retailprice"))


@query("box_value_by_event", "with " + _BOX.format(g="event_type", v="value", t="events").strip()
       + _BOX_STATS.format(g="event_type"))
def _(spark, folder):
    return _rounded_box(ch.box_stats(b.table(spark, folder, "events"), "event_type", "value"))


@query("box_outliers", "with " + _BOX.format(g="event_type", v="value", t="events").strip()
       + " select g as event_type, v as value, count(*) as n from fenced where not inside group by all")
def _(spark, folder):
    return ch.box_outliers(b.table(spark, folder, "events"), "event_type", "value")


@query("histogram", """
with r as (select min(l_quantity) as lo, max(l_quantity) as hi from lineitem),
c as (select least(floor((l_quantity - lo) / ((hi - lo) / 20::double)), 19)::int as bin, count(*) as n from lineitem, r group by 1)
select bin, round(lo + bin * ((hi - lo) / 20::double), 6) as "from",
  round(case when bin = 19 then hi else lo + (bin + 1) * ((hi - lo) / 20::double) end, 6) as "to", coalesce(n, 0) as n
from (select unnest(range(20))::int as bin) left join c using (bin), r""")
def _(spark, folder):
    found = ch.histogram(b.table(spark, folder, "lineitem"), "l_quantity", 20)
    return found.withColumns({c: F.round(c, 6) for c in ("from", "to")})


@query("histogram_marks", "select round(avg(l_quantity), 2) as mean, "
       "round(quantile_cont(l_quantity, 0.5), 2) as median from lineitem")
def _(spark, folder):
    return ch.marks(b.table(spark, folder, "lineitem"), "l_quantity")


@query("density", """
with s as (select count(*)::double as n, pow(count(*)::double, -0.2::double) * stddev_samp(l_quantity) as bw,
  min(l_quantity) as lo, (max(l_quantity) - min(l_quantity)) / 199 as step from lineitem),
c as (select l_quantity as v, count(*) as c from lineitem group by 1),
g as (select p::int as point, lo + p * step as x from s, (select unnest(range(200)) as p))
select point, round(x, 6) as x, round(sum(c * exp(-0.5 * pow((x - v) / bw, 2))) / (max(n) * max(bw) * sqrt(2 * pi())), 9) as density
from g, c, s group by point, x""")
def _(spark, folder):
    found = ch.density(b.table(spark, folder, "lineitem"), "l_quantity")
    return found.select("point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


@query("ordered_buckets", on(ENTITY, """
select list_position(['Free', 'Budget', 'Moderate', 'Expensive', 'Luxury'], price_label)::int as position,
  price_label as bucket, count(*) as n from entity group by price_label"""))
def _(spark, folder):
    return ch.ordered_counts(
        b.entity(spark, folder), F.col("price_label"), ["Free", "Budget", "Moderate", "Expensive", "Luxury"])


@query("priority_labels", """
select case left(o_orderpriority, 1) when '1' then 'first' when '2' then 'second' else 'later' end as label,
  count(*) as n from orders group by 1""")
def _(spark, folder):
    level = F.substring("o_orderpriority", 1, 1).cast("int")
    return ag.distribution(
        b.table(spark, folder, "orders"), ordinal_label(level, {1: "first", 2: "second"}, "later"), "label")
