"""Queries that check, clean and derive."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.functions import derive as dv
from shelfmark.functions import nested as ns
from shelfmark.functions import presets
from shelfmark.operators import cleaning as cl
from shelfmark.operators import project as pr
from shelfmark.operators import quality as ql
from shelfmark.operators.quantiles import approx_quantiles, quantiles
from shelfmark.plans import bindings as b
from shelfmark.plans.cleaning import clean_steps
from shelfmark.plans.oracle_tables import ENTITY, FILLED, KEPT, RAW, on
from shelfmark.plans.registry import query


@query("clean_entity", on(ENTITY, "select * from entity"))
def _(spark, folder):
    return b.clean_entity(spark, folder)


@query("raw_catalogue", on(RAW, "select * from raw"))
def _(spark, folder):
    return b.raw(spark, folder)


@query("dedup_documents", "select min(doc_id) as doc_id, arg_min(source, doc_id) as source, "
       "arg_min(lang, doc_id) as lang, arg_min(n_chars, doc_id) as n_chars from documents group by text")
def _(spark, folder):
    # Long texts are compared by their SHA-256, so they are neither sorted nor shuffled.
    docs = b.table(spark, folder, "documents").withColumn("text", F.sha2("text", 256))
    return cl.dedup(docs, ["text"], ["doc_id"]).select("doc_id", "source", "lang", "n_chars")


@query("dedup_lineitem", """
select * exclude (rn) from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
    order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus, l_shipdate) as rn from lineitem)
where rn = 1""")
def _(spark, folder):
    return cl.dedup(b.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("drop_all_null", on(RAW, "select * from raw where rating is not null or total_ratings is not null"))
def _(spark, folder):
    return pr.drop_all_null(b.raw(spark, folder), ["rating", "total_ratings"])


@query("median_exact", "select round(quantile_cont(o_totalprice, 0.5), 6) as median from orders")
def _(spark, folder):
    return cl.median(b.table(spark, folder, "orders"), "o_totalprice").select(F.round("median", 6).alias("median"))


@query("median_by_type", "select p_type, round(quantile_cont(p_retailprice, 0.5), 6) as median from part group by p_type")
def _(spark, folder):
    part = b.table(spark, folder, "part")
    return quantiles(part, "p_retailprice", [0.5], by=["p_type"], names=["median"]).select(
        "p_type", F.round("median", 6).alias("median"))


@query("quantiles_price", "select round(quantile_cont(l_extendedprice, 0.01), 6) as p1, "
       "round(quantile_cont(l_extendedprice, 0.5), 6) as p50, "
       "round(quantile_cont(l_extendedprice, 0.99), 6) as p99 from lineitem")
def _(spark, folder):
    found = quantiles(b.table(spark, folder, "lineitem"), "l_extendedprice", [0.01, 0.5, 0.99])
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


@query("median_approx", "select true as within_bound")
def _(spark, folder):
    # The rank of what is found lies within rows / accuracy of the middle.
    orders = b.table(spark, folder, "orders").select("o_totalprice")
    found = approx_quantiles(orders, "o_totalprice", [0.5], names=["median"], accuracy=1000).select("median").scalar()
    return orders.agg(
        F.count_if(F.col("o_totalprice") < found).alias("below"), F.count_if(F.col("o_totalprice") <= found).alias("upto"),
        F.count(F.lit(1)).alias("n"),
    ).select(((F.col("below") <= F.col("n") * 0.501 + 1) & (F.col("upto") >= F.col("n") * 0.499 - 1)).alias("within_bound"))


@query("mode_value", "select p_brand as mode from part group by p_brand order by count(*) desc, p_brand limit 1")
def _(spark, folder):
    return cl.mode_value(b.table(spark, folder, "part"), "p_brand")


@query("impute_values", on(FILLED, "select * from filled"))
def _(spark, folder):
    spec = b.entity_spec()
    return cl.impute(clean_steps(b.raw(spark, folder), spec)[-1][1], spec.fill)


_LABELLED = "documents left join labels using (doc_id)"


def _null_sql(table: str, columns: dict[str, str]) -> str:
    one = ("select '{c}' as \"column\", '{t}' as type, count(*) as rows, count(*) - count({c}) as nulls, "
           "round((count(*) - count({c})) * 100.0::double / count(*), 1) as percent from {f}")
    return " union all ".join(one.format(c=c, t=t, f=table) for c, t in columns.items())


@query("null_audit_labels", _null_sql(_LABELLED, {"text": "string", "quality": "int", "toxic": "int"}))
def _(spark, folder):
    docs, labels = b.table(spark, folder, "documents"), b.table(spark, folder, "labels")
    return ql.null_audit(docs.join(labels, "doc_id", "left"), ["text", "quality", "toxic"])


@query("null_audit_raw", on(RAW, _null_sql("raw", {
    "item_id": "bigint", "name": "string", "address": "string", "tags": "string", "rating": "double",
    "total_ratings": "bigint", "price_level": "int", "open_now": "boolean", "review_count": "bigint",
    "review_texts": "string", "avg_review_rating": "double", "collected_at": "timestamp_ntz"})))
def _(spark, folder):
    return ql.null_audit(b.raw(spark, folder))


@query("required_nulls", on(ENTITY, _null_sql("entity", {
    "item_id": "bigint", "category": "string", "district": "string", "rating": "double"})))
def _(spark, folder):
    required = ["item_id", "category", "district", "rating"]
    return ql.null_audit(ql.require_columns(b.entity(spark, folder), required), required)


def _describe_sql(table: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select '{c}' as \"column\", count({c}) as n, round(avg({c}), 6) as mean, "
        f"round(stddev_samp({c}), 6) as stddev, min({c})::double as min, max({c})::double as max from {table}"
        for c in columns)


def _round_stats(df):
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query("describe_lineitem", _describe_sql("lineitem", ["l_quantity", "l_extendedprice"]))
def _(spark, folder):
    return _round_stats(ql.describe(b.table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"]))


@query("describe_raw", on(RAW, _describe_sql("raw", ["rating", "total_ratings", "price_level"])))
def _(spark, folder):
    return _round_stats(ql.describe(b.raw(spark, folder), ["rating", "total_ratings", "price_level"]))


@query("step_counts", on(KEPT, """
select position, step, before, after, before - after as removed from (
  select 1 as position, 'dedup' as step, (select count(*) from raw) as before, (select count(*) from deduped) as after
  union all
  select 2, 'drop_all_null', (select count(*) from deduped), (select count(*) from kept))"""))
def _(spark, folder):
    return ql.step_counts(clean_steps(b.raw(spark, folder), b.entity_spec()))


@query("schema_of_lineitem", """
with total as (select count(*) as rows from lineitem)
select position, "column", type, rows from total, (values
 (0, 'l_orderkey', 'bigint'), (1, 'l_partkey', 'bigint'), (2, 'l_suppkey', 'bigint'), (3, 'l_linenumber', 'int'),
 (4, 'l_quantity', 'double'), (5, 'l_extendedprice', 'double'), (6, 'l_discount', 'double'), (7, 'l_tax', 'double'),
 (8, 'l_returnflag', 'string'), (9, 'l_linestatus', 'string'), (10, 'l_shipdate', 'timestamp_ntz')
) as t(position, "column", type)""")
def _(spark, folder):
    lines = b.table(spark, folder, "lineitem")
    return ql.schema_report(lines).withColumn("rows", lines.agg(F.count(F.lit(1))).scalar())


@query("cast_columns", """
select o_orderkey, o_orderpriority, try_cast(substr(o_orderpriority, 1, 1) as int) as digit,
       cast(substr(o_orderpriority, 1, 1) as int) as whole, cast(null as int) as bad from orders""")
def _(spark, folder):
    orders = b.table(spark, folder, "orders").select(
        "o_orderkey", "o_orderpriority",
        F.substring("o_orderpriority", 1, 1).alias("digit"),
        F.concat(F.substring("o_orderpriority", 1, 1), F.lit(".0")).alias("whole"),
        F.col("o_orderpriority").alias("bad"))
    return pr.cast_columns(orders, {"digit": "int", "whole": "int", "bad": "int", "absent": "int"})


@query("with_audit", "select c_custkey, timestamp '2024-01-02 03:04:05' as collected_at from customer")
def _(spark, folder):
    stamped = pr.with_audit(b.table(spark, folder, "customer").select("c_custkey"), "2024-01-02 03:04:05+00:00")
    utc = F.to_utc_timestamp("collected_at", F.current_timezone())
    return stamped.withColumn("collected_at", utc.cast("timestamp_ntz"))


@query("select_existing", "select c_custkey, c_name from customer")
def _(spark, folder):
    return pr.select_existing(b.table(spark, folder, "customer"), ["c_custkey", "absent", "c_name"])


@query("filters", on(ENTITY, """
select item_id, price_label, total_ratings, 'kept' as state from entity
where total_ratings >= 25 and open_now is not null and price_label <> 'Luxury'"""))
def _(spark, folder):
    df = b.entity(spark, folder)
    kept = (F.col("total_ratings") >= 25) & F.col("open_now").isNotNull() & (F.col("price_label") != "Luxury")
    return df.where(kept).select("item_id", "price_label", "total_ratings", F.lit("kept").alias("state"))


@query("extract_code", "select s_suppkey, s_name, 'Supplier ' || "
       "regexp_replace(regexp_extract(s_name, '(?i)supplier#(\\d+)', 1), '^0*(\\d+)$', '\\1') as code from supplier")
def _(spark, folder):
    code = dv.extract_code("s_name", "supplier#", "none", digits=r"\d+", zeros="0*", label="Supplier")
    return b.table(spark, folder, "supplier").select("s_suppkey", "s_name", code.alias("code"))


_TAG = """list_filter(string_split(p_name, ' '), lambda t: t not in ('small', 'red'))[1]"""


@query("primary_tag", f"select p_partkey, coalesce({_TAG}, 'plain') as tag from part")
def _(spark, folder):
    tag = dv.primary_tag("p_name", "plain", ["small", "red"], sep=" ")
    return b.table(spark, folder, "part").select("p_partkey", tag.alias("tag"))


@query("category_map", """
select p_partkey, case p_type when 'PROMO' then 'Sale' when 'ECONOMY' then 'Sale' when 'LARGE' then 'Size'
  when 'SMALL' then 'Size' else 'Other' end as category from part""")
def _(spark, folder):
    names = {"PROMO": "Sale", "ECONOMY": "Sale", "LARGE": "Size", "SMALL": "Size"}
    return b.table(spark, folder, "part").select(
        "p_partkey", dv.map_values("p_type", names, "Other").alias("category"))


@query("popularity", "select p_partkey, round(ln(1 + p_size::double) * p_retailprice, 4) as popularity from part")
def _(spark, folder):
    return b.table(spark, folder, "part").select(
        "p_partkey", dv.popularity("p_size", "p_retailprice").alias("popularity"))


@query("price_label", on(RAW, """
select item_id, collected_at, case price_level when 0 then 'Free' when 1 then 'Budget' when 2 then 'Moderate'
  when 3 then 'Expensive' when 4 then 'Luxury' else 'Unknown' end as price_label from raw"""))
def _(spark, folder):
    return b.raw(spark, folder).select(
        "item_id", "collected_at", dv.ordinal_label("price_level", presets.PRICE_LABELS).alias("price_label"))


@query("discount_buckets", """
select case when l_discount >= 0 and l_discount < 0.025 then 'low' when l_discount < 0.055 then 'middle'
  when l_discount <= 0.095 then 'high' else 'Unknown' end as bucket, count(*) as n from lineitem group by 1""")
def _(spark, folder):
    from shelfmark.operators.aggregate import distribution

    bucket = dv.bucketize("l_discount", [0, 0.025, 0.055, 0.095], ["low", "middle", "high"])
    return distribution(b.table(spark, folder, "lineitem"), bucket)


@query("fine_rating_buckets", on(RAW, """
select case when rating is null then 'Unknown' when rating < 3.5 then 'Poor' when rating < 4 then 'Average'
  when rating < 4.5 then 'Good' when rating < 5.01 then 'Excellent' else 'Unknown' end as bucket,
  count(*) as n from raw group by 1"""))
def _(spark, folder):
    from shelfmark.operators.aggregate import distribution

    bucket = dv.bucketize("rating", presets.FINE_RATING_EDGES, presets.FINE_RATING_LABELS, closed_last=False)
    return distribution(b.raw(spark, folder), bucket)


def _load_sql(weights, digits, spread, centre, per, places):
    curve = ", ".join(str(float(w)) for w in weights)
    number = f"('0x' || substr(md5(event_id::varchar), 1, {digits}))::bigint"
    return f"""
select event_id, round(greatest(0.0::double, least(100.0::double,
  (0.6::double * least(ln(1 + value) / ln(5001::double), 1.0::double)
   + 0.4::double * ([{curve}]::double[])[hour(ts) + 1]
   + ({number} % {spread} - {centre}) / {per}::double) * 100)), {places}) as load_score from events"""


LOAD_SQL = _load_sql(presets.HOUR_WEIGHTS, 8, 15, 7, 100, 1)


@query("load_score_a", LOAD_SQL)
def _(spark, folder):
    return b.table(spark, folder, "events").select(
        "event_id", dv.load_score("event_id", "value", "ts", presets.HOUR_WEIGHTS).alias("load_score"))


@query("load_score_b", _load_sql([p / 100 for p in presets.HOUR_PERCENT], 4, 140, 70, 1000, 2))
def _(spark, folder):
    score = dv.load_score(
        "event_id", "value", "ts", [p / 100 for p in presets.HOUR_PERCENT],
        hex_digits=4, spread=140, centre=70, per=1000, digits=2)
    return b.table(spark, folder, "events").select("event_id", score.alias("load_score"))


@query("surrogate_key", "select c_custkey, 'CU' || upper(substr(md5(c_name || '-' || c_custkey), 1, 20)) as id from customer")
def _(spark, folder):
    return b.table(spark, folder, "customer").select(
        "c_custkey", dv.surrogate_key(["c_name", "c_custkey"], "CU").alias("id"))


@query("assign_bucket", "select o_orderkey, "
       "(('0x' || substr(md5(o_orderkey::varchar), 1, 8))::bigint % 200 + 1)::int as bucket from orders")
def _(spark, folder):
    return b.table(spark, folder, "orders").select("o_orderkey", dv.assign_bucket("o_orderkey", 200).alias("bucket"))


@query("rescale_to_int", "select l_orderkey, l_linenumber, l_quantity, "
       "greatest(1, least(5, round((l_quantity - 1) / 49 * 4 + 1)::int)) as score from lineitem")
def _(spark, folder):
    return b.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        dv.rescale_to_int(dv.in_unit("l_quantity", 1, 50)).alias("score"))


@query("rounded", "select l_orderkey, l_linenumber, round(l_extendedprice / 7, 3) as price, "
       "round(l_quantity / 3, 0) as quantity from lineitem")
def _(spark, folder):
    lines = b.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 7).alias("price"),
        (F.col("l_quantity") / 3).alias("quantity"))
    return lines.withColumns(dv.rounded({"price": 3, "quantity": 0}))


@query("json_extract", "select event_id, (props->>'$.k')::int as k, cast(null as int) as absent from events")
def _(spark, folder):
    events = b.table(spark, folder, "events").select("event_id", "props")
    return ns.flatten_details(events, "props", "k int, absent int", {"k": "k", "absent": "absent"}, keep=["event_id"])


@query("flatten_details", on(RAW, """
select item_id, name, address as formatted_address, rating as lat, total_ratings as ratings, open_now
from raw where rating is not null or total_ratings is not null or open_now is not null"""))
def _(spark, folder):
    known = F.coalesce("rating", F.col("total_ratings"), F.col("open_now").cast("int")).isNotNull()
    payload = F.to_json(F.struct(
        "name", F.col("address").alias("formatted_address"),
        F.struct(F.struct(F.col("rating").alias("lat")).alias("location")).alias("geometry"),
        F.col("total_ratings").alias("user_ratings_total"),
        F.struct("open_now").alias("opening_hours")))
    rows = b.raw(spark, folder).select("item_id", F.when(known, payload).otherwise("{}").alias("payload"))
    schema = ("place_id bigint, name string, formatted_address string, geometry struct<location: struct<lat: double>>, "
              "user_ratings_total bigint, opening_hours struct<open_now: boolean>")
    return ns.flatten_details(rows, "payload", schema, {
        "item_id": "place_id", "name": "name", "formatted_address": "formatted_address",
        "lat": "geometry.location.lat", "ratings": "user_ratings_total", "open_now": "opening_hours.open_now",
    }, default_id=("item_id", "item_id"))


_LINES = "string_split(text, chr(10))"


@query("rollup_nested", f"""
select doc_id, len({_LINES}) as line_count, md5(array_to_string({_LINES}, ' | ')) as joined,
       round(list_avg(list_transform({_LINES}, lambda t: length(t)::double)), 6) as mean_length
from documents""")
def _(spark, folder):
    lines = F.transform(F.split("text", "\n"), lambda t: F.struct(t.alias("text"), F.length(t).alias("rating")))
    docs = b.table(spark, folder, "documents").select("doc_id", lines.alias("lines"))
    rolled = docs.select("doc_id", *ns.rollup_nested(
        "lines", "text", "rating", names=("line_count", "joined", "mean_length")))
    return rolled.select(
        "doc_id", F.col("line_count").cast("bigint").alias("line_count"), F.md5("joined").alias("joined"),
        F.round("mean_length", 6).alias("mean_length"))
