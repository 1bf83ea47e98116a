"""SQL forms of the tables in ``bindings``, as named parts of a WITH clause."""

RAW = """
lines as (
  select l_partkey, round(1 + 4 * (avg(l_quantity) - 1) / 49, 1) as r, count(*) as n,
         count(*) filter (where l_returnflag = 'R') as returned,
         sum(cast(round(l_tax * 100) as bigint))::bigint as tax
  from lineitem group by l_partkey),
raw as (
  select p_partkey as item_id, p_name as name,
         case when p_partkey % 9 = 0 then p_partkey || ' Main Street'
              else p_partkey || ' Main Street, ' || p_brand end as address,
         replace(p_name, ' ', ', ') || ', ' || lower(p_type) as tags,
         case when p_partkey % 7 <> 0 then r end as rating,
         case when p_partkey % 11 <> 0 then case when run = 2 then n else n // 2 end end as total_ratings,
         case when p_partkey % 13 <> 0 then p_size % 5 end as price_level,
         case when p_partkey % 3 = 0 then true when p_partkey % 3 = 1 then false end as open_now,
         case when p_partkey % 17 <> 0 then returned end as review_count,
         case when p_partkey % 4 <> 0 then p_name || ' | ' || p_type end as review_texts,
         case when p_partkey % 19 <> 0 then round(1 + 4 * (tax / n) / 8, 1) end as avg_review_rating,
         case when run = 2 then timestamp '2024-01-02 00:00:00' else timestamp '2024-01-01 00:00:00' end
           as collected_at
  from part left join lines on p_partkey = l_partkey
  cross join (values (1), (2)) as runs(run)
  where run = 2 or p_partkey % 5 = 0)
"""

KEPT = RAW + """,
deduped as (
  select * exclude (rn) from (
    select *, row_number() over (partition by item_id order by collected_at desc) as rn from raw)
  where rn = 1),
kept as (select * from deduped where rating is not null or total_ratings is not null)
"""

FILLED = KEPT + """,
stats as (
  select quantile_cont(rating, 0.5) as rating_median, quantile_cont(avg_review_rating, 0.5) as review_median,
         (select price_level from kept where price_level is not null
          group by price_level order by count(*) desc, price_level limit 1) as price_mode
  from kept),
filled as (
  select item_id, name, address, tags, coalesce(rating, rating_median) as rating,
         coalesce(total_ratings, 0) as total_ratings, coalesce(price_level, price_mode) as price_level, open_now,
         coalesce(review_count, 0) as review_count, coalesce(review_texts, '') as review_texts,
         coalesce(avg_review_rating, review_median) as avg_review_rating, collected_at
  from kept, stats)
"""

ENTITY = FILLED + """,
coded as (
  select *, regexp_extract(address, '(?i)Brand#\\s*(\\d{1,2})', 1) as code,
         list_filter(list_transform(string_split(tags, ','), lambda t: trim(t)),
                     lambda t: t not in ('small', 'large', 'red', 'blue', 'old', 'new', 'hot', 'cold'))[1] as tag
  from filled),
entity as (
  select * exclude (code, tag),
         case when code <> '' then 'Brand ' || regexp_replace(code, '^0?(\\d+)$', '\\1') else 'No brand' end
           as district,
         coalesce(tag, 'thing') as primary_type,
         round(ln(1 + total_ratings::double) * rating, 4) as popularity,
         case price_level when 0 then 'Free' when 1 then 'Budget' when 2 then 'Moderate'
              when 3 then 'Expensive' when 4 then 'Luxury' else 'Unknown' end as price_label,
         case coalesce(tag, 'thing')
              when 'ring' then 'Jewellery' when 'bolt' then 'Fasteners' when 'rod' then 'Fasteners'
              when 'gear' then 'Machinery' when 'widget' then 'Gadgets' when 'gizmo' then 'Gadgets'
              when 'plate' then 'Tableware' else 'Other' end as category
  from coded)
"""

INTERACTIONS = """
interactions as (
  select o_custkey as user_id, l_partkey as item_id,
         greatest(1, least(5, round((avg(l_quantity) - 1) / 49 * 4 + 1)::int)) as score, count(*) as n
  from orders join lineitem on o_orderkey = l_orderkey group by o_custkey, l_partkey)
"""

BASELINE_RECS = INTERACTIONS + """,
users as (select item_id, count(*) as users from interactions group by item_id),
baseline_recs as (
  select user_id, item_id, users, rank from (
    select user_id, item_id, users,
           (row_number() over (partition by user_id order by users desc, item_id))::int as rank
    from interactions join users using (item_id))
  where rank <= 10)
"""

SPLIT = INTERACTIONS + """,
flagged as (
  select *, ('0x' || substr(md5(user_id || '-' || item_id || '-42'), 1, 8))::bigint % 100 < 80 as train
  from interactions)
"""

BIAS = SPLIT + """,
u as (select user_id, avg(score) as u from flagged where train group by user_id),
i as (select item_id, avg(score) as i from flagged where train group by item_id),
predictions as (
  select user_id, item_id, score, u + i - (select avg(score) from flagged where train) as prediction
  from flagged join u using (user_id) join i using (item_id) where not train)
"""


def on(tables: str, select: str) -> str:
    """A query over the named tables."""
    return f"with {tables.strip()}\n{select.strip()}"
