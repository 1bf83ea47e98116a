"""The named queries of this subpackage and their SQL, with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.bpe import encode_digests
from shelfmark.llm.chat import chat_digests
from shelfmark.llm.collocations import collocations
from shelfmark.llm.exact_dedup import exact_duplicates
from shelfmark.llm.line_dedup import BLOCKS, MIN_PAGES, RATIO, drop_boilerplate, host_of, lines_of
from shelfmark.llm.main_text import main_text
from shelfmark.llm.minhash import near_duplicates
from shelfmark.llm.packing import pack
from shelfmark.llm.periodic import periodic_runs, repeat_tail
from shelfmark.llm.quality import fit, held_out, score
from shelfmark.llm.suffix_dedup import suffix_duplicates
from shelfmark.llm.token_counts import count_tokens
from shelfmark.llm.topk import top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


PIECE = ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset"]


@query("op6_mixture_packing")
def op6(spark, folder):
    packed = pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), window=4096, end_id=2)
    return packed.select(*PIECE, F.crc32("ids").alias("ids_crc32"))


@query("op7_exact_dedup", """
with n as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from n""")
def op7(spark, folder):
    return exact_duplicates(table(spark, folder, "documents"))


@query("op9_token_counts")
def op9(spark, folder):
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query("op10_bpe_round_trip")
def op10(spark, folder):
    return encode_digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op1_quality_scores")
def op1(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weights = fit(docs, table(spark, folder, "labels"))
    return score(docs, weights).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op3_chat_format", """
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (
  select *, length(text) + length(regexp_replace(text, '([^\\\\]|\\n)', '', 'g'))
    + len(regexp_extract_all(text, '\\[INST\\]|\\[/INST\\]|</s>|<s>|\\[ROLE\\]|\\[TEXT\\]|\\[/ROLE\\]')) as n
  from c)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(case role when 'user' then n + 15 when 'assistant' then n + 4 else n + length(role) + 23 end)::bigint
    as formatted_chars
from e group by conv_id""")
def op3(spark, folder):
    said = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat_digests(rows.unionByName(probe))


@query("op2_pivot_top_k", """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5""")
def op2(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5, scale=256)


HTML_LINES = rf"""
select row_number() over () as row, page_id,
  lower(coalesce(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '')) as host,
  list_filter(list_transform(regexp_split_to_array(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'),
      '(?i)</?({BLOCKS})( [^>]*)?/?>', chr(10), 'g'), '<[^>]*>', '', 'g'), '[\n\r]'),
    lambda x: regexp_replace(x, '^[ \t]+|[ \t]+$', '', 'g')), lambda x: x <> '') as lines
from pages"""


@query("op5_site_boilerplate", f"""
with p as ({HTML_LINES}),
l as (select row, host, generate_subscripts(lines, 1) as at, unnest(lines) as line from p),
b as (
  select host, line from l where host <> '' group by host, line
  having count(distinct row) >= {MIN_PAGES}
    and count(distinct row) > {RATIO} * (select count(*) from p as q where q.host = l.host)),
k as (
  select l.row, string_agg(l.line, chr(10) order by l.at) as text, count(*) as n from l
  where not exists (select 1 from b where b.host = l.host and b.line = l.line) group by l.row)
select p.page_id, p.host, len(p.lines)::int as n_lines, (len(p.lines) - coalesce(k.n, 0))::int as n_dropped,
  coalesce(k.text, '') as text
from p left join k on p.row = k.row""")
def op5(spark, folder):
    pages = table(spark, folder, "pages").select(
        "page_id", host_of(F.col("url")).alias("host"), lines_of(F.col("html")).alias("lines"))
    out = drop_boilerplate(pages, F.col("host"), F.col("lines"))
    return out.select("page_id", "host", "n_lines", "n_dropped", F.array_join("lines", "\n").alias("text"))


@query("op4_odd_sketch_near_dedup", r"""
with recursive d as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
g as (
  select distinct r, array_to_string(w[i:i + 2], ' ') as g from (select r, w, unnest(range(1, greatest(len(w) - 1, 2))) as i from d where len(w) > 0)),
n as (select r, count(*) as n from g group by r),
p as (
  select x.r as a, y.r as b, count(*) as common from g as x join g as y on x.g = y.g and x.r <> y.r group by x.r, y.r),
l as (
  select p.a, p.b from p join n as x on x.r = p.a join n as y on y.r = p.b where 100 * common >= 85 * (x.n + y.n - common)),
t as (select a, b from l union select t.a, l.b from t join l on l.a = t.b)
select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(min(o.doc_id), d.doc_id)) as component_id,
  d.doc_id <= coalesce(min(o.doc_id), d.doc_id) as kept
from d left join n using (r) left join t on t.a = d.r left join d as o on o.r = t.b group by d.r, d.doc_id, n.n""")
def op4(spark, folder):
    return near_duplicates(table(spark, folder, "documents"), shingle=3, percent=85)


@query("op8_suffix_dedup", r"""
with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
k as (select r, doc_id, unnest(range(0, greatest(1, (length(h) // 2 + 1023) // 1024))) as k, h from d),
b as (select r, doc_id, k, substr(h, 2048 * k + 1, 2146) as h from k),
p as (select r, doc_id, 1024 * k + j as i, substr(h, 2 * j + 1, 2) as x, substr(h, 2 * j + 1, 100) as g
      from (select *, unnest(range(0, least(1024, length(h) // 2))) as j from b)),
m as (select g, min(doc_id) as first from p where length(g) = 100 group by g),
c as (select p.*, length(p.g) = 100 and p.doc_id > m.first as hit from p left join m using (g)),
n as (select r, i, x, bool_or(coalesce(hit, false)) over (partition by r order by i rows between 49 preceding and current row) as gone from c),
e as (select *, gone and not coalesce(lag(gone) over (partition by r order by i), false) as begins from n),
s as (
  select r, count(*) as n_bytes, count(*) filter (gone) as n_removed, count(*) filter (begins) as n_spans,
    coalesce(string_agg(x, '' order by i) filter (not gone), '') as left_over from e group by r)
select d.doc_id, coalesce(n_bytes, 0) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(left_over, ''))) as kept_sha256
from d left join s using (r)""")
def op8(spark, folder):
    return suffix_duplicates(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_periodic_runs")
def op11(spark, folder):
    return periodic_runs(table(spark, folder, "documents"), whole=False, edit=repeat_tail)


@query("op13_main_text")
def op13(spark, folder):
    return main_text(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query("op12_collocations", r"""
with d as (
  select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
s as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\n\x0B\f\r]')) as s from d),
w as (select lang, list_filter(regexp_split_to_array(s, '[ \t]+'), lambda x: x <> '') as w from s),
o as (select lang, w, unnest(range(1, len(w) + 1)) as i from w),
p as (select lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) as k from o),
f as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as a from p group by all),
n as (select lang, sum(a)::hugeint as n from f where k = 1 group by lang),
c as (select *, string_split(phrase, ' ') as w from f where a >= 100 and k > 1),
j as (select *, unnest(range(1, k)) as j from c),
x as (
  select j.*, l.a as l, r.a as r, n.n, (1000::hugeint * j.a * n.n) // (l.a::hugeint * r.a) as score from j
  join f as l on l.lang = j.lang and l.phrase = array_to_string(j.w[1:j.j], ' ')
  join f as r on r.lang = j.lang and r.phrase = array_to_string(j.w[j.j + 1:], ' ')
  join n on n.lang = j.lang),
b as (select * from x qualify row_number() over (partition by lang, phrase order by score, j) = 1),
m as (
  select * from b where not exists (
    select 1 from c where c.lang = b.lang and c.k > b.k and 100 * c.a >= 100 * b.a
      and contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ')))
select * from (
  select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r,
    n::bigint as n, score::bigint as score from m)
where rank <= 2000""")
def op12(spark, folder):
    return collocations(table(spark, folder, "documents"))
