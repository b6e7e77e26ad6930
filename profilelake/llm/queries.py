"""The registered query of each operator, and the DuckDB SQL that checks it where there is one."""

from __future__ import annotations

from pyspark.sql import functions as F

from profilelake.llm import (
    bitplanes,
    brown,
    chat,
    decontaminate,
    embedding_dups,
    hardneg,
    mixing,
    pieces,
    pii,
    simhash,
    toxicity,
    variants,
    warc,
)
from profilelake.llm.common import table
from profilelake.session import configure, fresh_path


def op1_pii(spark, sf_dir):
    configure(spark)
    return pii.find(table(spark, sf_dir, "documents"), pii.labelled_table(spark))


def op2_bitplanes(spark, sf_dir):
    path = fresh_path(configure(spark), "bitplanes")
    bitplanes.write(table(spark, sf_dir, "documents"), path)
    return bitplanes.report(spark, path)


def op3_brown(spark, sf_dir):
    return brown.report(table(configure(spark), sf_dir, "documents"))


def op4_toxicity(spark, sf_dir):
    configure(spark)
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark, sf_dir):
    configure(spark)
    return mixing.mixed(table(spark, sf_dir, "documents")).drop("source")


def op6_embeddings(spark, sf_dir):
    return embedding_dups.near_duplicates(table(configure(spark), sf_dir, "embeddings"))


def op7_warc(spark, sf_dir):
    path = fresh_path(configure(spark), "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.verify(spark, path)


def op8_decontamination(spark, sf_dir):
    configure(spark)
    return decontaminate.report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: What both turns of the added conversation -7 say.
TRICKY = r"\### Assistant: </turn> ok"


def op9_chat(spark, sf_dir):
    configure(spark)
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    path = fresh_path(spark, "chat")
    chat.render(chat.fold(chat.as_events(rows.unionByName(added)))).write.parquet(path)
    return chat.digest(spark.read.parquet(path))


def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(configure(spark), sf_dir, "documents"))


def op11_hard_negatives(spark, sf_dir):
    return hardneg.mine(table(configure(spark), sf_dir, "embeddings"))


def op12_spelling_variants(spark, sf_dir):
    return variants.variants(table(configure(spark), sf_dir, "documents"))


def op13_sentencepiece(spark, sf_dir):
    return pieces.report(table(configure(spark), sf_dir, "documents"))


QUERIES = {
    f.__name__: f for f in (
        op1_pii, op2_bitplanes, op3_brown, op4_toxicity, op5_mixing, op6_embeddings, op7_warc,
        op8_decontamination, op9_chat, op10_simhash, op11_hard_negatives, op12_spelling_variants,
        op13_sentencepiece,
    )
}

_WORDS8 = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

ORACLES = {
    "op11_hard_negatives": """
with base as (
  select row_number() over () as rw, vec_id,
    case when vec_id % 7 = 0 then (label + 1) % 10 else label end as lab,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
),
pairs as (
  select a.rw, a.vec_id as aid, r.vec_id as rid, r.lab = a.lab as same,
    coalesce(list_sum(list_transform(range(1, greatest(len(a.v), len(r.v)) + 1),
      lambda i: coalesce(a.v[i], 0) * coalesce(r.v[i], 0))), 0) as score
  from base a join base r on r.vec_id <> a.vec_id
  where a.vec_id % 100 = 0
),
pos as (
  select rw, aid, rid as pid, score as ps,
    row_number() over (partition by rw order by score desc, rid) as pr
  from pairs where same qualify pr <= 5
),
neg as (
  select p.aid, p.pid, p.ps, n.rid as nid, n.score as ns,
    row_number() over (partition by p.rw, p.pr order by n.score desc, n.rid) as rk
  from pos p join pairs n on n.rw = p.rw and not n.same
    and 30 * p.ps <= 100 * n.score and 100 * n.score <= 90 * p.ps
)
select aid as anchor_id, pid as positive_id, cast(rk as integer) as rank, nid as negative_id,
  ps as positive_score, ns as negative_score
from neg where rk <= 10
""",
    "op8_decontamination": f"""
with b as (select cast(item_id as varchar) item, {_WORDS8} w from benchmark),
win as (
  select distinct item, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') s, least(10, len(w)) n
  from (select item, w, unnest(range(1, greatest(2, len(w) - 8))) i from b where len(w) > 0)
), d as (select row_number() over () r, doc_id, coalesce({_WORDS8}, []) w from documents),
pos as (
  select r, i, n, array_to_string(w[i:i + n - 1], ' ') s
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) i
        from d, (select distinct n from win) where len(w) >= n)
), found as (select r, i, pos.n, item from pos join win using (s)),
hit as (select r, count(distinct p) n_hit
        from (select r, unnest(range(i, i + n)) p from found) group by r),
items as (select r, count(distinct item) n_items, string_agg(distinct item, ',' order by item) s
          from found group by r)
select doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(s, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join hit using (r) left join items using (r)""",
    "op5_mixing": f"""
with recursive d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) size,
    md5(coalesce(cast(doc_id as varchar), '')) turn
  from documents
), per as (
  select source, sum(size)::bigint source_size,
    row_number() over (order by source is null, source collate "binary") no
  from d group by source
), w as (select *, (no - 1) % 3 + 1 weight, 3 * source_size cap from per),
tot as (select sum(source_size) t, sum(weight) tw from w),
lev as (
  select source_size * 3 * (6 // weight) level, sum(cap) c, sum(weight) cw from w group by 1
), full_at as (
  select level, sum(c) over (order by level) c, sum(cw) over (order by level) cw from lev
), st as (
  select max(level) top, coalesce(max(c), 0) c, coalesce(max(cw), 0) cw from full_at, tot
  where cw < tw and 6 * c + level * (tw - cw) <= 6 * t
), target as (
  select no, source, source_size,
    case when source_size * 3 * (6 // weight) <= coalesce(top, -1) then cap::double
      else (t - st.c)::double * weight / (tw - st.cw)::double end target
  from w, st, tot
), ends as (
  select *, round(sum(target) over (order by no)
    / (select sum(target) from target) * 2147483648)::bigint hi
  from target
), span as (select *, lag(hi, 1, 0) over (order by no) lo from ends),
slots as (
  select id, (id % 2147483648) * 1327217885 % 2147483648 point
  from (select unnest(range(floor((select sum(target) from target) / {mixing.BLOCK} + 0.5)::bigint)) id)
), ranked as (
  select no, row_number() over (partition by no order by id) - 1 rank
  from slots join span on point >= lo and point < hi
), used as (
  select no, rank % n block, count(*) times
  from ranked join (select no, (source_size + {mixing.BLOCK - 1}) // {mixing.BLOCK} n from target)
    using (no)
  where n > 0 and rank < 3 * n group by 1, 2
), placed as (
  select d.*, no, source_size, target, row_number() over () r,
    (sum(size) over (partition by no order by turn, doc_id, size rows unbounded preceding) - size)::bigint a
  from d join target on d.source is not distinct from target.source
), taken as (
  select r, sum((least(a + size, (b + 1) * {mixing.BLOCK}) - greatest(a, b * {mixing.BLOCK})) * times) taken
  from (select *, unnest(range(a // {mixing.BLOCK}, (a + size - 1) // {mixing.BLOCK} + 1)) b
        from placed where size > 0) p
    join used on used.no = p.no and used.block = p.b
  group by r
)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint taken
from placed left join taken using (r)""",
    "op6_embeddings": """
with recursive v as (
  select vec_id, embedding::double[] e from embeddings
), u as (
  select vec_id, e from v
  where e is not null and list_sum(list_transform(e, lambda x: x * x)) > 0
    and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
), l as (
  select a.vec_id a, b.vec_id b from u a, u b
  where a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.9
), r as (select a, b from l union select r.a, l.b from r join l on r.b = l.a)
select vec_id, (select count(*) from l where a = vec_id) n_links,
  least(vec_id, coalesce((select min(b) from r where a = vec_id), vec_id)) component_id,
  vec_id = least(vec_id, coalesce((select min(b) from r where a = vec_id), vec_id)) kept
from v""",
    "op7_warc": """
with p as (
  select page_id, coalesce(url, '') url, encode(coalesce(html, '')) h from pages
), k as (select page_id, url, octet_length(h) payload_bytes, sha256(h) k, upper(sha1(h)) x from p),
r as (
  select *, row_number() over (partition by k order by page_id desc nulls last, url desc) = 1 response,
    first_value(page_id) over (partition by k order by page_id desc nulls last, url desc) f
  from k
)
select page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(x, 1 + 10 * (i // 8), 10))::bigint >> (35 - 5 * (i % 8))) & 31)::int, 1)), '')
    payload_digest,
  case when response then 'response' else 'revisit' end record_type,
  case when not response then f end refers_to
from r""",
    "op9_chat": r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), f as (
  select *, '### ' || regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g') || ': '
    || regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g') || ' </turn>' || chr(10) s
  from c
)
select conv_id, count(*) n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, sha256(text)))
    turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, sha256(text))
    filter (role = 'assistant'), '')) loss_sha256,
  sum(length(s))::bigint formatted_chars
from f group by conv_id""",
}
