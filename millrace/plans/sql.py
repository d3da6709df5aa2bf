"""Pieces of SQL that several queries share."""

STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def strip(x: str) -> str:
    return STRIP.format(x)


def hash60(x: str) -> str:
    return f"cast(('0x' || substr(md5({x}), 1, 15)) as bigint)"


def tokens(x: str) -> str:
    return f"list_distinct(regexp_extract_all(lower({clean(x)}), '[\\p{{L}}\\p{{N}}_]+'))"


def clean(x: str) -> str:
    return strip(f"replace(coalesce({x}, ''), chr(10), ' ')")


def jaccard(a: str, b: str) -> str:
    return f"case when len({a}) = 0 or len({b}) = 0 then 0.0 else len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) end"


USABLE = "embedding is not null and len(embedding) = 128 and len(list_filter(embedding, lambda x: x is null)) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0"
STORE = f"""st as (
  select dataset, kind, id, lang, regexp_replace(id, '_[^_]*$', '') as item, embedding::double[] as v from (
    select coalesce(dataset, '') as dataset, coalesce(kind, '') as kind, coalesce(id, '') as id, coalesce(lang, '') as lang, embedding,
      row_number() over (partition by coalesce(dataset, ''), coalesce(kind, ''), coalesce(id, ''), coalesce(lang, '') order by coalesce(source_shard, 2147483647), embedding) as rn
    from vector_store where {USABLE}) where rn = 1)"""
L2 = "round(list_sum(list_transform(list_zip(q.v, p.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 9)"
SCORED = f"""{STORE},
keys as (select distinct coalesce(query_id, '') as query_id, coalesce(passage_id, '') as passage_id, coalesce(lang, '') as lang, coalesce(dataset, '') as dataset from pairs),
npos as (select query_id, lang, dataset, count(*) as n from keys group by all),
near as (select q.dataset, q.lang as ql, q.item as qi, p.lang as pl, p.item as pi,
    row_number() over (partition by q.dataset, q.lang, q.item order by {L2}, '{{"dataset":"' || p.dataset || '","lang":"' || p.lang || '","passage":"' || p.item || '"}}') as r
  from st q join st p on q.dataset = p.dataset and q.kind = 'query' and p.kind = 'passage'
  where exists (select 1 from npos n where n.query_id = q.item and n.lang = q.lang and n.dataset = q.dataset)),
ranked as (select k.*, n.n, case when x.r <= case when n.n > 1 then 100 else 30 end then x.r end as rr,
    row_number() over (partition by k.dataset, k.lang, k.query_id order by x.r nulls last) - 1 as b
  from keys k join npos n on k.query_id = n.query_id and k.lang = n.lang and k.dataset = n.dataset
  left join near x on x.dataset = k.dataset and x.ql = k.lang and x.qi = k.query_id and x.pl = k.lang and x.pi = k.passage_id and x.r <= 100),
ranks as (select *, coalesce(rr, -1) as retrieval_rank, coalesce(case when rr > 30 and n > 1 then rr - b end, -1) as virtual_rank from ranked),
scored as (select p.query_id, p.passage_id, p.lang, p.dataset, p.query, p.passage, cast(r.retrieval_rank as int) as retrieval_rank, cast(r.virtual_rank as int) as virtual_rank,
    (r.retrieval_rank <> -1 and r.retrieval_rank <= 30) or (r.virtual_rank <> -1 and r.virtual_rank <= 30) as consistency
  from pairs p join ranks r on coalesce(p.query_id, '') = r.query_id and coalesce(p.passage_id, '') = r.passage_id and coalesce(p.lang, '') = r.lang and coalesce(p.dataset, '') = r.dataset)"""
BY_R = "(retrieval_rank <> -1 and retrieval_rank < 30)"
BY_V = "(virtual_rank <> -1 and virtual_rank < 30)"

IP = "round(list_dot_product(q.v, p.v), 9)"
#: Mining over the store: k0 = 50, k_max = 1000, eight negatives, delta 0.05, by dataset.
MINED = f"""{STORE},
pos as (select distinct q.id as query, p.id as passage, q.lang = p.lang as same_lang, q.dataset as dataset, q.v as qv, p.v as pv
  from st q join pairs x on q.kind = 'query' and x.query_id = q.item and x.dataset = q.dataset
  join st p on p.kind = 'passage' and p.item = x.passage_id and p.dataset = q.dataset),
ref as (select query, round(coalesce(avg(case when same_lang then s end), avg(s)), 9) as avg_pos_score
  from (select query, same_lang, round(list_dot_product(qv, pv), 9) as s from pos) group by query),
size as (select dataset, count(*) as n, cast(50 * power(2, greatest(0, floor(log2(least(count(*), 1000) / 50.0) + 1e-12))) as bigint) as depth from st where kind = 'passage' group by dataset),
near as (select q.dataset, q.id as query, p.id as passage, {IP} as score, row_number() over (partition by q.id order by {IP} desc, p.id) as rk
  from st q join st p on q.kind = 'query' and p.kind = 'passage' and q.dataset = p.dataset where q.id in (select query from ref)),
cand as (select n.dataset, n.query, n.passage, n.score, r.avg_pos_score, cast(n.rk - 1 as int) as rank
  from near n join size s on s.dataset = n.dataset join ref r on r.query = n.query
  where n.rk <= s.depth and n.score <= r.avg_pos_score - abs(r.avg_pos_score) * 0.05
    and not exists (select 1 from pos p where p.query = n.query and p.passage = n.passage)),
mined as (select * from (select *, cast(row_number() over (partition by dataset, query order by score desc, passage desc) as int) as n from cand) where n <= 8)"""

#: Components of the query-passage graph: the smallest node that each node reaches.
COMPONENTS = """edges as (select distinct 'q:' || coalesce(query_id, '') as a, 'p:' || coalesce(passage_id, '') as b from pairs),
both_ways as (select a, b from edges union all select b, a from edges),
reach(node, root) as (select distinct a, a from both_ways union select e.b, r.root from reach r join both_ways e on e.a = r.node where r.root < e.b),
cc as (select node, min(root) as component from reach group by node)"""
