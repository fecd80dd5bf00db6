"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op10_jaccard_join"] = r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
sets as (
  select doc_id, case when len(words) = 0 or words is null then []
    when len(words) < 4 then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i+3], ' '))) end as s from w),
classes as (select s, min(doc_id) as rep, len(s) as n from sets where len(s) > 0 group by s),
items as (select rep, n, unnest(s) as x from classes),
pairs as (
  select a.rep as a, b.rep as b from items a join items b on a.x = b.x and a.rep < b.rep
  group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges as (select a, b from pairs union all select b, a from pairs),
reach(node, seen) as (
  select rep, rep from classes union select r.node, e.b from reach r join edges e on r.seen = e.a),
comp as (select node, min(seen) as c from reach group by node)
select t.doc_id, cast(len(t.s) as bigint) as n_shingles, coalesce(m.c, t.doc_id) as component_id
from sets t left join classes k on t.s = k.s left join comp m on k.rep = m.node
"""

SQL["op2_branch_and_bound"] = """
with v as (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.r as own, q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.r <> c.r where q.vec_id % 50 = 0),
r as (select query_id, cast(row_number() over (partition by own order by score desc, vec_id) as integer) as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""

SQL["op6_product_quantisation"] = """
with recursive v as (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
  and len(list_filter(embedding, lambda x: x <> 0)) > 0),
edges as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.95),
reach(node, seen) as (select vec_id, vec_id from embeddings union
  select r.node, e.b from reach r join edges e on r.seen = e.a),
comp as (select node, min(seen) as c from reach group by node),
n as (select a, count(*) as n from edges group by a)
select t.vec_id, coalesce(n.n, 0) as n_links, comp.c as component_id, t.vec_id = comp.c as kept
from embeddings t join comp on comp.node = t.vec_id left join n on n.a = t.vec_id
"""

SQL["op12_inverted_index"] = r"""
with low as (
  select doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
docs as (select row_number() over () as r, doc_id, coalesce(w, []) as w from low),
own as (
  select item_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
windows as (
  select distinct item_id, p from (select item_id,
    unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i+9])) as p from own where len(w) > 0)),
sizes as (select distinct len(p) as n from windows),
places as (
  select r, n, unnest(range(1, len(w) - n + 2)) as i, w from docs, sizes where len(w) >= n),
spans as (select r, i, n, w[i:i+n-1] as p from places),
hits as (select s.r, s.i, s.n, x.item_id from spans s join windows x on s.p = x.p),
covered as (select r, count(distinct i + k) as n_hit from (select r, i, unnest(range(0, n)) as k from hits) group by r),
items as (select r, list_sort(list_distinct(list(item_id::varchar))) as ids from hits where item_id is not null group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(c.n_hit, 0) as n_hit, cast(coalesce(len(t.ids), 0) as bigint) as n_items,
  sha256(coalesce(array_to_string(t.ids, ','), '')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated
from docs d left join covered c on c.r = d.r left join items t on t.r = d.r
"""

SQL["op11_threshold_negatives"] = """
with v as (select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.r as ar, a.vec_id as anchor_id, b.r as br, b.vec_id, a.label = b.label as same,
  cast(list_inner_product(a.e, b.e) as bigint) as score from v a join v b on a.r <> b.r where a.vec_id % 100 = 0),
p as (select *, row_number() over (partition by ar order by score desc, vec_id, br) as slot from s where same),
n as (select p.ar, p.slot, p.anchor_id, p.vec_id as positive_id, p.score as positive_score, s.vec_id as negative_id, s.score as negative_score,
  cast(row_number() over (partition by p.ar, p.slot order by s.score desc, s.vec_id, s.br) as integer) as rank
  from p join s on p.ar = s.ar and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score where p.slot <= 5)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10
"""
