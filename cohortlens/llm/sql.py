"""DuckDB SQL of the corpus queries that SQL can express."""

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"[^\x20\x09-\x0D]+"

OP1 = r"""
with conv as (
  select conv_id, list({'role': coalesce(role, 'user'), 'text': coalesce(text, '')}
                       order by turn nulls first, coalesce(role, 'user'), coalesce(text, '')) as t
  from conversations where conv_id is not null group by conv_id
), grp as (
  select conv_id, t, row_number() over (partition by floor(conv_id / 64.0) order by t[1].role, t[1].text, conv_id) - 1 as i,
         floor(conv_id / 64.0) as blk
  from conv
), pair as (
  select a.conv_id as chosen_id, b.conv_id as rejected_id, a.t as good, b.t as bad
  from grp a left join grp b on a.blk = b.blk and b.i = a.i + 1
  where a.i % 2 = 0
), cut as (
  select *, case when bad is null then 0 else
    len(list_filter(range(1, 1 + least(len(good), len(bad))), lambda k: good[1:k] = bad[1:k])) end as n from pair
), rest as (
  select *, good[n + 1:] as g, bad[n + 1:] as b from cut
)
select chosen_id as pair_id, chosen_id, rejected_id, n::int as n_prompt_turns,
  coalesce(list_aggregate(list_transform(good[1:n], lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), 'string_agg', ''), '') as prompt,
  coalesce(list_aggregate(list_transform(g, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), 'string_agg', ''), '') as chosen,
  array_to_string(list_transform(list_filter(range(1, len(g) + 1), lambda k: g[k].role = 'assistant'), lambda k:
    (coalesce(list_sum(list_transform(g[1:k - 1], lambda x: length(x.role) + length(x.text) + 13)), 0) + length(g[k].role) + 5)::int || '-' ||
    (coalesce(list_sum(list_transform(g[1:k - 1], lambda x: length(x.role) + length(x.text) + 13)), 0) + length(g[k].role) + 5 + length(g[k].text))::int), ',') as chosen_spans,
  case when bad is not null then coalesce(list_aggregate(list_transform(b, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), 'string_agg', ''), '') end as rejected,
  case when bad is not null then array_to_string(list_transform(list_filter(range(1, len(b) + 1), lambda k: b[k].role = 'assistant'), lambda k:
    (coalesce(list_sum(list_transform(b[1:k - 1], lambda x: length(x.role) + length(x.text) + 13)), 0) + length(b[k].role) + 5)::int || '-' ||
    (coalesce(list_sum(list_transform(b[1:k - 1], lambda x: length(x.role) + length(x.text) + 13)), 0) + length(b[k].role) + 5 + length(b[k].text))::int), ',') end as rejected_spans
from rest
"""

OP2 = rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_WORDS}') as w from documents
), s as (
  select doc_id, list_distinct(case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from w
), n as (
  select doc_id, len(s) as n from s
), e as (
  select s.doc_id, n.n, hash(u.x) as x from s join n using (doc_id), unnest(s.s) as u(x)
), r as (
  select *, count(*) over (partition by x) as df from e
), p as (
  select *, row_number() over (partition by doc_id order by df, x) as k from r
), c as (
  select distinct a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb
  from p a join p b on a.x = b.x and a.doc_id < b.doc_id
  where a.k <= a.n - ceil(0.8 * a.n) + 1 and b.k <= b.n - ceil(0.8 * b.n) + 1 and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), l as materialized (
  select c.a, c.b from c join s x on x.doc_id = c.a join s y on y.doc_id = c.b
  where 100 * len(list_intersect(x.s, y.s)) >= 80 * (c.na + c.nb - len(list_intersect(x.s, y.s)))
), g as materialized (
  select a as u, b as v from l union all select b, a from l
), reach as (
  select doc_id as u, doc_id as v from n
  union
  select reach.u, g.v from reach join g on g.u = reach.v
)
select n.doc_id, n.n as n_shingles, m.component_id
from n join (select u as doc_id, min(v) as component_id from reach group by u) m using (doc_id)
"""

_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))


def _parts(prefix: str) -> str:
    return (rf"translate(coalesce(regexp_extract({prefix}, '://([^/?#]*)', 1), ''), '{_UP}', '{_LOW}') as host, "
            rf"coalesce(regexp_extract({prefix}, '://[^/?#]*([^?#]*)', 1), '') as path")


OP3 = rf"""
with recursive rules(rule, verdict) as (values {', '.join(f"('{r}', '{v}')" for r, v in _RULES)}
), r as materialized (
  select rule, verdict, split_part(rule, '/', 1) as rh, substr(rule, strpos(rule, '/')) as rp from rules
), tags as (
  select url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) as t from pages
), hrefs as (
  select url, case when regexp_matches(t, '(?i)^<link') then regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
    else regexp_extract(t, '(?is)\bcontent\s*=\s*["'']?[^"''>]*?url\s*=\s*["'']?([^"''\s>]+)', 1) end as u
  from tags where regexp_matches(t, '(?is)^<link\b.*\brel\s*=\s*["'']?canonical\b|^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b')
), ends as (
  select url as a, case when regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.-]*://') then u
    when u like '//%' then regexp_extract(url, '(?s)^(.*?:)//', 1) || u
    when u like '/%' then regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || u
    when u like '?%' or u like '#%' then url
    else rtrim(regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)', 1), '/') || '/' || u end as b
  from hrefs
), nodes as (
  select distinct x, {_parts('x')} from (select a as x from ends union all select b from ends union all select url from pages)
), named as (
  select *, host || ' ' || path as node from nodes
), judged as materialized (
  select n.x, n.host, n.path, n.node,
    arg_max(r.rule, length(r.rule)) as rule, arg_max(r.verdict, length(r.rule)) as verdict
  from named n left join r on (n.host = r.rh or n.host like '%.' || r.rh) and starts_with(n.path, r.rp)
  group by all
), edges as materialized (
  select distinct p.node as a, q.node as b from ends e join judged p on p.x = e.a join judged q on q.x = e.b
  where p.host <> '' and q.host <> '' and p.node <> q.node
), both_ways as materialized (
  select a, b from edges union select b, a from edges
), reach as (
  select a as u, a as v from both_ways
  union
  select reach.u, b.b from reach join both_ways b on b.a = reach.v
), decided as (
  select reach.u as node, bool_or(j.verdict = 'block') and not bool_or(j.verdict = 'allow') as blocked
  from reach join (select distinct node, verdict from judged where verdict is not null) j on j.node = reach.v group by reach.u
)
select p.page_id, coalesce(j.host, '') as host, coalesce(j.path, '') as path, j.rule,
  coalesce(j.verdict, case when d.blocked then 'block' end, 'allow') as verdict
from pages p left join judged j on j.x = p.url left join decided d on d.node = j.node
"""
