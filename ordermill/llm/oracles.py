"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP4 = f"""
with recursive doc as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents
), shingle as (
  select distinct doc_id, w[i:i + 4] as s
  from doc, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as t(i) where len(w) > 0
), size as (
  select doc_id, count(*) as n from shingle group by doc_id
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as k
  from shingle a join shingle b on a.s = b.s and a.doc_id <> b.doc_id group by all
), link as (
  select a, b from common join size x on x.doc_id = a join size y on y.doc_id = b
  where 100 * k >= 80 * (x.n + y.n - k)
), reach as (
  select doc_id, doc_id as other from documents
  union
  select r.doc_id, l.b as other from reach r join link l on l.a = r.other
)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, min(other) as component_id
from documents d left join size using (doc_id) join reach r on r.doc_id = d.doc_id
group by all
"""

OP5 = f"""
with doc as (
  select doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') as w from documents
), item as (
  select item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') as w from benchmark
), windows as (
  select distinct item_id, w[i:i + 12] as win, len(w[i:i + 12]) as m
  from item, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as t(i)
  where len(w) > 0
), lengths as (
  select distinct m from windows
), places as (
  select doc_id, i, m, w[i:i + m - 1] as win
  from doc, lengths, unnest(range(1, len(w) - m + 2)) as t(i)
), found as (
  select distinct p.doc_id, p.i, p.m, q.item_id
  from places p join windows q on p.win = q.win
), hit as (
  select doc_id, count(distinct k) as n_hit
  from found, unnest(range(i, i + m)) as t(k) group by doc_id
), named as (
  select doc_id, count(*) as n_items,
         string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
  from (select distinct doc_id, item_id from found) group by doc_id
)
select d.doc_id, cast(len(d.w) as bigint) as n_words,
  cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
from doc d left join hit using (doc_id) left join named using (doc_id)
"""

OP6 = r"""
with parts as (
  select page_id, case when position('://' in url) > 0
    then substr(url, position('://' in url) + 3) else '' end as rest from pages
), split as (
  select page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts
), judged as (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and path like '/en/%' then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/de/%' then 'example.com/de/'
    when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
    when (host = 'net' or host like '%.net') and path like '/%' then 'net/'
  end as rule from split
)
select page_id, host, path, rule,
  case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict
from judged
"""

OP11 = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP12 = f"""
with doc as (
  select row_number() over () as r, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') as w from documents
), item as (
  select item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) as t from benchmark
), asked as (
  select item_id, t, count(*) as repeats from item group by all
), total as (
  select count(*) as n_docs, sum(len(w)) as n_terms from doc where len(w) > 0
), posting as (
  select r, doc_id, cast(len(w) as bigint) as n, unnest(w) as t from doc
), counted as (
  select r, doc_id, n, t, count(*) as tf from posting group by all
), weight as (
  select t, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as weight
  from counted, total where t in (select t from asked) group by t, n_docs
), scored as (
  select a.item_id, c.r, c.doc_id, cast(sum(repeats * weight *
    ((1000000000 * tf) // (1000 * tf + 12 * (75 + cast((25 * n * n_docs) // n_terms as bigint))))) as bigint) as score
  from asked a join weight using (t) join counted c using (t), total group by all
), ranked as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank,
    doc_id, score from scored where score > 0
)
select * from ranked where rank <= 20
"""

OP13 = r"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('7:' || cast(doc_id as varchar)) as h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as u from documents
), drawn as (
  select *, len(u) as n,
    cast('0x' || h[1:8] as bigint) % (len(u) + 1) as c1, cast('0x' || h[9:16] as bigint) % (len(u) + 1) as c2,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
        or cast('0x' || h[17:24] as bigint) % 100 >= 100 then 'plain'
      when cast('0x' || h[25:32] as bigint) % 100 < 50 then 'spm' else 'psm' end as form
  from d
), cut as (
  select *, coalesce(array_to_string(u[1:least(c1, c2)], ''), '') as p,
    coalesce(array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], ''), '') as m,
    coalesce(array_to_string(u[greatest(c1, c2) + 1:n], ''), '') as s from drawn
)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(case form when 'plain' then t else p || m || s end) as restored_sha256
from cut
"""

ORACLES: dict[str, str] = {
    "op4_jaccard_join": OP4,
    "op5_decontaminate": OP5,
    "op6_url_filter": OP6,
    "op11_content_sort": OP11,
    "op12_lexical_search": OP12,
    "op13_fill_in_middle": OP13,
}
