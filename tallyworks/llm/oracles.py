"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

_OP1 = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(role) + length(text) + length('<|role|><|text|><|end|>') + 1
    + len(regexp_extract_all(role || chr(1) || text,
        '\\|<\|>|<\||\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
    + len(regexp_extract_all(role || chr(1) || text, '<\|>'))) as bigint) as formatted_chars
from rows group by conv_id
"""

_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_OP2 = rf"""
with items as (
  select item_id, w, least(len(w), 10) as width from (select item_id, {_WORDS} as w from benchmark) where len(w) > 0
), windows as (
  select distinct item_id, width, array_to_string(w[i : i + width - 1], ' ') as gram
  from (select *, unnest(range(1, len(w) - width + 2)) as i from items)
), docs as (
  select doc_id, coalesce({_WORDS}, []) as w from documents
), spans as (
  select doc_id, i, width, array_to_string(w[i : i + width - 1], ' ') as gram
  from (select doc_id, w, width, unnest(range(1, len(w) - width + 2)) as i
        from docs, (select distinct width from windows))
), found as (select doc_id, i, s.width, item_id from spans s join windows using (width, gram)),
hits as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + width)) as p from found)
         group by doc_id),
named as (select doc_id, count(distinct item_id) as n,
            array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as ids
          from found group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(hits.n, 0) as n_hit, coalesce(named.n, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(hits.n, 0) > 0 as contaminated
from docs left join hits using (doc_id) left join named using (doc_id)
"""

_OP5 = r"""
with docs as (
  select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents
), windows as (
  select doc_id, i, array_to_string(w[i : i + 12], ' ') as gram
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from docs)
), firsts as (select gram, min(doc_id) as first from windows group by gram),
gone as (
  select doc_id, list_distinct(flatten(list(range(i, i + 13)))) as p
  from windows join firsts using (gram) where first < doc_id group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(p), 0) as bigint) as n_removed,
  sha256(coalesce(k, array_to_string(w, ' '))) as kept_sha256
from docs left join gone using (doc_id) left join (
  select doc_id, coalesce(string_agg(x, ' ' order by i), '') as k
  from (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as i, p from docs join gone using (doc_id))
  where not list_contains(p, i) group by doc_id
  union all
  select doc_id, '' from docs join gone using (doc_id) where len(p) = len(w)
) using (doc_id)
"""

_OP6 = r"""
with docs as (select doc_id, text, string_split(coalesce(text, ''), chr(10)) as l from documents),
lines as (
  select doc_id, i, trim(x, E' \t\n\x0b\x0c\r') as line,
    row_number() over (partition by doc_id order by i) as n
  from (select doc_id, unnest(l) as x, unnest(range(1, len(l) + 1)) as i from docs) where trim(x, E' \t\n\x0b\x0c\r') <> ''
), units as (
  select a.doc_id, a.i, a.line || chr(10) || b.line as unit, [a.i, b.i] as covers
  from lines a join lines b on a.doc_id = b.doc_id and b.n = a.n + 1
  union all
  select doc_id, i, line, [i] from lines where len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50
), firsts as (select unit, min((doc_id, i)) as first from units group by unit),
gone as (
  select distinct doc_id, unnest(covers) as i from units join firsts using (unit) where first < (doc_id, i)
), kept as (
  select doc_id, string_agg(x, chr(10) order by i) as k
  from (select doc_id, unnest(l) as x, unnest(range(1, len(l) + 1)) as i from docs) anti join gone using (doc_id, i)
  group by doc_id
)
select doc_id, coalesce(a.n, 0) as n_lines, coalesce(g.n, 0) as n_removed, sha256(coalesce(k, '')) as kept_sha256
from docs left join (select doc_id, count(*) as n from lines group by doc_id) a using (doc_id)
left join (select doc_id, count(*) as n from gone group by doc_id) g using (doc_id)
left join kept using (doc_id)
"""

# the given pages hold no redirects or canonical links, so aliases are spellings of one address
_OP7 = r"""
with parts as (
  select page_id, url,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
    coalesce(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '') as query
  from pages
), rules(h, p, action) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), ruled as (
  select page_id, host, path,
    (select h || p from rules where (host = h or host like '%.' || h) and starts_with(path, p)
     order by length(h || p) desc limit 1) as rule,
    host || regexp_replace(path, '/$', '') || '?' ||
      regexp_replace(regexp_replace(query, '(^|&)(utm_[^=&]*|ref)=[^&]*', '', 'g'), '^&', '') as address
  from parts
), acted as (select ruled.*, action from ruled left join rules on rule = h || p),
spread as (
  select address, coalesce(bool_or(action = 'block'), false) and not coalesce(bool_or(action = 'allow'), false) as bad
  from acted where host <> '' group by address
)
select page_id, host, path, rule,
  coalesce(action, case when coalesce(bad, false) and host <> '' then 'block' else 'allow' end) as verdict
from acted left join spread using (address)
"""

_OP10 = r"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
    md5(cast(doc_id as varchar)) as place
  from documents
), sources as (
  select source, cast(sum(size) as bigint) as s,
    (row_number() over (order by source nulls last) - 1) % 3 + 1 as w
  from docs group by source
), ordered as (
  select *, sum(s) over () as total,
    coalesce(sum(3 * s) over (order by 3.0 * s / w, source rows between unbounded preceding and 1 preceding), 0) as given,
    sum(w) over (order by 3.0 * s / w, source rows between current row and unbounded following) as open
  from sources
), judged as (select *, 3 * s * open <= w * (total - given) as stopped from ordered),
shared as (
  select source, s, case when stopped then cast(3 * s as double) else
      cast(w as double) * cast(total - coalesce(sum(3 * s) filter (stopped) over (), 0) as double)
      / cast(sum(w) filter (not stopped) over () as double) end as target
  from judged
), queued as (
  select doc_id, docs.source, size, coalesce(sum(size) over (
      partition by docs.source order by place, doc_id, size rows between unbounded preceding and 1 preceding), 0) as b
  from docs
)
select doc_id, cast(size as bigint) as size, s as source_size, target,
  cast(size * ((b < target)::int + (s + b < target)::int + (2 * s + b < target)::int) as bigint) as taken
from queued join shared on queued.source is not distinct from shared.source
"""

_OP12_START = r"""
with vectors as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
), parts as (select r, unnest(v) as x, unnest(range(64)) as i from vectors),
c0 as (
  select row_number() over (order by sha256('2:' || vec_id), v) - 1 as c, v from vectors
  order by sha256('2:' || vec_id), v limit 40
)"""

_OP12_ASSIGN = """, d{n} as (
  select r, c, sum((x - y) * (x - y)) as d
  from parts join (select c, unnest(v) as y, unnest(range(64)) as i from c{n}) using (i) group by r, c
), a{n} as (select r, arg_min(c, (d, c)) as c, min(d) as d from d{n} group by r)"""

_OP12_MOVE = """, c{m} as (
  select c{n}.c, coalesce(m.v, c{n}.v) as v from c{n} left join (
    select c, list(y order by i) as v from (
      select c, i, cast(floor(sum(x) / count(*)) as bigint) as y from parts join a{n} using (r) group by c, i
    ) group by c
  ) m on m.c = c{n}.c
)"""

_OP12 = _OP12_START + "".join(
    _OP12_ASSIGN.format(n=n) + (_OP12_MOVE.format(n=n, m=n + 1) if n < 5 else "") for n in range(6)
) + """
select vec_id, cast(c as integer) as cluster, cast(d as bigint) as distance,
  cast(sum(d) over (partition by c) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
  sha256(array_to_string(c5.v, ',')) as centroid_sha256
from a5 join vectors using (r) join c5 using (c)
"""

_OP13 = r"""
with docs as (
  select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents
), drawn as (
  select doc_id, t, length(t) as n, cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2,
    cast('0x' || h[17:24] as bigint) as h3, cast('0x' || h[25:32] as bigint) as h4
  from docs
), cuts as (
  select doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
         when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from drawn
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
  case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form
    when 'plain' then t
    when 'psm' then '<P>' || substring(t, 1, a) || '<S>' || substring(t, b + 1) || '<M>' || substring(t, a + 1, b - a)
    else '<S>' || substring(t, b + 1) || '<P>' || substring(t, 1, a) || '<M>' || substring(t, a + 1, b - a)
  end) as output_sha256, sha256(t) as restored_sha256
from cuts
"""

ORACLES = {
    "op1_chat_formatting": _OP1,
    "op2_decontamination": _OP2,
    "op5_substring_dedup": _OP5,
    "op6_line_dedup": _OP6,
    "op7_url_filters": _OP7,
    "op10_mixing": _OP10,
    "op12_centroid_clustering": _OP12,
    "op13_fill_in_middle": _OP13,
}
