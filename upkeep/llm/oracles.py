"""SQL with the same results, for the queries that SQL can express."""

from __future__ import annotations

#: Lines with their words: white space is U+0020 and U+0009 to U+000D.
LINES = r"""
d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as split, text from documents),
u as (select doc_id, unnest(split) as line, generate_subscripts(split, 1) - 1 as pos from d),
l as (
  select doc_id, pos, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from u
),
f as (select w, min({'d': doc_id, 'p': pos}) as f, len(w) as n from l where len(w) > 0 group by w)
"""

#: Each variant of a line of 8 words or more: one word masked (0), one word deleted (1), the line itself (2).
VARIANTS = r"""
c as (select w, f, n, unnest(range(1, n + 1)) as k from f where n >= 8),
v as (
  select 0 as kind, w, f, list_concat(list_concat(w[1:k - 1], [chr(0) || n]), w[k + 1:n]) as key from c
  union all select 1, w, f, list_concat(w[1:k - 1], w[k + 1:n]) from c
  union all select 2, w, f, w from f where n >= 8
),
g as (
  select key, min(f) filter (kind = 0) as f0, min(f) filter (kind = 1) as f1, min(f) filter (kind = 2) as f2
  from v group by key having count(*) > 1
),
near as (
  select distinct w from v join g using (key)
  where case kind when 0 then f0 when 1 then f2 else f1 end < v.f
)
"""

OP5 = rf"""
with {LINES}, {VARIANTS},
m as (
  select l.doc_id, l.pos, (l.pos <> f.f.p or l.doc_id <> f.f.d or near.w is not null) as goes
  from l join f using (w) left join near using (w)
),
b as (
  select doc_id, count(*) as n_lines, list(pos order by pos) filter (goes) as dropped from m group by doc_id
)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(len(dropped), 0) as n_dropped,
  sha256(array_to_string(list_filter(split, lambda x, i: not list_contains(coalesce(dropped, []), i - 1)), chr(10)))
    as kept_sha256
from d left join b using (doc_id)
"""


#: Text with A-Z lowered and nothing else.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array({LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from words
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as u, b.doc_id as v, count(*) as k from shingles a join shingles b using (s)
  where a.doc_id < b.doc_id group by all
),
links as (
  select u, v from pairs join sizes x on x.doc_id = u join sizes y on y.doc_id = v where 100 * k >= 85 * (x.n + y.n - k)
),
both_ways as (select u, v from links union all select v, u from links),
reached as (
  select u as node, v as other from both_ways
  union select node, v from reached join both_ways on other = u
),
least as (select node as doc_id, min(other) as least from reached group by node)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(least, d.doc_id)) as component_id,
  d.doc_id <= coalesce(least, d.doc_id) as kept
from documents d left join sizes using (doc_id) left join least using (doc_id)
"""


OP12 = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) as piece from documents
),
words as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces
),
totals as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
sizes as (select unnest([1, 2, 3, 4]) as size),
starts as (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i from words, sizes where len(w) >= size),
counts as (select lang, w[i:i + size - 1] as p, size, count(*) as f from starts group by lang, p, size),
found as (select lang, p, size, f as a from counts where size >= 2 and f >= 30),
inside as (
  select lang, a, p[i:i + s - 1] as p from found, (values (2, 1), (2, 2), (2, 3), (3, 1), (3, 2)) v(s, i)
  where s < len(p) and i + s - 1 <= len(p)
),
longer as (select lang, p, max(a) as most from inside group by lang, p),
cuts as (select f.lang, f.p, f.a, unnest(range(1, f.size)) as k from found f left join longer using (lang, p)
  where most is null or 100 * most < 80 * f.a),
scores as (
  select c.*, x.f as l, y.f as r, cast((cast(2000000 as hugeint) * c.a) // (x.f + y.f) as bigint) as score
  from cuts c join counts x on x.lang = c.lang and x.p = c.p[1:c.k] join counts y on y.lang = c.lang and y.p = c.p[c.k + 1:]
),
best as (select *, row_number() over (partition by lang, p order by score, k) as place from scores),
ranked as (
  select lang, array_to_string(p, ' ') as phrase, a, l, r, score,
    row_number() over (partition by lang order by score desc, a desc, array_to_string(p, ' ')) as rank
  from best where place = 1
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""


def all_oracles() -> dict[str, str]:
    return {"op5_line_dedup": OP5, "op11_minhash": OP11, "op12_phrases": OP12}
