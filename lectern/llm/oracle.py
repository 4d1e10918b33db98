"""DuckDB SQL for those training-text queries that SQL can express on whole tables."""

from __future__ import annotations


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


_TERMS = """
with uses as (
  select doc_uuid, trim(regexp_replace(lower(t), '[\\s\\x{00a0}_-]+', ' ', 'g')) as term
  from (select doc_uuid, unnest(themes) as t from genre_themes)
), terms as (select * from uses where term <> ''),
n as (select count(distinct coalesce(doc_uuid, chr(1))) as records from terms),
c as (select term, count(*) as n_uses, count(distinct coalesce(doc_uuid, chr(1))) as n_records from terms group by term)
select term, n_uses, n_records,
  case when n_records < 3 then 'rare' when n_records > 0.1 * n.records then 'common' end as mark
from c, n
"""

_PIECE_KIND = """
select 'text' as obj, variant_id as obj_key,
  case
    when list_max(list_transform(string_split(text, chr(10) || chr(10)), lambda p: length(p))) <= 1800 then 'paragraph'
    when list_max(list_transform(string_split(text, chr(10) || chr(10)), lambda p:
      list_max(list_transform(string_split(regexp_replace(p, '([.!?…])\\s', '\\1' || chr(1), 'g'), chr(1)), lambda s: length(s))))) <= 1800 then 'sentence'
    when list_max(list_transform(regexp_split_to_array(text, '\\s'), lambda w: length(w))) <= 1800 then 'word'
    else 'none'
  end as finest
from content_variants where length(text) > 2000
union
select 'sequence', item_key, 'item' from doc_items where kind = 'sequence' and len(item_ids) > 100
"""

_LEAKS = """
with d as (
  select doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as w from documents where text is not null
), i as (
  select item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') as w from eval_items where text is not null
), iw as (
  select distinct item_id, hash(array_to_string(w[k:k + 11], ' ')) as h from (select item_id, w, unnest(range(1, len(w) - 10)) as k from i where len(w) >= 12)
), dw as (
  select doc_id, hash(array_to_string(w[k:k + 11], ' ')) as h from (select doc_id, w, unnest(range(1, len(w) - 10)) as k from d where len(w) >= 12)
)
select distinct doc_id, item_id from dw join iw using (h)
"""

_EDITED = """
with w as (
  select variant_id, list_transform(regexp_extract_all(regexp_replace(text, '<[^<>]*>', ' ', 'g'), '[\\p{L}\\p{N}]+'), lambda x: lower(x)) as w
  from content_variants where name = 'original' and text is not null
), g as (
  select distinct variant_id, hash(w[i], w[i + 1], w[i + 2]) as h from (select variant_id, w, unnest(range(1, len(w) - 1)) as i from w where len(w) >= 40)
), n as (select variant_id, count(*) as n from g group by all),
p as (select a.variant_id as a, b.variant_id as b, count(*) as o from g a join g b on a.h = b.h and a.variant_id < b.variant_id group by all)
select a as variant_id_a, b as variant_id_b from p join n x on x.variant_id = a join n y on y.variant_id = b where 2 * o >= x.n + y.n - o
"""

_SHARED = """
with t as (select any_value(doc_id) as d, count(distinct doc_id) as copies, text, length(text) as n from documents where length(text) >= 240 group by text),
w as (select d, hash(substring(text, i, 240)) as h from (select d, text, unnest(range(1, n - 238)) as i from t)),
s as (select h from w group by h having count(distinct d) > 1),
f as (select distinct d from w semi join s using (h) union select d from t where copies > 1)
select distinct doc_id from documents join t using (text) join f using (d)
"""

_EDITED_GROUPS = f"""
with recursive w as (
  select variant_id, list_transform(regexp_extract_all(regexp_replace(text, '<[^<>]*>', ' ', 'g'), '[\\p{{L}}\\p{{N}}]+'), lambda x: lower(x)) as w
  from content_variants where name = 'original' and text is not null
), g as (
  select distinct variant_id, hash(w[i], w[i + 1], w[i + 2]) as h from (select variant_id, w, unnest(range(1, len(w) - 1)) as i from w where len(w) >= 40)
), s as (select variant_id, list_sort(list(h)) as h from g group by all),
p as ({_EDITED}),
e as (select variant_id_a as a, variant_id_b as b from p union all select variant_id_b, variant_id_a from p),
r as (select variant_id as id, variant_id as group_id from s union select e.b, r.group_id from r join e on e.a = r.id where r.group_id < e.b),
c as (select h, count(*) as n from s group by h),
l as (select e.a, count(distinct y.h) as n from e join s x on x.variant_id = e.a join s y on y.variant_id = e.b where x.h <> y.h group by e.a)
select s.variant_id, (select min(group_id) from r where r.id = s.variant_id) as group_id, c.n as n_copies, coalesce(l.n, 0) as n_links
from s join c using (h) left join l on l.a = s.variant_id
"""

_PIECES = """
with recursive t as (
  select variant_id as key, text, length(text) as n, string_split(text, '') as c from content_variants where length(text) > 2000
), ends as (
  select key, n, text, c, list_filter(range(1, n + 1), lambda i: c[i] in (' ', chr(9), chr(10), chr(11), chr(12), chr(13), chr(28), chr(29), chr(30), chr(31), chr(133), chr(160), chr(5760), chr(8232), chr(8233), chr(8239), chr(8287), chr(12288)) or (unicode(c[i]) between 8192 and 8202)) as spaces
  from t
), kinds as (
  select key, text, n, spaces,
    (select list(x) from (select sum(length(p) + 2) over (order by i) as x, i, len(ps) as k from (select unnest(range(1, len(ps) + 1)) as i, unnest(ps) as p, ps from (select string_split(text, chr(10) || chr(10)) as ps))) where i < k) as paragraphs,
    list_filter(spaces, lambda i: i > 1 and c[i - 1] in ('.', '!', '?', '…')) as sentences
  from ends
), cut as (
  select key, n, 0::bigint as no, 0::bigint as a,
    coalesce(list_max(list_filter(paragraphs, lambda x: x <= 2000 and x > 200)), list_max(list_filter(sentences, lambda x: x <= 2000 and x > 200)), list_max(list_filter(spaces, lambda x: x <= 2000 and x > 200)), 2000)::bigint as z,
    case when list_max(list_filter(paragraphs, lambda x: x <= 2000 and x > 200)) is not null then 'paragraph' when list_max(list_filter(sentences, lambda x: x <= 2000 and x > 200)) is not null then 'sentence'
      when list_max(list_filter(spaces, lambda x: x <= 2000 and x > 200)) is not null then 'word' else 'hard' end as kind
  from kinds
  union all
  select key, n, no + 1, b,
    case when n - b <= 2000 then n else coalesce(p, s, w, b + 2000) end, case when n - b <= 2000 then 'end' when p is not null then 'paragraph' when s is not null then 'sentence' when w is not null then 'word' else 'hard' end
  from (
    select c.key, c.n, c.no, c.z - 200 as b,
      list_max(list_filter(k.paragraphs, lambda x: x <= c.z + 1800 and x > c.z)) as p, list_max(list_filter(k.sentences, lambda x: x <= c.z + 1800 and x > c.z)) as s, list_max(list_filter(k.spaces, lambda x: x <= c.z + 1800 and x > c.z)) as w
    from cut c join kinds k using (key) where c.kind <> 'end')
), runs as (
  select item_key as key, len(item_ids) as n, unnest(range(0, (len(item_ids) - 11) // 90 + 1)) as no from doc_items where kind = 'sequence' and len(item_ids) > 100
)
select 'text' as obj, key as obj_key, f.finest, no::int as piece_no, a::int as piece_begin, z::int as piece_end, kind as cut, substring(text, a + 1, z - a) as piece_text
from cut join t using (key) join (__FINEST__) f on f.obj = 'text' and f.obj_key = key
union all
select 'sequence', key, 'item', no::int, (no * 90)::int, least(n, no * 90 + 100)::int, case when no * 90 + 100 >= n then 'end' else 'item' end, null from runs
""".replace("__FINEST__", _PIECE_KIND)

_WINDOWS = """
t as (select doc_id, text, length(text) as n from documents where text is not null and length(text) >= 240),
w as (select doc_id, i, hash(substring(text, i, 240)) as h from (select *, unnest(range(1, n - 238)) as i from t)),
s as (select h, min(doc_id) as first from w group by h having min(doc_id) <> max(doc_id)),
m as (select doc_id, i, first < doc_id as late from w join s using (h))
"""
_UNION = """(select doc_id, sum(z - a)::bigint as chars from (
  select doc_id, least(i + 240, coalesce(lead(i) over (partition by doc_id order by i), i + 240)) as z, i as a from m where {0}) group by doc_id)"""
_SHARES = f"""
with {_WINDOWS}
select d.doc_id, coalesce(length(d.text), 0)::bigint as n_chars, coalesce(a.chars, 0) as shared_chars, coalesce(b.chars, 0) as removable_chars,
  case when length(d.text) > 0 then coalesce(a.chars, 0) / length(d.text)::double else 0 end as shared_share
from documents d left join {_UNION.format('true')} a using (doc_id) left join {_UNION.format('late')} b using (doc_id)
"""

_SQL: dict[str, str] = {
    "p5_pieces": _PIECES,
    "p9_shares": _SHARES,
    "p3_groups": _EDITED_GROUPS,
    "p3_found": _EDITED,
    "p9_found": _SHARED,
    "p5_found": _PIECE_KIND,
    "p6_terms": _TERMS,
    "p6_found": f"select term, mark from ({_TERMS}) where mark is not null",
    "p7_found": _LEAKS,
    "p7_items": f"select item_id, count(*) as n_docs, min(doc_id) as first_doc from ({_LEAKS}) group by item_id",
}
