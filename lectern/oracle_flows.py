"""DuckDB SQL that gives the same rows as the queries of :mod:`lectern.catalog_flows`."""

from __future__ import annotations

from lectern.oracle import SQL as _CORE
from lectern.oracle import _DIAL, _FACTS, _ISSUES, _SRC, _WINDOW_TEXTS, _strip, _term, _words

_ESCAPED = "replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_POSTS = f"""
posts as (
  select v.*, t.thread, '/index.php?threads/a%20b-' || substr(v.doc_uuid, 1, 8) || '.' || t.thread || '/' as url, md5({_strip(_ESCAPED)}) as text_md5
  from content_variants v join (select doc_uuid, min(variant_id) as thread from content_variants where name = 'original' and post_id is not null group by doc_uuid) t using (doc_uuid)
  where v.name = 'original' and v.post_id is not null and {_strip(_ESCAPED)} <> ''
), latest as (
  select doc_uuid, thread, post_id, arg_max({{'a': coalesce(author_id, ''), 'when': coalesce(posted_at, ''), 'md5': text_md5}}, variant_id) as p from posts group by all
), placed as (
  select *, row_number() over (partition by doc_uuid order by p."when", try_cast(substr(post_id, 6) as bigint), post_id) as n from latest
)
"""

_CHATS = """
lines as (
  select doc_uuid, is_healthy, native_id, row_number() over (order by doc_uuid) as pos from doc_meta where source_identity = 'emberlamp/chatlogs'
), good as (select * from lines where pos % 9 <> 4 and is_healthy is not null),
t as (select doc_uuid, count(*) as n_turns, count(*) filter (actor_id = 'user') as n_human, arg_min(item_id, row(item_pos, item_id)) as first_turn from doc_items where kind = 'turn' group by doc_uuid)
"""

_BOOKS = rf"""
d as (
  select regexp_replace(lower(source), '[^a-z0-9]+', '', 'g') as native_id, doc_id, doc_id % 21 as chapter, text from documents where text is not null and source is not null
), parts as (
  select native_id, doc_id, chapter, i, p from (
    select *, unnest(range(len(ps))) as i, unnest(ps) as p from (
      select *, list_filter(list_transform(regexp_split_to_array(text, '\n[\s\x{{a0}}]*\n'), lambda x: {_strip('x')}), lambda x: x <> '') as ps from d where native_id <> ''))
  union all select native_id, doc_id, chapter, 1000000000, 'Number ' || doc_id || ' ends.' from d where native_id <> ''
), book as (
  select *, row_number() over (partition by native_id order by chapter, doc_id, i) as paragraph_no from parts
)
"""

_OPENING = f"""
{_WINDOW_TEXTS}, line as (
  select i.doc_uuid, row_number() over (partition by i.doc_uuid order by item_pos, i.item_id) as r, case when actor_id = 'user' then 'USER' else 'CHARACTER' end || ': ' || t as line
  from doc_items i join best using (doc_uuid, item_id) where kind = 'turn'
), prompt as (select doc_uuid, length(string_agg(line, chr(10) order by r)) as n from line where r <= 100 group by doc_uuid)
"""
_CHAT = f"(select doc_uuid from doc_meta where {_SRC} = 'emberlamp/chatlogs')"


def _has(*categories: str) -> str:
    names = ", ".join(f"'{c}'" for c in categories)
    return f"(select doc_uuid from doc_items where kind = 'categorization' and category in ({names}) and doc_uuid is not null group by doc_uuid having count(distinct category) = {len(categories)})"


_LATEST_MAP = f"""
m as (select {_term('t')} as term, max(row(theme_id, case when theme_id % 10 = 0 then null else lower(replace(theme, ' ', '-')) end)) as x
  from (select theme_id, theme, unnest(list_prepend(theme, aliases)) as t from theme_list) group by all),
mapping as (select term, x[2] as canonical, true as mapped from m)
"""

_RESOLVED = f"(select * from ({_CORE['resolve_meta']}))"
_STATS = f"({_CORE['doc_stats']})"

_AXES = f"""
axes as (
  select d.doc_uuid, coalesce(r.genre, 'Unset') as genre, coalesce(sexuality, 'Clean') as sexuality, coalesce(violence, 'None') as violence, coalesce(toxicity, 'Safe') as toxicity,
    coalesce(l.languages, ['en']) as languages
  from doc_meta d left join {_RESOLVED} r using (doc_uuid)
  left join (select doc_uuid, list(v) as languages from (select distinct doc_uuid, unnest(value) as v from doc_items where kind = 'categorization' and category = 'language') group by doc_uuid) l using (doc_uuid)
), tags as (select doc_uuid, {_term('tag')} as term from (select doc_uuid, unnest(value) as tag from doc_items where kind = 'categorization' and category = 'theme'))
"""

SQL: dict[str, str] = {
    "forum_posts": f"""
with {_POSTS}
select url || 'page-' || lpad(variant_id::varchar, 12, '0') as section_url, 1 as post_index, substr(post_id, 6) as post_id, url || post_id as post_url, thread::varchar as thread_id, 'a b-' || substr(doc_uuid, 1, 8) as thread_slug,
  rtrim(url, '/') as thread_url, coalesce(author_id, '') as author_id, coalesce(posted_at, '') as timestamp, text_md5 from posts""",
    "forum_threads": f"""
with {_POSTS} select 'thread:' || thread as native_id, printf('narrative-%06d', n) as item_id, substr(post_id, 6) as post_id, p.a as author_id, p."when" as posted_at, p.md5 as text_md5 from placed""",
    "forum_sequences": f"""
with {_POSTS} select 'thread:' || thread as native_id, count(*) as n_ids, string_agg(printf('narrative-%06d', n), ',' order by n) as ids, true as in_ledger from placed group by doc_uuid, thread""",
    "conversation_documents": f"""
with {_CHATS}
select doc_uuid as bot_id, 'the character' as bot_name, 'they' as pronoun, coalesce(n_turns, 0) + (n_turns > 0 is true)::int + (native_id is not null)::int as n_items, coalesce(n_turns, 0) as n_turns, coalesce(n_turns, 0) as n_sequence,
  coalesce(n_human, 0) as n_human, md5(case when native_id is not null then 'about ' || native_id else first_turn end) as first_md5, case when pos <= 40 then 1 else 2 end as run
from good left join t using (doc_uuid)""",
    "conversation_rejects": f"""
with {_CHATS} select reason, count(*) as n from (select case when pos % 9 = 4 then 'not JSON' when is_healthy is null then 'no time' end as reason from lines) where reason is not null group by reason""",
    "conversation_rebuilt": f"with {_CHATS} select true as same_id, count(*) as n_documents, 0::bigint as n_new_entries from good",
    "record_addresses": """
select doc_id, sha256('{"a":{"x":[' || coalesce(n_chars, 0) || ',true],"y":null},"b":' || doc_id || '}') as address, true as same from documents""",
    "minted_ids": """
select doc_id::varchar as native_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-7' as head, true as well_formed, true as is_new
from documents, (select lpad(lower(to_hex(epoch_ms(timestamp '2025-01-01 00:00:00'))), 12, '0') as h)""",
    "thread_identities": """
select doc_id, case when doc_id % 10 = 0 then '' else n_chars::varchar end as thread, case when doc_id % 10 = 0 then '' else doc_id || '-café ' || coalesce(lang, '') end as slug from documents""",
    "book_paragraphs": rf"""
with {_BOOKS}
select native_id, case when chapter = 0 then 'FOREWORD' else 'CHAPTER ' || ['I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX', 'X', 'XI', 'XII', 'XIII', 'XIV', 'XV', 'XVI', 'XVII', 'XVIII', 'XIX', 'XX'][chapter] || ': The part ' || chapter end as title,
  paragraph_no, printf('narrative-%06d', paragraph_no) as item_id,
  md5({_strip(r"regexp_replace(regexp_replace(p, '([\p{L}\p{N}_]+)-\n\s*([\p{L}\p{N}_]+)', '\1\2', 'g'), '[\s\x{a0}]+', ' ', 'g')")}) as text_md5,
  case when i = 1000000000 then '[1] a note on it' else '' end as annotation
from book""",
    "book_corpus": f"""
with {_BOOKS}
select native_id, count(*) as n_narratives, count(distinct chapter) + 1 as n_sequences, 2 * count(*) as n_ids, count(*) + count(distinct chapter) as last_pos, count(*) filter (i = 1000000000) as n_notes from book group by native_id""",
    "jsonl_lines": "select row_number() over (order by doc_id) - 1 as line_no, doc_id from documents",
    "jsonl_counts": "select 3 as n_files, count(*)::bigint as n_lines from content_variants",
    "ledger_appended": "select source, native_id, arg_max(uuid, row(recorded_at, uuid)) as uuid from ledger group by source, native_id",
    "ledger_listing": "select source, native_id, uuid from ledger where uuid is not null",
    "ledger_rewritten": "select source, count(*) as n, count(distinct uuid) as n_uuids from ledger where uuid not in (select doc_uuid from doc_meta where is_healthy and doc_uuid is not null) group by source",
    "stored_corpus": """
select 'meta' as part, count(*) as n from doc_meta union all select 'items', count(*) from doc_items union all select 'variants', count(*) from content_variants union all select 'ledger', count(*) from ledger""",
    "package_restored": """
select doc_uuid, item_id, i.kind, entity_id, actor_id, category, array_to_string(value, '|') as value, reasoning, coalesce(len(item_ids), -1) as n_ids from doc_items i semi join doc_meta using (doc_uuid)""",
    "package_variants": """
select doc_uuid, item_id, v.name, md5(v.text) as text_md5, annotation from content_variants v semi join doc_items using (doc_uuid, item_id) where doc_uuid in (select doc_uuid from doc_meta)""",
    "package_parts": """
with i as (select doc_uuid, item_id, (row_number() over (partition by doc_uuid order by item_pos, item_id) - 1) as n from doc_items where doc_uuid in (select doc_uuid from doc_meta))
select doc_uuid, (n // 20)::int as part_no, count(*) as n_items, arg_min(item_id, n) as first_item from i group by doc_uuid, n // 20
union all select doc_uuid, 0, 0, null from doc_meta where doc_uuid not in (select doc_uuid from i)""",
    "package_order": "select row_number() over (order by doc_uuid) - 1 as line_no, doc_uuid from doc_meta",
    "records_overwritten": "select doc_uuid, case when is_healthy then 'new' else 'old' end as line from doc_meta",
    "record_listing": "select * from (values ('a.json', 10), ('b.json', 0)) as t(file, n_bytes)",
    "acquired_files": "select * from (values ('old'), ('set/two.jsonl')) as t(value)",
    "rendered_templates": "select * from (values ('Say hello to all.'), ('Say no to all.')) as t(text)",
    "run_stamps": "select uuid, recorded_at, strftime(recorded_at, '%Y%m%d%H%M%S') as stamp from ledger",
    "ranked_sources": f"""
with c as (select {_SRC} as source, count(*) as n, min(doc_uuid) as first from doc_meta group by all), top as (select source, n from c order by n desc, first limit 3)
select * from top union all select '(other)', coalesce(sum(n), 0)::bigint from c anti join top using (source)""",
    "validated_documents": """
with n as (select doc_uuid, count(*) as n, count(*) filter (kind = 'turn') as t from doc_items group by doc_uuid),
d as (select coalesce(n, 0) as n, case when is_healthy is null then 'short' when source_identity is null then 'nameless' when not is_healthy and coalesce(t, 0) > 0 then 'kind' else '' end as fault from doc_meta left join n using (doc_uuid))
select fault <> '' as corrupt, count(*) as n, sum(case when fault = 'short' then 0 else n end)::bigint as n_items from d group by all""",
    "cluster_manifest": """
select cluster_id, label, n_terms as n_members, first as first_member from (
  select cluster_id, lower(replace(terms[1], ' ', '-')) as label, len(terms) as n_terms, terms[1] as first
  from (select cluster_id, list(term order by n desc, term) as terms from (select cluster_id, term, count(*) as n from (
    select coalesce(primary_genre, 'Unset') as cluster_id, __TERM__ as term from (select primary_genre, unnest(themes) as tag from genre_themes)) where term <> '' group by all) group by cluster_id))""".replace("__TERM__", _term("tag")),
    "worklist_decisions": f"""
with g as (select cluster_id, term, count(*) as n from (select coalesce(nullif(primary_genre, ''), 'Unset') as cluster_id, {_term('tag')} as term from (select primary_genre, unnest(themes) as tag from genre_themes)) where term <> '' group by all),
c as (select cluster_id, sum(n)::bigint as freq, coalesce(sum(n) filter (n = 1), 0)::bigint as uses_one from g group by cluster_id)
select row_number() over (order by freq desc, cluster_id) - 1 as row_no, * from c""",
    "cluster_counters": f"""
with t as (select coalesce(primary_genre, 'Unset') as genre, {_term('tag')} as term from (select primary_genre, unnest(themes) as tag from genre_themes)),
n as (select substr(term, 1, 1) as cluster_id, genre, count(*) as n from t where term <> '' group by all)
select cluster_id, 'genre' as axis, '{{' || string_agg('"' || genre || '":' || n, ',' order by genre collate "C") || '}}' as counts from n group by cluster_id""".replace(' collate "C"', ""),
    "report_lines": """
with k as (select kind, count(*) as n from doc_items group by kind), w as (select greatest(4, max(length(kind))) as a, greatest(7, max(length(n::varchar))) as b from k),
r as (select 3 as line_no, rpad('kind', a::int, ' ') || '  n_items' as line from w union all select 3 + row_number() over (order by kind), rpad(kind, a::int, ' ') || '  ' || n from k, w)
select (line_no - 1)::int as line_no, line from (select 1 as line_no, '== items ==' as line union all select 2, '-- kinds' union all select * from r)""",
    "report_sections": """
select 'items' as section, 'kinds' as name, count(distinct kind)::bigint as n from doc_items union all select 'turn_distribution', 'turns', 1 union all select 'turn_distribution', 'turn_histogram', 7 union all select 'unknown', 'nothing', 0""",
    "workspace_folders": "select unnest(['/raw', '/processed', '/models', '/exports']) as folder",
    "manifest_settings": """
select * from (values ('raw', '"/data/raw"'), ('other', '"$UNSET"'), ('limit', '7'), ('keep', '["a", "/data"]'), ('flag', 'true'), ('rate', '0.5'), ('start_uuid', '"0123"'), ('mode', 'null'), ('name', '"x"')) as t(name, value)""",
    "closed_schemas": "select * from (values ('safety', 1, 4), ('genre', 1, 3), ('characters', 5, 3), ('grammar', 1, 2)) as t(name, n_closed, n_violations)",
    "retry_delays": "select i::int as attempt, least(2 * 2 ** (i - 1), 2480)::double as seconds, 3.5::double as told from range(1, 15) as r(i)",
    "enriched_safety": f"""
with {_OPENING}, new as (
  select doc_uuid, n from prompt where doc_uuid in {_CHAT} and doc_uuid not in {_has('sexuality', 'violence', 'toxicity')} and n % 7 <> 0
), cells as (
  select doc_uuid, unnest(['sexuality', 'violence', 'toxicity']) as category, unnest([['Clean', 'Suggestive', 'Explicit'][n % 3 + 1], ['None', 'Combat', 'Graphic'][n % 3 + 1], ['Safe', 'Harassment', 'Dangerous'][n // 3 % 3 + 1]]) as value from new
)
select category, value, count(*) as n from (
  select category, array_to_string(value, '|') as value from doc_items where kind = 'categorization' and category in ('sexuality', 'violence', 'toxicity')
  union all select category, value from cells anti join (select doc_uuid, category from doc_items where kind = 'categorization') using (doc_uuid, category)) group by all""",
    "enriched_genre": f"""
with {_OPENING}, new as (select doc_uuid, n from prompt where doc_uuid in {_CHAT} and doc_uuid not in {_has('genre', 'theme')}),
cells as (
  select doc_uuid, 'genre' as category, ['Fantasy', 'Sci-Fi', 'Romance', 'Slice of Life', 'Action & Adventure', 'Mystery & Thriller', 'Comedy', 'Drama'][n % 8 + 1] as value from new
  union all select doc_uuid, 'theme', 'slow-burn|t-' || (n % 5) from new
)
select doc_uuid, category, array_to_string(value, '|') as value from doc_items semi join new using (doc_uuid) where kind = 'categorization' and category in ('genre', 'theme')
union all select doc_uuid, category, value from cells anti join (select doc_uuid, category from doc_items where kind = 'categorization') using (doc_uuid, category)""",
    "enriched_characters": f"""
with {_OPENING}, new as (
  select doc_uuid, n from prompt where doc_uuid in {_CHAT} and doc_uuid not in (select doc_uuid from doc_items where kind = 'character' and entity_id = 'user' and doc_uuid is not null)
), bot as (select doc_uuid, min(actor_id) filter (kind = 'turn' and actor_id <> 'user') as bot from doc_items group by doc_uuid)
select doc_uuid, unnest([0, 1]) as item_pos, unnest(['user', coalesce(bot, 'bot')]) as entity_id, 'female' as bot_gender,
  'Name: N' || n || chr(10) || 'Pronouns: she/her/hers' || chr(10) || case when n % 3 > 0 then 'Traits: calm' || chr(10) else '' end || 'Appearance: tall; grey' as text
from new left join bot using (doc_uuid)""",
    "enriched_grammar": f"""
with {_WINDOW_TEXTS}
select doc_uuid, item_id, md5(reverse(t)) as text_md5 from best semi join (select doc_uuid, item_id from doc_items where kind = 'turn' and doc_uuid in {_CHAT}) using (doc_uuid, item_id)
anti join (select doc_uuid, item_id from content_variants where name = 'refine-chat-grammar') using (doc_uuid, item_id)""",
    "genders": """
select response_id, case when lower(trim(coalesce(violence_axis, '  Male '))) in ('male', 'female', 'neutral', 'unknown') then lower(trim(coalesce(violence_axis, '  Male '))) else 'unknown' end as gender from safety_dials""",
    "markdown_variants": """
with o as (select doc_uuid, item_id, arg_max({'text': text, 'post': post_id, 'at': posted_at}, row(ingested_at, variant_id)) as x from content_variants where name = 'original' group by all),
n as (select doc_uuid, item_id, x.post as post_id, x.at as posted_at from o semi join (select doc_uuid, item_id from doc_items where kind = 'narrative') using (doc_uuid, item_id) where x.text is not null)
select *, false as shared_id from n
union all select doc_uuid, item_id, post_id, posted_at, false from content_variants anti join n using (doc_uuid, item_id) where name = 'refine-cdm-html-to-markdown'""",
    "refined_language": f"""
with {_WINDOW_TEXTS}, held as (select doc_uuid, count(*) as n from doc_items where kind = 'categorization' and category = 'language' group by doc_uuid),
seen as (select distinct doc_uuid from doc_items i join best using (doc_uuid, item_id) where kind in ('turn', 'narrative') and doc_uuid not in (select doc_uuid from held where doc_uuid is not null) and regexp_matches(t, '\\p{{L}}'))
select doc_uuid, n as n_items, false as detected from held where doc_uuid in (select doc_uuid from doc_meta) union all select doc_uuid, 1, true from seen where doc_uuid in (select doc_uuid from doc_meta)""",
    "scalpel_documents": """
with base as (select (select count(*) from doc_items) as i, (select count(*) from content_variants) as v, (select count(*) filter (is_healthy) * 6 from doc_meta) as a, (select count(*) from doc_meta where is_healthy) as h),
cat as (select count(*) filter (category = 'language') as l, count(*) filter (category in ('genre', 'theme')) as g, count(*) filter (category in ('sexuality', 'violence', 'toxicity')) as s from doc_items where kind = 'categorization'),
ch as (select count(*) as n from doc_items where kind = 'character'),
cv as (select count(*) as n from content_variants semi join (select doc_uuid, item_id from doc_items where kind = 'character') using (doc_uuid, item_id)),
md as (select count(*) as n, count(distinct doc_uuid) filter (is_healthy) as d from content_variants v left join doc_meta m using (doc_uuid) where v.name = 'refine-cdm-html-to-markdown'),
gr as (select count(*) as n, count(distinct doc_uuid) filter (is_healthy) as d from content_variants v semi join (select doc_uuid, item_id from doc_items where kind = 'turn') using (doc_uuid, item_id) left join doc_meta m using (doc_uuid) where v.name = 'refine-chat-grammar'),
r as (
  select 'scalpel-cdm-language' as step, i - l as items, v as variants, a - h as annotations from base, cat
  union all select 'scalpel-cdm-html-to-markdown', i, v - md.n, a - md.d from base, md
  union all select 'scalpel-chat-characters', i - ch.n, v - cv.n, a - h from base, ch, cv
  union all select 'scalpel-chat-genre-theme', i - g, v, a - h from base, cat
  union all select 'scalpel-chat-safety-dials', i - s, v, a - h from base, cat
  union all select 'scalpel-chat-grammar', i, v - gr.n, a - gr.d from base, gr)
select step, unnest(['items', 'variants', 'annotations']) as part, unnest([items, variants, annotations]) as n from r""",
    "scalpel_named": """
with u as (select distinct doc_uuid from doc_items where kind = 'character' and entity_id = 'user'),
m as (select doc_uuid, doc_uuid in (select doc_uuid from u where doc_uuid is not null) as has, coalesce(is_healthy, false) as ann from doc_meta),
i as (select doc_uuid, count(*) filter (kind = 'character') as n, count(*) filter (kind <> 'character') as other from doc_items group by doc_uuid)
select doc_uuid, case when has and ann then 0 else n end as n_characters, case when has and not ann then 1 else 0 end as n_identities from m join i using (doc_uuid) where not (has and ann and other = 0)""",
    "scalpel_sentinel": f"""
with {_FACTS}
select v.doc_uuid, count(*) filter (name = 'refine-chat-grammar') as n_grammar from content_variants v left join checks c using (doc_uuid) left join (select doc_uuid, item_id, bool_or(kind = 'turn') as turn from doc_items group by all) i using (doc_uuid, item_id)
where not (name = 'refine-chat-grammar' and coalesce(i.turn, false) and coalesce(chat and usr, false)) group by v.doc_uuid""",
    "corrupt_found": """
select doc_uuid, 'item kind' as reason from doc_items where (right(doc_uuid, 1) = 'a' and kind = 'world') or coalesce(kind, '') not in ('world', 'character', 'summary', 'narrative', 'turn', 'categorization', 'sequence')
union select doc_uuid, 'data' from doc_items where right(doc_uuid, 1) = 'b' and kind = 'sequence'
union select doc_uuid, 'item id' from doc_items where right(doc_uuid, 1) = 'c' and kind = 'summary'
union select doc_uuid, 'document kind' from doc_meta where right(doc_uuid, 1) = 'd'""",
    "annotation_steps": """
select doc_uuid, not coalesce(item_count > 10, false) as has_b,
  (case when is_healthy then 'a:second' else 'a:first' end) || (case when coalesce(item_count > 10, false) then '' else ',b:more' end) as notes from doc_meta""",
    "refreshed_meta": f"""
with {_FACTS.replace('coalesce(is_healthy, false) as noted', 'false as noted')}, {_ISSUES}, n as (select doc_uuid, count(*) as n from issues group by doc_uuid)
select s.doc_uuid, s.items as item_count, s.turns, s.words, r.genre, coalesce(n.n, 0) = 0 as is_healthy, coalesce(n.n, 0) as n_issues, coalesce(len(string_split(nullif(r.themes, ''), '|')), 0) as n_themes
from {_STATS} s left join {_RESOLVED} r using (doc_uuid) left join n using (doc_uuid)""",
    "described_documents": f"""
select s.doc_uuid, items, words, coalesce(sexuality, 'Unset') as sexuality, coalesce(violence, 'Unset') as violence, coalesce(toxicity, 'Unset') as toxicity, coalesce(genre, 'Unset') as genre, coalesce(themes, '') as themes, coalesce(languages, '') as languages
from {_STATS} s left join {_RESOLVED} using (doc_uuid)""",
    "kind_items": "select doc_uuid, item_id, kind from doc_items where kind in ('narrative', 'character')",
    "targeted_documents": "select doc_uuid, source_identity from doc_meta where doc_uuid in (select min(doc_uuid) from doc_meta union select max(doc_uuid) from doc_meta)",
    "pending_characters": "select doc_uuid from doc_meta where doc_uuid not in (select doc_uuid from doc_items where kind = 'character' and entity_id = 'user' and doc_uuid is not null)",
    "next_numbers": "select doc_uuid, " + ", ".join(f"coalesce(max(try_cast(nullif(regexp_extract(item_id, '^{k}-(\\d+)$', 1), '') as int)), 0) + 1 as {k}" for k in ("narrative", "turn", "character")) + " from doc_items group by doc_uuid",
    "actor_names": """
with w as (select doc_uuid, entity_id as actor_id, max(item_pos) as p from doc_items where kind = 'character' and entity_id is not null group by all)
select t.doc_uuid, t.item_id, coalesce('Name ' || w.p, 'the character') as actor_name from doc_items t left join w on w.doc_uuid = t.doc_uuid and w.actor_id = t.actor_id where t.kind = 'turn'""",
    "player_names": """
select doc_uuid, 'N ' || arg_min(item_id, row(item_pos, item_id)) filter (entity_id is not distinct from 'user') as player, 'N ' || arg_min(item_id, row(item_pos, item_id)) filter (entity_id is distinct from 'user') as bot
from doc_items where kind = 'character' group by doc_uuid""",
    "theme_axes": f"""
with {_AXES}
select term, axis, value, count(*) as n from (
  select term, unnest(['genre', 'sexuality', 'violence', 'toxicity']) as axis, unnest([genre, sexuality, violence, toxicity]) as value from tags join axes using (doc_uuid) where term <> ''
  union all select term, 'language', unnest(languages) from tags join axes using (doc_uuid) where term <> '') group by all""",
    "theme_curated": f"""
with {_LATEST_MAP}, t as (
  select doc_uuid, {_term('tag')} as term from (select doc_uuid, unnest(value) as tag from doc_items where kind = 'categorization' and category = 'theme')
), named as (select doc_uuid, list_sort(list(distinct case when mapped then canonical else lower(replace(term, ' ', '-')) end) filter (not (coalesce(mapped, false) and canonical is null))) as themes from t left join mapping using (term) where term <> '' group by doc_uuid),
old as (select doc_uuid, string_split(nullif(themes, ''), '|') as old from {_RESOLVED}),
c as (select doc_uuid, coalesce(themes, []) as themes, coalesce(old, []) as old from old left join named using (doc_uuid) where old is not null)
select doc_uuid, array_to_string(case when n.doc_uuid is null then c.old else c.themes end, '|') as themes, n.doc_uuid is not null and c.themes <> c.old as touched
from c left join (select doc_uuid from named) n using (doc_uuid) join (select doc_uuid from doc_meta) using (doc_uuid) where len(case when n.doc_uuid is null then c.old else c.themes end) > 0""",
    "manifest_run": """
with r as (select doc_uuid, doc_uuid between '01961283' and '01961290' as inside, item_count from doc_meta),
i as (select doc_uuid, count(*) as n, count(*) filter (kind = 'categorization' and category in ('genre', 'theme')) as g from doc_items group by doc_uuid),
v as (select doc_uuid, count(*) as n, count(*) filter (name = 'refine-chat-grammar' and turn) as g from content_variants left join (select doc_uuid, item_id, bool_or(kind = 'turn') as turn from doc_items group by all) using (doc_uuid, item_id) group by doc_uuid)
select doc_uuid, case when inside then coalesce(i.n, 0) - coalesce(i.g, 0) else item_count end as item_count, coalesce(i.n, 0) - case when inside then coalesce(i.g, 0) else 0 end as n_items,
  coalesce(v.n, 0) - case when inside then coalesce(v.g, 0) else 0 end as n_variants
from r left join i using (doc_uuid) left join v using (doc_uuid)""",
    "prepared_lines": f"""
with {_AXES} select case when sexuality in ('Clean', 'Suggestive') and toxicity = 'Safe' then 'general' else 'unbound' end as flavour, count(*) as n from axes group by all""",
    "stream_merge": _CORE["reconcile_upsert"],
    "run_counters": "select unnest(['rows', 'blank', 'html']) as counter, unnest([count(*), count(*) filter (coalesce(trim(text), '') = ''), count(*) filter (text like '%<%')]) as n from content_variants",
}
SQL["purged_corrupt"] = f"""
select m.doc_uuid, count(i.doc_uuid) as n_items from doc_meta m left join doc_items i using (doc_uuid) where m.doc_uuid not in (select doc_uuid from ({SQL['corrupt_found']}) where doc_uuid is not null) group by m.doc_uuid"""
