"""DuckDB SQL that gives the same rows as the queries of :mod:`lectern.catalog`."""

from __future__ import annotations

_SRC = "coalesce(nullif(source_identity, ''), 'unknown')"
_STRIP = r"regexp_replace({0}, '^[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{3000}}\x{{202f}}]+|[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{3000}}\x{{202f}}]+$', '', 'g')"


def _strip(c: str) -> str:
    return _STRIP.format(c)


def _term(c: str) -> str:
    return f"lower({_strip(f'''translate({c}, '-_', '  ')''')})"


def _sanitize(c: str) -> str:
    v = f"regexp_replace({_strip(f'lower({c})')}, '[\\s\\x{{a0}}_/:-]+', '-', 'g')"
    v = f"regexp_replace(regexp_replace({v}, '[^\\p{{L}}\\p{{M}}\\p{{N}}_-]', '', 'g'), '-+', '-', 'g')"
    return f"regexp_replace({v}, '^-+|-+$', '', 'g')"


def _words(c: str) -> str:
    return rf"len(list_filter(regexp_split_to_array({c}, '[\s\x{{a0}}\x{{2000}}-\x{{200a}}\x{{3000}}\x{{202f}}]+'), lambda w: w <> ''))"


_BUCKETS = "(values (1, 1, 10, '1-10'), (2, 11, 25, '11-25'), (3, 26, 50, '26-50'), (4, 51, 100, '51-100'), (5, 101, 250, '101-250'), (6, 251, 500, '251-500'), (7, 501, 1000000000, '501+')) as b(bucket_no, low, high, bucket)"
_TURNS = "(select m.doc_uuid, count(i.item_id) as turns from doc_meta m left join doc_items i on i.doc_uuid = m.doc_uuid and i.kind = 'turn' group by m.doc_uuid)"
_TAGS = "(select response_id, doc_uuid, primary_genre, unnest(range(len(themes)))::int as tag_no, unnest(themes) as tag from genre_themes)"
_DIAL = "(select doc_uuid, arg_max(row(sexual_axis, violence_axis, toxicity_axis), row(responded_at, response_id)) as x from safety_dials group by doc_uuid)"
_GENRE_TERMS = f"(select cluster_id, term, count(*) as n from (select coalesce(primary_genre, 'Unset') as cluster_id, {_term('tag')} as term from {_TAGS}) where term <> '' group by all)"


def _distribution(source: str, v: str) -> str:
    return f"select count({v}) as n, sum({v})::bigint as total, min({v}) as least, max({v}) as greatest, sum({v})::double / count({v}) as mean, list_sort(list({v}) filter ({v} is not null))[count({v}) // 2 + 1] as median from {source}"


def _shares(source: str, key: str) -> str:
    return f"select {key}, count(*) as n, count(*) * 100e0 / sum(count(*)) over () as pct from {source} group by {key}"


# The annotations of all steps are given to documents marked healthy, to others none.
_FACTS = f"""
facts as (
  select m.doc_uuid, {_SRC} as source, coalesce(is_healthy, false) as noted,
    coalesce(p.language, false) as language, coalesce(p.bot, false) as bot, coalesce(p.usr, false) as usr,
    coalesce(p.themes, false) as themes, p.genre is not null as genre,
    coalesce(p.sex, false) as sex, coalesce(p.violence, false) as violence, coalesce(p.toxicity, false) as toxicity,
    coalesce(c.narratives, 0) as narratives, coalesce(c.narratives_done, 0) as narratives_done,
    coalesce(c.turns, 0) as turns, coalesce(c.turns_done, 0) as turns_done, coalesce(c.turns_converted, 0) as turns_converted
  from doc_meta m
  left join (
    select doc_uuid,
      bool_or(category = 'language' and case when value_is_list then len(value) > 0 else value[1] <> '' end) as language,
      bool_or(kind = 'character' and entity_id is distinct from 'user') as bot,
      bool_or(kind = 'character' and entity_id is not distinct from 'user') as usr,
      bool_or(category = 'theme' and len(value) > 0) as themes,
      arg_max(value[1], item_pos) filter (category = 'genre' and not value_is_list and value[1] in ('Fantasy', 'Sci-Fi', 'Romance', 'Slice of Life', 'Action & Adventure', 'Mystery & Thriller', 'Comedy', 'Drama')) as genre,
      bool_or(category = 'sexuality' and not value_is_list and value[1] in ('Clean', 'Suggestive', 'Explicit')) as sex,
      bool_or(category = 'violence' and not value_is_list and value[1] in ('None', 'Combat', 'Graphic')) as violence,
      bool_or(category = 'toxicity' and not value_is_list and value[1] in ('Safe', 'Harassment', 'Dangerous')) as toxicity
    from doc_items group by doc_uuid
  ) p using (doc_uuid)
  left join (
    select i.doc_uuid,
      count(*) filter (kind = 'narrative') as narratives, count(*) filter (kind = 'narrative' and o and md) as narratives_done,
      count(*) filter (kind = 'turn') as turns, count(*) filter (kind = 'turn' and o and g) as turns_done, count(*) filter (kind = 'turn' and g) as turns_converted
    from doc_items i left join (
      select doc_uuid, item_id, bool_or(name = 'original') as o, bool_or(name = 'refine-cdm-html-to-markdown') as md, bool_or(name = 'refine-chat-grammar') as g
      from content_variants group by doc_uuid, item_id
    ) v using (doc_uuid, item_id)
    where kind in ('narrative', 'turn') group by i.doc_uuid
  ) c using (doc_uuid)
), checks as (
  select *, source = 'emberlamp/chatlogs' as chat, source = 'hollowquill/forum-raw' as forum,
    narratives > 0 and narratives = narratives_done as html, turns > 0 and turns = turns_done as prose
  from facts
)
"""
_ISSUES = """
issues as (
  select doc_uuid, unnest(list_filter([
    case when not noted then 'Missing ''refine-cdm-language'' annotation' end,
    case when not language then 'Unset or empty language categorization' end,
    case when forum and not noted then 'Missing ''refine-cdm-html-to-markdown'' annotation' end,
    case when forum and narratives > narratives_done then (narratives - narratives_done) || ' narratives lack variant ''refine-cdm-html-to-markdown''' end,
    case when chat and not noted then 'Missing ''refine-chat-characters'' annotation' end,
    case when chat and not bot then 'Missing bot character profile' end,
    case when chat and not usr then 'Missing user character profile' end,
    case when chat and not noted then 'Missing ''refine-chat-safety-dials'' annotation' end,
    case when chat and not sex then 'Unset sexuality categorization' end,
    case when chat and not violence then 'Unset violence categorization' end,
    case when chat and not toxicity then 'Unset toxicity categorization' end,
    case when chat and not noted then 'Missing ''refine-chat-genre-theme'' annotation' end,
    case when chat and not genre then 'Unset genre categorization' end,
    case when chat and not themes then 'Unset thematic categorization' end,
    case when chat and not noted then 'Missing ''refine-chat-grammar'' annotation' end,
    case when chat and turns > turns_done then (turns - turns_done) || ' turns lack variant ''refine-chat-grammar''' end
  ], lambda x: x is not null)) as issue from checks
)
"""

_WINDOW_TEXTS = f"""
best as (
  select doc_uuid, item_id, arg_max(t, row(case when name = 'original' then 1 else 0 end, ingested_at, variant_id)) as t
  from (select *, {_strip('text')} as t from content_variants) where t <> '' group by doc_uuid, item_id
)
"""

SQL: dict[str, str] = {
    "ingest_turn_items": """
select doc_uuid, printf('turn-%06d', n) as item_id, n as turn_no, case when actor_id = 'user' then 'user' else coalesce(actor_id, 'bot') end as actor
from (select *, row_number() over (partition by doc_uuid order by item_pos, item_id) as n from doc_items where kind = 'turn' and doc_uuid is not null)""",
    "ingest_sequence_items": "select doc_uuid, count(*) as n_ids, string_agg(item_id, ',' order by item_pos, item_id) as ids from doc_items where kind = 'turn' group by doc_uuid",
    "content_addresses": "select variant_id, sha256(text) as address from content_variants where text is not null",
    "content_dedup": "select sha256(text) as address, min(variant_id) as first_id, count(*) as copies from content_variants where name = 'original' and text is not null group by text",
    "exact_dup_groups": "select md5(text) as md5, count(*) as copies, min(doc_id) as first_id from documents where text is not null group by text having count(*) > 1",
    "ledger_latest": "select source, native_id, arg_max(uuid, row(recorded_at, uuid)) as uuid, count(*) as n_entries, count(distinct uuid) as n_uuids from ledger group by source, native_id",
    "ledger_register": f"""
with k as (select source, native_id, arg_max(uuid, row(recorded_at, uuid)) as uuid from ledger group by all),
r as (select distinct {_SRC} as source, native_id from doc_meta where native_id is not null)
select source, native_id, k.uuid is null as is_new, k.uuid as known_uuid from r left join k using (source, native_id)""",
    "ledger_source_ranges": f"""
with p as (select doc_uuid, {_SRC} as source, row_number() over (order by doc_uuid) as pos from doc_meta)
select source, min(doc_uuid) as first_key, max(doc_uuid) as last_key, count(*) as n
from (select *, pos - row_number() over (partition by source order by pos) as run from p) group by source, run""",
    "ledger_position_samples": f"select * from (select doc_uuid, {_SRC} as src, row_number() over (order by doc_uuid) as pos from doc_meta) where pos > 1 and pos % 100 in (0, 1)",
    "ledger_orphans": """
select coalesce(m.uuid, l.uuid) as uuid, case when l.uuid is null then 'document' else 'ledger' end as side
from (select distinct doc_uuid as uuid from doc_meta) m full join (select distinct uuid from ledger) l on m.uuid = l.uuid
where m.uuid is null or l.uuid is null""",
    "reconcile_upsert": """
select user_id, event_type, max(row(ts, event_id)).ts as ts, max(row(ts, event_id)).event_id as event_id, arg_max(value, row(ts, event_id)) as value
from (select user_id, event_type, ts, event_id, value from events) group by user_id, event_type""".replace("max(row(ts, event_id)).ts", "max(ts)").replace("max(row(ts, event_id)).event_id", "arg_max(event_id, row(ts, event_id))"),
    "redelivered_variants": "select doc_uuid, item_id, name, arg_max(variant_id, row(ingested_at, variant_id)) as latest_id, count(*) as deliveries from content_variants group by all having count(*) > 1",
    "reconcile_changes": """
with v as (select *, doc_uuid || '/' || item_id as k from content_variants where name = 'original'),
a as (select k, arg_min(text, variant_id) as text, true as a from v where text is not null group by k union all select k, null, true from v group by k having count(text) = 0),
b as (select k, arg_max(text, row(ingested_at, variant_id)) as text, true as b from v where ingested_at >= timestamp '2024-09-01' and text is not null group by k
  union all select k, null, true from v where ingested_at >= timestamp '2024-09-01' group by k having count(text) = 0)
select case when b is null then 'kept' when a is null then 'inserted' when a.text is not distinct from b.text then 'same' else 'updated' end as change, count(*) as n
from a full join b using (k) group by all""",
    "thread_sequence": """
select doc_uuid, count(*) as n_ids, string_agg(item_id, ',' order by coalesce(posted_at, ''), coalesce(try_cast(post_id as bigint), 0), item_id) as ids
from (select distinct doc_uuid, item_id, posted_at, post_id from content_variants where name = 'original' and post_id is not null) group by doc_uuid""",
    "paragraph_split": rf"""
with p as (select doc_id, list_filter(list_transform(regexp_split_to_array(text, '\n[\s\x{{a0}}]*\n'), lambda x: {_strip('x')}), lambda x: x <> '') as ps from documents where text is not null)
select doc_id, i::int as paragraph_no, {_strip(r"regexp_replace(regexp_replace(p, '([\p{L}\p{N}_]+)-\n\s*([\p{L}\p{N}_]+)', '\1\2', 'g'), '[\s\x{a0}]+', ' ', 'g')")} as paragraph
from (select doc_id, unnest(range(len(ps))) as i, unnest(ps) as p from p)""",
    "dangling_sequences": """
with x as (select doc_uuid, item_id, unnest(item_ids) as id from doc_items where kind = 'sequence'),
k as (select x.doc_uuid, x.item_id, x.id, count(*) as n from x group by all), i as (select distinct doc_uuid, item_id as id, true as known from doc_items)
select k.doc_uuid, k.item_id, sum(n)::bigint as n_ids, coalesce(sum(n) filter (known is null), 0)::bigint as n_dangling, sum(n - 1)::bigint as n_repeated
from k left join i using (doc_uuid, id) group by all""",
    "range_filter": "select doc_uuid, native_id from doc_meta where doc_uuid between '01961283' and '01961290'",
    "source_scope": f"select {_SRC} as source, count(*) as n from doc_meta where {_SRC} in ('emberlamp/chatlogs', 'unknown') group by all",
    "variant_select": f"""
select doc_uuid, item_id, x.name as name, x.text as text from (
  select doc_uuid, item_id, arg_max({{'name': name, 'text': t}}, row(case name when 'refine-chat-grammar' then 2 when 'original' then 1 else 0 end, ingested_at, variant_id)) as x
  from (select *, {_strip('text')} as t from content_variants) where t <> '' group by doc_uuid, item_id)""",
    "variants_present": """
select doc_uuid, item_id, kind from doc_items semi join
  (select doc_uuid, item_id from content_variants where name in ('original', 'refine-chat-grammar') group by all having count(distinct name) = 2) using (doc_uuid, item_id)""",
    "pending_categories": """
select doc_uuid from doc_meta where doc_uuid not in
  (select doc_uuid from doc_items where kind = 'categorization' and category in ('genre', 'theme') and doc_uuid is not null group by doc_uuid having count(distinct category) = 2)""",
    "inference_budget": """
select doc_uuid, item_pos, item_id from doc_items anti join (select doc_uuid, item_id from content_variants where name = 'refine-chat-grammar') using (doc_uuid, item_id)
where kind = 'turn' order by doc_uuid, item_pos, item_id limit 50""",
    "doc_stats": f"""
select m.doc_uuid, coalesce(items, 0) as items, coalesce(turns, 0) as turns, coalesce(narratives, 0) as narratives, coalesce(characters, 0) as characters, coalesce(words, 0) as words
from doc_meta m
left join (select doc_uuid, count(*) as items, count(*) filter (kind = 'turn') as turns, count(*) filter (kind = 'narrative') as narratives, count(*) filter (kind = 'character') as characters from doc_items group by doc_uuid) using (doc_uuid)
left join (select doc_uuid, sum(coalesce({_words('text')}, 0))::bigint as words from content_variants group by doc_uuid) using (doc_uuid)""",
    "item_kind_counts": "select kind, count(*) as n_items from doc_items group by kind",
    "variant_counts": "select i.kind, name, count(*) as n_variants from content_variants left join (select doc_uuid, item_id, any_value(kind) as kind from doc_items group by all) i using (doc_uuid, item_id) group by all",
    "structured_keys": """
select kind, case when kind = 'categorization' then coalesce(nullif(category, ''), '(none)') else coalesce(nullif(json_extract_string(data, '$.sequence_for'), ''), '(none)') end as key, count(*) as n_items
from doc_items where kind in ('categorization', 'sequence') group by all""",
    "content_shapes": """
select kind, case when kind in ('categorization', 'sequence') then case when blank is null then 'structured' else 'unexpected' end
  when coalesce(kind, '') not in ('world', 'character', 'summary', 'narrative', 'turn') then 'unclassified'
  when blank is null then 'missing' when blank then 'malformed' else 'variants' end as shape, count(*) as n_items
from doc_items left join (select doc_uuid, item_id, bool_or(coalesce(trim(name), '') = '') as blank from content_variants group by all) using (doc_uuid, item_id) group by all""",
    "malformed_counts": """
select (select count(*) from content_variants where coalesce(trim(name), '') = '') as blank_names,
  (select count(*) from doc_items where kind = 'categorization' and coalesce(trim(category), '') = '') as blank_categories,
  (select count(*) from doc_items where kind = 'sequence' and coalesce(trim(json_extract_string(data, '$.sequence_for')), '') = '') as blank_purposes""",
    "turn_distribution": _distribution(_TURNS, "turns"),
    "turn_buckets": f"select bucket_no, bucket, count(turns) as n, count(turns) * 100e0 / (select count(*) from doc_meta) as pct from {_BUCKETS} left join {_TURNS} t on turns between low and high group by all",
    "narrative_distribution": _distribution("(select length(text) as chars from documents)", "chars"),
    "safety_distribution": " union all ".join(
        f"select *, '{axis}' as axis from ({_shares(f"(select coalesce(x[{i}], 'Unset') as value from doc_meta left join {_DIAL} using (doc_uuid))", 'value')})"
        for i, axis in enumerate(("sexual_axis", "violence_axis", "toxicity_axis"), 1)
    ),
    "genre_mix": _shares("(select coalesce(primary_genre, 'Unset') as genre from genre_themes)", "genre"),
    "theme_top25": f"""
with t as (select distinct response_id, {_sanitize('tag')} as tag from {_TAGS}), c as (select tag, count(*) as n from t where tag <> '' group by tag),
top as (select * from c order by n desc, tag limit 25)
select * from top union all select '(other)', coalesce(sum(n), 0)::bigint from c anti join top using (tag)""",
    "language_distribution": "select lang, count(*) as n, count(*) * 100e0 / (select count(*) from doc_meta) as pct from (select unnest(value) as lang from doc_items where kind = 'categorization' and category = 'language') group by lang",
    "health_flags": f"""
with {_FACTS}, {_ISSUES}
select doc_uuid, source, coalesce(n, 0) = 0 as is_healthy, coalesce(n, 0) as n_issues, turns as total_turns, turns_converted as converted_turns,
  (noted and language)::varchar as refine_cdm_language_passed, case when forum then html::varchar else 'n/a' end as refine_cdm_html_to_markdown_narrative,
  case when chat then bot::varchar else 'n/a' end as refine_chat_characters_bot_detail, case when chat then usr::varchar else 'n/a' end as refine_chat_characters_user_info,
  case when chat then themes::varchar else 'n/a' end as refine_chat_genre_theme_themes, case when chat then prose::varchar else 'n/a' end as refine_chat_grammar_prose
from checks left join (select doc_uuid, count(*) as n from issues group by doc_uuid) using (doc_uuid)""",
    "stage_breakdown": f"""
with {_FACTS}, s as (
  select 'refine-cdm-language' as stage, unnest(['annotation', 'categorization_item', 'passed']) as "check", unnest([noted, language, noted and language]) as ok from checks
  union all select 'refine-cdm-html-to-markdown', unnest(['annotation', 'narrative', 'passed']), unnest([noted, html, noted and html]) from checks where forum
  union all select 'refine-chat-characters', unnest(['annotation', 'bot detail', 'user info', 'passed']), unnest([noted, bot, usr, noted and bot and usr]) from checks where chat
  union all select 'refine-chat-safety-dials', unnest(['annotation', 'sexuality axis', 'violence axis', 'toxicity axis', 'passed']), unnest([noted, sex, violence, toxicity, noted and sex and violence and toxicity]) from checks where chat
  union all select 'refine-chat-genre-theme', unnest(['annotation', 'primary genre', 'themes', 'passed']), unnest([noted, genre, themes, noted and genre and themes]) from checks where chat
  union all select 'refine-chat-grammar', unnest(['annotation', 'prose', 'passed']), unnest([noted, prose, noted and prose]) from checks where chat)
select stage, "check", count(*) filter (ok) as n_passed, count(*) as n_due, count(*) filter (ok) * 100e0 / count(*) as pct from s group by all""",
    "issue_counts": f"with {_FACTS}, {_ISSUES} select issue, count(*) as n_documents from issues group by all",
    "source_breakdown": _shares(f"(select {_SRC} as source from doc_meta)", "source"),
    "conversion_summary": f"with {_FACTS}, t as (select sum(turns)::bigint as total_turns, sum(turns_converted)::bigint as converted_turns from checks) select *, converted_turns * 100e0 / total_turns as pct, (total_turns - converted_turns) * 5e0 / 3600e0 as hours_left from t",
    "char_names": """
select doc_uuid, arg_min(entity_id, row(item_pos, item_id)) filter (entity_id = 'user') as player, arg_min(entity_id, row(item_pos, item_id)) filter (entity_id <> 'user') as bot
from doc_items where kind = 'character' group by doc_uuid""",
    "url_profile": "select thread_id, count(*) as n, count(distinct text) as n_texts, sum(n_chars)::bigint as chars, max(n_chars) as longest from documents group by thread_id",
    "resolve_meta": """
with c as (select * from doc_items where kind = 'categorization'),
l as (select doc_uuid, category, v, min(row(item_pos, i)) as ord from (select doc_uuid, category, item_pos, unnest(range(len(value))) as i, unnest(value) as v from c where category in ('theme', 'language')) group by all),
j as (select doc_uuid, string_agg(v, '|' order by ord) filter (category = 'theme') as themes, string_agg(v, '|' order by ord) filter (category = 'language') as languages from l group by doc_uuid),
s as (select doc_uuid,
  arg_max(value[1], item_pos) filter (category = 'sexuality' and not value_is_list and value[1] in ('Clean', 'Suggestive', 'Explicit')) as sexuality,
  arg_max(value[1], item_pos) filter (category = 'violence' and not value_is_list and value[1] in ('None', 'Combat', 'Graphic')) as violence,
  arg_max(value[1], item_pos) filter (category = 'toxicity' and not value_is_list and value[1] in ('Safe', 'Harassment', 'Dangerous')) as toxicity,
  arg_max(value[1], item_pos) filter (category = 'genre' and not value_is_list and value[1] in ('Fantasy', 'Sci-Fi', 'Romance', 'Slice of Life', 'Action & Adventure', 'Mystery & Thriller', 'Comedy', 'Drama')) as genre
  from c group by doc_uuid)
select doc_uuid, sexuality, violence, toxicity, genre, coalesce(themes, '') as themes, coalesce(languages, '') as languages from s left join j using (doc_uuid)""",
    "history_context": """
select doc_uuid, item_pos, item_id, coalesce(array_to_string(list(item_id) over (partition by doc_uuid order by item_pos, item_id rows between 5 preceding and 1 preceding), chr(10)), '') as history
from doc_items where kind = 'turn' and doc_uuid is not null""",
    "prompt_first_100": f"""
with {_WINDOW_TEXTS}, t as (
  select i.doc_uuid, row_number() over (partition by i.doc_uuid order by item_pos, i.item_id) as r, case when actor_id = 'user' then 'USER' else 'CHARACTER' end || ': ' || t as line
  from doc_items i join best using (doc_uuid, item_id) where kind = 'turn')
select doc_uuid, sha256(p) as prompt_sha, length(p) as chars from (select doc_uuid, string_agg(line, chr(10) order by r) as p from t where r <= 100 group by doc_uuid)""",
    "token_budgets": f"""
select variant_id, estimate, greatest(8192, floor(estimate * 3e0)::int) as budget from (select variant_id, floor(coalesce({_words('text')}, 0) * 1.3e0)::int as estimate from content_variants)""",
    "language_windows": f"""
with {_WINDOW_TEXTS}, i as (select doc_uuid, item_id, item_pos, ((row_number() over (partition by doc_uuid order by item_pos, item_id) - 1) // 5)::int as window_no from doc_items where kind in ('turn', 'narrative'))
select doc_uuid, window_no, sha256(string_agg(t, chr(10) order by item_pos, item_id)) as text_sha from i join best using (doc_uuid, item_id) group by doc_uuid, window_no""",
    "language_scores": f"""
with {_WINDOW_TEXTS}, i as (select doc_uuid, item_id, item_pos, (row_number() over (partition by doc_uuid order by item_pos, item_id) - 1) // 5 as window_no from doc_items where kind in ('turn', 'narrative')),
w as (select doc_uuid, window_no, string_agg(t, chr(10) order by item_pos, item_id) as text from i join best using (doc_uuid, item_id) group by doc_uuid, window_no),
letters as (
  select doc_uuid, window_no, null as lang, string_split(' ' || lower({_strip("regexp_replace(text, '[^\\p{L}]+', ' ', 'g')")}) || ' ', '') as c from w
  union all select null, null, lang, string_split(' ' || lower({_strip("regexp_replace(text, '[^\\p{L}]+', ' ', 'g')")}) || ' ', '') from lang_samples where text is not null and lang is not null
), g as (select doc_uuid, window_no, lang, c[k] || c[k + 1] || c[k + 2] as g from (select *, unnest(range(1, len(c) - 1)) as k from letters)),
counts as (select lang, g, count(*) as n from g where lang is not null group by all),
size as (select lang, ln(0.5 / (sum(n) + 0.5 * count(*))) as least from counts group by lang),
mine as (select doc_uuid, window_no, g, count(*) as m from g where lang is null group by all),
total as (select doc_uuid, window_no, sum(m) as k from mine group by all),
gains as (select doc_uuid, window_no, lang, sum(m * ln(n / 0.5 + 1)) as gain from mine join counts using (g) group by all),
means as (select doc_uuid, window_no, k, size.lang, least + coalesce(gain, 0) / k as m from total cross join size left join gains using (doc_uuid, window_no, lang)),
e as (select *, exp((m - max(m) over (partition by doc_uuid, window_no)) * least(k, 40)) as e from means),
s as (select doc_uuid, window_no, lang, e / sum(e) over (partition by doc_uuid, window_no) as score from e),
b as (select doc_uuid, lang, max(score) as score, count(*) as n from s group by doc_uuid, lang having max(score) >= 0.05)
select doc_uuid, string_agg(lang, ',' order by score desc, lang) as languages, max(n) as n_windows from b group by doc_uuid""",
    "latest_annotations": "select doc_uuid, item_id, arg_max(annotation, row(ingested_at, variant_id)) as annotation, count(*) as n from content_variants where annotation is not null group by all",
    "html_extract": "select variant_id, regexp_extract(text, '^<([a-z0-9]+)', 1) as first_tag, len(regexp_extract_all(text, '<(/?[a-z0-9]+)[^<>]*>', 1)) as n_tags from content_variants where text like '%<%'",
    "scalpel_items": "select doc_uuid, count(*) as n_items from doc_items where not coalesce(kind = 'categorization' and category in ('language', 'genre', 'theme'), false) group by doc_uuid",
    "scalpel_variants": "select name, count(*) as n from content_variants v where not (name = 'refine-chat-grammar' and exists (select 1 from doc_items i where i.doc_uuid = v.doc_uuid and i.item_id = v.item_id and i.kind = 'turn')) group by name",
    "purge_records": """
with k as (select 'ledger' as part, uuid from ledger where uuid not in (select doc_uuid from doc_meta where doc_uuid between '01961283' and '01961290')
  union all select 'meta', doc_uuid from doc_meta where doc_uuid not between '01961283' and '01961290')
select part, count(*) as n, count(distinct uuid) as n_uuids from k group by part""",
    "corrupt_records": """
select doc_uuid, 'item kind' as reason from doc_items where coalesce(kind, '') not in ('world', 'character', 'summary', 'narrative', 'turn', 'categorization', 'sequence')
union select doc_uuid, 'item id' from doc_items group by doc_uuid, item_id having count(*) > 1 or item_id is null
union select doc_uuid, 'data' from doc_items where data is not null and not json_valid(data)
union select doc_uuid, 'document kind' from doc_meta where kind is null or kind <> 'document'""",
    "package_lines": """
select m.doc_uuid, count(i.doc_uuid) as n_items, m.native_id, arg_min(i.item_id, row(i.item_pos, i.item_id)) as first_item
from doc_meta m left join doc_items i using (doc_uuid) group by m.doc_uuid, m.native_id""",
    "flavour_split": f"""
select case when coalesce(x[1], 'Clean') in ('Clean', 'Suggestive') and coalesce(x[3], 'Safe') = 'Safe' then 'general' else 'unbound' end as flavour, count(*) as n
from doc_meta left join {_DIAL} using (doc_uuid) group by all""",
    "theme_sanitize": f"select response_id, tag_no, {_sanitize('tag')} as tag from {_TAGS}",
    "theme_term_frequency": f"select term, count(*) as n from (select {_term('tag')} as term from {_TAGS}) where term <> '' group by term having count(*) >= 2",
    "theme_crosstab": f"""
with t as (select {_term('tag')} as term, coalesce(primary_genre, 'Unset') as genre, coalesce(x[1], 'Clean') as s, coalesce(x[2], 'None') as v, coalesce(x[3], 'Safe') as h from {_TAGS} left join {_DIAL} using (doc_uuid))
select term, axis, value, count(*) as n from (
  select term, unnest(['genre', 'sexuality', 'violence', 'toxicity']) as axis, unnest([genre, s, v, h]) as value from t where term <> '') group by all""",
    "theme_cluster_rollup": f"""
with g as (select cluster_id, count(*) as n_terms, sum(n)::bigint as freq, list(term order by n desc, term) as terms from {_GENRE_TERMS} group by cluster_id)
select cluster_id, lower(replace(terms[1], ' ', '-')) as label, n_terms, freq, array_to_string(terms[1:5], ', ') as top_terms from g""",
    "theme_summary_top3": f"""
with r as (select *, row_number() over (partition by cluster_id order by n desc, term) as r, sum(n) over (partition by cluster_id) as a from {_GENRE_TERMS})
select cluster_id, string_agg(term || ' ' || round(n * 100 / a)::int || '%', ' | ' order by r) as summary from r where r <= 3 group by cluster_id""",
    "theme_curation": f"""
with m as (select {_term('t')} as term, max(row(theme_id, case when theme_id % 10 = 0 then null else lower(replace(theme, ' ', '-')) end)) as x
  from (select theme_id, theme, unnest(list_prepend(theme, aliases)) as t from theme_list) group by all),
c as (select term, x[2] as canonical, true as mapped from m),
t as (select doc_uuid, {_term('tag')} as term from {_TAGS})
select doc_uuid, coalesce(string_agg(distinct theme, ',' order by theme), '') as themes from (
  select doc_uuid, case when mapped then canonical else lower(replace(term, ' ', '-')) end as theme from t left join c using (term) where term <> '') group by doc_uuid""",
    "embedding_pairs": """
select a.vec_id as a, b.vec_id as b from embeddings a join embeddings b on a.vec_id < b.vec_id
where 1 - list_cosine_similarity(a.embedding::double[], b.embedding::double[]) < 0.7""",
    "embedding_components": """
with recursive p as (
  select a.vec_id as a, b.vec_id as b from embeddings a join embeddings b on a.vec_id <> b.vec_id where 1 - list_cosine_similarity(a.embedding::double[], b.embedding::double[]) < 0.7
), r(node, reach) as (select distinct a, a from p union select r.node, p.b from r join p on p.a = r.reach)
select node, min(reach) as component from r group by node""",
    "event_windows": "select time_bucket(interval 1 hour, ts) as window_start, time_bucket(interval 1 hour, ts) + interval 1 hour as window_end, event_type, count(*) as n from events group by all",
}
