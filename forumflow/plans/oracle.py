"""The registered queries as plain SQL over the same tables, for checking only."""

from __future__ import annotations

from forumflow.functions.display import SPACE
from forumflow.plans.catalog import BASE_URL, BATCH, FIRST_SEGMENT, RUN_STARTED
from forumflow.plans.inputs import EVENT_TEXTS, TURN_TEXTS

_START = f"timestamp '{RUN_STARTED}'"


def _select(texts: dict[str, str]) -> str:
    return ", ".join(f"{sql} as {name}" for name, sql in texts.items())


def _votes(text: str, zero: str, kind: str = "decimal(20,6)") -> str:
    return (
        f"case when {zero} then 0 when {text} like '%k' then "
        f"try_cast(trunc(try_cast(left({text}, -1) as {kind}) * 1000) as integer) "
        f"else try_cast({text} as integer) end"
    )


def _time(text: str, at: str) -> str:
    n, unit = f"try_cast(split_part({text}, ' ', 1) as integer)", f"split_part({text}, ' ', 2)"
    return f"""case when {text} is null then null when {text} like 'just%' then {at}
        when {unit} = '' then null
        when {unit} in ('hour', 'hours') then {at} - to_hours({n})
        when {unit} in ('minute', 'minutes') then {at} - to_minutes({n})
        when {unit} in ('day', 'days') then {at} - to_days({n})
        when {unit} in ('month', 'months') then {at} - to_months({n})
        else {at} end"""


_POST_VOTES = _votes("votes_text", "votes_text in ('•', 'None', 'Vote')")
_COMMENT_VOTES = _votes("c_votes", "c_votes is null or c_votes = 'Vote'")
_PERCENT = """case when percent_text is null or percent_text = '' then 0 else
    try_cast(left(split_part(trim(percent_text), ' ', 1), -1) as integer) end"""

# Events as typed posts, each with its one comment.
_TYPED = f"""
with shown as (select {_select(EVENT_TEXTS)} from events),
parsed as (
    select *, {_POST_VOTES} as upvotes, {_PERCENT} as percent_upvotes,
        {_time("age_text", "captured_at")} as datetime,
        concat_ws(' ', first_paragraph, second_paragraph) as text,
        {_COMMENT_VOTES} as c_upvotes, {_time("c_age", "captured_at")} as c_datetime
    from shown),
typed as (
    select *,
        case when age_text is not null and datetime is null then 'age'
            when upvotes is null then 'votes' when percent_upvotes is null then 'percent' end as reason,
        case when author is null then 'author' when datetime is null then 'datetime' end as insert_reason,
        case when c_upvotes is null then 'votes'
            when c_age is not null and c_datetime is null then 'age'
            when c_author is null or c_datetime is null then 'incomplete' end as c_reason
    from parsed)"""

# What a run over all events leaves, from nothing.
_RUN = f"""{_TYPED},
firsts as (
    select title, arg_min(author, seq) as author, arg_min(text, seq) as text,
        arg_min(datetime, seq) as datetime, min(seq) as first_seq
    from typed where reason is null and insert_reason is null group by title),
lasts as (
    select title, arg_max(upvotes, seq) as upvotes, arg_max(percent_upvotes, seq) as percent_upvotes,
        arg_max(community, seq) as community, max(seq) as last_seq
    from typed where reason is null group by title),
posts as (
    select sha256(title) as id, title, author, upvotes, percent_upvotes, 1 as comment_count, text,
        datetime, community, first_seq, last_seq
    from firsts join lasts using (title)),
accepted as (
    select typed.*, posts.datetime as post_datetime, posts.id as post_id
    from typed join posts using (title) where reason is null and seq >= first_seq),
storable as (select * from accepted where c_reason is null)"""

_POST_COLUMNS = """id, title, author, upvotes, percent_upvotes, comment_count, text, datetime, community"""

# Conversations: the first turn is a post, the others are its comments.
_TURNS = f"""
with turns as (
    select *, timestamp '2024-01-01' + to_minutes(seq % 100000) as captured_at
    from (select turn, text as body, {_select(TURN_TEXTS)} from conversations)),
counted as (
    select seq, cast(count(*) filter (where turn > 0) as integer) as n from turns group by seq),
heads as (select * from turns join counted using (seq) where turn = 0)"""


def _conversation_votes(zero: str = "false") -> str:
    return _votes("votes_text", zero)


_ORACLE_POSTS = f"select {_POST_COLUMNS} from posts"


def _two_arrivals() -> str:
    """Posts after an earlier and a later arrival of interleaved captures."""

    def half(name: str, test: str) -> str:
        return f"""
{name}_first as (
    select title, arg_min(author, seq) as author, arg_min(text, seq) as text,
        arg_min(datetime, seq) as datetime
    from typed where reason is null and insert_reason is null and community {test} 'm' group by title),
{name}_last as (
    select title, arg_max(upvotes, seq) as upvotes, arg_max(percent_upvotes, seq) as percent_upvotes,
        arg_max(community, seq) as community, max(seq) as last_seq
    from typed where reason is null and community {test} 'm' group by title)"""

    return f"""{_TYPED}, {half("a", "<")}, {half("b", ">=")},
stored as (select * from a_first join a_last using (title)),
merged as (
    select title, s.title is not null as known, s.author as s_author, f.author as f_author,
        s.text as s_text, f.text as f_text, s.datetime as s_datetime, f.datetime as f_datetime,
        case when s.title is null or l.last_seq >= s.last_seq then l.upvotes else s.upvotes end as upvotes,
        case when s.title is null or l.last_seq >= s.last_seq then l.percent_upvotes
            else s.percent_upvotes end as percent_upvotes,
        case when s.title is null or l.last_seq >= s.last_seq then l.community
            else s.community end as community,
        case when s.title is null or l.last_seq >= s.last_seq then l.last_seq else s.last_seq end as last_seq
    from stored s full join b_last l using (title) left join b_first f using (title))
select sha256(title) as id, title, case when known then s_author else f_author end as author, upvotes,
    percent_upvotes, 1 as comment_count, case when known then s_text else f_text end as text,
    case when known then s_datetime else f_datetime end as datetime, community, last_seq,
    cast(case when known then {BATCH} else {BATCH + 1} end as bigint) as inserted_in
from merged where known or f_author is not null"""


def _marks(times: str) -> str:
    return f"""{_RUN}, times as ({times})
select least({_START}, coalesce(min(times.datetime), {_START})) as datetime, community
from (select distinct community from typed) c left join times using (community) group by community"""


def _entities(text: str) -> str:
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{char}')"
    return text


def _re2(java: str) -> str:
    """The character class in RE2's notation for code points."""
    out, rest = "", java
    while rest:
        if rest[0] == "\\":
            width = 2 if rest[1] == "x" else 4
            out += f"\\x{{{rest[2:2 + width]}}}"
            rest = rest[2 + width :]
        else:
            out, rest = out + rest[0], rest[1:]
    return out


_WORDS = f"regexp_extract_all(text, '[^{_re2(SPACE)}]+')"
_H1 = "regexp_extract(html, '<h1(?:\\s[^>]*)?>([^<]*)', 1)"
_HREF = "nullif(regexp_extract(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1), '')"
_PARAGRAPHS = "regexp_extract_all(html, '<p>(?:<[^>]*>)*([^<]*)', 1)"

ORACLE: dict[str, str] = {
    "scan_pages": """
select page_id as seq, url, regexp_extract(html, '<html lang="([^"]*)"', 1) as community,
    cast(length(html) as integer) as n_chars, sha256(html) as html_digest from pages""",
    "assemble_items": f"""{_TURNS}
select h.seq, h.community, h.title as "postTitle", h.n as comment_total,
    cast(t.turn - 1 as bigint) as pos, t.author, sha256(t.body) as text_digest
from heads h left join turns t on h.seq = t.seq and t.turn > 0""",
    "union_communities": f"""{_TURNS}, shown as (select {_select(EVENT_TEXTS)} from events)
select 'from_events' as community, seq, title as "postTitle", votes_text as "postUpVotes" from shown
union all
select 'from_conversations', seq, title, votes_text from heads""",
    "seed_consistency": f"""
with seeds as (
    select regexp_extract(html, '<html lang="([^"]*)"', 1) as community, url as start_url,
        unnest([url, coalesce(case when {_HREF} like '%://%' then {_HREF}
            else '{BASE_URL}' || {_HREF} end, '')]) as listed_url from pages)
select *, regexp_extract(start_url, '{FIRST_SEGMENT}', 1) as start_community,
    regexp_extract(listed_url, '{FIRST_SEGMENT}', 1) as listed_community
from seeds where regexp_extract(start_url, '{FIRST_SEGMENT}', 1) <> community
    or regexp_extract(listed_url, '{FIRST_SEGMENT}', 1) <> community""",
    "sink_roundtrip": f"{_RUN} {_ORACLE_POSTS}",
    "extract_cards": """
select page_id, pos, regexp_extract(card, '>([^<]*)$', 1) as label,
    regexp_extract(card, 'href="([^"]*)"', 1) as href
from (
    select page_id, cast(unnest(generate_series(0, len(found) - 1)) as integer) as pos, unnest(found) as card
    from (select page_id, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*') as found from pages))""",
    "extract_title": f"select page_id, {_entities(f"nullif({_H1}, '')")} as title from pages",
    "extract_first_link": f"select page_id, {_entities(_HREF)} as href from pages",
    "extract_fallback": f"""
select page_id, {_entities(f"coalesce(nullif(regexp_extract(html, '<p>([^<]+)', 1), ''), nullif({_H1}, ''))")} as text
from pages""",
    "extract_paragraphs": f"""
select page_id, cast(unnest(generate_series(0, len(found) - 1)) as integer) as pos,
    {_entities("unnest(found)")} as text
from (select page_id, {_PARAGRAPHS} as found from pages)""",
    "extract_nested": f"""
select page_id, {_entities(f"nullif({_H1}, '')")} as "postTitle",
    {_entities("nullif(regexp_extract(html, '<li><a[^>]*>([^<]*)', 1), '')")} as first_menu_text,
    {_entities("nullif(regexp_extract(html, '<div class=\"ad\">([^<]*)', 1), '')")} as ad_text,
    {_entities("nullif(regexp_extract(html, '<title>([^<]*)', 1), '')")} as h2_or_title,
    0 as pos, {_entities(f"nullif({_H1}, '')")} as author,
    cast(len({_PARAGRAPHS}) as integer) as n_paragraphs,
    sha256({_entities(f"array_to_string({_PARAGRAPHS}, chr(10))")}) as text_digest
from pages""",
    "paragraph_null_literal": """
select conv_id, turn,
    case when role = 'user' then 'None' else role end || ' ' || replace(text, chr(10), ' ') as text,
    case when role = 'user' then 'None' else role end as role_text,
    nullif(role, 'user') as role_text_or_null
from conversations""",
    "filter_promoted": """
with cards as (
    select event_id, case event_id % 4 when 0 then 'promoted' when 1 then null else event_type end as label
    from events)
select * from cards where label <> 'promoted'""",
    "resolve_url": f"""
select page_id, case when {_HREF} like '%://%' then {_HREF} else '{BASE_URL}' || {_HREF} end as post_url,
    url as page_url from pages""",
    "project_post": f"""{_TURNS}
select seq, community, title, author, age_text, votes_text, percent_text, n as comment_count from heads""",
    "filter_complete": f"""{_TYPED}
select seq, cast(0 as bigint) as pos, c_author as author, c_upvotes as upvotes, c_datetime as datetime,
    c_text as text, sha256(title) as post_id
from typed where c_author is not null and c_upvotes is not null and c_datetime is not null""",
    "validate_rows": """
select doc_id, case when lang is null or length(lang) > 255 then 'lang'
    when source is null or length(source) > 255 then 'source'
    when text is null or length(text) > 10000 then 'text' end as reason
from documents""",
    "fk_orphans": """
select doc_id, count(*) as n_rows from documents
where doc_id is not null and doc_id not in (select doc_id from labels) group by doc_id""",
    "unique_violations": """
select sha256(text) as text_digest, count(*) as n_rows from documents
where text is not null group by text having count(*) > 1""",
    "votes_post": f"""
with shown as (select {_select(EVENT_TEXTS)} from events)
select seq, votes_text, {_POST_VOTES} as upvotes,
    {_votes("votes_text", "votes_text in ('•', 'None', 'Vote')", "double")} as upvotes_binary from shown""",
    "votes_comment": f"""
with shown as (select {_select(EVENT_TEXTS)} from events)
select seq, c_votes, {_COMMENT_VOTES} as upvotes from shown""",
    "percent_upvoted": f"""
with shown as (select {_select(EVENT_TEXTS)} from events)
select seq, percent_text, {_PERCENT} as percent from shown""",
    "relative_time": f"""
with shown as (select {_select(EVENT_TEXTS)} from events),
timed as (select seq, age_text, {_time("age_text", "captured_at")} as datetime from shown)
select seq, datetime, age_text is null or datetime is not null as age_ok,
    case when age_text is not null then age_text like 'just%' or split_part(age_text, ' ', 2) in
        ('hour', 'hours', 'minute', 'minutes', 'day', 'days', 'month', 'months') end as age_known
from timed""",
    "combine_join": """
select conv_id, turn, array_to_string(string_split(text, chr(10)), ' ') as text from conversations""",
    "combine_last": """
select conv_id, turn, case when len(parts) = 1 then parts[1] else ' ' || parts[-1] end as text
from (select conv_id, turn, string_split(text, chr(10)) as parts from conversations)""",
    "word_split": f"""
select doc_id, cast(len(w) as integer) as n_words, w[1] as first_word,
    sha256(array_to_string(w, chr(10))) as words_digest
from (select doc_id, {_WORDS} as w from documents)""",
    "comment_count": f"{_TURNS} select seq, n as comment_count from heads",
    "upsert_community": "select distinct sha256(event_type) as id, event_type as community from events",
    "lookup_post": f"""{_TYPED},
stored as (
    select title, first_row.author as stored_author, upvotes as stored_upvotes,
        first_row.datetime as stored_datetime
    from (select title, arg_min(struct_pack(author := author, datetime := datetime), seq) as first_row
          from typed where reason is null and insert_reason is null and community < 'm' group by title)
    join (select title, arg_max(upvotes, seq) as upvotes from typed
          where reason is null and community < 'm' group by title) using (title))
select title, seq, stored_author, stored_upvotes, stored_datetime, s.title is not null as known
from typed left join stored s using (title)""",
    "resolve_post_id": f"""{_TURNS}
select t.seq, t.pos, sha256(h.title) as post_id from turns t join heads h using (seq)
where t.turn > 0 and length(h.title) <= 10000""",
    "lookup_comment": """
with stored as (
    select text, arg_max(source, doc_id) as stored_source, max(doc_id) as stored_doc_id
    from documents where source < 'src5' group by text)
select doc_id, stored_source, stored_doc_id, s.text is not null as known
from documents left join stored s using (text)""",
    "flatten_comments": f"""{_TURNS}
select t.seq, t.pos, h.community, sha256(h.title) as post_id, t.author, t.votes_text, t.body as text
from turns t join heads h using (seq) where t.turn > 0""",
    "upsert_posts": f"{_RUN} {_ORACLE_POSTS}",
    "upsert_comments": f"""{_RUN}
select arg_max(post_id, seq) as post_id, sha256(c_text) as id, arg_max(c_author, seq) as author,
    arg_max(c_upvotes, seq) as upvotes, c_text as text, arg_max(c_datetime, seq) as datetime,
    arg_max(community, seq) as community
from storable group by c_text""",
    "post_mark": _marks("select community, post_datetime as datetime from accepted"),
    "comment_mark": _marks("select community, c_datetime as datetime from storable"),
    "merge_marks": f"""
with old as (select 'p' || user_id as community, least({_START}, min(ts)) as datetime from events group by user_id),
new as (select event_type as community, least({_START}, min(ts)) as datetime from events group by event_type)
select coalesce(new.datetime, old.datetime) as datetime, community from new full join old using (community)""",
    "fold_duplicates": f"""{_TYPED}
select title, arg_min(author, seq) filter (where insert_reason is null) as first_author,
    min(seq) filter (where insert_reason is null) as first_seq, arg_max(upvotes, seq) as last_upvotes,
    max(seq) as last_seq
from typed where reason is null group by title""",
    "stream_fold": f"""{_TYPED}
select title, arg_min(author, seq) filter (where insert_reason is null) as first_author,
    min(seq) filter (where insert_reason is null) as first_seq, arg_max(upvotes, seq) as last_upvotes,
    max(seq) as last_seq
from typed where reason is null group by title""",
    "first_per_key": """
select user_id, min(event_id) as event_id, arg_min(event_type, event_id) as event_type,
    arg_min(value, event_id) as value from events group by user_id""",
    "conversation_posts": f"""{_TURNS}
select sha256(title) as id, title, author, {_conversation_votes()} as upvotes,
    cast(seq % 101 as integer) as percent_upvotes, n as comment_count, replace(body, chr(10), ' ') as text,
    captured_at - to_hours(seq % 25) as datetime, community
from heads where length(title) <= 10000""",
    "conversation_comments": f"""{_TURNS},
flat as (
    select t.*, replace(t.body, chr(10), ' ') as joined, h.title as post_title,
        h.captured_at - to_hours(t.seq % 25) as datetime, h.seq * 1000000 + t.pos as rank
    from turns t join heads h using (seq)
    where t.turn > 0 and length(h.title) <= 10000 and length(t.body) <= 10000)
select sha256(arg_max(post_title, rank)) as post_id, sha256(joined) as id, arg_max(author, rank) as author,
    arg_max({_conversation_votes()}, rank) as upvotes, joined as text, arg_max(datetime, rank) as datetime,
    arg_max(community, rank) as community
from flat group by joined""",
    "stream_ingest": f"""{_TYPED}
select seq, community, title, upvotes, datetime, reason, insert_reason from typed""",
    "stream_upsert": f"{_RUN} {_ORACLE_POSTS}",
    "late_update": _two_arrivals(),
    "sink_two_batches": _two_arrivals(),
    "reject_report": f"""{_RUN}
select 'post' as stage, coalesce(reason, insert_reason) as reason, seq, cast(null as bigint) as pos
from typed left join posts using (title)
where reason is not null or (insert_reason is not null and (first_seq is null or seq < first_seq))
union all
select 'comment', c_reason, seq, 0 from accepted where c_reason is not null""",
}
