"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

# Words of a text: A-Z lower-cased, then runs of ASCII letters and digits and of anything beyond
# ASCII. Used by the operators on word shingles and by decontamination.
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION = rf"""
with item as (select item_id, {_WORDS} as w from benchmark),
win as (
  select distinct item_id, w[i:i + least(len(w), 10) - 1] as win
  from item, unnest(generate_series(1, greatest(len(w) - 10, 0) + 1)) as s(i)
  where len(w) > 0),
doc as (select row_number() over () as rn, doc_id, {_WORDS} as w from documents),
place as (
  select rn, i, l, w[i:i + l - 1] as win
  from doc, (select distinct len(win) as l from win),
    unnest(generate_series(1, len(w))) as s(i)
  where i + l - 1 <= len(w)),
hit as (select rn, i, l, item_id from place join win using (win)),
word as (
  select rn, count(distinct p) as n_hit
  from hit, unnest(generate_series(i, i + l - 1)) as s(p) group by rn),
ids as (
  select rn, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct rn, item_id::varchar as id from hit) group by rn)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc left join word using (rn) left join ids using (rn)
"""

JACCARD = rf"""
with recursive doc as (select row_number() over () as rn, doc_id, {_WORDS} as w from documents),
gram as (
  select distinct rn, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') as g
  from doc, unnest(generate_series(1, greatest(len(w) - 5, 0) + 1)) as s(i) where len(w) > 0),
size as (select rn, count(*) as n from gram group by rn),
pair as (
  select a.rn as a, b.rn as b
  from gram a join gram b on a.g = b.g and a.rn <> b.rn
    join size s on s.rn = a.rn join size t on t.rn = b.rn
  group by a.rn, b.rn, s.n, t.n having 9 * count(*) >= 4 * (s.n + t.n)),
reach as (select rn as a, rn as b from doc union select r.a, p.b from reach r join pair p on p.a = r.b),
class as (select a, min(doc_id) as class_id from reach join doc on rn = b group by a)
select doc_id, class_id, (select count(*) from pair where pair.a = rn) as n_links
from doc join class on class.a = rn
"""

# The latest earlier response by a plain correlated maximum, validators in order of strength.
REVISITS = r"""
with page as (
  select page_id as n, url, html, '"' || md5(html)[1:12] || '"' as tag, sha1(html) as sha,
    strftime(make_timestamp((1700000000 + (page_id % 50) * 86400) * 1000000), '%Y-%m-%d') as day
  from pages),
raw as (
  select 2 * n as record_id, true as is_full, url as uri, 1700000000 + n * 600 as t,
    list_filter([
      {'k': 'Content-Type', 'v': 'text/html'}, {'k': 'Content-Length', 'v': strlen(html)::varchar},
      {'k': 'ETag', 'v': case when n % 4 <> 0 then tag end},
      {'k': 'Last-Modified', 'v': case when n % 3 <> 0 then day end},
      {'k': 'Cache-Control', 'v': 'max-age=60'}], lambda h: h.v is not null) as headers, sha
  from page
  union all
  select 2 * n + 1, false,
    url || case when contains(url, '?') or contains(url, '#') then ''
      else ['', '#top', '/'][n % 3 + 1] end,
    1700000000 + n * 600 + (n % 40) * 601,
    list_filter([
      {'k': 'Content-Length', 'v': '0'},
      {'k': 'ETag', 'v': case when n % 5 = 0 then '"other"' when n % 2 = 0 then 'W/' || tag
        when n % 7 <> 0 then tag end},
      {'k': 'last-modified', 'v': case when n % 11 <> 0 then day end},
      {'k': 'Cache-Control', 'v': case when n % 2 = 0 then 'max-age=120' end}],
      lambda h: h.v is not null),
    case when n % 13 <> 0 then sha end
  from page),
cut as (
  select *, regexp_replace(uri, '#.*$', '') as whole,
    lower(regexp_extract(uri, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) as site from raw),
part as (
  select *, regexp_replace(regexp_replace(whole, '\?.*$', '')[len(site) + 1:], '/+$', '') as path,
    list_sort(list_filter(string_split(regexp_extract(whole, '\?(.*)$', 1), '&'),
      lambda p: p <> '' and not starts_with(p, 'utm_'))) as params from cut),
rec as (
  select record_id, is_full, t, headers, sha, site || path ||
    case when len(params) = 0 then '' else '?' || array_to_string(params, '&') end as url
  from part),
near as (
  select r.record_id, arg_max(f.record_id, (f.t, f.record_id)) as target_id
  from rec r join rec f on r.url = f.url and f.t < r.t
  where not r.is_full and f.is_full group by r.record_id),
both_ as (
  select r.record_id, r.url, target_id, r.headers as h, f.headers as g, r.sha as a, f.sha as b,
    regexp_replace(list_filter(r.headers, lambda x: lower(x.k) = 'etag')[1].v, '^W/', '') as e1,
    regexp_replace(list_filter(f.headers, lambda x: lower(x.k) = 'etag')[1].v, '^W/', '') as e2,
    list_filter(r.headers, lambda x: lower(x.k) = 'last-modified')[1].v as l1,
    list_filter(f.headers, lambda x: lower(x.k) = 'last-modified')[1].v as l2
  from rec r left join near using (record_id) left join rec f on f.record_id = target_id
  where not r.is_full),
judged as (
  select *, case when target_id is null then 'no response'
      when e1 is not null and e2 is not null then case when e1 = e2 then 'etag' else 'differs' end
      when l1 is not null and l2 is not null then case when l1 = l2 then 'last-modified' else 'differs' end
      when a is not null and b is not null then case when a = b then 'digest' else 'differs' end
      else 'no validator' end as verdict,
    list_filter(h, lambda x: lower(x.k) in ('cache-control', 'content-location', 'date', 'etag',
      'expires', 'last-modified', 'vary')) as new
  from both_),
merged as (
  select *, verdict in ('etag', 'last-modified', 'digest') as ok,
    list_concat(list_filter(g, lambda x: not list_contains(
      list_transform(new, lambda y: lower(y.k)), lower(x.k))), new) as m from judged)
select record_id, url, coalesce(target_id, -1) as target_id, verdict, case when ok then len(m) else 0 end::bigint as n_headers,
  case when ok then sha256(array_to_string(list_transform(m, lambda x: x.k || ': ' || x.v), chr(10)))
    end as headers_sha256,
  case when ok then b end as payload_digest
from merged
"""



def _quality() -> str:
    """Base statistics, then the robust estimates step by step; all sizes are written out."""
    floors = (0.25, 0.15, 0.35, 0.35)
    factor = 1.4864156071332657  # 3/4 over P(chi2 with 6 degrees < the 3/4 quantile of one with 4)
    places = [(i, j) for i in range(4) for j in range(i + 1)]
    names = [f"m{i}" for i in range(4)] + [f"l{i}{j}" for i, j in places]
    ys = []
    for i in range(4):
        rest = "".join(f" - {{e}}l{i}{k} * y{k}" for k in range(i))
        ys.append(f"(x{i} / 256.0 - {{e}}m{i}{rest}) / {{e}}l{i}{i} as y{i}")
    distance = "y0 * y0 + y1 * y1 + y2 * y2 + y3 * y3"
    chol = [f"s{i} / s / 256 as m{i}" for i in range(4)]
    for i, j in places:
        cov = f"(q{i}{j} / s / 65536 - m{i} * m{j})"
        rest = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        if i == j:
            square = floors[i] ** 2
            cov = f"greatest({cov}, 0.0) * {factor!r} + {square!r}{rest}"
            chol.append(f"sqrt(greatest({cov}, {square!r})) as l{i}{i}")
        else:
            chol.append(f"({cov} * {factor!r}{rest}) / l{j}{j} as l{i}{j}")
    parts = [f"s{i}" for i in range(4)] + [f"q{i}{j}" for i, j in places]
    sums = [f"sum(x{i}::double) as s{i}" for i in range(4)]
    sums += [f"sum(x{i}::double * x{j}::double) as q{i}{j}" for i, j in places]
    seen = "sum(n) over (partition by {by} order by bin rows unbounded preceding) - n < {share} * sum(n) over (partition by {by})"
    same = "v.level = e.level and v.a is not distinct from e.a and v.b is not distinct from e.b"
    medians = ", ".join(f"(max(bin) filter (i = {i}) + 0.5) / 8 as m{i}" for i in range(4))
    scales = ", ".join(f"{4 * floors[i] if i == j else 0.0!r}::double as l{i}{j}" for i, j in places)
    steps = ""
    for k in range(1, 5):
        steps += f""",
bins{k} as (
  select level, a, b, least(floor(ln(1 + {distance}) * 128), 4095)::bigint as bin, count(*) as n, {", ".join(sums)}
  from (select v.*, {", ".join(y.format(e="e.") for y in ys)} from vec v join est{k - 1} e on {same})
  group by all),
kept{k} as (select * from bins{k} qualify {seen.format(by="level, a, b", share=0.75)}),
est{k} as (
  select level, a, b, {", ".join(chol)}
  from (
    select level, a, b, sum(n)::double as s, {", ".join(f"sum({c}) as {c}" for c in parts)}
    from kept{k} group by level, a, b))"""
    best = ", ".join(f"coalesce(e0.{c}, e1.{c}, e2.{c}) as {c}" for c in names)
    return rf"""
with doc as (
  select row_number() over () as rn, doc_id, lang, source, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (
  select rn, i, count(*) over (partition by rn, w[i], w[i + 1], w[i + 2]) as n
  from doc, unnest(generate_series(1, len(w) - 2)) as s(i)),
rep as (
  select rn, count(distinct i + k) as n from win, unnest([0, 1, 2]) as s(k) where n > 1 group by rn),
line as (
  select rn, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from doc),
stat as (
  select doc_id, lang, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words
  from doc join line using (rn) left join rep using (rn)),
feat as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    greatest(n_words, 1)::double as n, greatest(word_chars, 1)::double as c,
    round(ln(n) * 256)::bigint as x0, round(ln(c / n) * 2 * 256)::bigint as x1,
    round(ln(1 + 200 * n_symbols / c) * 256)::bigint as x2,
    round(ln(1 + 20 * n_repeat_words / n + n_dup_lines / 4) * 256)::bigint as x3 from stat),
vec as (
  select 0 as level, lang as a, source as b, x0, x1, x2, x3 from feat where not base_failed
  union all select 1, lang, null, x0, x1, x2, x3 from feat where not base_failed
  union all select 2, null, null, x0, x1, x2, x3 from feat where not base_failed),
bins0 as (
  select level, a, b, i, floor(x / 32)::bigint as bin, count(*) as n
  from (select level, a, b, unnest([0, 1, 2, 3]) as i, unnest([x0, x1, x2, x3]) as x from vec) group by all),
kept0 as (
  select *, sum(n) over (partition by level, a, b, i) as total from bins0
  qualify {seen.format(by="level, a, b, i", share=0.5)}),
est0 as (
  select level, a, b, {medians}, {scales} from kept0 group by level, a, b having max(total) >= 30){steps}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce({distance} <= 36, true) as kept
from (select *, {", ".join(y.format(e="") for y in ys)} from (
  select f.*, {best} from feat f
    left join est4 e0 on e0.level = 0 and e0.a is not distinct from f.lang and e0.b is not distinct from f.source
    left join est4 e1 on e1.level = 1 and e1.a is not distinct from f.lang
    left join est4 e2 on e2.level = 2))
"""


CHAT = r"""
with turn as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text))
    as loss_sha256,
  sum(length('### ' || role || ': ' || text || '</turn>' || chr(10))
    + len(regexp_extract_all(text, '\\|###|</turn>|<\|'))
    + len(regexp_extract_all(role, '\\|###|</turn>|<\||:')))::bigint as formatted_chars
from turn group by conv_id
"""

# What the pages of the tables hold, by their own layout: the blocks of their one article.
PAGE_TEXT = r"""
with block as (
  select page_id, url, list_transform(
    regexp_split_to_array(coalesce(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), ''), '</?(?:p|h1)[^>]*>'),
    lambda x: regexp_replace(regexp_replace(x, '<br>', ' ', 'g'), '<[^>]*>', '', 'g')) as raw from pages),
text as (
  select page_id, url, array_to_string(list_filter(list_transform(raw, lambda x: trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(x, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'),
      '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) as text
  from block)
select page_id, url, text, length(text)::bigint as n_chars from text
"""

ORACLE: dict[str, str] = {
    "op7_html_extraction": PAGE_TEXT,
    "op5_chat_formatting": CHAT,
    "op4_warc_revisits": REVISITS,
    "op8_ngram_jaccard_join": JACCARD,
    "op9_quality_rules": _quality(),
    "op10_decontamination": DECONTAMINATION,
}


def _codebooks(rounds: int = 2, entries: int = 64) -> str:
    """k-means of integer parts: ``rounds`` assignments and updates, then a final assignment."""
    blocks = []
    for r in range(rounds + 1):
        blocks.append(
            f"""a{r} as (
  select rn, label, p, x, arg_min(idx, [d, idx]) as idx, min(d) as d from (
    select rn, label, pt.p, x, idx,
      list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - e[i]) * (x[i] - e[i])))::bigint as d
    from part pt join b{r} using (p)) group by all)"""
        )
        if r < rounds:
            blocks.append(
                f"""s{r} as (
  select p, idx, list(floor(s / c)::bigint order by i) as e from (
    select p, idx, i, sum(x[i]) as s, count(*) as c
    from a{r}, unnest(range(1, len(x) + 1)) as t(i) group by p, idx, i) group by p, idx),
b{r + 1} as (select p, idx, coalesce(s.e, b.e) as e from b{r} b left join s{r} s using (p, idx))"""
            )
    final = f"a{rounds}"
    return f"""
with good as (
  select vec_id, label, embedding from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(embedding) % 16 = 0
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
dim as (select len(embedding) as n from good order by vec_id, embedding limit 1),
kept as (
  select row_number() over (order by vec_id, embedding) as rn, vec_id, label,
    list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as q
  from good where len(embedding) = (select n from dim)),
part as (
  select rn, label, p::int as p, q[p * (len(q) // 16) + 1 : (p + 1) * (len(q) // 16)] as x
  from kept, range(16) as t(p)),
b0 as (
  select p, (rn - 1)::int as idx, x as e from part where rn <= {entries}),
{",\n".join(blocks)},
book as (
  select sha256(string_agg(v::varchar, ',' order by p, idx, i)) as h
  from b{rounds}, unnest(e) with ordinality as t(v, i)),
code as (
  select rn, any_value(label) as label, sum(d)::bigint as error,
    string_agg(lower(printf('%02x', idx)), '' order by p) as code
  from {final} group by rn)
select k.vec_id, c.code, c.error,
  (sum(c.error) over (partition by c.label))::bigint as label_error,
  (select h from book) as codebooks_sha256
from code c join kept k using (rn)
"""


ORACLE["op12_vector_codes"] = _codebooks()

# Exact nearest neighbours by brute force: every 50th row against all others.
NEAREST = r"""
with good as (
  select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
nz as (select vec_id, min(v) as v from good where list_dot_product(v, v) > 0 group by vec_id),
dim as (select len(v) as n from nz order by vec_id, v limit 1),
kept as (select vec_id, v, sqrt(list_dot_product(v, v)) as nrm from nz where len(v) = (select n from dim)),
pairs as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v) / (q.nrm * c.nrm) as score
  from kept q join kept c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
"""

ORACLE["op11_nearest_neighbours"] = NEAREST
