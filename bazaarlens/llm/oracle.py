"""The queries of `queries` that SQL can express, for DuckDB over the same tables."""

# A-Z only; other characters keep their case.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
with docs as materialized (
    select doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents
), items as (
    select item_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark
), sized as (
    select item_id, words, least(10, len(words)) as size from items where len(words) > 0
), windows as (
    select distinct item_id, size, list_slice(words, start, start + size - 1) as words
    from (select item_id, words, size, unnest(range(1, len(words) - size + 2)) as start from sized)
), sizes as (
    select distinct size from windows
), spans as (
    select doc_id, start, size, list_slice(words, start, start + size - 1) as words
    from (select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as start from docs, sizes where len(words) >= size)
), found as (
    select doc_id, item_id, start, s.size from spans s join windows w on s.size = w.size and s.words = w.words
), hit as (
    select doc_id, count(distinct place) as n_hit
    from (select doc_id, unnest(range(start, start + size)) as place from found) group by doc_id
), ids as (
    select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct doc_id, cast(item_id as varchar) as item_id from found) group by doc_id
)
select d.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from docs d left join hit using (doc_id) left join ids using (doc_id)
"""

NEAR_DUPLICATES = rf"""
with recursive docs as materialized (
    select doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') as words from documents
), sets as materialized (
    select doc_id, case when len(words) = 0 then [] when len(words) < 4 then [words]
        else list_distinct([words[i:i + 3] for i in range(1, len(words) - 2)]) end as shingles
    from docs
), sized as materialized (
    select doc_id, len(shingles) as n, hash(list_sort(shingles)) as same from sets
), classes as materialized (
    select same, n, min(doc_id) as rep from sized where n > 0 group by same, n
), postings as materialized (
    select rep, n, unnest(shingles) as shingle from classes join sets on rep = doc_id
), shared as (
    select a.rep as a, b.rep as b, count(*) as common, any_value(a.n) as n_a, any_value(b.n) as n_b
    from postings a join postings b on a.shingle = b.shingle and a.rep < b.rep
        and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    group by a.rep, b.rep
), links as materialized (
    select a, b from shared where 100 * common >= 80 * (n_a + n_b - common)
), both_ways as materialized (
    select a, b from links union all select b, a from links
), reached(node, other) as (
    select rep, rep from classes
    union
    select r.node, l.b from reached r join both_ways l on r.other = l.a
), components as (
    select node, min(other) as component from reached group by node
)
select s.doc_id, s.n as n_shingles, coalesce(component, s.doc_id) as component_id,
    coalesce(component, s.doc_id) = s.doc_id as kept
from sized s left join classes c on s.same = c.same and s.n = c.n left join components on c.rep = components.node
"""

ARCHIVE = """
with payloads as (
    select page_id, strlen(coalesce(html, '')) as size, sha256(coalesce(html, '')) as digest from pages
), firsts as (
    select page_id, size, digest, min(page_id) over (partition by digest) as first_page from payloads
)
select page_id, cast(size as bigint) as payload_bytes, digest as payload_digest,
    case when size >= 100 and page_id > first_page then 'revisit' else 'response' end as record_type,
    case when size >= 100 and page_id > first_page then first_page end as refers_to
from firsts
"""

_VALUE = r"""(?:"([^"]*)"|''([^'']*)''|([^\s"''>][^\s>]*))"""
_CANONICAL = r"""(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"|''(?:[^''>]*\s)?canonical(?:\s[^''>]*)?''|canonical(?:\s|/|>))"""
_REFRESH = r"""(?:"\s*refresh\s*"|''\s*refresh\s*''|refresh(?:\s|/|>))"""
_GO_TO = r"""(?is)^\s*(?:[\d.]+[;,\s]+(?:url\s*=\s*)?|[;,\s]*url\s*=\s*)(?:"([^"]*)|''([^'']*)|([^"''\s;,]\S*))"""


def _values(texts: str, pattern: str) -> str:
    """What one of the pattern's three groups holds in each text."""
    groups = " || ".join(f"regexp_extract(t, '{pattern}', {group})" for group in (1, 2, 3))
    return f"list_transform({texts}, lambda t: {groups})"


def _tags(tag: str, attribute: str, value: str) -> str:
    return rf"regexp_extract_all(shown, '(?is)<{tag}\b[^>]*\b{attribute}\s*=\s*{value}[^>]*>?')"


_HREFS = _values(_tags("link", "rel", _CANONICAL), rf"(?is)(?:^|[^\w-])href\s*=\s*{_VALUE}")
_CONTENTS = _values(_tags("meta", "http-equiv", _REFRESH), rf"(?is)(?:^|[^\w-])content\s*=\s*{_VALUE}")
_DECODED = f"""list_transform({_CONTENTS}, lambda t: replace(replace(t, '&quot;', '"'), '&#39;', chr(39)))"""

URL_FILTERS = rf"""
with recursive rules(rule_host, rule_path, rule_verdict) as (
    values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), shown as (
    select url, regexp_replace(html, '(?s)<!--.*?(?:-->|\z)', '', 'g') as shown from pages where url is not null and html is not null
), tags as (
    select url, trim(replace(unnest(list_concat({_HREFS}, {_values(_DECODED, _GO_TO)})), '&amp;', '&')) as target from shown
), absolute as (
    select url, case when contains(target, '://') then target
        when starts_with(target, '//') then regexp_extract(url, '(?s)^(.*?:)//', 1) || target
        when starts_with(target, '/') then regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || target
        else regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)', 1) || target end as target
    from tags where target <> ''
), links as (
    select regexp_replace(url, '(?s)#.*$', '') as a, regexp_replace(target, '(?s)#.*$', '') as b from absolute
), both_ways as (
    select a, b from links where a <> b union select b, a from links where a <> b
), reached(node, other) as (
    select a, a from both_ways union select r.node, l.b from reached r join both_ways l on r.other = l.a
), urls as (
    select url, regexp_replace(url, '(?s)#.*$', '') as node from (select url from pages union select a from both_ways)
), parts as (
    select url, node,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
    from urls
), ruled as (
    select url, node, host, path, rule_host || rule_path as rule, rule_verdict
    from parts left join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    qualify row_number() over (partition by url order by length(rule_host || rule_path) desc) = 1
), aliases as (
    select r.node, case when bool_or(d.rule_verdict = 'allow') then 'allow' when bool_or(d.rule_verdict = 'block') then 'block' end as verdict
    from reached r join ruled d on d.node = r.other group by r.node
)
select p.page_id, r.host, r.path, r.rule, coalesce(r.rule_verdict, a.verdict, 'allow') as verdict
from pages p join ruled r on p.url is not distinct from r.url left join aliases a on a.node = r.node
"""

COLLOCATIONS = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(coalesce({_LOWER}, ''), '[.,;:!?\x0A-\x0D]')) as piece from documents
), split as materialized (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces
), sizes as (
    select lang, cast(sum(len(words)) as bigint) as n from split group by lang
), places as (
    select lang, words, k, unnest(range(1, len(words) - k + 2)) as start from split, (values (1), (2), (3)) lengths(k)
), f as materialized (
    select lang, k, array_to_string(words[start:start + k - 1], ' ') as phrase, count(*) as f
    from places group by all having count(*) >= 10
), candidates as materialized (
    select lang, k, phrase, f as a, string_split(phrase, ' ') as words from f where k > 1
), cuts as (
    select lang, phrase, k, a, cut, array_to_string(words[1:cut], ' ') as first, array_to_string(words[cut + 1:], ' ') as rest
    from (select *, unnest(range(1, k)) as cut from candidates)
), scored as (
    select c.lang, c.phrase, c.a, c.cut, x.f as l, y.f as r,
        cast((1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as bigint) as score
    from cuts c join f x on x.lang = c.lang and x.phrase = c.first join f y on y.lang = c.lang and y.phrase = c.rest
), weakest as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), explained as (
    select distinct s.lang, s.phrase
    from candidates s join (
        select lang, a, array_to_string(words[start:start + 1], ' ') as part from (select *, unnest([1, 2]) as start from candidates where k = 3)
    ) t on t.lang = s.lang and t.part = s.phrase
    where s.k = 2 and 100 * t.a >= 50 * s.a
), ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
    from weakest anti join explained using (lang, phrase)
)
select lang, rank, phrase, a, l, r, n, score from ranked join sizes using (lang) where rank <= 2000
"""
