"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from strata.llm.queries import HOST_RULES, UNWANTED_PATTERNS, UNWANTED_WORDS

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _url_filters() -> str:
    fits = " union all ".join(
        f"select '{name}' as rule, '{name.split('/')[0]}' as rule_host, "
        f"'{name[name.index('/'):]}' as rule_path, '{verdict}' as verdict"
        for name, verdict in HOST_RULES
    )
    words = ", ".join(f"('{word}')" for word in UNWANTED_WORDS)
    forms = ", ".join(f"('{form}')" for form in UNWANTED_PATTERNS)
    body = "regexp_replace(replace(replace(pattern, '.', '[.]'), '*', '.*'), '^[|][|]', '')"
    regex = (
        "'(?s)' || case when starts_with(pattern, '||') then '^(?:[^/]*[.])?' else '' end || "
        f"replace({body}, '^', '(?:[^A-Za-z0-9]|^|$)')"
    )
    after = "case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end"
    return f"""
with rules as ({fits}),
words(word) as (values {words}), forms(form) as (values {forms}),
patterns as (select replace(form, '{{0}}', word) as pattern from words, forms),
unwanted_rules as (select pattern, {regex} as regex from patterns),
parts as (select page_id, url, coalesce({after}, '') as tail from pages),
split as (
  select page_id, {LOWER.format("regexp_extract(tail, '^[^/?#]*')")} as host,
    regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) as path
  from parts),
distinct_targets as (select distinct host, path from split),
best as (
  select host, path, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
  from distinct_targets join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by all),
unwanted as (
  select host, path, arg_min(pattern, (-length(pattern), pattern)) as pattern
  from distinct_targets join unwanted_rules on regexp_matches(host || path, regex)
  group by all)
select s.page_id, s.host, s.path, b.rule,
  coalesce(b.verdict, case when u.pattern is not null then 'block' else 'allow' end) as verdict,
  coalesce('||' || b.rule, u.pattern) as pattern
from split s left join best b using (host, path) left join unwanted u using (host, path)
"""


def _quality_rules() -> str:
    white = r"[\x20\x09-\x0D]+"
    normal = LOWER.format(f"trim(regexp_replace(line, '{white}', ' ', 'g'), ' ')")
    return rf"""
with docs as (select doc_id, source, coalesce(text, '') as text from documents),
worded as (
  select doc_id, list_filter(regexp_split_to_array(text, '{white}'), lambda x: x <> '') as words from docs),
windowed as (
  select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as run
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from worded)),
twice as (
  select doc_id, i from (select *, count(*) over (partition by doc_id, run) as n from windowed)
  where n > 1),
repeated as (
  select doc_id, count(distinct word_no) as n_repeat_words
  from (select doc_id, unnest([i, i + 1, i + 2]) as word_no from twice) group by doc_id),
lines as (
  select doc_id, source, text, line, regexp_replace({normal}, '[0-9]', '0', 'g') as normal
  from (select *, unnest(string_split(text, chr(10))) as line from docs)),
solid as (select * from lines where normal <> ''),
dups as (
  select doc_id, (count(*) - count(distinct line))::bigint as n_dup_lines from solid group by doc_id),
texts as (select distinct source, text, normal, string_split(normal, ' ') as words from solid),
edged as (
  select source, text, normal, len(words) as n, array_to_string(words[1:4], ' ') as head,
    array_to_string(words[greatest(len(words) - 3, 1):], ' ') as tail
  from texts),
heads as (select source, head from edged group by all having count(distinct text) > 1),
tails as (select source, tail from edged group by all having count(distinct text) > 1),
own as (
  select e.source, e.text from edged e
    left join heads h on h.source is not distinct from e.source and h.head = e.head
    left join tails t on t.source is not distinct from e.source and t.tail = e.tail
  group by e.source, e.text
  having least(sum(case when h.head is null then n else 0 end), sum(case when t.tail is null then n else 0 end))
    >= greatest(0.2 * sum(n), 1)),
hosts as (select source, count(*) as n from own group by source),
frequent as (
  select a.source, a.normal
  from edged a join own o on o.source is not distinct from a.source and o.text = a.text
    join hosts h on h.source is not distinct from a.source
  group by a.source, a.normal, h.n having count(*) > 0.04 * h.n + sqrt(h.n)),
removed as (
  select s.doc_id, sum(len(string_split(s.normal, ' ')))::bigint as n_removed_words
  from solid s join frequent f on s.source is not distinct from f.source and s.normal = f.normal
  group by s.doc_id),
counted as (
  select d.doc_id, len(w.words)::bigint as n_words,
    coalesce(list_sum(list_transform(w.words, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    coalesce(u.n_dup_lines, 0)::bigint as n_dup_lines,
    coalesce(r.n_repeat_words, 0)::bigint as n_repeat_words,
    coalesce(m.n_removed_words, 0)::bigint as n_removed_words
  from docs d join worded w using (doc_id) left join dups u using (doc_id)
    left join repeated r using (doc_id) left join removed m using (doc_id)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and 2 * (n_words - n_removed_words) >= n_words as kept, n_removed_words
from judged
"""


_WORDS = (
    "list_filter(regexp_split_to_array("
    + LOWER.format("coalesce(text, '')")
    + r", '[\x20\x09-\x0D]+'), lambda x: x <> '')"
)


def _near_duplicates(numerator: int) -> str:
    """All pairs with a shingle in common, and what links lead to."""
    five = " || ' ' || ".join(f"words[i + {k}]" for k in range(5))
    return f"""
with recursive docs as (select doc_id, {_WORDS} as words from documents),
shingles as (
  select distinct doc_id, shingle from (
    select doc_id, unnest(case when len(words) < 5 then [array_to_string(words, ' ')]
      else list_transform(range(1, len(words) - 3), lambda i: {five}) end) as shingle
    from docs where len(words) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= {numerator} * (x.n + y.n - common)),
reached(doc_id, other) as (
  select doc_id, doc_id from docs
  union select r.doc_id, l.b from reached r join links l on l.a = r.other),
first as (select doc_id, min(other) as component_id from reached group by doc_id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, component_id = doc_id as kept
from first left join sizes using (doc_id)
"""


def _repeated_passages(least: int) -> str:
    """Words of windows that another text holds, or of texts held twice, as stretches."""
    return f"""
with docs as (select doc_id, coalesce(text, '') as text, {_WORDS} as words from documents),
windows as (
  select doc_id, text, start, array_to_string(words[start + 1:start + {least}], ' ') as content
  from (select *, unnest(range(0, len(words) - {least} + 1)) as start from docs)),
held as (select content from windows group by content having count(distinct text) > 1),
copied as (select text from docs group by text having count(*) > 1),
marked as (
  select distinct doc_id, unnest(range(start, start + {least})) as word from windows
  where content in (select content from held) or text in (select text from copied)),
stretches as (select doc_id, word, word - row_number() over (partition by doc_id order by word) as part from marked)
select doc_id, min(word)::int as start_word, count(*)::int as n_words from stretches group by doc_id, part
"""


def _divergence() -> str:
    term = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
    share = "1 + (1000000000::hugeint * ({0}.n + 5)) // ({0}.total + 5 * {0}.kept)"
    return rf"""
with docs as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
    {LOWER.format("coalesce(text, '')")} as text
  from documents),
found as (
  select doc, lang, source, term, count(*) as n
  from (select doc, lang, source, unnest(regexp_extract_all(text, '{term}')) as term from docs)
  group by all),
terms as (
  select lang, term, sum(n) as n from found group by all having count(*) >= 30),
spaces as (select lang, count(*) as kept, sum(n) as total from terms group by lang),
counts as (
  select lang, source, term, sum(f.n) as n from found f join terms t using (lang, term) group by all),
sums as (select lang, source, sum(n) as total from counts group by all),
groups as (
  select lang, source, coalesce(sums.total, 0) as total, coalesce(kept, 0) as kept
  from (select distinct lang, source from docs) left join sums using (lang, source) left join spaces using (lang)),
cells as (
  select g.lang, g.source, t.term, coalesce(c.n, 0) as n, g.total, g.kept
  from groups g join terms t using (lang) left join counts c using (lang, source, term)),
priced as (select lang, source, term, n, {share.format("c")} as p from cells c),
overall as (
  select lang, term, {share.format("o")} as q
  from (select lang, term, n, total, kept from terms join spaces using (lang)) o),
apart as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from priced a join priced b using (lang, term) group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source),
ahead as (
  select lang, source, 'term' as part, term as item, p - q as value
  from priced join overall using (lang, term) where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select * from pairs union all select * from ahead))
select lang, source, part, item, value::bigint as value, rank::int as rank
from ranked where part = 'pair' or rank <= 50
"""


def _infill() -> str:
    group = "('0x' || substr(h, {0}, 8))::bigint"
    draws = ", ".join(f"{group.format(8 * k + 1)} as h{k + 1}" for k in range(4))
    return f"""
with docs as (
  select doc_id, coalesce(text, '') as text, sha256('1:' || doc_id::varchar) as h from documents),
drawn as (select doc_id, text, length(text) as n, {draws} from docs),
cut as (
  select doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90
      then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from drawn),
parts as (
  select *, substr(text, 1, a) as prefix, substr(text, a + 1, b - a) as middle, substr(text, b + 1) as suffix
  from cut)
select doc_id, n::bigint as n, form,
  case when form <> 'plain' then a end::bigint as prefix_chars,
  case when form <> 'plain' then b - a end::bigint as middle_chars,
  sha256(case form when 'plain' then text
    when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""


ORACLES = {
    "op3_minhash_dedup": _near_duplicates(85),
    "op4_url_filters": _url_filters(),
    "op6_quality_rules": _quality_rules(),
    "op7_suffix_dedup": _repeated_passages(50),
    "op11_divergence": _divergence(),
    "op12_infill": _infill(),
}
