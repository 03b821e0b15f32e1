"""DuckDB SQL of the queries that SQL can express: the contracts' columns over the same tables, by plain counting."""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: Windows of 35 words as texts; a word goes if a window over it starts in two places.
SUBSTRINGS = f"""
with d as (select row_number() over () r, doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) w from documents),
starts as (select r, w, unnest(range(1, len(w) - 33)) i from d where len(w) >= 35),
windows as (select r, i, array_to_string(list_slice(w, i, i + 34), ' ') s from starts),
twice as (select s from windows group by s having count(*) > 1),
gone as (select distinct r, i + k j from windows semi join twice using (s), range(35) t(k)),
words as (select r, unnest(w) x, unnest(range(1, len(w) + 1)) j from d),
kept as (select r, string_agg(x, ' ' order by j) text from words anti join gone using (r, j) group by r),
lost as (select r, count(*) n from gone group by r)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n, 0) n_removed, sha256(coalesce(kept.text, '')) kept_sha256
from d left join lost using (r) left join kept using (r)
"""

RULES = """
with p as (select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) path from pages),
rules(name, start, rule, verdict) as (values
  ('com', '/', 'com/', 'allow'), ('example.com', '/en/', 'example.com/en/', 'block'),
  ('www.example.com', '/en/', 'www.example.com/en/', 'allow'), ('net', '/es/', 'net/es/', 'block'), ('net', '/fr/', 'net/fr/', 'block')),
n as (select *, row_number() over () k from p),
best as (select k, arg_max(rule, length(rule)) rule, arg_max(verdict, length(rule)) verdict
         from n join rules on (host = name or ends_with(host, '.' || name)) and starts_with(path, start) group by k)
select page_id, host, path, rule, verdict by_rule from n left join best using (k)
"""

QUALITY_BASE = f"""
with d as (select row_number() over () r, doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), {_WORD}) w from documents),
lines as (select r, unnest(string_split(t, chr(10))) line from d),
repeated as (select r, count(*) - count(distinct line) n from lines where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by r),
starts as (select r, w, unnest(range(1, len(w) - 3)) i from d where len(w) >= 5),
windows as (select r, i, array_to_string(list_slice(w, i, i + 4), ' ') s from starts),
twice as (select r, s from windows group by r, s having count(*) > 1),
covered as (select r, count(distinct i + k) n from windows semi join twice using (r, s), range(5) t(k) group by r),
base as (
  select doc_id, cast(len(w) as bigint) n_words, cast(length(array_to_string(w, '')) as bigint) word_chars,
         cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols,
         coalesce(repeated.n, 0) n_dup_lines, coalesce(covered.n, 0) n_repeat_words
  from d left join repeated using (r) left join covered using (r))
select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed from base
"""

#: Sets of 5-word shingles; all pairs of sets that share one are counted, and links followed to the smallest doc_id.
NGRAM_JOIN = f"""
with recursive d as (select row_number() over () r, doc_id,
                            regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORD}) w from documents),
places as (select r, w, unnest(range(1, greatest(len(w) - 3, 2))) i from d where len(w) > 0),
shingles as (select r, list(distinct array_to_string(list_slice(w, i, i + 4), ' ')) s from places group by r),
sized as (select r, cast(len(s) as bigint) n, md5(array_to_string(list_sort(s), chr(10))) same, s from shingles),
sets as (select min(r) r, any_value(n) n, any_value(s) s, same from sized group by same),
tokens as (select r, n, unnest(s) x from sets),
shared as (select a.r p, b.r q, count(*) k, any_value(a.n) m, any_value(b.n) n from tokens a join tokens b on a.x = b.x and a.r < b.r group by 1, 2),
links as (select p, q from shared where 100 * k >= 75 * (m + n - k)
          union select sets.r, sized.r from sized join sets using (same) where sized.r <> sets.r),
both_ways as (select p, q from links union select q, p from links),
reach(a, b) as (select r, r from sized union select reach.a, both_ways.q from reach join both_ways on reach.b = both_ways.p),
roots as (select a r, min(doc_id) root from reach join d on d.r = reach.b group by a)
select doc_id, coalesce(n, 0) n_shingles, coalesce(root, doc_id) component_id
from d left join sized using (r) left join roots using (r)
"""

REVISITS = """
with p as (select page_id, coalesce(html, '') html, octet_length(encode(coalesce(html, ''))) bytes from pages),
first as (select html, min(page_id) first from p where bytes >= 100 group by html)
select page_id, cast(bytes as bigint) payload_bytes, sha256(p.html) payload_digest,
       if(first is null or first = page_id, 'response', 'revisit') record_type, if(first = page_id, null, first) refers_to
from p left join first on p.html = first.html and bytes >= 100
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": SUBSTRINGS, "url_filter_rules": RULES, "quality_base": QUALITY_BASE, "op7_ngram_join": NGRAM_JOIN,
        "op9_warc": REVISITS,
    }
