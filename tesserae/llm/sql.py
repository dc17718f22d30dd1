"""What DuckDB must return for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP3 = r"""
with items as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from benchmark where text is not null
), wins as (
  select distinct item_id, least(len(w), 8) n, array_to_string(w[k : k + least(len(w), 8) - 1], ' ') s
  from (select *, unnest(range(1, len(w) - least(len(w), 8) + 2)) k from items where len(w) > 0)
), docs as (
  select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) w
  from documents
), pos as (select doc_id, w, unnest(range(1, len(w) + 1)) p from docs),
lens as (select distinct n from wins),
hits as (
  select a.doc_id, a.p, a.n, wins.item_id
  from (select doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') s from pos, lens where p + n - 1 <= len(w)) a
  join wins on wins.s = a.s and wins.n = a.n
), cover as (
  select doc_id, count(distinct q) n_hit from (select doc_id, unnest(range(p, p + n)) q from hits) group by doc_id
), found as (
  select doc_id, count(distinct item_id) n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) ids from hits group by doc_id
)
select d.doc_id, len(d.w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_items, 0) >= 2 contaminated
from docs d left join cover using (doc_id) left join found using (doc_id)
"""

OP4 = r"""
with docs as (
  select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents
), lines as (
  select doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l from docs
), grams as (
  select doc_id, p, array_to_string(w[p : p + 4], ' ') g from (select doc_id, w, unnest(range(1, len(w) - 3)) p from docs where len(w) > 4)
), again as (select doc_id, p from grams qualify count(*) over (partition by doc_id, g) > 1),
cover as (select doc_id, count(distinct q) n from (select doc_id, unnest(range(p, p + 5)) q from again) group by doc_id),
base as (
  select d.doc_id, t, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint n_symbols,
    (len(l) - len(list_distinct(l)))::bigint n_dup_lines, coalesce(n, 0)::bigint n_repeat_words
  from docs d join lines using (doc_id) left join cover using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words or n_symbols > 0.1 * n_words or word_chars < 2 * n_words or word_chars > 12 * n_words
    or n_dup_lines > 0.5 * (1 + len(string_split(t, chr(10)))) or length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) > 0.4 * word_chars) kept
from base
"""


OP5 = r"""
with p as (select page_id, strlen(coalesce(html, '')) n, sha1(coalesce(html, '')) h from pages),
top as (select h, max(page_id) first_id from p group by h),
-- five hex digits are four letters of base32
d as (select page_id, n, h, list_transform(range(8), lambda i: list_sum(list_transform(range(5), lambda j: (strpos('0123456789abcdef', h[5 * i + j + 1]) - 1) * (16 ** (4 - j))))::bigint) v from p)
select page_id, n::bigint payload_bytes, array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda k: ('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')[((x >> k) & 31) + 1]), '')), '') payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end record_type, case when page_id <> first_id then first_id end refers_to
from d join top using (h)
"""

OP9 = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) h, strlen(coalesce(text, '')) n from documents),
-- strings of fifty bytes, taken from blocks of 500 places as slices of long texts are slow
blocks as (select doc_id, b, h[1000 * b + 1 : 1000 * b + 1098] t, least(500, n - 49 - 500 * b) c from (select *, unnest(range((n + 450) // 500)) b from d where n >= 50)),
pos as (select doc_id, 500 * b + j i, t[2 * j + 1 : 2 * j + 100] s from (select *, unnest(range(c)) j from blocks)),
first as (select s, min(doc_id) m from pos group by s),
hit as (select doc_id, i, lag(i) over (partition by doc_id order by i) before from pos join first using (s) where m < doc_id),
runs as (select doc_id, i, sum(case when before is null or i > before + 50 then 1 else 0 end) over (partition by doc_id order by i) r from hit),
cut as (select doc_id, r, min(i) a, max(i) + 50 b from runs group by all),
gaps as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) z, lead(a) over (partition by doc_id order by a) y from cut),
kept as (select doc_id, sum(b - a)::bigint n_removed, count(*) n_spans, string_agg(h[2 * z + 1 : 2 * a], '' order by a) || any_value(h[2 * m + 1 :]) k
  from (select gaps.*, d.h, max(b) over (partition by gaps.doc_id) m from gaps join d on d.doc_id = gaps.doc_id) group by doc_id)
select d.doc_id, n::bigint n_bytes, coalesce(n_removed, 0) n_removed, coalesce(n_spans, 0) n_spans, sha256(unhex(coalesce(k, h))) kept_sha256 from d left join kept on kept.doc_id = d.doc_id
"""


EMAIL, IP, CARD, PHONE = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", r"[0-9](?:[\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def matches(kind: int, pattern: str, fits: str) -> str:
    """Matches of a pattern with their places: what lies between them is as long as it is."""
    return f"""select doc_id, {kind} kind, m, s from (select doc_id, m, sum(length(g)) over w + coalesce(sum(length(m)) over (partition by doc_id order by k rows between unbounded preceding and 1 preceding), 0) s
  from (select doc_id, unnest(regexp_extract_all(t, '{pattern}')) m, unnest(string_split_regex(t, '{pattern}')[1:len(regexp_extract_all(t, '{pattern}'))]) g, unnest(range(len(regexp_extract_all(t, '{pattern}')))) k from docs) window w as (partition by doc_id order by k)) where {fits}"""


WORD = r"[\p{L}\p{N}]+"
DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
LUHN = f"list_sum(list_transform(range(1, length({DIGITS}) + 1), lambda i: case when i % 2 = 1 then reverse({DIGITS})[i]::int when reverse({DIGITS})[i]::int < 5 then 2 * reverse({DIGITS})[i]::int else 2 * reverse({DIGITS})[i]::int - 9 end)) % 10 = 0"
OP7 = f"""
with docs as (select doc_id, coalesce(text, '') t from documents),
base as ({matches(0, EMAIL, "true")} union all {matches(1, IP, "len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 or coalesce(try_cast(x as int), 999) > 255)) = 0")}
  union all {matches(2, CARD, f"length({DIGITS}) between 13 and 19 and {LUHN}")} union all {matches(3, PHONE, f"length({DIGITS}) between 9 and 15")}),
spans as (select doc_id, kind, s::bigint s, (s + length(m))::bigint e, m, ['email', 'ip', 'card', 'phone'][kind + 1] name from base),
words as (select doc_id, lower(m) term, s::bigint s, (s + length(m))::bigint e from ({matches(0, WORD, "true")})),
clear as (select w.* from words w anti join spans b on b.doc_id = w.doc_id and b.s < w.e and w.s < b.e),
held as (select distinct doc_id, name || ' ' || lower(m) entity from spans),
n_entity as (select entity, count(*) n from held group by entity having count(*) >= 2),
n_term as (select term, count(distinct doc_id) n from clear group by term),
pairs as (select entity, term, count(*) n from (select distinct entity, term, held.doc_id from held join n_entity using (entity) join clear on clear.doc_id = held.doc_id) group by all having count(*) >= 2),
told as (select p.entity, p.term from pairs p join n_entity e on e.entity = p.entity join n_term w on w.term = p.term, (select count(*) total from docs) where total > e.n and ln(p.n * total::double / (w.n * e.n)) / ln(total::double / e.n) >= 0.9),
marks as (select distinct c.doc_id, c.s, c.e from clear c join held using (doc_id) join told on told.entity = held.entity and told.term = c.term),
b as (select doc_id, count(*) filter (kind = 0) n_email, count(*) filter (kind = 1) n_ip, count(*) filter (kind = 2) n_card, count(*) filter (kind = 3) n_phone, string_agg(name || ':' || s || ':' || e, ',' order by kind, s) shown from spans group by doc_id),
m as (select doc_id, string_agg('term:' || s || ':' || e, ',' order by s) shown from marks group by doc_id)
select docs.doc_id, coalesce(n_email, 0) n_email, coalesce(n_ip, 0) n_ip, coalesce(n_card, 0) n_card, coalesce(n_phone, 0) n_phone, sha256(coalesce(b.shown, '')) base_sha256, concat_ws(',', b.shown, m.shown) spans
from docs left join b on b.doc_id = docs.doc_id left join m on m.doc_id = docs.doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_decontaminate": OP3, "op4_quality": OP4, "op5_warc": OP5, "op7_pii": OP7, "op9_substrings": OP9}
