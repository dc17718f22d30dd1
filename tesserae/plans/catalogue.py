"""The registered queries: ``queries()`` and the SQL that each must agree with, ``oracle_sql()``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae.functions import dates as D
from tesserae.functions import languages as L
from tesserae.functions import text as T
from tesserae.functions import urls as U
from tesserae.operators import duplicates, enrich, folds, gate, html, links, tenure
from tesserae.plans.registry import ORACLES, QUERIES, query
from tesserae.plans.views import table, view
from tesserae.sources import files


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dup_clusters(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


c = F.col
CLUSTERS = r"""r as (select *, case when regexp_replace(coalesce(text, ''), '\s', '', 'g') <> '' then text else text_originlanguage end tx from v_dups),
n as (select *, sha1(regexp_replace(regexp_replace(lower(tx), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')) h, regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\.', ''), ':\d*$', '') host, rtrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') path from r where regexp_replace(coalesce(tx, ''), '\s', '', 'g') <> ''),
f as (select *, regexp_extract_all(path, '/(\d{2,})(?:/|$)', 1) ids, first_value(regexp_extract_all(path, '/(\d{2,})(?:/|$)', 1)) over (partition by source_id, h order by host, path) ids0 from n),
g as (select source_id, h, min(country) country, count(*) n, arg_min(tx, ord) tx, list(doc_id order by ord)[1:8] di, list(url order by ord)[1:8] ur, list_sort(list_distinct(list(capture) filter (capture <> '')))[1:8] ca, list_sort(list_distinct(list(title)))[1:4] ti,
  count(distinct host || path) np, count(distinct path) npath, count(distinct host) nh, count(distinct regexp_replace(path, '-\d+$', '')) ns, bool_and(len(list_intersect(ids, ids0)) > 0) same from f group by all having count(*) >= 2),
k as (select *, length(regexp_replace(regexp_replace(lower(tx), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')) l from g),
q as (select source_id, country, case when l < 300 and (l < 120 or contains(lower(tx), 'page not found')) then 'junk_stub' when np = 1 then 'url_variant' when npath = 1 and nh > 1 then 'mirror' when same then 'id_variant' when ns = 1 then 'slug_variant' else 'shared_text_suspect' end cause,
  n, n - 1 extra, length(tx)::int chars, h[1:12] text_hash, array_to_string(di, ' | ') doc_ids, array_to_string(ur, ' | ') urls, coalesce(array_to_string(ca, ' | '), '') captures, array_to_string(ti, ' | ') titles, regexp_replace(tx[1:300], '\s+', ' ', 'g') text_head from k)"""


@query(f"with {CLUSTERS} select * from q")
def dup_clusters(spark, d):
    return duplicates.clusters(view(spark, d, "v_dups"))


@query(f"with {CLUSTERS} select cause, sum(extra)::bigint extra_rows, count(*) n_clusters from q group by cause")
def dup_extra_by_cause(spark, d):
    return duplicates.by_cause(duplicates.clusters(view(spark, d, "v_dups")))


HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '^www\.', '')"
PATH = r"regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '')"
IDENTITY = rf"""(select ord, url, {HOST} || lower({PATH}) || case when len(q) > 0 then '?' || array_to_string(list_sort(q), '&') else '' end identity from (
  select *, list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' and not regexp_matches(lower(x), '^(utm_[^=]*|at_[^=]*|pk_[^=]*|piwik_[^=]*|ref|referrer|source|fbclid|gclid|print|amp|output|comment)(=|$)')) q from {{0}}))"""


@query(f"select identity, count(*) n, min(ord) first_ord from {IDENTITY.format('v_urls')} i group by identity")
def url_identity(spark, d):
    return view(spark, d, "v_urls").groupBy(U.page_identity(c("url")).alias("identity")).agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"))


@query(f"select ord, url, {HOST} host, {PATH} path, {HOST} || {PATH} canonical from v_urls")
def url_canonical(spark, d):
    p = U.canonical(c("url"))
    return view(spark, d, "v_urls").select("ord", "url", p["host"].alias("host"), p["path"].alias("path"), p["url"].alias("canonical"))


@query(r"select ord, rtrim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(url), '^https?://', ''), '^www\.', ''), ':80/', '/'), '/{2,}', '/', 'g'), '/') link_key from v_urls")
def url_link_key(spark, d):
    return view(spark, d, "v_urls").select("ord", U.link_key(c("url")).alias("link_key"))


@query(f"select ord, url from (select *, row_number() over (partition by identity order by ord) k from {IDENTITY.format('v_urls')} i) where k = 1")
def url_identity_dedupe(spark, d):
    return links.first_of(view(spark, d, "v_urls").withColumn("identity", U.page_identity(c("url"))), "identity").select("ord", "url")


@query(r"select ord, url from v_urls where regexp_matches(url, '/(en|fr)/\d+')")
def url_pattern_filter(spark, d):
    return links.matching(view(spark, d, "v_urls"), r"/(?P<lang>en|fr)/\d+").select("ord", "url")


@query(f"select ord, url from v_urls where {PATH} not in (select {PATH} from pages where page_id % 9 = 0)")
def listing_index_drop(spark, d):
    return links.without_listings(view(spark, d, "v_urls"), table(spark, d, "pages").where("page_id % 9 = 0")).select("ord", "url")


@query(f"""with i as (select * from {IDENTITY.format('v_urls')} x), l as (select distinct identity from {IDENTITY.format('(select 0 ord, url from v_ledger)')} y)
select ord, url, identity, case when url in (select url from v_ledger) then 'exact' when identity in (select identity from l) then 'already'
  when row_number() over (partition by identity order by ord) > 1 then 'within' else 'kept' end fate from i""")
def unscraped_select(spark, d):
    return links.unscraped(view(spark, d, "v_urls"), view(spark, d, "v_ledger"))


@query("select doc_id, source from documents where doc_id not in (select doc_id from labels)")
def resume_antijoin(spark, d):
    return links.resume(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"))


@query("with n as (select count(*) n from documents), i as (select distinct round_even(i * (n - 1) / 16.0, 0)::bigint k from n, range(17) t(i)) select doc_id from (select doc_id, row_number() over (order by doc_id) - 1 k from documents) join i using (k)")
def sample_evenly(spark, d):
    return links.evenly(table(spark, d, "documents").select("doc_id", c("doc_id").alias("ord")), 17).select("doc_id")


@query(r"select doc_id, array_to_string(list_filter(list_transform(string_split(replace(text, chr(13), chr(10)), chr(10)), lambda x: trim(regexp_replace(x, '[ \t\f\v]+', ' ', 'g'))), lambda x: x <> ''), chr(10)) tidy from documents")
def clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.tidy(c("text")).alias("tidy"))


@query(r"select doc_id, case when len(w) > 50 then array_to_string(w[1:50], ' ') || ' [...]' else text end short from (select *, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') w from documents)")
def truncate_words(spark, d):
    return table(spark, d, "documents").select("doc_id", T.truncated(c("text"), 50).alias("short"))


@query(r"select doc_id, coalesce(l[1], '')[1:200] first_line, l[1:4] head, len(l)::int n_lines from (select doc_id, list_filter(list_transform(regexp_split_to_array(text, '\r\n|[\n\r\v\f]'), lambda x: trim(x)), lambda x: x <> '') l from documents)")
def head_lines(spark, d):
    t = c("text")
    return table(spark, d, "documents").select("doc_id", T.first_line(t).alias("first_line"), T.head_lines(t).alias("head"), F.size(T.filled_lines(t)).alias("n_lines"))


@query(r"select conv_id, turn, list_filter(regexp_split_to_array(regexp_replace(trim(text), '([.!?。！？])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x) <> '') sentences from conversations")
def sentences(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.sentences(c("text")).alias("sentences"))


LAST = lambda mark: f"(case when contains(w, {mark}) then length(w) - strpos(reverse(w), reverse({mark})) + 2 - length({mark}) else 0 end)"
CUT = f"""case when length(rest) <= 400 then length(rest) when greatest({LAST("'. '")}, {LAST("'.' || chr(10)")}, {LAST("'。'")}) > 0 then greatest({LAST("'. '")}, {LAST("'.' || chr(10)")}, {LAST("'。'")})
  {" ".join(f"when {LAST(m)} > 0 then {LAST(m)}" for m in ("'? '", "'! '", "'; '", "', '", "chr(10)", "' '"))} else 400 end"""


@query(f"""with recursive r as (select doc_id, -1 k, '' chunk, text rest from documents where text <> '' union all select doc_id, k + 1, rest[1:cut], rest[cut + 1:] from (select *, {CUT} cut from (select *, rest[1:400] w from r where rest <> '') a) b)
select doc_id, k, chunk from r where k >= 0""")
def chunk_text(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(enrich.chunks(c("text"), 400)).alias("k", "chunk"))


@query(r"select page_id, replace(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '&amp;', '&') title, replace(trim(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1)), '&amp;', '&') h1 from pages")
def html_fields(spark, d):
    pages = html.fields(table(spark, d, "pages").select("page_id", "html"), title=["head title", "title"], h1=["h1"])
    return pages.select("page_id", "title", "h1")


@query("select page_id, list_transform(list_distinct(list_sort(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1))), lambda x: regexp_extract(url, '^(https?://[^/?#]*)', 1) || x).list_sort() found from pages")
def html_links(spark, d):
    return table(spark, d, "pages").select("page_id", F.array_sort(html.page_links("html", "url")).alias("found"))


@query()
def html_article(spark, d):
    """An own heuristic; no other engine has its like."""
    return table(spark, d, "pages").select("page_id", F.length(html.article_text("html")).alias("chars"))


@query("select page_id, 'x' kind from pages where page_id % 10 = 0")
def block_page(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.when(c("page_id") % 10 == 0, F.concat(F.lit("<html><title>Just a moment...</title><body>"), c("url"), F.lit("</body></html>"))).otherwise(c("html")).alias("html"))
    return html.blocked(pages).select("page_id", F.lit("x").alias("kind"))


@query(r"select lower(case when regexp_extract(html[1:4096], '(?i)<meta[^>]+charset\s*=\s*[\"'']?\s*([A-Za-z0-9_.:-]+)', 1) = '' then 'utf-8' else regexp_extract(html[1:4096], '(?i)<meta[^>]+charset\s*=\s*[\"'']?\s*([A-Za-z0-9_.:-]+)', 1) end) charset, count(*) n from pages group by 1")
def charset_sniff(spark, d):
    return table(spark, d, "pages").groupBy(html.charset(c("html")).alias("charset")).agg(F.count("*").alias("n"))


@query("select page_id from pages where not regexp_matches(html, 'lang=\"(en|de)\"')")
def keep_if(spark, d):
    return table(spark, d, "pages").where(html.keep_if(c("html"), 'lang="(en|de)"', negate=True)).select("page_id")


LINES = """concat('A title without a date', chr(10), case shape when 0 then concat(lpad(cast(d as string), 2, '0'), '.', lpad(cast(m as string), 2, '0'), '.', cast(y as string)) when 1 then concat('Published: ', day)
  when 2 then concat(cast(d as string), 'th of ', monthname_, ' ', cast(y as string)) when 3 then concat('Friday, ', monthname_, ' ', cast(d as string), ', ', cast(y as string))
  when 4 then concat(cast(m as string), '/', cast(d as string), '/', cast(y as string)) when 5 then concat('It happened on ', day, ' in the city') when 6 then cast(y as string)
  else concat('| ', cast(d as string), '.', cast(m as string), '.', cast(y as string), ' |') end, chr(10), 'Body text follows.')"""


def dated(spark, d):
    names = F.element_at(F.array(*[F.lit(n) for n in list(D.MONTHS)[:12]]), c("m"))
    return view(spark, d, "v_heads").withColumn("monthname_", names).withColumn("text", F.expr(LINES.replace("chr(10)", r"'\n'")))


@query("select doc_id, case when shape in (0, 1, 2, 3, 7) then day when shape = 4 and d > 12 then day end head_date from v_heads")
def head_date(spark, d):
    return dated(spark, d).select("doc_id", D.head_date(c("text"), max_year=F.lit(2030)).alias("head_date"))


HIJRI = "فروردین اردیبهشت خرداد تیر مرداد شهریور مهر آبان آذر دی بهمن اسفند"


# counted from New Year's Day of 1400, year by year
@query("""with n as (select y, sum(365 + (y % 33 in (1, 5, 9, 13, 17, 22, 26, 30))::int) over (order by y) - (365 + (y % 33 in (1, 5, 9, 13, 17, 22, 26, 30))::int) c from range(1300, 1421) t(y)), o as (select o_orderkey k, 1380 + o_orderkey % 40 jy, o_orderkey % 12 + 1 jm, o_orderkey % 29 + 1 jd from orders)
select k doc_id, case when k % 5 = 4 then (jy + 621)::varchar else strftime(date '2021-03-21' + (n.c - (select c from n where y = 1400) + coalesce(list_sum([31, 31, 31, 31, 31, 31, 30, 30, 30, 30, 30][1:jm - 1]), 0) + jd - 1)::int, '%Y-%m-%d') end iso, case when k % 5 = 4 then 'year' else 'day' end "precision" from o join n on n.y = o.jy""")
def hijri_date(spark, d):
    month = F.get(F.array(*[F.lit(x) for x in HIJRI.split()]), (c("o_orderkey") % 12).cast("int"))
    y, m, day = ((c("o_orderkey") % 40 + 1380).cast("string"), (c("o_orderkey") % 12 + 1).cast("string"), (c("o_orderkey") % 29 + 1).cast("string"))
    arabic = F.translate(F.concat(day, F.lit(" "), month, F.lit(" "), y), "0123456789", "۰۱۲۳۴۵۶۷۸۹")
    text = (
        F.when(c("o_orderkey") % 5 == 0, F.concat(F.lit("تاریخ "), y, F.lit("/"), m, F.lit("/"), day)).when(c("o_orderkey") % 5 == 1, F.concat(F.lit("در "), arabic, F.lit(" سال 1399")))
        .when(c("o_orderkey") % 5 == 2, F.concat(y, F.lit(" "), month, F.lit(" "), day)).when(c("o_orderkey") % 5 == 3, F.concat(F.lit("جلسه "), day, month, y)).otherwise(F.concat(F.lit("در سال "), y, F.lit(" گفت")))
    )
    got = D.hijri_date(text)
    return table(spark, d, "orders").select(c("o_orderkey").alias("doc_id"), got.alias("g")).select("doc_id", c("g.date").alias("iso"), c("g.precision").alias("precision"))


@query("select doc_id, try_cast(concat(y, '-', m, '-', d + 3) as date)::varchar url_date from v_heads")
def url_date(spark, d):
    url = F.expr("concat('https://x.example/', cast(y as string), '/', lpad(cast(m as string), 2, '0'), '/', lpad(cast(d + 3 as string), 2, '0'), '/post')")
    return view(spark, d, "v_heads").select("doc_id", D.url_date(url, r"/(\d{4})/(\d{2})/(\d{2})/").alias("url_date"))


@query("select doc_id, concat(y, '-', lpad((case when doc_id % 5 = 0 then 1 else m end)::varchar, 2, '0'), '-', lpad((case when doc_id % 5 = 0 then 1 else d end)::varchar, 2, '0')) capture from v_heads")
def capture_date(spark, d):
    stamp = F.expr("concat(cast(y as string), case when doc_id % 5 = 0 then '0000' else concat(lpad(cast(m as string), 2, '0'), lpad(cast(d as string), 2, '0')) end, '120000')")
    return view(spark, d, "v_heads").select("doc_id", D.capture_date(stamp).alias("capture"))


@query("""with x as (select doc_id, case when doc_id % 3 = 0 then day else '' end sel, case when doc_id % 4 = 0 then '' else concat(y + doc_id % 3, '-06-01') end cap,
  case when doc_id % 5 = 0 then '' when doc_id % 5 = 1 then concat(y + 9, '-01-01') when doc_id % 5 = 2 then concat(y + doc_id % 3, '-06-01') else day end model, doc_id % 7 = 0 no, case when shape in (0, 1, 2, 3, 7) or shape = 4 and d > 12 then day end head from v_heads),
y as (select *, cap = '' or head[1:4] <= cap[1:4] fits_head, model <> '' and (cap = '' or model[1:4] <= cap[1:4]) fits_model from x)
select doc_id, case when sel <> '' then sel when fits_model and model <> cap then model when head is not null and fits_head then head when cap <> '' then cap else '' end "date",
  case when sel <> '' then 'scraped' when fits_model and model <> cap then 'model' when head is not null and fits_head then 'regex_text' when cap <> '' then 'wayback_capture' end "precision",
  no or (head is not null and not fits_head) or (model <> '' and not fits_model) or coalesce(abs(try_cast(nullif(model[1:4], '') as int) - try_cast(nullif(sel[1:4], '') as int)) > 5, false) disagreement,
  sel = '' and not (fits_model and model <> cap) and not (head is not null and fits_head) and cap <> '' is_fallback from y""")
def resolve_date(spark, d):
    rows = dated(spark, d).select(
        "doc_id", F.expr("case when doc_id % 3 = 0 then day else '' end").alias("sel"), F.expr("case when doc_id % 4 = 0 then '' else concat(cast(y + doc_id % 3 as string), '-06-01') end").alias("cap"),
        F.expr("case when doc_id % 5 = 0 then '' when doc_id % 5 = 1 then concat(cast(y + 9 as string), '-01-01') when doc_id % 5 = 2 then concat(cast(y + doc_id % 3 as string), '-06-01') else day end").alias("model"),
        F.expr("case when doc_id % 7 = 0 then 'No' else 'yes' end").alias("agrees"), D.head_date(c("text"), max_year=F.lit(2030)).alias("head"), D.hijri_date(c("text")).alias("hijri"))
    r = D.resolved(c("sel"), c("cap"), c("model"), c("agrees"), c("hijri"), c("head"))
    return rows.withColumn("r", r).select("doc_id", "r.date", "r.precision", "r.disagreement", "r.is_fallback")


@query("""select doc_id, case when lower(document_type) not in ('speech', 'interview', 'official_statement') then 'rejected_not_representative' when trim(speaker) = '' then 'rejected_no_speaker'
  when tenure <> 'exact' and speaker_type = 'foreign_visitor' then 'rejected_foreign' when tenure <> 'exact' and speaker_type in ('other_minister', 'other') then 'rejected_non_leader' else 'accepted' end clean_status,
  case when lower(document_type) not in ('speech', 'interview', 'official_statement') then 'document_type=' || case when document_type = '' then 'unknown' else document_type end || ' does not represent the leader' when trim(speaker) = '' then 'no speaker could be identified'
  when tenure <> 'exact' and speaker_type = 'foreign_visitor' then 'speaker is a foreign visitor, not this country''s leader' when tenure <> 'exact' and speaker_type in ('other_minister', 'other') then 'speaker_type=' || speaker_type || ' (not a head of state/government)' else '' end gate_reason from v_meta""")
def gate_decide(spark, d):
    v = gate.decide(c("document_type"), c("speaker"), c("speaker_type"), c("tenure"))
    return view(spark, d, "v_meta").withColumn("v", v).select("doc_id", "v.clean_status", "v.gate_reason")


@query("""select doc_id, case when lower(document_type) in ('speech', 'interview', 'official_statement') then case when substantive = 'no' then '4_courtesy' when lower(document_type) <> 'official_statement' then '1_speech'
  when first_person = 'yes' then '2_first_person_statement' else '3_third_person_statement' end end tier,
  tenure = 'none' and (speaker_type in ('head_of_state', 'head_of_government', 'both') or (first_person = 'yes' and substantive = 'yes')) review from v_meta""")
def gate_tier_review(spark, d):
    review = gate.needs_review(F.lit("accepted"), c("tenure"), c("speaker_type"), c("first_person"), c("substantive"))
    return view(spark, d, "v_meta").select("doc_id", gate.tier(c("document_type"), c("first_person"), c("substantive")).alias("tier"), review.alias("review"))


@query("""select p.position, n_name country, case when p.position = '' then null when p.position in ('Vice President', 'Minister of Trade', 'Governor-General', 'Deputy Prime Minister', 'General') then false else case when p.position = 'Poet' then null else true end end is_leader
from nation, (values (''), ('President'), ('Vice President'), ('Minister of Trade'), ('Prime Minister'), ('Governor-General'), ('Poet'), ('King of the North'), ('Deputy Prime Minister'), ('General')) p(position)""")
def position_class(spark, d):
    some = F.array(*[F.lit(x) for x in ("", "President", "Vice President", "Minister of Trade", "Prime Minister", "Governor-General", "Poet", "King of the North", "Deputy Prime Minister", "General")])
    return table(spark, d, "nation").select(c("n_name").alias("country"), F.explode(some).alias("position")).select("position", "country", gate.by_position(c("position"))["is_leader"].alias("is_leader"))


NAMES = "lower(strip_accents(speaker))"
MATCH = f"""with k as (select *, {NAMES} kn from v_key), s as (select distinct speaker, country, "year", {NAMES} sn from v_people),
home as (select s.speaker, s.country, s.year, min(k.ord) o from s join k on k.country = s.country and k.year between s.year - 1 and s.year + 1 and (contains(sn, kn) or contains(kn, sn)
  or len(list_intersect(list_filter(string_split(sn, ' '), lambda x: length(x) > 2), list_filter(string_split(kn, ' '), lambda x: length(x) > 2))) > 0) group by all),
away as (select s.speaker, s.country, s.year, min(k.ord) o from s anti join home h on h.speaker = s.speaker and h.country = s.country and h.year = s.year join k on k.country <> s.country and (contains(sn, kn) or contains(kn, sn)) group by all),
hit as (select *, 'exact' m from home union all select *, 'other_country' from away)
select p.ord, p.speaker, p.country, p.year, p.position, coalesce(h.m, 'none') tenure_match, case when h.m = 'exact' then k.is_ceremonial end is_ceremonial, coalesce(k.speaker, '') matched_name
from v_people p left join hit h on h.speaker = p.speaker and h.country = p.country and h.year = p.year left join k on k.ord = h.o"""


@query(MATCH)
def tenure_match(spark, d):
    return tenure.match(view(spark, d, "v_people"), view(spark, d, "v_key"))


@query("""with a as (select distinct country, "year" from v_people), n as (select a.country, a.year, k.speaker, min(k.ord) o from a left join v_key k on k.country = a.country and k.year between a.year - 1 and a.year + 1 group by all)
select country, "year", coalesce(string_agg(speaker, ', ' order by o), '') leaders from n group by all""")
def leaders_for(spark, d):
    return tenure.leaders_for(view(spark, d, "v_people").select("country", "year"), view(spark, d, "v_key"))


@query("""with h as (select speaker, country, position, count(*) n, min(ord) f from v_people where position <> '' group by all), m as (select speaker, country, arg_max(position, struct_pack(n := n, f := -f)) position from h group by all)
select p.speaker, p.country, count(*) n, min("year")::int min_year, max("year")::int max_year, any_value(m.position) position from v_people p left join m on m.speaker = p.speaker and m.country = p.country group by p.speaker, p.country""")
def speaker_inventory(spark, d):
    return tenure.inventory(view(spark, d, "v_people").withColumn("date", F.concat(c("year").cast("string"), F.lit("-05-05"))))


@query("""with a as (select speaker, country, min("year") a, max("year") b from v_people group by all), y as (select speaker, country, unnest(range(a, b + 1)) y from a)
select speaker, country, y::int "year" from y where not exists (select 1 from v_key k where k.speaker = y.speaker and k.country = y.country and k.year = y.y)""")
def leader_years_new(spark, d):
    spans = view(spark, d, "v_people").groupBy("speaker", "country").agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))
    return tenure.new_years(spans, view(spark, d, "v_key"))


@query("""with a as (select speaker, country, min("year") min_year, max("year") max_year from v_people group by all), t as (select speaker, country, min("year") lo, max("year") hi from v_key group by all)
select a.speaker, a.country, min_year::int min_year, max_year::int max_year, coalesce(max_year >= lo and min_year <= hi, false) in_office from a left join t on t.speaker = a.speaker and t.country = a.country""")
def tenure_spans(spark, d):
    people = view(spark, d, "v_people").groupBy("speaker", "country").agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))
    return tenure.spans_overlap(people, view(spark, d, "v_key"))


@query("""select ord, speaker, country, "year", position, case when speaker = 'Jose Nunez' and "year" between 1992 and 1995 then 'J. Nunez' when speaker = 'Jose Nunez' then 'José Núñez' when speaker = 'ANNA weber' then 'Anna Weber' else speaker end canonical from v_people""")
def name_key(spark, d):
    people = view(spark, d, "v_people")
    rules = people.sparkSession.createDataFrame([(1, "Jose Nunez", None, None, "José Núñez"), (2, "Jose Nunez", 1992, 1995, "J. Nunez"), (3, "ANNA weber", None, None, "Anna Weber")], "ord int, name string, y_lo int, y_hi int, canonical string")
    rules = rules.join(F.broadcast(table(spark, d, "nation").select(c("n_name").alias("country"))))
    return tenure.apply_name_rules(people, rules)


@query("""select source, doc_id, 'XXX' || lpad((100 + row_number() over (partition by source order by doc_id))::varchar, 4, '0') new_id from documents""")
def doc_ids(spark, d):
    docs = table(spark, d, "documents")
    last = docs.select(c("source").alias("country")).distinct().withColumn("last_num", F.lit(100))
    rows = docs.select(c("source").alias("country"), c("doc_id").alias("ord"), F.lit(None).cast("string").alias("iso3"))
    return links.numbered(rows, last).select(c("country").alias("source"), c("ord").alias("doc_id"), c("doc_id").alias("new_id"))


@query("""select source_id, count(*) n_docs, count(*) filter (trim(text) <> '') n_text, min("day") date_min, max("day") date_max, 0::bigint n_bad_dates, arg_min('S' || ord, ord) first_id, arg_max('S' || ord, ord) last_id
from (select *, strftime(date '2001-01-01' + (ord % 900)::int, '%Y-%m-%d') "day" from v_rows) group by source_id""")
def source_index(spark, d):
    rows = view(spark, d, "v_rows").select("source_id", "text", F.concat(F.lit("S"), c("doc_id")).alias("doc_id"), F.expr("cast(date_add(date'2001-01-01', cast(ord % 900 as int)) as string)").alias("date"))
    return links.source_index(rows)


@query("""with k as (select regexp_extract(url, '/([a-z]{2})/', 1) source_id, (ord % 3)::varchar file, rtrim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(url), '^https?://', ''), '^www\\.', ''), ':80/', '/'), '/{2,}', '/', 'g'), '/') key from v_urls),
f as (select source_id, file, count(distinct key) n from k group by all), t as (select source_id, max(n) largest, count(*) n_files from f group by all)
select k.source_id, count(distinct key) n_links, any_value(largest) largest, any_value(n_files) n_files, any_value((select count(*) from f where f.source_id = t.source_id and 2 * f.n >= t.largest)) n_big from k join t on t.source_id = k.source_id group by k.source_id""")
def link_universe(spark, d):
    listed = view(spark, d, "v_urls").select(F.regexp_extract("url", "/([a-z]{2})/", 1).alias("source_id"), (c("ord") % 3).cast("string").alias("file"), "url")
    return links.universe(listed)


@query("""with r as (select source_id, 'ABC' || lpad((ord // 2 * 40)::varchar, greatest(4, length((ord // 2 * 40)::varchar))::int, '0') id from v_rows) select (select count(*) from r) n_rows, (select count(distinct source_id) from r) n_sources, (select count(distinct id) from r) n_ids, 0::bigint n_blank_ids,
  (select count(*) from r where length(id) > 7) n_wide_ids, (select count(*) - count(distinct id) from r)::bigint n_repeated""")
def merge_report(spark, d):
    return links.merge_report(view(spark, d, "v_rows").select("source_id", F.expr("concat('ABC', lpad(cast(ord div 2 * 40 as string), greatest(4, length(cast(ord div 2 * 40 as string))), '0'))").alias("doc_id")))


@query("""with x as (select *, 'A' || (ord // 2) id from v_rows) select id doc_id, source_id, ord // 2 doc_number from x qualify row_number() over (partition by id order by ord) = 1""")
def merge_keep(spark, d):
    return tenure.merged_once(view(spark, d, "v_rows").withColumn("doc_id", F.expr("concat('A', cast(ord div 2 as string))"))).select("doc_id", "source_id", "doc_number")


@query("""select source_id, count(*) n_rows, count(*) filter (doc_id::bigint % 3 = 0) n_accepted, count(*) filter (doc_id::bigint % 3 = 1) n_rejected, count(*) filter (doc_id::bigint % 3 = 2) n_errors, count(*) filter (doc_id::bigint % 5 = 0) n_review,
  count(*) filter (title = 'en') n_translated, min(doc_id) doc_id_first, max(doc_id) doc_id_last from v_rows group by source_id""")
def cleaned_index(spark, d):
    status = F.when(c("ord") % 3 == 0, "accepted").when(c("ord") % 3 == 1, "rejected_foreign").otherwise("error")
    return links.cleaned_index(view(spark, d, "v_rows").select("source_id", "doc_id", status.alias("clean_status"), (c("ord") % 5 == 0).alias("speaker_review"), (c("title") != "en").alias("needs_translation")))


RUNS = """with e as (select *, sum(case when failed then 0 else 1 end) over (partition by source_id order by ord) g from v_events where not filtered),
f as (select source_id, ord, row_number() over (partition by source_id, g order by ord) k from e where failed)
select s.source_id, coalesce(max(k), 0)::bigint longest_run, min(case when k = 6 then f.ord end) tripped_at from (select distinct source_id from v_events) s left join f on f.source_id = s.source_id group by s.source_id"""


@query(RUNS)
def circuit_breaker(spark, d):
    return folds.breaker(view(spark, d, "v_events"), 6, neutral="filtered")


@query("""with recursive e as (select source_id, throttled, row_number() over (partition by source_id order by ord) i from v_events),
w as (select source_id, 0::bigint i, 2.0::double delay, 0 clean, 0::bigint hits from (select distinct source_id from v_events) s
  union all select w.source_id, e.i, case when e.throttled then case when w.delay < 30 then round(least(30.0, w.delay + 1.5), 2) else w.delay end when w.clean + 1 >= 20 and w.delay > 2 then round(greatest(2.0, w.delay - 0.5), 2) else w.delay end,
  case when e.throttled or (w.clean + 1 >= 20 and w.delay > 2) then 0 else w.clean + 1 end, w.hits + case when e.throttled then 1 else 0 end from w join e on e.source_id = w.source_id and e.i = w.i + 1)
select source_id, arg_max(delay, i) delay, arg_max(hits, i) throttle_events from w group by source_id""")
def adaptive_pacer(spark, d):
    return folds.paced(view(spark, d, "v_events"), 2.0, 30.0)


@query("select event_id, least(60.0, 0.5 * pow(2.0, event_id % 9)) delay from events")
def backoff(spark, d):
    return table(spark, d, "events").select("event_id", folds.backoff(c("event_id") % 9, 0.5).alias("delay"))


@query("""select event_id, 0 ord, json_extract_string(props, '$.k') k, 'deep' || event_id t from events union all select event_id, 1, null, 'second' from events""")
def api_json(spark, d):
    raw = F.concat(F.lit('{"d": {"r s": [{"props": '), c("props"), F.lit(', "x": [{"t": "deep'), c("event_id").cast("string"), F.lit('"}]}, {"x": [{"t": "second"}]}]}}'))
    return files.api_items(table(spark, d, "events").select("event_id", raw.alias("raw")), "$.d['r s']", {"k": "$.props.k", "t": "$.x[0].t"})


@query("select event_type, user_id, 'K' || (event_id % 5) k, arg_max(value, event_id) v from events group by all")
def cells_pivot(spark, d):
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "value"))), lambda x: F.struct(F.concat(F.lit("K"), (x["event_id"] % 5).cast("string")).alias("Key"), x["value"].alias("Value")))
    rows = table(spark, d, "events").groupBy("event_type", "user_id").agg(pairs.alias("cells"))
    return files.cells(rows, "cells").select("event_type", "user_id", F.explode("cells").alias("k", "v"))


@query("select doc_id, case lang when 'en' then 'en' else lang end iso, lang <> 'en' needs from documents")
def translate_need(spark, d):
    origin, target = F.when(c("lang") != "en", c("text")), F.when(c("lang") == "en", c("text"))
    needs = F.when(c("lang").isNotNull(), L.needs_translation(origin, target))  # without a language it isn't known which of both the text is
    return table(spark, d, "documents").select("doc_id", L.source_language(F.lit(None).cast("string"), c("lang")).alias("iso"), needs.alias("needs"))


@query("select doc_id, 'speaker: not available' || chr(10) || 'lang: ' || lang || chr(10) || 'text:' || chr(10) || case when len(w) > 20 then array_to_string(w[1:20], ' ') || ' [...]' else text end prompt from (select *, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') w from documents)")
def prompts(spark, d):
    return table(spark, d, "documents").select("doc_id", enrich.prompt(c("text"), 20, speaker=F.lit(""), lang=c("lang")).alias("prompt"))


@query("select event_id, 'x' || (event_id % 4) speaker, event_id % 7 = 0 empty from (select * from events where event_id % 7 <> 0) union all select event_id, null, true from events where event_id % 7 = 0")
def model_replies(spark, d):
    raw = F.when(c("event_id") % 7 == 0, "not json").otherwise(F.concat(F.lit('{"speaker": " x'), (c("event_id") % 4).cast("string"), F.lit(' ", "title": ""}')))
    rows = table(spark, d, "events").select("event_id", enrich.reply(raw).alias("r"))
    return rows.select("event_id", "r.speaker", enrich.empty_reply(c("r")).alias("empty"))


@query("select url original, max(len) length, arg_min(ts, struct_pack(a := -len, b := ord)) as \"timestamp\" from (select url, ord, (ord * 37 % 101)::bigint len, (20100101000000 + ord)::varchar ts, ord % 4 <> 0 ok from v_urls) where ok group by url")
def best_capture(spark, d):
    rows = view(spark, d, "v_urls").select(c("url").alias("original"), "ord", (c("ord") * 37 % 101).alias("length"), (c("ord") + 20100101000000).cast("string").alias("timestamp"), F.when(c("ord") % 4 != 0, "200").otherwise("404").alias("statuscode"))
    return links.best_capture(rows)


@query("""with p as (select page_id % 10 "start", page_id // 10 page, regexp_extract(url, '^[^?#]*') url from pages), n as (select "start", url, min(page) page from p group by all), g as (select "start", page, count(*) gain from n group by all),
a as (select distinct p.start, p.page, coalesce(g.gain, 0) gain from p left join g on g.start = p.start and g.page = p.page), e as (select "start", min(page) page from a where gain = 0 group by all)
select p.start, coalesce(any_value(e.page), max(p.page)) stopped_at, case when any_value(e.page) is null then 'cap' else 'no_new' end stop_reason from p left join e on e.start = p.start group by p.start""")
def pager_stop(spark, d):
    pages = table(spark, d, "pages").select((c("page_id") % 10).alias("start"), F.expr("page_id div 10").alias("page"), F.regexp_extract("url", r"^[^?#]*", 0).alias("url"), F.lit(200).alias("status"))
    return links.pager_stops(pages)


# extensions beyond the inventory


@query("select date_trunc('hour', ts)::timestamp as window_start, event_type, count(*) n, sum(value) total from events group by all")
def events_tumbling(spark, d):
    w = F.window("ts", "1 hour")
    return table(spark, d, "events").groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(c("w.start").alias("window_start"), "event_type", "n", "total")


@query("""select l_returnflag, l_linestatus, sum(l_quantity) sum_qty, sum(l_extendedprice) sum_base, sum(l_extendedprice * (1 - l_discount)) sum_disc, avg(l_quantity) avg_qty, count(*) n from lineitem where l_shipdate <= timestamp '1998-09-02' group by all""")
def pricing_summary(spark, d):
    t = table(spark, d, "lineitem").where("l_shipdate <= timestamp'1998-09-02'")
    return t.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.sum("l_extendedprice").alias("sum_base"), F.sum(c("l_extendedprice") * (1 - c("l_discount"))).alias("sum_disc"), F.avg("l_quantity").alias("avg_qty"), F.count("*").alias("n"))


from tesserae.plans import corpus  # noqa: E402, F401  registers its queries
