"""More registered queries: records and their replays, reports, sources and single functions, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.functions import countries, languages
from tesserae.functions import dates as D
from tesserae.functions import text as T
from tesserae.functions import urls as U
from tesserae.operators import enrich, folds, gate, html, links, media, records, reports, tenure
from tesserae.plans.registry import query
from tesserae.plans.views import table, view
from tesserae.sources import fetch, files

c = F.col


def s(sql: str):
    return F.expr(sql)


# records


@query("""select d.doc_id::varchar doc_id, 'N' || (d.doc_id % 4) country, case when d.doc_id % 4 = 0 then '' else '00' || (d.doc_id % 4) end iso3n, 'P' "position", case when d.doc_id % 2 = 0 then 'T' else '' end title, case when d.doc_id % 2 = 0 then '' else 'T' end title_origin,
  case when d.doc_id % 2 = 0 then t else '' end "text", case when d.doc_id % 2 = 0 then '' else t end text_origin, case when d.doc_id % 3 = 0 then '2011-03-' || lpad((d.doc_id % 28 + 1)::varchar, 2, '0') else '' end head
from (select *, case when doc_id % 3 = 0 then (doc_id % 28 + 1) || '.03.2011' || chr(10) else '' end || lang || ' and more' t from documents) d""")
def map_to_schema(spark, d):
    recipes = spark.createDataFrame([(f"s{k}", f"N{k}", None if k == 0 else f"00{k}", "P", "English (UK)" if k % 2 == 0 else "French", "x") for k in range(4)], "source_id string, country string, iso3n string, position string, source_language string, dataset string")
    text = s("concat(case when doc_id % 3 = 0 then concat(cast(doc_id % 28 + 1 as string), '.03.2011', '\\n') else '' end, lang, ' and more')")
    docs = table(spark, d, "documents").select(s("concat('s', cast(doc_id % 4 as string))").alias("source_id"), c("doc_id").cast("string").alias("doc_id"), F.lit("u").alias("source"), F.lit("S").alias("speaker"), F.lit("T").alias("title"), text.alias("text"), F.lit("").alias("context"), F.lit(None).cast("string").alias("date"))
    out = records.mapped(docs, recipes, F.lit(2030))
    return out.select("doc_id", "country", c("ISO3N").alias("iso3n"), "position", "title", c("title_originlanguage").alias("title_origin"), "text", c("text_originlanguage").alias("text_origin"), c("date_regex_recovered").alias("head"))


@query("""select doc_id, lang speaker_scraped, '' date_scraped, 'error_call' clean_status, ('reason ' || repeat('x', doc_id % 600))[1:300] gate_reason, null::varchar document_type, '' "position" from documents""")
def error_rows(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text", c("lang").alias("speaker"))
    out = records.failed(rows, F.lit("error_call"), s("concat('reason ', repeat('x', cast(doc_id % 600 as int)))"))
    return out.select("doc_id", "speaker_scraped", "date_scraped", "clean_status", "gate_reason", "document_type", "position")


@query("""select doc_id, case when k = 2 and ok then '' when k = 3 and ok then 'Linked body' || chr(10) || doc_id else 'chrome' end "text", case when k = 3 and ok and doc_id % 5 = 0 then 'Linked body' when doc_id % 5 = 0 then '' else 'T' end title, k = 3 and ok followed
from (select doc_id, doc_id % 4 k, doc_id % 3 <> 0 ok from documents)""")
def linked_body(spark, d):
    rows = table(spark, d, "documents").select(
        "doc_id", F.lit("chrome").alias("text"), s("case when doc_id % 5 = 0 then '' else 'T' end").alias("title"), s("case when doc_id % 4 = 0 then '' else 'https://x/p.pdf' end").alias("link"),
        s("case when doc_id % 3 <> 0 then 'pdf' else 'other' end").alias("kind"), s("case doc_id % 4 when 3 then concat(' Linked body\\n', cast(doc_id as string), ' ') when 1 then null else '  ' end").alias("linked_text"))
    return records.followed(rows.where("doc_id % 4 <> 1")).select("doc_id", "text", "title", "followed").unionByName(records.followed(rows.where("doc_id % 4 = 1").withColumn("kind", F.lit(None).cast("string"))).select("doc_id", "text", "title", "followed"))


@query("""select doc_id, case when doc_id % 3 = 0 then day when shape = 4 and false then null else y || '-' || lpad(m::varchar, 2, '0') || '-' || lpad(d::varchar, 2, '0') end "value", case when doc_id % 3 = 0 then 'time' else 'url_regex: /(\\d{4})/(\\d{2})/(\\d{2})/' end origin from v_heads""")
def date_origin(spark, d):
    heads = view(spark, d, "v_heads")
    url = s("concat('https://x.example/', cast(y as string), '/', lpad(cast(m as string), 2, '0'), '/', lpad(cast(d as string), 2, '0'), '/post')")
    got = records.date_provenance([("h1", F.lit("a title")), ("time", s("case when doc_id % 3 = 0 then concat('Posted ', day) else 'soon' end"))], url, r"/(\d{4})/(\d{2})/(\d{2})/", ["en"])
    return heads.select("doc_id", got.alias("p")).select("doc_id", "p.value", "p.origin")


VERDICT = """case when lower(document_type) not in ('speech', 'interview', 'official_statement') then 'rejected_not_representative' when tm <> 'exact' and speaker_type = 'foreign_visitor' then 'rejected_foreign'
  when tm <> 'exact' and speaker_type in ('other_minister', 'other') then 'rejected_non_leader' else 'accepted' end"""


@query(f"""with x as (select *, 'none' tm, clean_status like 'error%' e from v_clean), y as (select *, {VERDICT} v from x)
select doc_id, case when e then clean_status else v end clean_status, case when e or v = clean_status then gate_reason when v = 'accepted' then '' when v = 'rejected_foreign' then 'speaker is a foreign visitor, not this country''s leader'
  when v = 'rejected_non_leader' then 'speaker_type=' || speaker_type || ' (not a head of state/government)' else 'document_type=' || case when document_type = '' then 'unknown' else document_type end || ' does not represent the leader' end gate_reason,
  case when e or lower(document_type) not in ('speech', 'interview', 'official_statement') then null when is_substantive = 'no' then '4_courtesy' when document_type <> 'official_statement' then '1_speech' when is_first_person = 'yes' then '2_first_person_statement' else '3_third_person_statement' end inclusion_tier,
  not e and v in ('accepted', 'rejected_non_leader', 'rejected_foreign') and (speaker_type in ('head_of_state', 'head_of_government', 'both') or (is_first_person = 'yes' and is_substantive = 'yes')) speaker_review from y""")
def regate(spark, d):
    once = records.regated(view(spark, d, "v_clean"))
    return records.regated(once).select("doc_id", "clean_status", "gate_reason", "inclusion_tier", "speaker_review")


NAMED = "lower(strip_accents(speaker))"


@query(f"""with k as (select *, {NAMED} kn from v_key), s as (select *, {NAMED} sn, "date"[1:4]::int y from v_clean where clean_status not like 'error%'),
home as (select s.ord, min(k.ord) o from s join k on k.country = s.country and k.year between y - 1 and y + 1 and (contains(sn, kn) or contains(kn, sn) or len(list_intersect(list_filter(string_split(sn, ' '), lambda x: length(x) > 2), list_filter(string_split(kn, ' '), lambda x: length(x) > 2))) > 0) group by all),
away as (select s.ord, min(k.ord) o from s join k on k.country <> s.country and (contains(sn, kn) or contains(kn, sn)) where s.ord not in (select ord from home) group by all),
x as (select v.*, case when v.clean_status like 'error%' then 'none' when h.ord is not null then 'exact' when a.ord is not null then 'other_country' else 'none' end tm, coalesce(kh.speaker, ka.speaker) name from v_clean v left join home h on h.ord = v.ord left join away a on a.ord = v.ord left join v_key kh on kh.ord = h.o left join v_key ka on ka.ord = a.o)
select doc_id, tm tenure_match, name tenure_matched_name, case when clean_status like 'error%' then clean_status else {VERDICT} end clean_status from x""")
def regate_tenure(spark, d):
    return records.regated(view(spark, d, "v_clean"), view(spark, d, "v_key")).select("doc_id", "tenure_match", "tenure_matched_name", "clean_status")


@query("""with x as (select doc_id, case when doc_id % 3 = 0 then day when doc_id % 3 = 1 then day else '' end own, case when doc_id % 4 = 0 then '' else concat(y + doc_id % 3, '-06-01') end cap, case when doc_id % 5 = 0 then '' when doc_id % 5 = 1 then concat(y + 9, '-01-01') else day end model, doc_id % 13 = 0 e from v_heads),
y as (select *, model <> '' and (cap = '' or model[1:4] <= cap[1:4]) fits from x)
select doc_id, case when e then 'stored' when own <> '' then own when fits and model <> cap then model when cap <> '' then cap else '' end "date", case when e then 'scraped' when own <> '' then 'scraped' when fits and model <> cap then 'model' when cap <> '' then 'wayback_capture' end date_precision,
  case when e then null else own = '' and not (fits and model <> cap) and cap <> '' end date_is_fallback from y""")
def redate(spark, d):
    null = lambda t: F.lit(None).cast(t)
    rows = view(spark, d, "v_heads").select(
        "doc_id", s("case when doc_id % 3 = 1 then day when doc_id % 13 = 0 then 'stored' else 'stored' end").alias("date"), F.lit("scraped").alias("_p"), s("case when doc_id % 3 = 0 then day else '' end").alias("date_scraped"),
        s("case when doc_id % 3 = 1 or doc_id % 13 = 0 then 'scraped' else 'model' end").alias("date_precision"), F.lit("Body text.").alias("text"), F.lit("").alias("text_originlanguage"),
        s("case when doc_id % 4 = 0 then '' else concat(cast(y + doc_id % 3 as string), '-06-01') end").alias("wayback_capture"), s("case when doc_id % 5 = 0 then '' when doc_id % 5 = 1 then concat(cast(y + 9 as string), '-01-01') else day end").alias("date_model"),
        F.lit("yes").alias("date_matches_metadata"), null("string").alias("date_parsed"), null("string").alias("date_regex_recovered"), null("boolean").alias("date_disagreement_flag"), null("boolean").alias("date_is_fallback"),
        s("case when doc_id % 13 = 0 then 'error_call' else 'accepted' end").alias("clean_status"))
    rows = rows.withColumn("date", s("case when doc_id % 13 = 0 then 'stored' else date end"))
    return records.redated(rows, max_year=F.lit(2030)).select("doc_id", "date", "date_precision", "date_is_fallback")


@query("""with p as (select page_id, url, case page_id % 5 when 0 then 'seen' when 1 then 'failed' when 2 then 'filtered' end st from pages), k as (select *, row_number() over (partition by url order by page_id) n from p),
r as (select 'default' mode, page_id, url from k where st is null union all select 'retry_failed', page_id, url from k where st is null or st = 'failed' union all select 'rescrape', page_id, url from k where st is null or st <> 'filtered')
select mode, count(*) n, sum(page_id)::bigint total from r group by mode""")
def reopen(spark, d):
    pages = table(spark, d, "pages").select(c("page_id").alias("ord"), F.concat(F.lit("https://x.example/"), c("page_id").cast("string")).alias("url"))
    state = pages.where("ord % 5 < 3").select("url", s("case ord % 5 when 0 then 'seen' when 1 then 'failed' else 'filtered' end").alias("status"))
    modes = [("default", {}), ("retry_failed", {"retry_failed": True}), ("rescrape", {"rescrape": True})]
    out = None
    for mode, kw in modes:
        one = records.reopened(pages, state, **kw).where("fate = 'kept'").select(F.lit(mode).alias("mode"), "ord")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("mode").agg(F.count("*").alias("n"), F.sum("ord").alias("total"))


@query("""select 's' || n_nationkey source_id, case when n_nationkey % 2 = 0 then 'old.example/' else 'n' || n_nationkey || '.example/*' end prefix, case when n_nationkey % 3 = 0 then 'h2' else 'h1' end title from nation""")
def archive_continuation(spark, d):
    rows = table(spark, d, "nation").select(
        s("concat('s', cast(n_nationkey as string))").alias("source_id"), s("array(concat('https://n', cast(n_nationkey as string), '.example/'))").alias("start_urls"), F.lit("h1").alias("title"),
        s("struct(case when n_nationkey % 2 = 0 then 'old.example/' end as prefix, case when n_nationkey % 3 = 0 then 'h2' end as title)").alias("extend"))
    return records.continuation(rows, ["title"])


# reports

KEY = r"rtrim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(url), '^https?://', ''), '^www\.', ''), ':80/', '/'), '/{2,}', '/', 'g'), '/')"
UNIVERSE = rf"""l as (select *, {KEY} k, pattern is null or regexp_matches(url, pattern) fits from v_lists), e as (select source_id, k, bool_or(fits) fits from l group by all),
n as (select source_id, count(*) filter (fits) n_links, count(*) filter (not fits) n_dropped from e group by all), f as (select source_id, file, count(distinct k) n, bool_or(kind = 'run') run, bool_or(stopped_early) se, bool_or(capped) ca, bool_or(page1_only) p1, bool_or(pattern is null) un from l group by all),
m as (select source_id, max(n) top from f group by all), g as (select f.source_id, count(*) n_files, bool_or(run) run, bool_or(un) un, bool_or(2 * n >= top and se) se, bool_or(2 * n >= top and ca) ca, bool_or(2 * n >= top and p1) p1 from f join m on m.source_id = f.source_id group by all),
u as (select g.*, n_links, n_dropped, case when p1 then 'page1_only' when se then 'stopped_early' when ca then 'capped' when un then 'unfiltered' when run then 'complete' else 'probe_only' end st from g join n on n.source_id = g.source_id)"""
INDEX = "i as (select source source_id, count(*) n_docs from documents group by all)"


@query(f"with {UNIVERSE} select source_id, n_files, n_links + n_dropped union_raw, n_links n_unique_links, n_dropped dropped_by_pattern, st links_status from u")
def link_audit(spark, d):
    return reports.audit(reports.link_universe(view(spark, d, "v_lists")))


@query(f"with {UNIVERSE}, {INDEX} select i.source_id, n_docs, n_links, case when n_links > 0 then round_even(100.0 * n_docs / n_links, 1) end percent_scraped, case when n_files is null then '' when n_docs > n_links then 'stale_links' else st end links_status from i left join u on u.source_id = i.source_id")
def index_with_links(spark, d):
    index = table(spark, d, "documents").groupBy(c("source").alias("source_id")).agg(F.count("*").alias("n_docs"))
    return reports.with_links(index, reports.link_universe(view(spark, d, "v_lists")))


@query(f"with {UNIVERSE}, {INDEX} select count(*) n_sources, sum(n_links)::bigint known_links, sum(n_docs)::bigint scraped, 100.0 * sum(n_docs) / sum(n_links) percent from i left join u on u.source_id = i.source_id")
def index_totals(spark, d):
    index = table(spark, d, "documents").groupBy(c("source").alias("source_id")).agg(F.count("*").alias("n_docs"))
    return reports.totals(reports.with_links(index, reports.link_universe(view(spark, d, "v_lists"))))


@query("""with r as (select source, case doc_id % 4 when 0 then '0001-11-30' when 1 then 'no date' else strftime(date '2001-01-01' + (doc_id % 900)::int, '%Y-%m-%d') end "date" from documents)
select source, min("date") filter (try_cast("date" as date) >= date '1900-01-01') date_floor from r group by all""")
def date_floor(spark, d):
    rows = table(spark, d, "documents").select("source", s("case doc_id % 4 when 0 then '0001-11-30' when 1 then 'no date' else cast(date_add(date'2001-01-01', cast(doc_id % 900 as int)) as string) end").alias("date"))
    return reports.date_floor(rows, "source")


@query("""select n_nationkey k, case when n_nationkey % 3 = 0 then '20200101' when n_nationkey % 3 = 1 and n_nationkey % 2 = 0 then '20110101' when n_nationkey % 5 = 0 then null else '20050607' end bound,
  case when n_nationkey % 3 = 0 then '--wayback-to' when n_nationkey % 3 = 1 and n_nationkey % 2 = 0 then 'recipe wayback_extend.wayback_to' when n_nationkey % 5 = 0 then 'unbounded (nothing scraped yet, no wayback_to)' else 'date_floor of the scraped CSV (2005-06-07)' end origin from nation""")
def archive_bound(spark, d):
    b = reports.archive_bound(s("case when n_nationkey % 3 = 0 then '20200101' end"), s("case when n_nationkey % 3 = 1 and n_nationkey % 2 = 0 then '20110101' end"), s("case when n_nationkey % 5 <> 0 then '2005-06-07' end"))
    return table(spark, d, "nation").select(c("n_nationkey").alias("k"), b.alias("b")).select("k", "b.bound", "b.origin")


@query("""select event_type source_id, case when arg_min(event_id, event_id) % 2 = 0 then 'audio' else 'audio:b' || (min(event_id) % 3) end renderer, case when min(event_id) % 5 = 0 then '' else 'playlist' end pagination from events group by all""")
def media_marks(spark, d):
    rows = table(spark, d, "events").select(c("event_type").alias("source_id"), c("event_id").alias("ord"), s("case when event_id % 2 = 0 then '' else concat('b', cast(event_id % 3 as string)) end").alias("backend"), s("case when event_id % 5 = 0 then '' else 'playlist' end").alias("kind"))
    return reports.media_marks(rows)


@query("""select page_id % 7 site, count(*) links, count(*) filter (page_id % 3 <> 0) dated, count(*) filter (page_id % 2 = 0 and page_id % 5 <> 0) titled, min(case when page_id % 3 <> 0 then '20' || lpad((page_id % 90)::varchar, 2, '0') || '-01-01' end) date_min,
  max(case when page_id % 3 <> 0 then '20' || lpad((page_id % 90)::varchar, 2, '0') || '-01-01' end) date_max from pages group by all""")
def listing_summary(spark, d):
    pages = table(spark, d, "pages").select("page_id", s("concat('u', cast(page_id as string))").alias("url"), (c("page_id") % 7).alias("site"))
    meta = pages.where("page_id % 3 <> 0 or page_id % 2 = 0").select("url", s("case when page_id % 2 = 0 and page_id % 5 <> 0 then 'T' else ' ' end").alias("title"), s("case when page_id % 3 <> 0 then concat('20', lpad(cast(page_id % 90 as string), 2, '0'), '-01-01') end").alias("date"))
    return reports.listing_summary(pages.select("site", "url"), meta, "site")


@query("""select page_id % 7 site, count(*) filter (page_id % 5 <> 0) sampled, count(*) filter (page_id % 5 <> 0 and page_id % 3 <> 0) kept, count(*) filter (page_id % 5 <> 0 and page_id % 3 = 0) filtered_out from pages group by all""")
def keep_summary(spark, d):
    rows = table(spark, d, "pages").select((c("page_id") % 7).alias("site"), s("case when page_id % 5 = 0 then 'timeout' end").alias("error"), s("case when page_id % 3 = 0 then false when page_id % 3 = 1 then true end").alias("keep"))
    return reports.keep_summary(rows, "site")


@query("""with r as (select event_type, case when value > 100 then 'failed' when event_id % 10 = 3 then 'filtered' else 'scraped' end st from events) select event_type, count(*) filter (st = 'scraped') scraped, count(*) filter (st = 'failed') failed, count(*) filter (st = 'filtered') filtered,
  count(*) filter (st = 'failed') / count(*) filter (st <> 'filtered') failure_rate, count(*) filter (st = 'failed') / count(*) filter (st <> 'filtered') > 0.5 high_failure from r group by all""")
def run_summary(spark, d):
    rows = table(spark, d, "events").select("event_type", s("case when value > 100 then 'failed' when event_id % 10 = 3 then 'filtered' else 'scraped' end").alias("status"))
    return reports.run_summary(rows, "event_type")


@query("select count(*) filter (c_custkey % 2 = 0) approved, count(*) filter (c_custkey % 3 = 0) classified, count(*) filter (c_custkey % 5 = 0) confirmed from customer")
def people_summary(spark, d):
    return reports.people_summary(table(spark, d, "customer").select((c("c_custkey") % 2 == 0).alias("approved"), (c("c_custkey") % 3 == 0).alias("classified"), (c("c_custkey") % 5 == 0).alias("confirmed")))


@query("""with e as (select event_type source_id, event_id ord, case when event_id % 4 = 0 then '' else 'Talk ' || event_id || repeat('x', 70) end title, case when event_id % 3 = 0 then '' else strftime(ts, '%Y%m%d') end up from events),
t as (select source_id, string_agg('''' || title[1:60] || '''', '; ' order by ord) e from (select *, row_number() over (partition by source_id order by ord) n from e where title <> '') where n <= 3 group by all)
select e.source_id, 'Found ' || count(*) || ' video(s)' || ' | dates ' || min(nullif(up, ''))[1:4] || '-' || min(nullif(up, ''))[5:6] || ' .. ' || max(nullif(up, ''))[1:4] || '-' || max(nullif(up, ''))[5:6] || ' | e.g. ' || any_value(t.e) summary from e join t on t.source_id = e.source_id group by all""")
def harvest_summary(spark, d):
    rows = table(spark, d, "events").select(c("event_type").alias("source_id"), c("event_id").alias("ord"), s("case when event_id % 4 = 0 then '' else concat('Talk ', cast(event_id as string), repeat('x', 70)) end").alias("title"), s("case when event_id % 3 = 0 then '' else date_format(ts, 'yyyyMMdd') end").alias("upload_date"))
    return reports.harvest_summary(rows)


@query("""select case doc_id % 3 when 0 then 'matched' when 1 then 'unmatched' else 'wrong_country' end bucket, count(*) n from documents group by all""")
def tenure_buckets(spark, d):
    rows = table(spark, d, "documents").select(s("case doc_id % 3 when 0 then 'exact' when 1 then 'none' else 'other_country' end").alias("tenure_match"))
    return reports.buckets(rows).groupBy("bucket").agg(F.count("*").alias("n"))


@query("""with p as (select distinct country, case when ord % 4 = 0 then string_split(speaker, ' ')[2] else speaker end speaker from v_people)
select country, speaker, 0 k, case when contains(speaker, ' ') then '  # ' || country || ': confirm canonical form of "' || speaker || '" (add variants if any)' else '  # ' || country || ': "' || speaker || '" looks like a surname only — map to the full name:' end line from p
union all select country, speaker, 1, '  dataframe$speaker[dataframe$country == "' || country || '" & dataframe$speaker == "' || speaker || '"] <- "<FULL NAME>"' from p where not contains(speaker, ' ')""")
def name_suggestions(spark, d):
    people = view(spark, d, "v_people").select("country", s("case when ord % 4 = 0 then split(speaker, ' ')[1] else speaker end").alias("speaker")).distinct()
    return reports.name_suggestions(people)


@query("""with o as (select c_custkey ord, 'P' || (c_custkey % 20) speaker, c_nationkey::varchar country, 1990 + c_custkey % 7 a, 1995 + c_custkey % 11 b, case when c_custkey % 3 = 0 then null else 'R' || c_custkey % 5 end r, case when c_custkey % 4 = 0 then null else c_custkey % 2 = 0 end ce from customer)
select speaker, country, min(a)::int min_year, max(b)::int max_year, arg_min(r, ord) filter (r is not null) "role", arg_min(ce, ord) filter (ce is not null) is_ceremonial from o group by all""")
def approved_leaders(spark, d):
    rows = table(spark, d, "customer").select(
        c("c_custkey").alias("ord"), s("concat('P', cast(c_custkey % 20 as string))").alias("speaker"), c("c_nationkey").cast("string").alias("country"), s("cast(1990 + c_custkey % 7 as int)").alias("min_year"), s("cast(1995 + c_custkey % 11 as int)").alias("max_year"),
        s("case when c_custkey % 3 <> 0 then concat('R', cast(c_custkey % 5 as string)) end").alias("role"), s("case when c_custkey % 4 <> 0 then c_custkey % 2 = 0 end").alias("is_ceremonial"))
    return tenure.approvals(rows)


@query("""with k as (select s_suppkey ord, s_nationkey::varchar country, case when s_suppkey % 3 <> 0 then 'A' || s_suppkey end iso3, case when s_suppkey % 2 = 0 then s_suppkey::varchar end num from supplier)
select country, arg_min(iso3, ord) filter (iso3 is not null) iso3, arg_min(num, ord) filter (num is not null) num from k group by all""")
def first_codes(spark, d):
    rows = table(spark, d, "supplier").select(c("s_suppkey").alias("ord"), c("s_nationkey").cast("string").alias("country"), s("case when s_suppkey % 3 <> 0 then concat('A', cast(s_suppkey as string)) end").alias("iso3"), s("case when s_suppkey % 2 = 0 then cast(s_suppkey as string) end").alias("num"))
    return tenure.country_codes(rows, ["iso3", "num"])


@query("""with a as (select distinct source id from documents where doc_id % 3 = 0), b as (select distinct source id from documents where doc_id % 5 = 0 union select 'x' || n_nationkey from nation where n_nationkey < 3)
select id source_id, 'missing' state from a where id not in (select id from b) union all select id, 'unlisted' from b where id not in (select id from a)""")
def stale_index(spark, d):
    docs, nation = table(spark, d, "documents").select("doc_id", c("source").alias("source_id")), table(spark, d, "nation")
    extra = nation.where("n_nationkey < 3").select(s("concat('x', cast(n_nationkey as string))").alias("source_id"))
    return files.stale_index(docs.where("doc_id % 3 = 0"), docs.where("doc_id % 5 = 0").select("source_id").unionByName(extra))


@query("select distinct 'src' || (page_id % 40) source_id from pages where 'src' || (page_id % 40) not in (select source from documents)")
def never_scraped(spark, d):
    listed = table(spark, d, "pages").select(s("concat('src', cast(page_id % 40 as string))").alias("source_id"))
    return links.never_scraped(listed, table(spark, d, "documents").select(c("source").alias("source_id")))


@query("""select page_id, url, case when page_id % 3 = 0 then 'T' || page_id end title, case when page_id % 3 = 0 then page_id % 2 = 0 end dated from pages""")
def carried_metadata(spark, d):
    pages = table(spark, d, "pages").select("page_id", s("concat('u', cast(page_id as string))").alias("key"), "url")
    told = pages.where("page_id % 3 = 0").select(c("key").alias("url"), F.explode(F.array(F.lit(0), F.lit(1))).alias("ord"), "page_id")
    meta = told.select("url", "ord", s("case ord when 0 then concat('T', cast(page_id as string)) else 'later' end").alias("title"), (c("page_id") % 2 == 0).alias("dated"))
    got = links.with_carried(pages.select("page_id", c("key").alias("url"), c("url").alias("address")), meta)
    return got.select("page_id", c("address").alias("url"), "title", "dated")


@query("select doc_id, lang from documents where doc_id in (3, 14, 15, 92)")
def chosen_documents(spark, d):
    return links.selected(table(spark, d, "documents").select("doc_id", "lang"), [3, 14, 15, 92])


# archive and pages

CAPTURES = "select page_id ord, 'k' || (page_id % 40) urlkey, ((20100101000000 + (page_id % 9) * 10000000000) + page_id)::varchar \"timestamp\", url original, case page_id % 3 when 0 then 'application/pdf' else 'text/html' end mimetype, case page_id % 4 when 0 then '404' else '200' end statuscode, 'd' || (page_id % 6) digest from pages"


def captured(spark, d):
    return table(spark, d, "pages").select(
        c("page_id").alias("ord"), s("concat('k', cast(page_id % 40 as string))").alias("urlkey"), s("cast(20100101000000 + (page_id % 9) * 10000000000 + page_id as string)").alias("timestamp"), c("url").alias("original"),
        s("case page_id % 3 when 0 then 'application/pdf' else 'text/html' end").alias("mimetype"), s("case page_id % 4 when 0 then '404' else '200' end").alias("statuscode"), s("concat('d', cast(page_id % 6 as string))").alias("digest"))


@query(f"""with c as ({CAPTURES}), f as (select * from c where "timestamp" >= '2011' and "timestamp"[1:4] <= '2016' and statuscode = '200' and not regexp_full_match(mimetype, 'application/.*')),
l as (select *, lag(digest) over (partition by urlkey order by "timestamp", ord) p from f) select ord, original, "timestamp" from l where p is null or p <> digest order by ord limit 50""")
def archive_listing(spark, d):
    return files.archived(captured(spark, d), since="2011", until="2016", filters=["statuscode:200", "!mimetype:application/.*"], collapse="digest", limit=50).select("ord", "original", "timestamp")


@query(f"""with c as ({CAPTURES}) select ord, original from c where regexp_matches(original, '^https?://(www\\.)?([^/]*\\.)?example\\.org(/|$|\\?)')""")
def archive_domain(spark, d):
    return files.archived(captured(spark, d), prefix="example.org", match="domain").select("ord", "original")


@query(f"""with c as ({CAPTURES}), b as (select 'https://web.archive.org/web/' || "timestamp" || 'id_/' || original u, ord from c) select ord, u snapshot from b""")
def snapshots(spark, d):
    return captured(spark, d).select("ord", U.snapshot_url(c("timestamp"), c("original")).alias("snapshot"))


@query("""with cap as (select page_id ord, 'https://x.example/' || (page_id % 60) url, strftime(date '2001-01-01' + (page_id * 13 % 4000)::int, '%Y%m%d') || '000000' ts from pages), old as (select * from cap where ts[1:8] < '20080301'),
k as (select *, row_number() over (partition by url order by ord) n from old where url not in (select 'https://x.example/' || page_id from pages where page_id % 4 = 0)) select ord, url from k where n = 1""")
def archive_extension(spark, d):
    caps = table(spark, d, "pages").select(c("page_id").alias("ord"), s("concat('https://x.example/', cast(page_id % 60 as string))").alias("url"), s("concat(date_format(date_add(date'2001-01-01', cast(page_id * 13 % 4000 as int)), 'yyyyMMdd'), '000000')").alias("timestamp"))
    live = table(spark, d, "pages").select(s("case when page_id % 7 = 0 then '0001-01-01' else concat(cast(2008 + page_id % 3 as string), '-03-01') end").alias("date"))
    ledger = table(spark, d, "pages").where("page_id % 4 = 0").select(s("concat('https://x.example/', cast(page_id as string))").alias("url"))
    return links.extended(caps, live, ledger).select("ord", "url")


@query("""select page_id, case when page_id % 5 = 0 then 'filtered' when page_id % 3 = 0 then 'failed' else 'seen' end fate from pages""")
def page_outcome(spark, d):
    return table(spark, d, "pages").select("page_id", links.link_fate(c("url"), s("case when page_id % 3 = 0 then ' ' else 'text' end"), c("page_id") % 5 != 0).alias("fate"))


@query(r"""with h as (select page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) base, regexp_extract_all(html, '<a href="([^"]*)"', 1) l, regexp_extract_all(html, '<li>(<a href="[^"]*">[^<]*)</a></li>', 1) b from pages),
x as (select page_id, base || unnest(l) link, regexp_extract(unnest(b), '>(.*)$', 1) title, unnest(range(len(l))) i from h), y as (select page_id, link, arg_min(title, i) title, min(i) i from x group by all)
select page_id, (row_number() over (partition by page_id order by i) - 1)::int ord, link, title from y""")
def listing_blocks(spark, d):
    return html.listing_meta(table(spark, d, "pages").select("page_id", "url", "html"), "li", ["a"], ["time"]).select("page_id", "ord", "link", "title")


@query("select page_id, regexp_extract(html, '<h1>([^<]*)</h1>', 1) h1 from pages")
def decoded_pages(spark, d):
    """Bytes in the charset that the page states itself, after an unknown override gave way."""
    pages = table(spark, d, "pages").select("page_id", F.replace(c("html"), F.lit('charset="utf-8"'), F.lit("charset='utf-16le'")).alias("html"))
    raw = F.encode(c("html"), "UTF-8")
    text = html.decoded(raw, override=F.lit("no-such-charset"), header=F.lit("text/html; charset=utf-8"))
    return pages.select("page_id", F.regexp_extract(text, "<h1>([^<]*)</h1>", 1).alias("h1"))


@query("""select page_id, case page_id % 4 when 0 then 'pdf' when 1 then 'zip' when 2 then 'ole' else 'other' end kind, page_id % 3 = 0 or page_id % 2 = 0 wants from pages""")
def document_kinds(spark, d):
    data = s("case page_id % 4 when 0 then unhex('0A255044462D312E34') when 1 then unhex('504B030414') when 2 then unhex('D0CF11E0A1B11AE1') else cast(html as binary) end")
    url = s("concat('https://x.example/a', case when page_id % 3 = 0 then '.PDF?x=1' else '.pdfx' end)")
    return table(spark, d, "pages").select("page_id", html.file_kind(data).alias("kind"), html.wants_document(url, s("case when page_id % 2 = 0 then 'application/pdf' else 'text/html' end")).alias("wants"))


@query("""select page_id, k::int ord, 'Talk & more <' || page_id || '>' title, 'https://x.example/?a=1&b=' || k url, '2020-01-0' || (k + 1) "date", 'Body ' || k "text" from pages, (select unnest(range(3)) k) where page_id < 200""")
def feed_entries(spark, d):
    item = lambda k: f"<item><title>Talk &amp; more &lt;', cast(page_id as string), '&#62;</title><link>https://x.example/?a=1&amp;b={k}</link><pubDate>2020-01-0{k + 1}</pubDate><description><![CDATA[Body {k}]]></description></item>"
    xml = s("concat('<rss><channel><title>x</title>" + "".join(item(k) for k in range(3)) + "</channel></rss>')")
    return files.feed(table(spark, d, "pages").where("page_id < 200").select("page_id", xml.alias("xml")))


@query("""select page_id, case when page_id % 4 = 0 then 'ok' when page_id % 4 = 1 and page_id % 6 < 4 then 'retry' when page_id % 4 = 2 and page_id % 6 < 4 then 'retry' else 'raise' end step, case when page_id % 4 = 3 and page_id % 2 = 1 then case when page_id % 3 > 0 then 'end' else 'error' end when page_id % 4 = 0 then 'page' else 'error' end fate from pages""")
def fetch_policy(spark, d):
    status = s("case page_id % 4 when 0 then 200 when 1 then 429 when 2 then null else 404 end")
    return table(spark, d, "pages").select("page_id", folds.retries(status, c("page_id") % 6, 5).alias("step"), fetch.page_fate(F.coalesce(status, F.lit(0)), c("page_id") % 3).alias("fate"))


@query("""select event_id, 'https://www.youtube.com/watch?v=v' || event_id url, 'a, b' tags, coalesce(nullif(event_type, 'error'), 'up') channel, case when value > 100 then '' else value::varchar end duration from events where value between 20 and 150 and strftime(ts, '%Y%m%d') >= '20240101'""")
def media_entries(spark, d):
    rows = table(spark, d, "events").select(
        "event_id", s("concat('v', cast(event_id as string))").alias("id"), F.lit(None).cast("string").alias("webpage_url"), s("array('a', '', null, 'b')").alias("tags"), s("nullif(event_type, 'error')").alias("channel"), F.lit("up").alias("uploader"),
        s("date_format(ts, 'yyyyMMdd')").alias("upload_date"), c("value").alias("duration"))
    return media.normalised(media.wanted(rows, date_min="20240101", min_duration=20, max_duration=150)).select("event_id", "url", "tags", "channel", s("case when duration > 100 then '' else cast(duration as string) end").alias("duration"))


# single functions


@query("""select doc_id, case shape when 3 then day when 4 then day else day end iso from v_heads where y >= 1900""")
def parse_date(spark, d):
    names = {"es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre", "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre", "de": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember"}
    month = {k: F.element_at(F.array(*[F.lit(x) for x in v.split()]), c("m")) for k, v in names.items()}
    n = lambda x: c(x).cast("string")
    raw = (
        F.when(c("shape") == 0, F.concat(F.lit("Buenos Aires, "), n("d"), F.lit(" de "), month["es"], F.lit(" de "), n("y"))).when(c("shape") == 1, F.concat(F.lit("Publié le "), n("d"), F.lit(" "), month["fr"], F.lit(" "), n("y"), F.lit(" à Paris")))
        .when(c("shape") == 2, F.concat(n("d"), F.lit(". "), month["de"], F.lit(" "), n("y"))).when(c("shape") == 3, F.concat(c("day"), F.lit("T10:00:00Z"))).when(c("shape") == 4, F.concat(n("d"), F.lit("/"), n("m"), F.lit("/"), n("y")))
        .when(c("shape") == 5, F.concat(F.lit("vom "), n("d"), F.lit("."), n("m"), F.lit("."), n("y"), F.lit(", 12 Uhr"))).when(c("shape") == 6, F.concat(n("y"), F.lit("年"), n("m"), F.lit("月"), n("d"), F.lit("日"))).otherwise(F.concat(F.lit("on "), c("day")))
    )
    return view(spark, d, "v_heads").select("doc_id", D.parse_date(raw, max_year=F.lit(2030)).alias("iso"))


@query("""select event_id, case event_id % 4 when 0 then '2024-03-10' when 1 then '2024-03-09' when 2 then (date '2024-03-10' - (event_id % 20)::int)::varchar else (date '2024-03-10' - 7 * (event_id % 20)::int)::varchar end iso from events""")
def relative_date(spark, d):
    raw = s("case event_id % 4 when 0 then 'Today, 10:30' when 1 then 'posted yesterday' when 2 then concat(cast(event_id % 20 as string), ' days ago') else concat(cast(event_id % 20 as string), ' weeks ago') end")
    return table(spark, d, "events").select("event_id", D.parse_date(raw, ["en"], today=F.lit("2024-03-10")).alias("iso"))


@query("""select doc_id, day upload, case when y % 100 < 69 then 2000 + y % 100 else 1900 + y % 100 end "year", case when m > 12 then null else day end short_url_date from v_heads""")
def upload_dates(spark, d):
    url = s("concat('https://x.example/sp', lpad(cast(d as string), 2, '0'), lpad(cast(m as string), 2, '0'), lpad(cast(y % 100 as string), 2, '0'), '.html')")
    return view(spark, d, "v_heads").select("doc_id", D.upload_date(F.replace(c("day"), F.lit("-"), F.lit(""))).alias("upload"), D.full_year(c("y") % 100).alias("year"), D.url_date(url, r"/sp(\d{2})(\d{2})(\d{2})\.", 3, 2, 1).alias("short_url_date"))


@query("""with k as (values ('Germany', 'DEU', '276'), ('ukraine', 'UKR', '804'), ('FRA', 'FRA', '250'), ('us', 'USA', '840'), ('Atlantis', 'XXX', null), ('Slovenia', 'SVN', '705'), ('Japan', 'JPN', '392'), ('Brazil', 'BRA', '076'))
select doc_id, col0 country, col1 iso3, col2 iso3n from documents, k where (doc_id % 8) = case col0 when 'Germany' then 0 when 'ukraine' then 1 when 'FRA' then 2 when 'us' then 3 when 'Atlantis' then 4 when 'Slovenia' then 5 when 'Japan' then 6 else 7 end""")
def country_codes(spark, d):
    names = F.array(*[F.lit(x) for x in ("Germany", "ukraine", "FRA", "us", "Atlantis", "Slovenia", "Japan", "Brazil")])
    docs = table(spark, d, "documents").select("doc_id", F.get(names, (c("doc_id") % 8).cast("int")).alias("country"))
    return countries.with_codes(docs).select("doc_id", "country", "iso3", c("ISO3N").alias("iso3n"))


@query("""select doc_id, case lang when 'en' then 'eng_Latn' when 'de' then 'deu_Latn' when 'fr' then 'fra_Latn' when 'es' then 'spa_Latn' end code, lang hint from documents""")
def translation_codes(spark, d):
    iso = languages.source_language(c("lang"), F.lit(None).cast("string"))
    return table(spark, d, "documents").select("doc_id", languages.translator_code(iso).alias("code"), languages.date_hint(c("lang"), F.lit(None).cast("string")).alias("hint"))


@query("""select doc_id, case when doc_id % 3 = 0 or doc_id % 2 = 0 then 'Model' else 'Site' end speaker, case when doc_id % 5 = 0 then 'Listing' else 'Page' end title, case when doc_id % 5 = 0 then ['title'] else [] end filled,
  case doc_id % 4 when 0 then true when 1 then false else doc_id % 2 = 0 and doc_id % 7 < 3 end approved from documents""")
def corrections(spark, d):
    site, page = s("case when doc_id % 3 = 0 then ' ' else 'Site' end"), s("case when doc_id % 5 = 0 then '' else 'Page' end")
    word, sure = s("case doc_id % 4 when 0 then 'Yes' when 1 then 'no' else '' end"), s("case when doc_id % 7 < 2 then 'high' when doc_id % 7 = 2 then 'Medium' else 'low' end")
    return table(spark, d, "documents").select(
        "doc_id", gate.corrected(site, F.lit("Model"), s("case when doc_id % 2 = 0 then 'No' else 'yes' end")).alias("speaker"), gate.from_entry(page, F.lit("Listing")).alias("title"),
        gate.filled_names(title=(page, F.lit("Listing")), date=(F.lit("x"), F.lit("y"))).alias("filled"), gate.approved(word, c("doc_id") % 2 == 0, sure).alias("approved"))


@query(r"""select page_id, rtrim(ltrim(regexp_replace(lower(regexp_extract(html, '<title>([^<]*)</title>', 1)), '[^a-z0-9]+', '-', 'g'), '-')[1:60], '-') slug, page_id % 4 = 0 yes, case when regexp_matches(url, '[?&]page=') then regexp_replace(url, '([?&]page=)[^&#]*', '\1' || page_id) when contains(url, '?') then url || '&page=' || page_id else url || '?page=' || page_id end paged,
  case when regexp_matches(url, '/(es|en)/(\d+)') then regexp_extract(url, '/(es|en)/(\d+)', 2) end part from (select page_id, html, regexp_replace(url, '#.*$', '') url from pages)""")
def small_functions(spark, d):
    pages = table(spark, d, "pages").select("page_id", "html", F.regexp_replace("url", "#.*$", "").alias("url"))
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return pages.select("page_id", T.slug(title).alias("slug"), T.truthy(s("case page_id % 4 when 0 then ' TRUE ' when 1 then '0' when 2 then null else 'nope' end")).alias("yes"), U.with_param(c("url"), "page", c("page_id")).alias("paged"), U.url_match(c("url"), r"/(?P<l>es|en)/(\d+)", 2).alias("part"))


@query("""select doc_id, case when length(t) > 120 then (case when strpos(t, '. ') > 0 then t[1:strpos(t, '. ') - 1] else t end)[1:120] else t end cell from (select doc_id, case when doc_id % 2 = 0 then 'Short. One' else 'First sentence here. ' || repeat('and on ', 30) end t from documents)""")
def public_cells(spark, d):
    rows = table(spark, d, "documents").select("doc_id", s("case when doc_id % 2 = 0 then 'Short. One' else concat('First sentence here. ', repeat('and on ', 30)) end").alias("cell"), F.lit("secret").alias("internal"))
    return files.public_list(rows, ["doc_id", "cell", "not_there"]).select(c("doc_id").cast("long").alias("doc_id"), "cell")


@query("""select event_id, 'speech' document_type, case when event_id % 3 = 0 then null else 'de' end "language", 'True' is_first_person, null::varchar speaker, '1990-01-02' "date" from events""")
def reply_fields(spark, d):
    raw = F.concat(F.lit('{"document_type": " speech ", "is_first_person": true, "speaker": null, "date": "1990-01-02", "language": "'), s("case when event_id % 3 = 0 then '  ' else 'de' end"), F.lit('"}'))
    return table(spark, d, "events").select("event_id", enrich.reply(raw).alias("r")).select("event_id", "r.document_type", "r.language", F.initcap("r.is_first_person").alias("is_first_person"), "r.speaker", "r.date")
