"""Views of the test tables in the shapes that the operators take; the same SQL runs in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: By name, SQL over the tables.
VIEWS = {
    "v_rows": """select source as source_id, doc_id as ord, cast(doc_id as string) as doc_id, text, lang as title, '' as capture,
        case doc_id % 4 when 0 then 'https://a.example/news/1234/x' when 1 then 'http://www.a.example:80/news/1234/x/?q=1'
        when 2 then 'https://b.example/news/1234/x' else 'https://a.example/talks/99/y-2' end as url from documents""",
    "v_urls": """select page_id * 5 as ord, url from pages union all select page_id * 5 + 1, concat(replace(url, 'https://', 'http://'), '') from pages where page_id % 3 = 0
        union all select page_id * 5 + 2, concat(url, case when url like '%?%' then '&' else '?' end, 'utm_source=x') from pages where page_id % 4 = 0 and url not like '%#%'
        union all select page_id * 5 + 3, replace(url, '://', '://www.') from pages where page_id % 5 = 0 and url not like '%www.%'""",
    "v_ledger": "select url from pages where page_id % 6 = 0",
    "v_heads": """select o_orderkey as doc_id, cast(cast(o_orderdate as date) as string) as day, year(o_orderdate) as y, month(o_orderdate) as m, day(o_orderdate) as d, o_orderkey % 8 as shape from orders""",
    "v_meta": """select d.doc_id, case d.doc_id % 5 when 0 then 'Speech' when 1 then 'interview' when 2 then 'official_statement' when 3 then 'other' else '' end as document_type,
        case when d.doc_id % 7 = 0 then ' ' else concat('Speaker ', cast(d.doc_id % 11 as string)) end as speaker,
        case d.doc_id % 6 when 0 then 'head_of_state' when 1 then 'foreign_visitor' when 2 then 'other_minister' when 3 then 'unknown' when 4 then 'both' else 'other' end as speaker_type,
        case d.doc_id % 3 when 0 then 'exact' when 1 then 'none' else 'other_country' end as tenure,
        case d.doc_id % 2 when 0 then 'yes' else 'no' end as first_person, case d.doc_id % 4 when 0 then 'no' else 'yes' end as substantive, l.quality, l.toxic
        from documents d left join labels l on l.doc_id = d.doc_id""",
    "v_key": """select s_suppkey * 3 + k as ord, concat(case s_suppkey % 6 when 0 then 'José' when 1 then 'Anna' when 2 then 'Zoë' when 3 then 'Omar' when 4 then 'Li' else 'Maria' end, ' ',
        case s_suppkey % 9 when 0 then 'Núñez' when 1 then 'Weber' when 2 then 'Okafor' when 3 then 'Silva' when 4 then 'Haddad' when 5 then 'Novak' when 6 then 'Tanaka' when 7 then 'Lund' else 'Ali' end) as speaker,
        n_name as country, 1992 + cast(s_suppkey % 5 as int) + k as year, s_suppkey % 2 = 0 as is_ceremonial
        from supplier join nation on n_nationkey = s_nationkey cross join (select 0 as k union all select 1 union all select 2) k""",
    "v_people": """select c_custkey as ord, concat(case c_custkey % 5 when 0 then 'Jose' when 1 then 'ANNA' when 2 then 'Zoe' when 3 then 'Maria' else 'Peter' end, ' ',
        case c_custkey % 7 when 0 then 'Nunez' when 1 then 'weber' when 2 then 'Okafor' when 3 then 'Sund' when 4 then 'haddad' when 5 then 'Novák' else 'Stone' end) as speaker,
        n_name as country, 1990 + cast(c_custkey % 9 as int) as year, case c_custkey % 3 when 0 then 'President' when 1 then 'Prime Minister' else '' end as position
        from customer join nation on n_nationkey = c_nationkey""",
    "v_events": "select event_type as source_id, event_id as ord, value > 50 as failed, value > 90 as throttled, event_id % 10 = 3 as filtered from events where value is not null",
    "v_dups": """select concat('s', cast(doc_id % 3 as string)) as source_id, 'XYZ' as country, doc_id as ord, cast(doc_id as string) as doc_id, lang as title, case when j % 2 = 0 then concat('2015010', cast(j as string)) else '' end as capture,
        case when t = 3 and j = 0 then ' ' else concat(case when j % 2 = 1 then '  ' else '' end, body) end as text, case when t = 3 and j = 0 then upper(body) else '' end as text_originlanguage,
        case t when 0 then concat('https://a.example/stub/', cast(c as string)) when 1 then concat(case j % 3 when 0 then 'https://www.a.example/x/' when 1 then 'http://a.example:80/x/' else 'https://A.example/x/' end, cast(c as string), case j % 3 when 0 then '/' when 1 then '?q=1' else '' end)
          when 2 then concat('https://h', cast(j as string), '.example/same/', cast(c as string)) when 3 then concat('https://a.example/news/', cast(1000 + c as string), '/slug', cast(j as string))
          when 4 then concat('https://a.example/talks/peace', cast(c as string), 'x-', cast(j as string)) else concat('https://a.example/p', cast(j as string), '/item', cast(c as string), 'y', cast(j as string)) end as url
        from (select *, case c % 6 when 0 then concat('Page not found in cluster ', cast(c as string)) else repeat(concat('Words of cluster ', cast(c as string), ' go on. '), 20) end as body, c % 6 as t
          from (select *, cast(floor(doc_id / 18) as bigint) as c, cast(floor(doc_id / 3) as bigint) % 6 as j from documents ) a) b""",
    "v_lists": """select concat('src', cast(page_id % 12 as string)) as source_id, concat('f', cast(page_id % 12 as string), '_', cast(k as string)) as file, case when page_id % 12 = 5 then 'probe' when k = 0 then 'run' else 'probe' end as kind,
        case when k = 1 and page_id % 2 = 0 then concat('http://www.', substring(url, 9)) else url end as url, case when page_id % 12 = 3 then cast(null as string) else '/(en|de)/' end as pattern,
        page_id % 12 = 1 and k = 0 as stopped_early, page_id % 12 = 2 as capped, page_id % 12 = 4 and k = 1 as page1_only
        from pages cross join (select 0 as k union all select 1 union all select 2) kk where page_id % (k * 2 + 1) = 0 and url like 'https://%'""",
    "v_clean": """select d.doc_id as ord, cast(d.doc_id as string) as doc_id, k.n_name as country, concat(case d.doc_id % 5 when 0 then 'Jose' when 1 then 'ANNA' when 2 then 'Zoe' when 3 then 'Maria' else 'Peter' end, ' ',
        case d.doc_id % 7 when 0 then 'Nunez' when 1 then 'weber' when 2 then 'Okafor' when 3 then 'Sund' when 4 then 'haddad' when 5 then 'Novak' else 'Stone' end) as speaker,
        case d.doc_id % 5 when 0 then 'Speech' when 1 then 'interview' when 2 then 'official_statement' when 3 then 'other' else '' end as document_type,
        case d.doc_id % 6 when 0 then 'head_of_state' when 1 then 'foreign_visitor' when 2 then 'other_minister' when 3 then 'unknown' when 4 then 'both' else 'other' end as speaker_type,
        case d.doc_id % 2 when 0 then 'yes' else 'no' end as is_first_person, case d.doc_id % 4 when 0 then 'no' else 'yes' end as is_substantive, concat(cast(1990 + d.doc_id % 9 as string), '-03-04') as date,
        case d.doc_id % 11 when 0 then 'error_call' when 1 then 'accepted' else 'rejected_foreign' end as clean_status, 'as it was' as gate_reason, 'none' as tenure_match, cast(null as string) as tenure_matched_name,
        cast(null as boolean) as is_ceremonial, false as speaker_review, cast(null as string) as inclusion_tier
        from documents d join nation k on k.n_nationkey = d.doc_id % 25""",
}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``VIEWS``; its tables are passed by name, so no state stays in the session."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if f" {t}" in f" {VIEWS[name]} "}
    body = f" {VIEWS[name]} "
    for t in used:
        for before in ("from ", "join "):
            body = body.replace(f"{before}{t} ", f"{before}{{{t}}} ")
    return spark.sql(body.strip(), **used)


def with_views(sql: str) -> str:
    """``sql`` for the other engine, with the views that it names in front."""
    named = [f"{n} as ({v.replace('as string)', 'as varchar)')})" for n, v in VIEWS.items() if n in sql]
    head = f"with {', '.join(named)}" if named else ""
    body = sql.strip()
    if body.startswith("with recursive "):
        return f"with recursive {head[5:]}, {body[15:]}" if head else body
    if body.startswith("with "):
        return f"{head}, {body[5:]}" if head else body
    return f"{head} {body}"
