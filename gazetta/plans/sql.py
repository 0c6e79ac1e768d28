"""The queries in DuckDB SQL, where SQL can express them. HTML trees and collations beyond ASCII are held by tests instead."""

from __future__ import annotations

from gazetta.functions import flags
from gazetta.operators.browse import FACETS
from gazetta.operators.lifecycle import BLOCKED, CHALLENGES, ENDED, STATES
from gazetta.plans.views import FEED_ORDERS, MOMENTS
from gazetta.sources.feed import SUMMARY_COLUMNS

TODAY, NOW = "'1996-06-15'", 10 * 60 + 30
DATED = "coalesce(regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') and try_cast({c} as date) is not null and {c} >= '0100', false)"
TIMED = "regexp_full_match({c}, '(([01][0-9]|2[0-3]):[0-5][0-9])?')"
IS_DATE, IS_TIME = DATED.format(c="closing_date"), TIMED.format(c="closing_time")
GONE = f"({IS_DATE} and {IS_TIME} and (closing_date < {TODAY} or (closing_date = {TODAY} and closing_time <> '' and {NOW} >= try_cast(closing_time[1:2] as int) * 60 + try_cast(closing_time[4:5] as int))))"
SAFE = "(trim(apply_url) <> '' and lower(regexp_extract(trim(apply_url), '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) in ('', 'http', 'https'))"
VISIBLE = f"{FEED_ORDERS}, vis as (select * from feed where not {GONE} and {SAFE})"
CLOSING = f"case when {IS_DATE} then strftime(try_cast(closing_date as date), '%-d %b %Y') || case when closing_time <> '' and {IS_TIME} then ', ' || closing_time else '' end else 'Closing date not stated' end"
DAYS = f"case when {IS_DATE} then date_diff('day', date {TODAY}, try_cast(closing_date as date)) end"
URGENCY = f"case {DAYS} when 0 then 'Closes today' when 1 then 'Closes tomorrow' else case when {DAYS} between 2 and 7 then 'Closes in ' || {DAYS} || ' days' else '' end end"
TIME = f"case when closing_time <> '' and {IS_TIME} then closing_time else '23:59' end"
PART = {k: f"regexp_extract({{u}}, '(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?', {k})" for k in (1, 2, 3, 4)}
SCHEME, HOST, PATH, QUERY = (PART[k].format(u="url") for k in (1, 2, 3, 4))
COUNTS = "counts as (select trim(apply_url) as u, count(*) as n from feed where trim(apply_url) <> '' group by 1)"
WS = r"[\s\x0b\x1c-\x1f\x85\xa0]"
CLEAN = rf"trim(regexp_replace({{c}}, '{WS}+', ' ', 'g'))"
FOLD = f"replace(lower({CLEAN}), 'ß', 'ss')"
N_WORDS = f"case when {CLEAN} = '' then 0 else len(string_split({CLEAN}, ' ')) end"


def sort_sql(order: str) -> str:
    return f"with {FEED_ORDERS} select rec_no, row_number() over (order by {order}, rec_no) as rank from feed"


def flag_sql(rules, column: str) -> str:
    """A comma-joined list of distinct flags in rule order."""
    cases = []
    for code, how, p in rules:
        test = {"<": f"n < {p}", "=": f"n = {p}"}.get(how)
        if test is None:
            rx = p.replace(r"\z", "$").replace("'", "''")
            test = f"regexp_matches({column}, '{rx}'{', chr(105)' if how == 'i' else ''})".replace("chr(105)", "'i'")
        cases.append(f"case when {test} then '{code}' end")
    every = f"list_filter([{', '.join(cases)}], lambda x: x is not null)"
    return f"array_to_string(list_filter({every}, lambda x, i: list_position({every}, x) = i), ',')"


def rules_sql(rules: dict[str, str]) -> str:
    return "list_filter([" + ", ".join(f"case when {t} then '{c}' end" for c, t in rules.items()) + "], lambda x: x is not null)"


def listed(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


STATE = "list_value" + listed(STATES)
DOC_FEED = "docs as (select doc_id + 2 as n, coalesce(source, '') as organization, coalesce(lang, '') as job_title, doc_id::varchar as job_reference, coalesce(text, '') as job_summary from documents)"
PAGE_BASE = f"base as (select page_id as rec_no, string_split({PATH}, '/')[2] as organization, url as apply_url, {HOST} as host from pages)"
DECISIONS = """dec as (select doc_id as identity, case when quality = 1 then 'include' when doc_id % 2 = 0 then 'exclude' else 'maybe' end as outcome,
  doc_id % 11 = 0 as unreasoned, doc_id % 13 = 0 as holes, doc_id % 5 = 0 as blank, case when doc_id % 7 <> 0 then toxic = 1 end as shared from labels)"""
RUNS = f"""runs as (select user_id as source_id, {STATE}[user_id % 6 + 1] as status, user_id % 6 <> 0 as started, user_id % 5 <> 0 as finished,
  case when user_id % 4 = 0 then 0 else count(*) end as n, user_id % 2 = 0 as done, count(*) filter (event_type = 'error') > 3 as limited, user_id % 7 = 0 as failed from events group by user_id)"""
AUDITED = f"{FEED_ORDERS}, told as (select feed.*, rec_no % 6 = 0 as blank, apply_url in (select trim(apply_url) from feed where trim(apply_url) <> '' group by 1 having count(*) > 1) as shared from feed)"
RUN_RULES = {
    "not_started_with_progress": "status = 'NOT_STARTED' and (started or finished or n <> 0 or done)",
    "running_not_started": "status = 'RUNNING' and not started",
    "running_but_finished": "status = 'RUNNING' and (finished or done)",
    "message_before_end": "status in ('NOT_STARTED', 'RUNNING') and (limited or failed)",
    "ended_without_times": f"status in {listed(ENDED)} and not (started and finished)",
    "empty_with_candidates": "status = 'EMPTY' and (not done or n <> 0)",
    "ok_without_candidates": "status = 'OK' and (not done or n = 0)",
    "message_on_success": "status in ('EMPTY', 'OK') and (limited or failed)",
    "partial_without_limitation": "status = 'PARTIAL' and not limited",
    "error_without_text": "status = 'ERROR' and not failed",
}
DECISION_RULES = {
    "reason_missing": "unreasoned",
    "outcome_unknown": "outcome = 'maybe'",
    "row_incomplete": "outcome = 'include' and holes",
    "destination_not_assessed": "outcome = 'include' and shared is null",
    "shared_reason_missing": "outcome = 'include' and coalesce(shared, false)",
    "summary_reason_missing": "outcome = 'include' and blank",
}
REPEATED = f"""{DOC_FEED}, keyed as (select n, {FOLD.format(c="job_summary")} as s, {FOLD.format(c="organization")} || chr(1) || {FOLD.format(c="job_title")} || chr(1) || {FOLD.format(c="job_reference")} as role from docs where {N_WORDS.format(c="job_summary")} >= 30),
  rep as (select min(n) as first_row, count(*)::int as n, string_agg(n::varchar, ',' order by n) as rows from keyed group by s having count(distinct role) > 1)"""
SUMMARY_FLAGS = f"case when {CLEAN.format(c='t')} = '' then '{flags.BLANK}' else {flag_sql(flags.RESIDUE + flags.SUMMARY, 't')} end"
DOC_FLAGS = f"flagged as (select doc_id, {SUMMARY_FLAGS} as flags from (select doc_id, coalesce(text, '') as t, {N_WORDS.format(c='coalesce(text, chr(32))')} as n from documents))"

STEPS = f"steps as (select user_id as source_id, event_id as at_, {STATE}[(event_id * 5 + user_id) % 6 + 1] as status from events)"
DETAILS = f"""p as (select page_id as place, {HOST} as source_id, page_id % 7 = 0 as done, page_id % 37 = 0 and page_id % 11 <> 0 as denied, page_id % 53 = 0 and page_id % 11 <> 0 and page_id % 41 <> 0 and page_id % 43 <> 0 as checked,
  page_id % 11 = 0 or page_id % 41 = 0 or page_id % 43 = 0 as failed from pages),
r as (select *, case when done then 'reused' when denied or checked then 'withheld' when failed then 'failed' else 'read' end as one from p),
e as (select source_id, min(place) filter (one = 'withheld') as e from r group by source_id),
details as (select source_id, place::varchar as detail_url, place, case when place > e then 'unread' else one end as result from r join e using (source_id))"""

GROUPED = f"""{REPEATED}, {DOC_FLAGS}, keyed_docs as (select n, {FOLD.format(c="organization")} as e, organization, {CLEAN.format(c="job_summary")} = '' as blank from docs),
g as (select e, min_by(organization, n) as organization, min(n) as first, count(*) as c, bool_and(blank) as blank from keyed_docs group by 1 having count(*) >= 3 and e <> ''),
blanks as (select e, organization, first, c, 'salary' as field from g union all select e, organization, first, c, 'job_summary' from g where blank)"""
REASON = f"case code {' '.join(f"when '{c}' then '{r}'" for c, r in flags.REASONS.items())} else upper(code[1]) || lower(replace(code[2:], '_', ' ')) end"

UNESCAPED = "replace(replace(replace(replace({c}, '&quot;', chr(34)), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')"

SQL = {
    "browse_default": f"""with {VISIBLE}, {COUNTS}, hit as (select vis.*, coalesce(counts.n, 0) as link_count from vis left join counts on u = trim(apply_url)
  where job_area = 'BUILDING' and (contains(lower(job_title), 'urgent') or contains(lower(organization), 'urgent') or contains(lower(job_area), 'urgent') or contains(lower(location), 'urgent') or contains(lower(location_area), 'urgent')))
select rec_no, job_title as title, organization, job_area, work_pattern, coalesce(nullif(location, ''), nullif(location_area, ''), 'Location not stated') as location, coalesce(nullif(salary, ''), 'Salary not stated') as salary,
  {CLOSING} as closing, {URGENCY} as urgency, link_count > 1 as is_shared, case when link_count > 1 then 'Open vacancies page' else 'View & Apply' end as label,
  case when link_count > 1 then 'Open vacancies page: ' || job_title || '. Reference ' || job_reference else 'View & Apply: ' || job_title end as aria_label, case when link_count > 1 then job_reference else '' end as reference,
  row_number() over (order by not {IS_DATE}, case when {IS_DATE} then closing_date || 'T' || {TIME} else '' end, job_title, rec_no) as rank from hit""",
    "visible_jobs": f"with {VISIBLE} select rec_no, closing_date, closing_time, apply_url from vis",
    "visible_count": f"with {VISIBLE} select count(*) as n, count(*) || case when count(*) = 1 then ' job' else ' jobs' end || ' found' as heading from vis",
    "urgency_labels": f"with {FEED_ORDERS} select rec_no, {URGENCY} as urgency, {CLOSING} as closing from feed",
    "keyword_any_field": "select doc_id from documents where contains(lower(coalesce(text, '')), 'the') or contains(lower(coalesce(source, '')), 'the')",
    "facet_options": f"with {VISIBLE} " + " union all ".join(f"select distinct '{f}' as facet, {f} as value from vis where {f} <> ''" for f in FACETS),
    "sort_soonest": sort_sql(f"not {IS_DATE}, case when {IS_DATE} then closing_date || 'T' || {TIME} else '' end, job_title"),
    "sort_latest": sort_sql(f"not {IS_DATE}, case when {IS_DATE} then closing_date || 'T' || {TIME} else '' end desc, job_title"),
    "sort_org_az": sort_sql("organization, job_title"),
    "sort_title_az": sort_sql("job_title, organization"),
    "shared_link_counts": f"with {FEED_ORDERS}, {COUNTS} select rec_no, coalesce(n, 0) as link_count, coalesce(n, 0) > 1 as is_shared from feed left join counts on u = trim(apply_url)",
    "shared_hosts": f"select page_id, count(*) over (partition by {HOST}) as link_count from pages",
    "newest_checked": "select coalesce(max(strftime(ts, '%Y-%m-%d')), '') as newest from events",
    "display_fallbacks": "select d.doc_id, coalesce(l.q, nullif(d.lang, ''), 'not stated') as shown from documents d left join (select doc_id, max(quality)::varchar as q from labels group by doc_id) l using (doc_id)",
    "url_parts": f"select page_id, lower({SCHEME}) as scheme, {HOST} as authority, {PATH} as path, {QUERY} as query from pages",
    "safe_url": f"""select page_id, u <> '' and s in ('', 'http', 'https') as browser_safe, s in ('http', 'https') and {PART[2].format(u="u")} <> '' as absolute from (select *, lower({PART[1].format(u="u")}) as s
  from (select page_id, case when page_id % 7 = 0 then 'ftp:' || url when page_id % 5 = 0 then '' when page_id % 3 = 0 then '/jobs/1' else url end as u from pages))""",
    "query_param": f"select page_id, regexp_extract(q, '(?:^|&)page=([^&]+)', 1) as page, regexp_extract(q, '(?i)(?:^|&)ref=([^&]+)', 1) as ref, regexp_matches(q, '(?i)(^|&)page(=|&|$)') as has_page from (select page_id, {QUERY} as q from pages)",
    "slug": f"select page_id, string_split(rtrim({PATH}, '/'), '/')[-1] as slug from pages",
    "same_site_links": f"select a.page_id, {PART[2].format(u='b.url')} = {PART[2].format(u='a.url')} as same_site from pages a join pages b on a.page_id = b.page_id + 1",
    "redirect_guard": f"select page_id, not regexp_matches({QUERY}, '(^|&)ref=x') as kept from pages",
    "participant_links": f"""select page_id, case when page_id % 2 = 0 and (page_id % 3 = 0 or page_id % 4 <> 0) then 'https://board.example.org/'
  else lower({SCHEME}) || '://' || {HOST} || '/?' || case when page_id % 3 = 0 then 'USESSION=1' else 'a=1' end end as destination from pages""",
    "sha256_text": "select doc_id, sha256(coalesce(text, '')) as sha256 from documents",
    "html_escape": "select page_id, sha256(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')) as sha256 from pages",
    "html_links": "select page_id, cast(i - 1 as int) as pos, h[i] as href from (select page_id, h, unnest(range(1, len(h) + 1)) as i from (select page_id, regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1) as h from pages))",
    "access_challenges": "select page_id, " + " or ".join("contains(lower(html), '" + c.replace("'", "''") + "')" for c in CHALLENGES) + f" as challenged, regexp_matches(html, '{BLOCKED}') as blocked from pages",
    "markup_residue": f"select page_id, {flag_sql(flags.RESIDUE, 'html')} as flags from pages",
    "salary_flags": f"select page_id, {flag_sql(flags.RESIDUE + flags.SALARY, 's')} as flags from (select page_id, 'Location: ' || {PATH} as s from pages)",
    "summary_flags": f"with {DOC_FLAGS} select doc_id, flags from flagged",
    "word_counts": f"select doc_id, cast({N_WORDS.format(c='t')} as int) as words from (select doc_id, coalesce(text, '') as t from documents)",
    "repeated_summary": f"with {REPEATED} select first_row, n, rows from rep",
    "group_all_blank": f"""with {DOC_FEED}, g as (select {FOLD.format(c="organization")} as e, min_by(organization, n) as organization, count(*) as n, bool_and({CLEAN.format(c="job_summary")} = '') as blank from docs group by 1)
select 'salary' as field, organization, n::int as n from g where n >= 3 and e <> '' union all select 'job_summary', organization, n::int from g where n >= 3 and e <> '' and blank""",
    "finding_report": f"""with {REPEATED}, {DOC_FLAGS}, g as (select {FOLD.format(c="organization")} as e, count(*) as c, bool_and({CLEAN.format(c="job_summary")} = '') as blank from docs group by 1)
select true as advisory_only, (select count(*) from documents) as row_count, (select count(*) from rep) + (select count(*) filter (blank) + count(*) from g where c >= 3 and e <> '')
  + (select coalesce(sum(len(string_split(flags, ','))), 0)::bigint from flagged where flags <> '') as finding_count""",
    "quality_findings": f"""with {REPEATED}, {DOC_FLAGS}, g as (select {FOLD.format(c="organization")} as e, count(*) as c, bool_and({CLEAN.format(c="job_summary")} = '') as blank from docs group by 1),
  every as (select unnest(string_split(flags, ',')) as code, 'job_summary' as field from flagged where flags <> '' union all select 'repeated_summary', 'job_summary' from rep
  union all select 'employer_field_entirely_blank', 'salary' from g where c >= 3 and e <> '' union all select 'employer_field_entirely_blank', 'job_summary' from g where c >= 3 and e <> '' and blank)
select code, field, case code {" ".join(f"when '{c}' then '{r}'" for c, r in flags.REASONS.items())} else upper(code[1]) || lower(replace(code[2:], '_', ' ')) end as reason, count(*) as n from every group by code, field""",
    "exact_cover_gaps": """select coalesce(d.doc_id, l.doc_id) as identity, case when d.doc_id is null then 'unknown' when l.doc_id is null then 'missing' else 'repeated' end as problem
from (select distinct doc_id from documents) d full outer join (select doc_id, count(*) as n from labels group by doc_id) l on d.doc_id = l.doc_id where d.doc_id is null or l.doc_id is null or n > 1""",
    "decision_violations": f"with {DECISIONS} select identity, unnest({rules_sql(DECISION_RULES)}) as code from dec",
    "decision_include": f"with {DECISIONS} select identity from dec where outcome = 'include'",
    "decision_exclude": f"with {DECISIONS} select identity from dec where outcome = 'exclude'",
    "partition_split": f"""with {PAGE_BASE} select rec_no, case when host = 'tionsh.example.net' then 's0' when host = 'ththre.example.com' and (organization = 'en' or contains(apply_url, '/fr/')) then 's1' when host = 'therha.example.com' then 's2' end as source_id from base""",
    "keyword_parts": "select p_partkey from part where contains(lower(coalesce(p_name, '')), 'al') or contains(lower(coalesce(p_brand, '')), 'al') or contains(lower(coalesce(p_type, '')), 'al')",
    "source_counts": """select source_id, coalesce(max(b), 0) as baseline_rows, coalesce(max(f), 0) as fresh_rows, coalesce(max(x), 0) as excluded from (
  select source as source_id, count(*) as b, null as f, null as x from documents where source is not null group by 1 union all
  select source, null, count(*) filter (quality = 1), count(*) filter (quality is distinct from 1) from labels join documents using (doc_id) group by 1) group by 1""",
    "baseline_guard": "select o_orderkey as rec_no, 'other_day' as code from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey where o_orderstatus = 'P'",
    "merge_union": f"with {FEED_ORDERS} select job_reference, organization from feed",
    "feed_lines": f"with {FEED_ORDERS} select concat_ws(',', " + ", ".join(SUMMARY_COLUMNS).replace("salary", "case when contains(salary, ',') then '\"' || salary || '\"' else salary end") + ") as line from feed",
    "semi_membership": "select l_partkey, count(*) as n from lineitem where l_partkey in (select p_partkey from part where p_size <= 25) group by l_partkey",
    "anti_unmatched": "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)",
    "audit_counts": f"with {AUDITED} select count(*) as total_rows, count(*) filter (not shared) as job_specific_apply_urls, count(*) filter (shared) as shared_apply_urls, count(*) filter (not blank) as nonblank_summaries, count(*) filter (blank) as blank_summaries from told",
    "inherited_exceptions": f"with {AUDITED} select job_reference, shared as shared_apply_url, blank as blank_summary from told where shared or blank",
    "identity_conflicts": "select l_orderkey, l_linenumber, count(*) as rows from lineitem group by l_orderkey, l_linenumber having count(distinct (l_partkey, l_suppkey)) > 1",
    "duplicate_candidates": f"""with p as (select {HOST} as source_id, {PATH} as detail_url, {QUERY} as source_platform_id from pages)
select source_id, 'detail_url' as field, detail_url as value, count(*) as n from p where detail_url <> '' group by all having count(*) > 1
union all select source_id, 'source_platform_id', source_platform_id, count(*) from p where source_platform_id <> '' group by all having count(*) > 1""",
    "completeness_check": """select o_orderkey as l_orderkey, o_orderkey % 7 + 1 as advertised, true as counts_agree, coalesce(u, 0) as unique_identities,
  case when coalesce(u, 0) > o_orderkey % 7 + 1 then 'over' when coalesce(u, 0) < o_orderkey % 7 + 1 then 'short' else 'equal' end as verdict
from orders left join (select l_orderkey, count(distinct l_linenumber) as u from lineitem group by l_orderkey) on l_orderkey = o_orderkey""",
    "run_violations": f"with {RUNS} select source_id, unnest({rules_sql(RUN_RULES)}) as code from runs",
    "run_outcome": f"with {RUNS} select source_id, case when done and n > 0 then 'OK' when done then 'EMPTY' when n > 0 then 'PARTIAL' else 'ERROR' end as outcome from runs",
    "run_counters": "select user_id as source_id, count(*) as listed, count(*) filter (event_type = 'view') as detail_complete from events group by user_id",
    "transition_check": f"""select *, coalesce((before is null and status = 'NOT_STARTED') or (before = 'NOT_STARTED' and status = 'RUNNING') or (before = 'RUNNING' and status in {listed(ENDED)}), false) as allowed
from (select source_id, "at", status, lag(status) over (partition by source_id order by "at") as before from (select user_id as source_id, event_id as "at", {STATE}[length(event_type) % 6 + 1] as status from events))""",
    "latest_per_key": "select user_id as identity, min(event_id) as page, 0 as place, arg_max(event_type, event_id) as url, arg_max(value, event_id) as v, min(event_type) <> max(event_type) as url_conflict from events group by user_id",
    "next_pages": f"select h as page_url, case when min(p) = max(p) then min(p) end as next_url, min(p) <> max(p) as ambiguous from (select {HOST} as h, {PATH} as p from pages) group by h",
    "id_mismatches": "select o_orderkey as identity, 'x' as observed_id from orders where o_orderkey % 9 = 0",
    "json_extract": "select event_id, cast(json_extract_string(props, '$.k') as int) as k from events",
    "section_extract": """with t as (select conv_id, turn, role, min(turn) filter (role = 'user') over (partition by conv_id) as u from conversations),
s as (select *, min(turn) filter (role = 'system' and turn > u) over (partition by conv_id) as stop from t)
select conv_id, coalesce(string_agg(role, ',' order by turn) filter (turn > u and role <> 'user' and (stop is null or turn < stop)), '') as section from s group by conv_id""",
    "casefold_sort": "select s_suppkey, row_number() over (order by replace(lower(s_name), 'ß', 'ss'), s_suppkey) as rank from supplier",
    "validation_summary": f"with {FEED_ORDERS}, bad as (select rec_no, case when trim(apply_url) = '' then 'apply_url_blank' when not regexp_matches(apply_url, '^https?://[^/?#]') then 'apply_url_not_web' end as code from feed) select code, count(*) as n, min(rec_no) as first_rec_no from bad where code is not null group by code",
    "resume_remaining": "select doc_id from documents where doc_id not in (select doc_id from labels)",
    "partition_replace": "select doc_id, source from documents where source <> 'src1' union all select doc_id, 'src1' from documents where doc_id % 2 = 0",
    "reuse_details": "select d.doc_id::varchar as detail_url, coalesce(quality <> 1, true) as remains from documents d left join (select distinct on (doc_id) doc_id, quality from labels) l using (doc_id)",
    "previous_heading": "select conv_id, turn, max(case when role = 'system' then turn end) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as above from conversations",
    "bounded_fields": "select doc_id, trim(coalesce(source, '')) as contract, trim(coalesce(lang, '')) as location, 7 as number from documents",
    "run_fold": f"""with {STEPS}, a as (select *, min(at_) filter (status = 'NOT_STARTED') over (partition by source_id) as m0 from steps),
b as (select *, min(at_) filter (status = 'RUNNING' and at_ > m0) over (partition by source_id) as m1 from a), c as (select *, min(at_) filter (status in {listed(ENDED)} and at_ > m1) over (partition by source_id) as m2 from b)
select source_id, at_ as "at", status, case when at_ > m2 then max(status) filter (at_ = m2) over (partition by source_id) when at_ > m1 then 'RUNNING' when at_ > m0 then 'NOT_STARTED' end as before, coalesce(at_ in (m0, m1, m2), false) as accepted from c""",
    "run_final_states": f"""with {STEPS}, f as (select source_id, count(*) as n, list_reduce(list_prepend('', list(status order by at_)), lambda s, x: case when (s = '' and x = 'NOT_STARTED') or (s = 'NOT_STARTED' and x = 'RUNNING') or (s = 'RUNNING' and x in {listed(ENDED)}) then x else s end) as s from steps group by source_id)
select source_id, nullif(s, '') as status, (case s when '' then 0 when 'NOT_STARTED' then 1 when 'RUNNING' then 2 else 3 end)::bigint as accepted, n - case s when '' then 0 when 'NOT_STARTED' then 1 when 'RUNNING' then 2 else 3 end as rejected from f""",
    "detail_stop_scan": f"with {DETAILS} select * from details",
    "detail_outcomes": f"""with {DETAILS}, l as (select {HOST} as source_id, min(page_id) % 3 <> 0 as whole from pages group by 1)
select source_id, count(*) as listed, count(*) filter (result in ('read', 'reused')) as detail_complete, count(*) filter (result in ('withheld', 'failed')) as failures,
  case when any_value(whole) and count(*) filter (result in ('withheld', 'failed', 'unread')) = 0 then 'OK' else 'PARTIAL' end as status from l join details using (source_id) group by source_id""",
    "resume_plan": f"""with u as (select user_id as u, count(*) as n, user_id % 5 <> 0 as there, case when user_id % 9 <> 0 then {STATE}[user_id % 6 + 1] end as status, case when user_id % 4 = 0 then 0 else count(*) end as told from events group by user_id),
p as (select *, case when there and (u % 11 = 0 or u % 23 = 0) then 'checkpoint_unreadable' when there and u % 13 = 0 then 'source_mismatch' when there and u % 17 = 0 then 'registry_mismatch' when there and u % 19 = 0 then 'route_changed'
  when status = 'RUNNING' and not there then 'running_without_checkpoint' when status in ('OK', 'EMPTY') and not (n = told and there and u % 3 <> 0) then 'finished_disagrees' end as problem from u)
select u::varchar as source_id, case when problem is not null then 'refuse' when status in ('OK', 'EMPTY') then 'skip' else 'collect' end as action, problem from p""",
    "page_walk": """with recursive e as (select page_id as k, case when page_id % 31 = 30 then page_id + 1 when page_id % 23 = 22 then page_id - 14 else page_id + 7 end as t, page_id % 29 = 28 as amb from pages),
w as (select page_id as k, 0 as step, [page_id] as path from pages where page_id < 7 union all
  select e.t, step + 1, list_append(path, e.t) from w join e on w.k = e.k where not amb and e.t % 7 = e.k % 7 and not list_contains(path, e.t) and step + 1 < 20)
select 'https://h' || w.k % 7 || '.org/' || w.k as page_url, step, case when amb then 'ambiguous' when e.k is null then null when e.t % 7 <> e.k % 7 then 'other site' when list_contains(path, e.t) then 'repeated page' when step = 19 then 'budget' end as problem
from w left join e on w.k = e.k""",
    "feed_record_numbers": "select doc_id, 1 + doc_id % 3 as gap, sha256(coalesce(text, '')) as sha256, null::varchar as problem from documents",
    "numbered_lines": "select doc_id, 1 + doc_id % 3 as gap, doc_id % 10 = 0 as broken from documents",
    "visible_moments": f"with {FEED_ORDERS}, m as (select * from (values " + ", ".join(f"('{k}', '{t}', {n})" for k, (t, n) in MOMENTS.items()) + f""") v(moment, today, now)),
vis as (select * from feed cross join m where not {GONE.replace(TODAY, "today").replace(str(NOW), "now")} and {SAFE})
select moment, '' as facet, '' as value, count(*) as visible from vis group by moment """ + "".join(f" union all select moment, '{f}', {f}, count(*) from vis where {f} <> '' group by all" for f in FACETS),
    "finding_heads": f"""with {GROUPED}, heads as (select 0 as part, doc_id + 2 as first, unnest(string_split(flags, ',')) as code, 'job_summary' as field, null::varchar as organization, 1::bigint as n from flagged where flags <> ''
  union all select 1, first_row, 'repeated_summary', 'job_summary', null, n from rep union all select 2, first, 'employer_field_entirely_blank', field, organization, c from blanks)
select *, {REASON} as reason from heads""",
    "finding_rows": f"""with {GROUPED}, same as (select s, min(n) as first from keyed group by s having count(distinct role) > 1)
select 'repeated_summary' as code, 'job_summary' as field, first, n as row_number from keyed join same using (s) union all select 'employer_field_entirely_blank', field, first, n from keyed_docs join blanks using (e)""",
    "registry_lookup": "select doc_id, case when source <> 'src1' then upper(source) end as name, case when source is null or source = 'src1' then 'unknown source' end as problem from documents",
    "folded_text": "select doc_id, sha256(replace(lower(coalesce(text, '')), 'ß', 'ss')) as sha256 from documents",
    "page_access": "select page_id, page_id % 9 = 0 as withheld from pages",
    "html_title_h1": f"select page_id, len(regexp_extract_all(html, '<title>'))::int as titles, {CLEAN.format(c=UNESCAPED.format(c="regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} as h1 from pages",
    "html_links_resolved": f"""select page_id, cast(i - 1 as int) as pos, lower({SCHEME}) || '://' || {HOST} || regexp_replace({UNESCAPED.format(c="h[i]")}, '^([^#]*)#$', '\\1') as target
from (select page_id, url, h, unnest(range(1, len(h) + 1)) as i from (select page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) as h from pages))""",
    "html_list_cards": f"""with l as (select page_id, url, unnest(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>')) as li, unnest(range(len(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>')))) as i from pages),
c as (select page_id, i, {UNESCAPED.format(c="regexp_extract(li, 'href=" + chr(34) + "([^" + chr(34) + "]*)" + chr(34) + "', 1)")} as h, {CLEAN.format(c=UNESCAPED.format(c="regexp_extract(li, '>([^<]*)</a>', 1)"))} as title, lower({SCHEME}) || '://' || {HOST} as site from l),
k as (select page_id, min(i) as i, regexp_extract(h, '^/([^?#]*)', 1) as own, site || regexp_replace(h, '^([^#]*)#$', '\\1') as target, title from c group by all),
per as (select page_id, count(*) > count(distinct own) as clash, string_agg(own || '|' || target || '|' || title, chr(10) order by i) as cards from (select page_id, min(i) as i, own, target, title from k group by page_id, own, target, title) group by page_id)
select page_id, case when clash then 'conflicting identity' else '' end as problem, case when clash then '' else cards end as cards from per""",
    "html_postings": "select page_id, case page_id % 4 when 3 then 0 when 1 then 2 else 1 end as n, (page_id % 4 < 2)::int as postings, case when page_id % 4 < 2 then 'Job ' || page_id end as title from pages",
}
