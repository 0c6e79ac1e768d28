"""The same results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from . import pii, repair, secrets, urls


def secret_sql() -> str:
    each = []
    for k, r in enumerate(secrets.RULES):
        rx = r.pattern.replace("'", "''")
        each.append(f"""
select doc_id, rid, {k} as ord, '{r.kind}' as kind, i,
  coalesce(list_sum(list_transform(gap[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(hit[1:i - 1], lambda x: length(x))), 0) as s,
  length(hit[i]) as n, length(own[i]) as m, {r.least} as least
from (select doc_id, rid, gap, hit, own, unnest(range(1, len(hit) + 1)) as i
  from (select doc_id, rid, string_split_regex(text, '{rx}') as gap, regexp_extract_all(text, '{rx}') as hit, regexp_extract_all(text, '{rx}', {r.group}) as own from docs))""")
    base = ", ".join(f"'{r.kind}'" for r in secrets.RULES if r.base)
    return f"""
with docs as (select doc_id, row_number() over () as rid, coalesce(text, '') as text from documents),
spans as (select rid, ord, kind, cast(s as bigint) as s, cast(s + n as bigint) as e from ({" union all ".join(each)}) where m >= least),
told as (select rid, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' order by s, ord) filter (kind in ({base})) as base,
  string_agg(kind || ':' || s || ':' || e, ',' order by s, ord) as spans from spans group by rid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join told using (rid)"""


def url_sql() -> str:
    fits = lambda r: f"((host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}'))"
    order = sorted(urls.RULES, key=lambda r: -len(r.name))
    case = lambda what: "case " + " ".join(f"when {fits(r)} then '{what(r)}'" for r in order) + " end"
    k = lambda name, table: f"""{name} as (select coalesce(greatest(1.0, least(1000.0, case when s2 - v * h / n > 0 and v > s2 then (v - s2) / (s2 - v * h / n) else 1000.0 end)), 1000.0) as {name}
  from (select sum(n * (y::double / n - m) ** 2) / sum(n) as s2, max(m) * (1 - max(m)) as v, count(*)::double as h, sum(n)::double as n from {table}, (select sum(y)::double / sum(n) as m from {table} where n > 0) where n > 0))"""  # noqa: E731
    known = ", ".join(f"'{s}'" for s in urls.SUFFIXES)
    return f"""
with p as (select page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{urls._UP}', '{urls._LOW}') as host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
o as (select doc_id as page_id, (quality = 1 and coalesce(toxic, 0) = 0)::int as good from labels where quality is not null),
lab as (select host, count(*) as n, sum(good) as y from p join o using (page_id) group by host),
bare as (select host, regexp_replace(host, ':[0-9]*$', '') as b from (select distinct host from p)),
two as (select host, b, array_to_string(list_slice(string_split(b, '.'), -2, -1), '.') as last2, regexp_matches(b, '{urls._IP}') as ip from bare),
ev as (select host, case when ip then b when last2 in ({known}) then array_to_string(list_slice(string_split(b, '.'), -3, -1), '.') else last2 end as domain,
  case when ip then 'ip' when last2 in ({known}) then last2 else string_split(b, '.')[-1] end as suffix, coalesce(n, 0) as n, coalesce(y, 0) as y
  from two left join lab using (host)),
dom as (select domain, suffix, sum(n) as n, sum(y) as y from ev group by domain, suffix),
suf as (select suffix, sum(n) as n, sum(y) as y from dom group by suffix),
tot as (select coalesce(sum(y)::double / nullif(sum(n), 0), 0.5) as m0 from suf),
{k("k1", "suf")}, {k("k2", "dom")}, {k("k3", "ev")},
s as (select suffix, (y + k1 * m0) / (n + k1) as m1 from suf, tot, k1),
d as (select domain, (y + k2 * m1) / (n + k2) as m2 from dom join s using (suffix), k2),
h as (select host, n as n_labels, (y + k3 * m2) / (n + k3) as m3, n + k3 as w from ev join d using (domain), k3),
u as (select host, n_labels, m3, m3 + 1.645 * sqrt(m3 * (1 - m3) / (w + 1)) as upper from h)
select page_id, host, path, {case(lambda r: r.name)} as rule,
  coalesce({case(lambda r: r.verdict)}, case when upper < 0.7 then 'block' else 'allow' end) as verdict,
  n_labels, round(m3, 6) as reputation, round(upper, 6) as upper
from p left join u using (host)"""


def chat_sql() -> str:
    escape = lambda c: f"replace(replace(replace({c}, '\\', '\\\\'), '<', '\\l'), '[', '\\b')"
    return f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select * from (values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
  cast(sum(length('<s>' || replace({escape("role")}, chr(10), '\\n') || chr(10) || {escape("text")} || '</s>')) as bigint) as formatted_chars
from t group by conv_id"""



#: A list of what each byte becomes when it leaves the CRC-32 register, by eight single steps.
CRC_TABLE = "crcs as (select list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: case when a & 1 = 1 then xor(3988292384, a >> 1) else a >> 1 end)) as steps)"


def crc(text: str) -> str:
    """The CRC-32 of the UTF-8 bytes of a text, with `crcs` in reach."""
    data = f"list_transform(range(cast(strlen({text}) as bigint)), lambda i: cast('0x' || substr(hex({text}), cast(2 * i + 1 as bigint), 2) as bigint))"
    return f"xor(list_reduce(list_prepend(4294967295, {data}), lambda a, b: xor(a >> 8, steps[cast(xor(a, b) & 255 as int) + 1])), 4294967295)"


def repair_sql() -> str:
    """Nodes are read from the last row to the first; a path is text, nine digits of cost and its letters behind them."""
    then = lambda path, cost, letter: f"lpad(cast(cast(left({path}, 9) as bigint) + {cost} as varchar), 9, '0') || '{letter}' || substr({path}, 10)"
    # g has the paths that begin with an edit of the next row, by state; what may be inserted first is added
    user = f"least(g[3], {then('g[4]', repair.INSERT, 'I')})"
    closed = lambda g: f"list_transform([{g}], lambda g: list_transform([{user}], lambda u: [least(g[1], {then('u', repair.INSERT, 'I')}), least(g[2], {then('u', repair.INSERT, 'I')}), u, least(g[4], {then('u', repair.INSERT, 'I')})])[1])[1]"
    must, extra = "r[2] in ('b', 'd')", f"case when r[2] = 't' then {repair.TRUNCATED} else 0 end"
    kept = lambda initial, to: f"case when r[1] = '{initial}' and not {must} then {then(f'f[{to}]', extra, 'K')} end"
    other = lambda to: f"case when not {must} then {then(f'f[{to}]', f'{repair.REROLE} + {extra}', 'R')} end"
    gone = lambda own: then(f"f[{own}]", repair.DELETE, "D")
    read = f"[least({gone(1)}, {kept('s', 2)}, {kept('u', 3)}, {other(3)}), least({gone(2)}, {kept('u', 3)}, {other(3)}), least({gone(3)}, {kept('a', 4)}, {other(4)}), least({gone(4)}, {kept('u', 3)}, {other(3)})]"
    start = closed("['000000000', null, null, '000000000']")
    key = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"
    good = ", ".join(f"'{g}'" for g in repair.GOOD)
    space = r"\x20\x09-\x0D"
    return f"""
with {CRC_TABLE},
marked as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {crc("k")} % 20 as m from (select *, {key} as k from conversations), crcs),
said as (select conv_id, turn, case when m = 4 then 'user' else role end as role, case m when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
  unnest(range(case m when 0 then 0 when 3 then 2 else 1 end)) as copy from marked),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as k, row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as again from said),
told as (select *, left(role, 1) as initial, case when not regexp_matches(text, '[^{space}]') then 'b' when again > 1 then 'd' when not regexp_matches(text, '[.!?][{space}]*\\z') then 't' else '' end as fault,
  lag(left(role, 1)) over (partition by conv_id order by k) as before from placed),
counted as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated,
  count(*) filter (before is not null and before || initial not in ({good})) as illegal, list([initial, fault] order by k desc) as rows from told group by conv_id),
paths as (select conv_id, gaps, blank, duplicate, truncated, illegal, list_reduce(list_prepend({start}, rows), lambda f, r: {closed(read)})[1] as path from counted),
edits as (select conv_id, length(replace(audit, 'D', '')) % 2 as led, unnest(string_split(audit, '')) as edit, unnest(range(1, length(audit) + 1)) as pos from (select conv_id, substr(path, 10) as audit from paths) where audit <> ''),
numbered as (select *, count(*) filter (edit <> 'I') over w as k, count(*) filter (edit <> 'D') over w - 1 as place from edits window w as (partition by conv_id order by pos)),
output as (select e.conv_id, string_agg(case when edit = 'K' then t.role when (place - led) % 2 = 0 then 'user' else 'assistant' end || ':' || case when edit = 'I' then '' else t.text end, chr(10) order by place) as whole
  from numbered e left join told t on e.conv_id is not distinct from t.conv_id and e.k = t.k where edit <> 'D' group by e.conv_id)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(cast(left(path, 9) as bigint), 0) as cost, coalesce(substr(path, 10), '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join paths p on c.conv_id is not distinct from p.conv_id left join output o on c.conv_id is not distinct from o.conv_id"""


def pii_sql() -> str:
    digits = "regexp_replace(hit, '[^0-9]', '', 'g')"
    even = f"list_transform(string_split(reverse({digits}), ''), lambda c, i: case when i % 2 = 1 then c::int else (2 * c::int) // 10 + (2 * c::int) % 10 end)"
    value = "list_transform(string_split(substr(own, 5) || left(own, 4), ''), lambda c: case when c between 'A' and 'Z' then (ascii(c) - 55)::varchar else c end)"
    rest = f"list_reduce(list_prepend(0, list_transform(string_split(array_to_string({value}, ''), ''), lambda c: c::int)), lambda a, b: (a * 10 + b) % 97)"
    #: kind: pattern, group, characters of the match behind the group, check
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0, 0, "true"),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0, 0, "list_bool_and(list_transform(string_split(hit, '.'), lambda p: length(ltrim(p, '0')) <= 3 and coalesce(try_cast(ltrim(p, '0') as int), 0) <= 255))"),
        "card": (r"[0-9]([\x20-]?[0-9])+", 0, 0, f"case when length({digits}) between 13 and 19 then list_sum({even}) % 10 = 0 else false end"),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", 0, 0, f"length({digits}) between 9 and 15"),
        "login": (pii.LOGIN, 1, 1, "true"),
        "tel": (pii.TEL, 1, 0, "true"),
        "iban": (pii.IBAN, 1, 0, f"case when length(own) <= 34 then {rest} = 1 else false end"),
        "account": (pii.ACCOUNT, 1, 0, "length(own) <= 17"),
    }
    each = []
    for k, (kind, (rx, group, tail, ok)) in enumerate(rules.items()):
        each.append(f"""
select rid, {k} as ord, '{kind}' as kind, cast(past - {tail} - length(own) as bigint) as s, cast(past - {tail} as bigint) as e from (select rid, hit[i] as hit, own[i] as own,
  list_sum(list_transform(gap[1:i], lambda x: length(x))) + list_sum(list_transform(hit[1:i], lambda x: length(x))) as past
  from (select rid, gap, hit, own, unnest(range(1, len(hit) + 1)) as i
  from (select rid, string_split_regex(text, '{rx}') as gap, regexp_extract_all(text, '{rx}') as hit, regexp_extract_all(text, '{rx}', {group}) as own from docs))) where {ok}""")
    base = ", ".join(f"'{k}'" for k in pii.BASE)
    counts = ", ".join(f"count(*) filter (kind = '{k}') as n_{k}" for k in pii.BASE)
    return f"""
with docs as (select doc_id, row_number() over () as rid, coalesce(text, '') as text from documents),
found as ({" union all ".join(each)}),
told as (select rid, {counts}, string_agg(kind || ':' || s || ':' || e, ',' order by ord, s) filter (kind in ({base})) as base, string_agg(kind || ':' || s || ':' || e, ',' order by ord, s) as spans from found group by rid)
select doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in pii.BASE)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from docs left join told using (rid)"""


def importance_sql() -> str:
    words = lambda name, table: f"{name} as (select *, regexp_extract_all(translate(coalesce(text, ''), '{urls._UP}', '{urls._LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from {table})"
    grams = "list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
with {CRC_TABLE},
{words("docs", "(select row_number() over () as rid, doc_id, text from documents)")}, {words("items", "benchmark")},
df as (select rid, unnest({grams}) as f from docs), tf as (select unnest({grams}) as f from items),
held as (select f, {crc("f")} % 10000 as bucket from (select distinct f from (select f from df union all select f from tf)), crcs),
a as (select bucket, count(*) as s from df join held using (f) group by bucket), b as (select bucket, count(*) as t from tf join held using (f) group by bucket),
total as (select (select count(*) from df)::double as n_s, (select count(*) from tf)::double as n_t),
gain as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::double) * (n_s + 10000) / ((coalesce(s, 0) + 1.0::double) * (n_t + 10000))))::bigint as g from a full outer join b using (bucket), total),
per as (select rid, count(*) as n, sum(g)::bigint as g from df join held using (f) join gain using (bucket) group by rid),
noisy as (select rid, doc_id, len(w) as n_words, coalesce(n, 0) as n_features, case when n > 0 then (g - ((g % n) + n) % n) // n else 0 end as weight,
  ('0x' || left(sha256('7:' || coalesce(doc_id::varchar, '')), 8))::bigint as h from docs left join per using (rid)),
scored as (select *, (weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296))))::bigint as score from noisy),
ranked as (select rid, row_number() over (order by score desc, doc_id nulls first) as r from scored where n_words >= 20)
select doc_id, n_features, weight, score, case when r <= (25 * (select count(*) from ranked)) // 100 then r end as rank, n_words from scored left join ranked using (rid)"""


ORACLES = {"op7_chat_formatting": chat_sql(), "op4_secret_scans": secret_sql(), "op10_url_filters": url_sql(), "op11_structure_repair": repair_sql(), "op12_pii_anchors": pii_sql(), "op13_importance_resampling": importance_sql()}
