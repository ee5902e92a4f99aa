"""SQL counterparts of the registered queries, where SQL can express them."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op8_decontamination"] = f"""
with doc as (select doc_id, {WORDS.format("coalesce(text, '')")} as w from documents),
item as (select item_id, {WORDS.format("text")} as w from benchmark where text is not null),
phrase as (
  select distinct item_id, least(13, len(w)) as n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as p
  from item, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as r(i) where len(w) > 0),
lengths as (select distinct n from phrase),
grams as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as p
  from doc, lengths, unnest(range(1, len(w) - n + 2)) as r(i) where len(w) >= n),
found as (select doc_id, i, n, item_id from grams join phrase using (n, p)),
hit as (
  select doc_id, count(distinct i + k) as n_hit
  from (select distinct doc_id, i, n from found), unnest(range(0, n)) as r(k) group by doc_id),
whose as (
  select doc_id, count(distinct item_id) as n_items,
    array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as items
  from found group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join hit using (doc_id) left join whose using (doc_id)
"""


def sketch(text: str) -> str:
    """The 128 smallest hashes of the runs of five words."""
    words = f"list_filter(string_split(replace(replace(replace({text}, chr(10), ' '), chr(9), ' '), chr(13), ' '), ' '), " \
            "lambda x: x <> '')"
    return f"""(select list_sort(list_distinct(
        case when len(w) = 0 then [] else list_transform(range(1, greatest(len(w) - 4, 1) + 1),
          lambda i: md5(array_to_string(w[i:i + 4], ' '))[1:16]) end))[1:128] from (select {words} as w))"""


def alike(a: str, b: str) -> str:
    return f"""(select case when len(u) = 0 then 1.0::double
        else len(list_filter(u, lambda x: list_contains({a}, x) and list_contains({b}, x)))::double / len(u) end
      from (select list_sort(list_distinct(list_concat({a}, {b})))[1:128] as u))"""


ORACLE["op2_fingerprints"] = f"""
with doc as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n,
    coalesce(lead(coalesce(text, '')) over (order by doc_id desc),
      first_value(coalesce(text, '')) over (order by doc_id desc)) as next
  from documents),
edit as (select *, left(t, n - n // 2) || left(next, n // 2) as e from doc),
done as (
  select doc_id, n, e, {sketch("t")} as a, {sketch("e")} as b, {sketch("next")} as c from edit)
select doc_id, cast(n as bigint) as n_chars, sha256(e) as edited_sha256, array_to_string(a, '') as fingerprint,
  array_to_string(b, '') as edited_fingerprint, {alike("a", "b")} as near_edited, {alike("a", "c")} as near_next
from done
"""


# Kind, pattern, the group whose length counts (0: all) and the least length.
SECRETS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 0),
    ("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 0),
    ("forge", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("maps", r"AIza[A-Za-z0-9_-]{35,}", 0, 0),
    ("signed", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 0),
)


def rule_spans(kind: str, pattern: str, group: int, shortest: int, order: int) -> str:
    """One row per span: what stands between matches and the matches add up to its place."""
    quoted = pattern.replace("'", "''")
    return f"""
  select doc_id, '{kind}' as kind, {order} as o, s, s + len(found[i]) as e from (
    select *, unnest(range(1, len(found) + 1)) as i from (
      select doc_id, string_split_regex(t, '{quoted}') as gaps, regexp_extract_all(t, '{quoted}', 0) as found,
        regexp_extract_all(t, '{quoted}', {group}) as judged from doc)),
    lateral (select coalesce(list_sum(list_transform(gaps[1:i], lambda x: len(x))), 0)
      + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: len(x))), 0) as s)
  where len(judged[i]) >= {shortest}"""


ORACLE["op7_secret_scan"] = f"""
with doc as (select doc_id, coalesce(text, '') as t from documents),
span as ({" union all ".join(rule_spans(*rule, i) for i, rule in enumerate(SECRETS))}),
listed as (
  select doc_id,
    count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || cast(s as bigint) || ':' || cast(e as bigint), ',' order by s, o) filter (o < 3) as base,
    string_agg(kind || ':' || cast(s as bigint) || ':' || cast(e as bigint), ',' order by s, o) as spans
  from span group by doc_id)
select doc_id, cast(coalesce(n_assign, 0) as bigint) as n_assign, cast(coalesce(n_access, 0) as bigint) as n_access,
  cast(coalesce(n_hex, 0) as bigint) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join listed using (doc_id)
"""


LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Every combination of a URL's tokens is counted; one that is frequent enough among blocked URLs, and seldom allowed, blocks.
ORACLE["op11_url_filters"] = f"""
with page as (
  select row_number() over () as r, page_id, coalesce(url, '') as url, strpos(coalesce(url, ''), '://') as mark from pages),
rest as (select *, case when mark > 0 then substr(url, mark + 3) else '' end as t from page),
part as (
  select r, page_id, {LOWERED.format("regexp_extract(t, '^[^/?#]*')")} as host,
    regexp_extract(t, '^[^/?#]*([^?#]*)', 1) as path,
    case when mark > 0 then {LOWERED.format("left(url, mark - 1)")} else '' end as scheme,
    regexp_extract(t, '^[^?#]*\\?([^#]*)', 1) as query, regexp_extract(t, '(?s)^[^#]*#(.*)$', 1) as fragment
  from rest),
slot as (
  select r, page_id, host, path, string_split(host, '.') as l, regexp_replace(path, '[0-9]+', '0', 'g') as p,
    regexp_replace(regexp_replace(query, '=[^&]*', '', 'g'), '[0-9]+', '0', 'g') as q,
    regexp_replace(fragment, '[0-9]+', '0', 'g') as f, scheme from part),
named as (
  select r, page_id, host, path, list_filter([
      case when scheme <> '' then 'scheme=' || scheme end, case when l[-1] <> '' then 'top=' || l[-1] end,
      case when l[-2] <> '' then 'domain=' || l[-2] end, case when l[-3] <> '' then 'site=' || l[-3] end,
      case when len(l) > 3 and array_to_string(l[1:len(l) - 3], '.') <> ''
        then 'sub=' || array_to_string(l[1:len(l) - 3], '.') end,
      case when regexp_extract(p, '^/([^/]*)', 1) <> '' then 'section=' || regexp_extract(p, '^/([^/]*)', 1) end,
      case when regexp_extract(p, '(?s)^/[^/]*(/.*)$', 1) <> '' then 'page=' || regexp_extract(p, '(?s)^/[^/]*(/.*)$', 1) end,
      case when q <> '' then 'query=' || q end, case when f <> '' then 'fragment=' || f end], lambda x: x is not null) as tokens
  from slot),
listed as (
  select *, case
      when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
      when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
      when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
      when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
      when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/' end as rule
  from named),
subset as (
  select r, rule in ('example.org/en/1', 'example.org/es/', 'com/de/') as blocked, rule is not null as labelled,
    list_sort(list_filter(tokens, lambda x, i: (m >> (i - 1)) & 1 = 1)) as tokens
  from listed, unnest(range(1, 1 << len(tokens))) as u(m)),
counted as (
  select tokens, count(*) as n, count(*) filter (blocked) as n_blocked from subset where labelled group by tokens),
mined as (
  select tokens from counted where n_blocked >= ceil(0.01 * (select count(*) from listed where rule is not null))
    and n_blocked > 0 and n_blocked::double / n >= 0.9),
hit as (select distinct r from subset where tokens in (select tokens from mined))
select page_id, host, path, rule,
  case when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 'block' when rule is not null then 'allow'
    when r in (select r from hit) then 'block' else 'allow' end as verdict
from listed
"""
