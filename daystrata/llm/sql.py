"""SQL for DuckDB that gives the rows of the operators' queries."""

from __future__ import annotations

from daystrata.llm import license_scan, pii


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


EXACT_DEDUP = """
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(text) as text_sha256
from (
  select doc_id, text, max(doc_id) over (partition by text) as keep_id, count(*) over (partition by text) as group_size
  from (select doc_id, coalesce(text, '') as text from documents))
"""


def license_scan_sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    places, found = [], []
    for phrase, label in license_scan.PHRASES.items():
        n = len(phrase.split())
        at = f"list_filter(range(greatest(len(w) - {n - 1}, 0)), lambda i: w[i + 1 : i + {n}] = {_list(phrase.split())})"
        places.append(at)
        found.append(f"case when len({at}) > 0 then ['{label}'] else [] end")
    rows = []
    for label, text in license_scan.TEMPLATES:
        rows.append(f"('{label}', {_list(license_scan.template_words(text))})")
    return f"""
with docs as (select doc_id, coalesce(text, '') as text, row_number() over () as row_no from documents),
words as (select row_no, doc_id, text, regexp_extract_all({lower.format('text')}, '{word}') as w from docs),
base as (
  select row_no, doc_id, len(w) as n_words, list_concat({", ".join(places)}) as places,
    list_sort(list_distinct(list_concat({", ".join(found)}))) as base_found
  from words),
templates(label, tw) as (values {", ".join(rows)}),
lines as (
  select row_no, list_distinct(regexp_extract_all({lower.format('line')}, '{word}')) as have
  from (select row_no, unnest(string_split(text, chr(10))) as line from docs where text <> '')),
met as (
  select row_no, label, len(list_intersect(tw, have)) / len(tw) as containment
  from lines, templates
  where list_has_any(tw, have) and len(list_intersect(tw, have)) >= ceil({license_scan.CONTAINMENT} * len(tw) - 1e-9)),
found as (select row_no, list(distinct label) as found, max(containment) as containment from met group by row_no)
select doc_id, n_words, len(places)::bigint as n_base, list_min(places)::bigint as first_word,
  list_max(places)::bigint as last_word, array_to_string(base_found, ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base_found, coalesce(found, [])))), ',') as labels,
  case when len(places) > 0 then 1.0::double else coalesce(containment, 0.0)::double end as score
from base left join found using (row_no)
"""


def pii_sql() -> str:
    # Plain patterns; this engine's matching is linear by itself.
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
    }
    digits = "regexp_replace(v, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(range(len({digits})), lambda i: "
        f"case when i % 2 = 0 then reverse({digits})[i + 1]::int "
        f"when reverse({digits})[i + 1]::int > 4 then reverse({digits})[i + 1]::int * 2 - 9 "
        f"else reverse({digits})[i + 1]::int * 2 end)) % 10 = 0"
    )
    account = "replace(v, ' ', '')"
    turned = f"({account}[5:] || {account}[1:4])"
    code = f"(ascii({turned}[i + 1]) - 48)"
    mod97 = (
        f"list_reduce(list_prepend(0, list_transform(range(len({account})), lambda i: "
        f"case when {code} < 10 then {code} else 100 + {code} - 7 end)), "
        "lambda a, b: case when b < 10 then (a * 10 + b) % 97 else (a * 100 + b - 100) % 97 end) = 1"
    )
    valid = {
        "email": "true",
        "ip": r"len(list_filter(string_split(v, '.'), lambda p: len(regexp_replace(p, '^0+', '')) > 3 "
        r"or coalesce(try_cast(p as hugeint), 0) > 255)) = 0",
        "card": f"case when len({digits}) between 14 and 19 then {luhn} else false end",
        "phone": f"len({digits}) between 10 and 15",
        "iban": f"case when len({account}) between 15 and 34 then {mod97} else false end",
    }
    parts = []
    for no, kind in enumerate(pii.KINDS):
        pattern = patterns[kind.name]
        words = lambda w: f"regexp_matches(near, '{pii.context_pattern(w)}')" if w else "false"
        score = (
            f"greatest(0, least(100, {round(100 * kind.base)} + case when {words(kind.near)} then 25 else 0 end "
            f"- case when {words(kind.against)} then 25 else 0 end)) / 100"
        )
        parts.append(f"""
select row_no, '{kind.name}' as kind, {no} as kind_no, s, s + len(v) as e, printf('%.2f', ({score})::double) as score
from (
  select row_no, hits[i] as v,
    (list_sum(list_transform(gaps[1:i], lambda g: len(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: len(h))), 0))::bigint as s,
    right(gaps[i], {pii.NEAR}) || ' ' || left(gaps[i + 1], {pii.NEAR}) as near
  from (
    select row_no, hits, gaps, unnest(range(1, len(hits) + 1)) as i
    from (
      select row_no, regexp_extract_all(text, '{pattern}') as hits, string_split_regex(text, '{pattern}') as gaps
      from docs where regexp_matches(text, '{pattern}'))))
where {valid[kind.name]}""")
    order = "order by s, kind_no"
    each = "kind || ':' || s || ':' || e"
    base = len(pii.BASE_KINDS)
    counts = ", ".join(f"coalesce(n_{k.name}, 0)::bigint as n_{k.name}" for k in pii.BASE_KINDS)
    sums = ", ".join(f"count(*) filter (kind = '{k.name}') as n_{k.name}" for k in pii.BASE_KINDS)
    return f"""
with docs as (select doc_id, coalesce(text, '') as text, row_number() over () as row_no from documents),
spans as ({" union all ".join(parts)}),
found as (
  select row_no, {sums},
    string_agg({each}, ',' {order}) filter (kind_no < {base}) as base,
    string_agg({each}, ',' {order}) as spans, string_agg(score, ',' {order}) as scores
  from spans group by row_no)
select doc_id, {counts}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(scores, '') as scores
from docs left join found using (row_no)
"""


PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def near_dedup_sql(words: int = 4) -> str:
    return f"""
with recursive split as (
  select doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{SPACED_WORD}') as w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < {words} then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i : i + {words - 1}], ' ')) end) as s
  from split),
shingles as (select doc_id, unnest(s) as g from sets),
common as (
  select a.doc_id as l, b.doc_id as r, count(*) as n
  from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
linked as (
  select l, r from common join sets a on a.doc_id = l join sets b on b.doc_id = r
  where 100 * n >= 80 * (len(a.s) + len(b.s) - n)),
both_ways as (select l, r from linked union select r, l from linked),
reach as (
  select doc_id as l, doc_id as r from sets
  union select reach.l, both_ways.r from reach join both_ways on both_ways.l = reach.r)
select doc_id, n_shingles, component_id, doc_id = component_id as kept
from (
  select sets.doc_id, len(s)::bigint as n_shingles, min(reach.r) as component_id
  from sets join reach on reach.l = sets.doc_id group by sets.doc_id, s)
"""


def leaks_sql(window: int = 20, needed: int = 16) -> str:
    return f"""
with docs as (
  select doc_id, w, unnest(range(len(w))) as at, unnest(w) as word
  from (select doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{PLAIN_WORD}') as w from documents)),
items as (
  select item_id, w, unnest(range(len(w))) as at, unnest(w) as word
  from (select item_id, regexp_extract_all({_lower("text")}, '{PLAIN_WORD}') as w from benchmark where text is not null)),
equal_words as (
  select doc_id, item_id, docs.at - items.at as start, items.at as place, len(docs.w) as doc_words, len(items.w) as item_words
  from docs join items using (word)),
aligned as (
  select doc_id, item_id, start, doc_words, item_words,
    count(*) over (partition by doc_id, item_id, start order by place range between current row and {window - 1} following) as near
  from equal_words),
places as (
  select doc_id, item_id, start, max(near) as most, count(*) as n_equal,
    greatest(start, 0) as start_word, least(item_words, doc_words - start) - greatest(0, -start) as n_words, item_words
  from aligned group by doc_id, item_id, start, doc_words, item_words),
held as (
  select *, row_number() over (partition by doc_id, item_id order by n_equal desc, start_word) as rank
  from places
  where case when item_words < {window} then n_words = item_words and n_equal = item_words
    else n_words >= {window} and most >= {needed} end)
select doc_id, item_id, start_word::bigint as start_word, n_words::bigint as n_words, n_equal, n_equal / n_words as share
from held where rank = 1
"""


def substring_dedup_sql(window: int = 35) -> str:
    return f"""
with docs as (
  select row_number() over () as row_no, doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED_WORD}') as w from documents),
windows as (
  select row_no, start, md5(array_to_string(w[start : start + {window - 1}], ' ')) as run
  from (select row_no, w, unnest(range(1, len(w) - {window - 2})) as start from docs where len(w) >= {window})),
recurring as (
  select row_no, start from windows join (select run from windows group by run having count(*) > 1) using (run)),
covered as (select distinct row_no, unnest(range(start, start + {window})) as place from recurring),
removed as (select row_no, list(place) as places, count(*) as n from covered group by row_no),
words as (
  select docs.row_no, place, word
  from (select row_no, unnest(range(1, len(w) + 1)) as place, unnest(w) as word from docs) docs
  anti join covered on covered.row_no = docs.row_no and covered.place = docs.place),
kept as (select row_no, string_agg(word, ' ' order by place) as text from words group by row_no)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from docs left join removed using (row_no) left join kept using (row_no)
"""


def ranked_search_sql(top: int = 20) -> str:
    words = lambda: f"regexp_extract_all({_lower("coalesce(text, '')")}, '{PLAIN_WORD}')"
    return f"""
with docs as (select row_number() over () as row_no, doc_id, {words()} as w from documents),
stats as (select (count(*) filter (len(w) > 0))::bigint as n_docs, sum(len(w))::bigint as n_terms from docs),
counted as (
  select row_no, doc_id, n, term, count(*) as tf
  from (select row_no, doc_id, len(w)::bigint as n, unnest(w) as term from docs) group by all),
weights as (
  select term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint as weight from counted, stats group by term, n_docs),
asked as (
  select item_no, item_id, term, count(*) as times
  from (select row_number() over () as item_no, item_id, unnest({words()}) as term from benchmark) group by all),
scored as (
  select item_no, item_id, row_no, doc_id,
    sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::bigint as score
  from asked join counted using (term) join weights using (term), stats
  group by item_no, item_id, row_no, doc_id),
ranked as (select *, row_number() over (partition by item_no order by score desc, doc_id nulls last) as rank from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= {top}
"""


def all_sql() -> dict[str, str]:
    return {
        "op1_near_dedup": near_dedup_sql(),
        "op5_decontaminate": leaks_sql(),
        "op4_license_scan": license_scan_sql(),
        "op6_substring_dedup": substring_dedup_sql(),
        "op7_exact_dedup": EXACT_DEDUP,
        "op10_pii": pii_sql(),
        "op13_ranked_search": ranked_search_sql(),
    }
