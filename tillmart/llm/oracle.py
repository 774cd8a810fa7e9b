"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from tillmart.llm import collocations, decontamination, divergence, mixing, quality_rules

_QUOTE = "'"


def _texts(values) -> str:
    return ", ".join(_QUOTE + v.replace(_QUOTE, _QUOTE * 2) + _QUOTE for v in values)


def _rules() -> str:
    parts = []
    for rule in quality_rules.RULES:
        if rule.low is not None:
            parts.append(f"100 * {rule.part} >= {rule.low} * {rule.whole}")
        if rule.high is not None:
            parts.append(f"100 * {rule.part} <= {rule.high} * {rule.whole}")
    return " and ".join(parts)


_STOP = sorted({w for words in quality_rules.STOP_WORDS.values() for w in words})

OP2 = rf"""
with d as (
  select doc_id, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from documents
), w as (
  select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as place from d
), g as (
  select doc_id, place, word,
    lead(word, 1) over (partition by doc_id order by place) as word2,
    lead(word, 2) over (partition by doc_id order by place) as word3
  from w
), c as (
  select doc_id, place, count(*) over (partition by doc_id, word, word2, word3) as times
  from g where word3 is not null
), r as (
  select doc_id, count(distinct place + k) as n_repeat_words
  from c cross join (values (0), (1), (2)) as three(k)
  where times > 1 group by doc_id
), s as (
  select doc_id, count(*) as n_stop_words from w where word in ({_texts(_STOP)}) group by doc_id
), m as (
  select d.doc_id,
    len(ws)::bigint as n_words,
    length(array_to_string(ws, ''))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    len(ls)::bigint as n_lines,
    (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    coalesce(n_stop_words, 0)::bigint as n_stop_words
  from d left join r using (doc_id) left join s using (doc_id)
), b as (
  select *, n_words < {quality_rules.MIN_WORDS}
    or 100 * n_repeat_words > {quality_rules.MAX_REPEAT} * n_words as base_failed
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {_rules()} as kept
from b
"""

# Quotients are listed one by one here and the blocks' words follow by overlap. One level
# of the shard tree is written out, which is all there is up to FAN shards a source.
_BLOCK, _LIMIT, _SEED = mixing.BLOCK, mixing.LIMIT, mixing.SEED


def _number(digest: str) -> str:
    return f"('0x' || substr({digest}, 1, 15))::bigint"


OP4 = rf"""
with d as (
  select doc_id, source, coalesce('=' || source, 'null') as key,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::bigint as size,
    md5('{_SEED}' || coalesce(':' || doc_id::varchar, '')) as draw
  from documents
), t as (
  select key, source, sum(size)::bigint as source_size,
    row_number() over (order by source nulls last) as rank
  from d group by key, source
), w as (
  select *, list_extract({list(mixing.WEIGHTS)}, ((rank - 1) % {len(mixing.WEIGHTS)} + 1)::int) as weight,
    {mixing.SHARE}::double * (sum(source_size) over ())::double as goal
  from t
), o as (
  select *, ({_LIMIT} * source_size)::double / weight as stop from w
), l as (
  select *,
    (goal - coalesce(sum({_LIMIT} * source_size) over before, 0)::double)
      / (sum(weight) over () - coalesce(sum(weight) over before, 0))::double as level
  from o
  window before as (order by stop, rank rows between unbounded preceding and 1 preceding)
), f as (
  select key, rank, source_size,
    greatest(ceil(source_size::double / {mixing.SHARD_WORDS}), 1)::bigint as shards,
    least(({_LIMIT} * source_size)::double,
      weight * coalesce(max(case when level <= stop then level end) over (), 0))::double as target
  from l
), q as (
  select key, rank, seat, target / (2 * seat - 1) as quotient
  from (select *, unnest(range(1, (2 * target / {_BLOCK})::bigint + 50)) as seat from f)
), p as (
  select key, count(*) as all_seats
  from (select *, row_number() over (order by quotient desc, rank, seat) as place from q where quotient > 0)
  where place <= (select floor(sum(target) / {_BLOCK} + 0.5) from f)
  group by key
), x as (
  select d.doc_id, d.key, d.size, d.draw, f.source_size, f.target, ({_number("draw")} % shards) as shard
  from d join f using (key)
), h as (
  select key, shard, sum(size)::bigint as words, any_value(coalesce(all_seats, 0)) as all_seats
  from x left join p using (key) group by key, shard
), hq as (
  select key, shard, all_seats, seat, words::double / (2 * seat - 1) as quotient
  from (select *, unnest(range(1, (2 * (words // {_BLOCK}) + 50)::bigint * {_LIMIT})) as seat from h)
), hp as (
  select key, shard, count(*) as seats
  from (
    select *, row_number() over (partition by key order by quotient desc, shard, seat) as place
    from hq where quotient > 0
  )
  where place <= all_seats group by key, shard
), c as (
  select key, shard, words, greatest(words, 1) as cut,
    least(coalesce(seats, 0) * {_BLOCK}, {_LIMIT} * words) as quota,
    {_number(f"md5('{_SEED}:' || key || ':' || shard)")} as toss
  from h left join hp using (key, shard)
), k as (
  select *, quota // cut as passes, quota % cut as rest,
    toss % greatest((words + {_BLOCK - 1}) // {_BLOCK}, 1) * {_BLOCK} as start
  from c
), a as (
  select *,
    sum(size) over (partition by key, shard order by draw, doc_id nulls first, size
      rows between unbounded preceding and current row)::bigint as upto
  from x
)
select doc_id, size, source_size, target, (
    passes * size
    + greatest(least(upto, start + rest, words) - greatest(upto - size, start), 0)
    + greatest(least(upto, greatest(start + rest - words, 0)) - (upto - size), 0)
  )::bigint as taken
from a join k using (key, shard)
"""

OP7 = """
with g as (
  select coalesce(text, '') as t, max(doc_id) as keep_id, count(*) as group_size
  from documents group by coalesce(text, '')
)
select d.doc_id, g.keep_id, g.group_size::bigint as group_size,
  d.doc_id = g.keep_id as kept, sha256(g.t) as text_sha256
from documents d join g on coalesce(d.text, '') = g.t
"""


def _base32(digest: str) -> str:
    groups = []
    for i in range(8):
        number = f"('0x' || substr({digest}, {1 + 5 * i}, 5))::integer"
        groups += [
            f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({number} >> {shift}) & 31) + 1, 1)"
            for shift in (15, 10, 5, 0)
        ]
    return " || ".join(groups)


OP10 = f"""
with p as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest from pages
), g as (
  select payload, max(page_id) as response_id from p group by payload
)
select page_id, octet_length(encode(payload))::bigint as payload_bytes,
  {_base32("digest")} as payload_digest,
  case when page_id = response_id then 'response' else 'revisit' end as record_type,
  case when page_id <> response_id then response_id end as refers_to
from p join g using (payload)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
with d as (
  select row_number() over () as row_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), t as (
  select lang, source, row_id, unnest(terms) as term from d
), k as (
  select lang, term from t group by lang, term having count(distinct row_id) >= {divergence.LEAST_DOCS}
), v as (
  select lang, count(*)::hugeint as v from k group by lang
), g as (
  select distinct lang, source from d
), c as (
  select lang, source, term, count(*) as n from t semi join k using (lang, term) group by lang, source, term
), dense as (
  select g.lang, g.source, k.term, coalesce(c.n, 0)::hugeint as n
  from g join k using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term
), p as (
  select lang, source, term, n,
    1 + ({divergence.SCALE} * (n + 1)) // (sum(n) over (partition by lang, source)::hugeint + v) as p
  from dense join v using (lang)
), l as (
  select lang, term, 1 + ({divergence.SCALE} * (n + 1)) // (sum(n) over (partition by lang)::hugeint + v) as q
  from (select lang, term, sum(n)::hugeint as n from dense group by lang, term) join v using (lang)
), pairs as (
  select a.lang, a.source, b.source as item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
    left join p x on x.lang = a.lang and x.source = a.source
    left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by a.lang, a.source, b.source
), terms as (
  select lang, source, term as item, ((p - q) * (p - q) // q)::bigint as value
  from p join l using (lang, term) where n > 0 and p > q
), u as (
  select 'pair' as part, * from pairs union all select 'term' as part, * from terms
)
select lang, source, part, item, value,
  (row_number() over (partition by lang, source, part order by value desc, item))::integer as rank
from u
qualify part = 'pair' or rank <= {divergence.TOP}
"""

_PARTS = range(1, collocations.LONGEST)

OP12 = rf"""
with pieces as materialized (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), w as materialized (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from pieces
), g as (
  {" union all ".join(
      f"select lang, {size} as size, array_to_string(ws[i:i + {size - 1}], ' ') as phrase"
      f" from (select lang, ws, unnest(range(1, len(ws) - {size - 2})) as i from w)"
      for size in range(1, collocations.LONGEST + 1)
  )}
), f as materialized (
  select lang, size, phrase, count(*) as n from g group by all
), t as (
  select lang, sum(n)::bigint as n from f where size = 1 group by lang
), c as materialized (
  select lang, size, phrase, n as a, string_split(phrase, ' ') as ws
  from f where size > 1 and n >= {collocations.THRESHOLD}
), cuts as (
  select c.lang, c.phrase, c.size, c.a, k, x.n as l, y.n as r,
    (2000000::hugeint * c.a) // (x.n + y.n) as score
  from (
    select *, array_to_string(ws[1:k], ' ') as first, array_to_string(ws[k + 1:], ' ') as rest
    from (select *, unnest(range(1, size)) as k from c)
  ) c
    join f x on x.lang = c.lang and x.phrase = c.first
    join f y on y.lang = c.lang and y.phrase = c.rest
  qualify row_number() over (partition by c.lang, c.phrase order by score, k) = 1
), inner_parts as (
  {" union all ".join(
      f"select lang, a, array_to_string(ws[i:i + {many - 1}], ' ') as phrase"
      f" from (select lang, a, ws, unnest(range(1, size - {many - 2})) as i from c where size > {many})"
      for many in _PARTS if many > 1
  )}
), longer as (
  select lang, phrase, max(a) as longer from inner_parts group by lang, phrase
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase)::integer as rank,
  phrase, a, l, r, t.n, score::bigint as score
from cuts left join longer using (lang, phrase) join t using (lang)
where longer is null or 100::hugeint * longer < {collocations.SHARE}::hugeint * a
qualify rank <= {collocations.KEEP}
"""

OP13 = rf"""
with d as (
  select row_number() over () as row_id, doc_id,
    regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents
), i as (
  select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark
), s as (
  select item_id, ws, least(len(ws), {decontamination.WINDOW}) as size from i where len(ws) > 0
), windows as (
  select distinct item_id, size, array_to_string(ws[b:b + size - 1], ' ') as phrase
  from (select *, unnest(range(1, len(ws) - size + 2)) as b from s)
), places as (
  select row_id, size, b, array_to_string(ws[b:b + size - 1], ' ') as phrase
  from (
    select *, unnest(range(1, len(ws) - size + 2)) as b
    from d cross join (select distinct size from windows)
  )
), met as (
  select row_id, b, size, item_id from places join windows using (size, phrase)
), hit as (
  select row_id, count(distinct place) as n_hit
  from (select row_id, unnest(range(b, b + size)) as place from met) group by row_id
), names as (
  select row_id, list_sort(list(distinct item_id::varchar)) as items
  from met where item_id is not null group by row_id
)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(len(items), 0)::bigint as n_items,
  sha256(coalesce(array_to_string(items, ','), '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (row_id) left join names using (row_id)
"""

ORACLE: dict[str, str] = {
    "op2_quality_rules": OP2,
    "op4_mixing": OP4,
    "op7_exact_dedup": OP7,
    "op10_warc": OP10,
    "op11_divergence": OP11,
    "op12_collocations": OP12,
    "op13_decontamination": OP13,
}
