"""The queries' results in DuckDB's SQL, written from the contracts."""

from __future__ import annotations

from feedgate.llm import url_filter
from feedgate.llm.hilbert import BITS, hilbert_table

_SPACES = r"[\x20\x09-\x0D]+"
_WORDS = r"[^\x20\x09-\x0D]+"

_EXACT = f"""
with t as (
  select doc_id, regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g') as n from documents
)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id is not distinct from min(doc_id) over g as kept, sha256(n) as text_sha256
from t window g as (partition by n)
"""

_MIX = f"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0)::bigint as size,
         md5(coalesce(doc_id::varchar, '')) as shuffle
  from documents
), s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as rank
  from d group by source
), w as (
  select *, case rank % 3 when 0 then 5 when 1 then 2 else 1 end as weight, 2 * source_size as cap,
         sum(source_size) over () as total
  from s
), l as (
  -- Sources that stop at their cap come first by cap per weight; the level is what the rest share by.
  select *, (total * 150 / 100.0::double
             - coalesce(sum(cap) over (order by cap::double / weight, rank rows between unbounded preceding and 1 preceding), 0)::double)
            / (sum(weight) over (order by cap::double / weight, rank rows between current row and unbounded following))::double as level
  from w
), v as (
  select arg_min(level, (cap::double / weight, rank)) as level from l where level * weight < cap
), targets as (
  select source, rank, source_size,
         least(cap::double, coalesce((select level from v) * weight, cap::double)) as target
  from w
), q as (
  select d.*, t.rank, t.source_size, t.target,
         sum(d.size) over (partition by t.rank order by d.shuffle, d.doc_id, d.size
                           rows between unbounded preceding and current row) as upto
  from d join targets t on d.source is not distinct from t.source
), c as (
  select *, case when target > 0 then (copy * source_size + upto)::double / target else 0 end as finish
  from q, (select unnest([0, 1]) as copy)
), r as (
  select *, sum(size) over (order by finish, rank, copy, shuffle, doc_id, size
                            rows between unbounded preceding and current row) as position
  from c
)
select doc_id, size, source_size::bigint as source_size, target,
       sum(case when position <= (select sum(target order by rank) from targets) then size else 0 end)::bigint as taken
from r group by rank, shuffle, doc_id, size, source_size, target, upto
"""


def _hilbert() -> str:
    """Curve index of the cell ``(q0, q1, q2)``, one step of the curve per bit."""
    table = "[" + ", ".join(map(str, hilbert_table(3))) + "]"
    ctes, last = [], "cells"
    for level, bit in enumerate(reversed(range(BITS))):
        corner = " + ".join(f"((q{i} >> {bit}) & 1) * {1 << i}" for i in range(3))
        state, index = ("0", "0::bigint") if level == 0 else ("packed >> 3", "index * 8 + (packed & 7)")
        ctes.append(
            f"h{level} as (select * exclude (packed, index), {index} as index, "
            f"{table}[({state}) * 8 + {corner} + 1] as packed from {last})"
        )
        last = f"h{level}"
    return ",\n".join(ctes) + f",\ncurve as (select *, index * 8 + (packed & 7) as hilbert from {last})"


def _level(column: str) -> str:
    """Share of rows with smaller values, in 2**BITS levels."""
    return f"(({column}_before * {1 << BITS}) // n)::int"


_SHARDS = f"""
with crc as (
  -- One byte through the reflected polynomial of CRC-32.
  select list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0],
              lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) order by i) as t
  from (select unnest(range(0, 256))::bigint as i)
), d as (
  select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang, coalesce(text, '') as text,
         strlen(coalesce(text, ''))::bigint + 1 as size
  from documents
), b as (
  select *, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::bigint) as bytes from d
), k as (
  select doc_id, source, lang, size,
         xor(list_reduce([4294967295::bigint] || bytes, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) as text_crc32
  from b, crc
), v as (
  select *, rank() over (order by source) - 1 as source_before, rank() over (order by lang) - 1 as lang_before,
         rank() over (order by size) - 1 as size_before, count(*) over () as n
  from k
), cells as (
  select *, {_level('source')} as q0, {_level('lang')} as q1, {_level('size')} as q2, 0 as packed, 0::bigint as index
  from v
), {_hilbert()},
r as (
  select *, row_number() over (order by hilbert, text_crc32, doc_id nulls first, size) - 1 as rank from curve
), s as (
  select *, (rank * 8) // n as shard from r
)
select doc_id, size, text_crc32, 'rows' as law, shard::int as shard,
       row_number() over (partition by shard order by rank) - 1 as slot, null::int as grown_shard, hilbert
from s
"""

_LINES = r"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
  from documents
), k as (
  select *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l
), r as (
  select key, max(doc_id) as keeper from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5
), j as (
  select k.*, r.key is not null and k.doc_id <> r.keeper as gone from k left join r using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from j group by doc_id
"""


def _urls() -> str:
    """The tree's levels one after the other, then branches and purity."""
    levels, last = [], "t0"
    for level in range(1, url_filter.DEPTH + 1):
        levels.append(f"""
c{level} as (select host, template, segments[{level}] as segment, sum(rows) as n from {last}
             where segments[{level}] is not null group by all),
m{level} as (select *, count(*) over p >= {url_filter.MANY} and n < sum(n) over p * {url_filter.RARE}::double as wild
             from c{level} window p as (partition by host, template)),
t{level} as (
  select t.host, t.segments, t.rows, t.labelled, t.bad,
         case when m.segment is null then t.template
              else t.template || '/' || case when m.wild then '*' else m.segment end end as template,
         case when m.segment is null then t.parent else t.template end as parent
  from {last} t left join m{level} m
       on t.host = m.host and t.template = m.template and t.segments[{level}] = m.segment
)""")
        last = f"t{level}"
    deepest = url_filter.DEPTH - 1
    rest = f"array_to_string(s[{deepest + 1}:], '/')"
    return rf"""
with u as (
  select page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages
), fits as (
  select host, path, arg_max((rule_host || rule_path, verdict), length(rule_host || rule_path)) as r
  from (select distinct host, path from u)
       join (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) as r(rule_host, rule_path, verdict)
       on ends_with('.' || host, '.' || rule_host) and starts_with(path, rule_path)
  group by host, path
), f as (
  select u.*, r[1] as rule, r[2] as ruled,
         string_split(regexp_replace(regexp_replace(regexp_replace(path,
           '(^|/|-|_)[0-9a-fA-F]{{16,}}(/|-|_|[.]|$)', '{{hex}}', 'g'), '[0-9]+', '{{n}}', 'g'), '^/', ''), '/') as s
  from u left join fits using (host, path)
), g as (
  select *, case when len(s) > {deepest} then s[:{deepest}] || [{rest}] else s end as segments from f
), t0 as (
  select host, segments, count(*) as rows, count(ruled) as labelled, count(*) filter (ruled = 'block') as bad,
         '' as template, '' as parent
  from g group by host, segments
), {",".join(levels)},
leaves as (
  select host, parent, template, sum(labelled) as labelled, sum(bad) as bad from {last} group by all
), shares as (
  select *, (bad / labelled)::double as share,
         (sum(bad) over p / sum(labelled) over p)::double as whole
  from leaves window p as (partition by host, parent)
), branches as (
  select *, case when labelled = 0 or abs(share - whole) <= sqrt(whole * (1 - whole) / labelled) * {url_filter.ERRORS}::double
                 then parent || '/~' else template end as branch
  from shares
), hosts as (
  select host, (sum(bad) + (select coalesce(sum(bad) / nullif(sum(labelled), 0), 0.5)::double from leaves) * {url_filter.PRIOR}::double)
               / (sum(labelled) + {url_filter.PRIOR}::double) as prior
  from leaves group by host
), pooled as (
  select host, branch, (sum(bad) + any_value(prior) * {url_filter.PRIOR}::double) / (sum(labelled) + {url_filter.PRIOR}::double) as purity
  from branches join hosts using (host) group by host, branch
)
select page_id, g.host, path, rule,
       coalesce(ruled, case when purity >= {url_filter.REJECT} then 'block' else 'allow' end) as verdict,
       {last}.template, purity
from g join {last} using (host, segments)
       join branches on branches.host = g.host and branches.template = {last}.template
       join pooled on pooled.host = g.host and pooled.branch = branches.branch
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_RUNS = rf"""
with crc as (
  select list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0],
              lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) order by i) as t
  from (select unnest(range(0, 256))::bigint as i)
), d as (
  select row_number() over () as row, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') as w,
         list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::varchar, ''))), '..'), lambda x: ('0x' || x)::bigint) as bytes
  from documents
), h as (
  select row, doc_id, w, len(w) as n,
         xor(list_reduce([4294967295::bigint] || bytes, lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) as h
  from d, crc
), p as (
  select *, case when n > 0 and h % 10 = 0 then (h // 10) % n end as a, h // 10 as g from h
), x as (
  select row, doc_id, case when a is null then w
         else w[:a] || list_transform(range(0, n - a), lambda i: w[a + i % (1 + (n - a) // (3 + g % 8)) + 1]) end as w
  from p
), v as (
  select row, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from x
), grams as (
  select row, unnest(range(0, len(w) - 5)) as i, unnest(list_transform(range(1, len(w) - 4), lambda k: array_to_string(w[k:k + 5], ' '))) as gram
  from x where len(w) >= 6
), matches as (
  select b.row, b.i, b.i - a.i as q from grams a join grams b on a.row = b.row and a.gram = b.gram and a.i < b.i
), islands as (
  select *, i - row_number() over (partition by row, q order by i) as island from matches
), stretches as (
  select row, q, min(i) - q as s, max(i) + 6 as e from islands group by row, q, island
), r as (
  select row, s, e, min(q) as q from stretches where e - s >= greatest(12, 2 * q) group by row, s, e
), best as (
  select *, e - s as length from r qualify row_number() over (partition by row order by e - s desc, s, q) = 1
), lists as (
  select row, count(*) as n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' order by s, q) as runs from r group by row
), gone as (
  select distinct row, unnest(range(s + q, e)) as i from r
), kept as (
  select row, string_agg(word, ' ' order by i) as text from v anti join gone using (row, i) group by row
)
select doc_id, coalesce(n_runs, 0) as n_runs, s as start, length, q as period, 1000 * length // q as exponent_milli,
       sha256(coalesce(runs, '')) as runs_sha256, sha256(coalesce(text, '')) as collapsed_sha256
from x left join lists using (row) left join best using (row) left join kept using (row)
"""

_PHRASES = rf"""
with p as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), w as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p
), g as (
  select lang, 1 as k, unnest(w) as phrase from w
  union all
  select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from w
  union all
  select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from w
), f as (
  select lang, k, phrase, count(*) as a from g group by all
), c as (
  select *, string_split(phrase, ' ') as parts from f where k > 1 and a >= 10
), cuts as (
  select c.lang, c.phrase, c.a, cut, l.a as l, r.a as r,
         ((1000000::hugeint * c.a * c.a) // (l.a::hugeint * r.a))::bigint as score
  from c join (values (1), (2)) as v(cut) on cut < k
         join f l on l.lang = c.lang and l.phrase = array_to_string(parts[:cut], ' ')
         join f r on r.lang = c.lang and r.phrase = array_to_string(parts[cut + 1:], ' ')
), lowest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), held as (
  select lang, unnest([parts[1] || ' ' || parts[2], parts[2] || ' ' || parts[3]]) as phrase, a as longer from c where k = 3
), n as (
  select lang, sum(a)::bigint as n from f where k = 1 group by lang
), ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
  from lowest join n using (lang)
  where not exists (select 1 from held where held.lang = lowest.lang and held.phrase = lowest.phrase and 100 * longer >= 50 * lowest.a)
)
select * from ranked where rank <= 2000
"""

_NEAR = rf"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{_WORDS}') as w from documents
), s as (
  select doc_id, list_sort(list_distinct(case
           when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
           when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as shingles
  from d
), k as (
  select doc_id, len(shingles) as n, md5(array_to_string(shingles, chr(10))) as key, shingles from s
), sets as (
  select key, any_value(n) as n, min(doc_id) as least, any_value(shingles) as shingles from k where n > 0 group by key
), posts as (
  select key, n, unnest(shingles) as shingle from sets
), links as (
  select a.key as a, b.key as b from posts a join posts b on a.shingle = b.shingle and a.key <> b.key
  group by a.key, b.key, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(a, b) as (
  select key, key from sets
  union
  select reach.a, links.b from reach join links on reach.b = links.a
), c as (
  select reach.a as key, min(least) as component_id from reach join sets on reach.b = sets.key group by reach.a
)
select doc_id, n as n_shingles, case when n = 0 then doc_id else component_id end as component_id,
       doc_id is not distinct from case when n = 0 then doc_id else component_id end as kept
from k left join c using (key)
"""


ORACLE = {
    "op1_hilbert_shards": _SHARDS,
    "op4_fair_mix": _MIX,
    "op5_exact_dedup": _EXACT,
    "op9_url_templates": _urls(),
    "op10_line_mph": _LINES,
    "op11_periodic_runs": _RUNS,
    "op12_collocations": _PHRASES,
    "op13_minhash_postings": _NEAR,
}
