"""SQL counterparts of the registered queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

SUBSTRINGS = r"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
places as (
  select doc_id, words, unnest(range(1, len(words) + 1)) as place from texts),
windows as (
  select doc_id, place, words[place] as word,
    case when place + 19 <= len(words) then array_to_string(words[place : place + 19], ' ') end as content
  from places),
judged as (
  select *, content is not null
    and row_number() over (partition by content order by doc_id, place) > 1 as repeated
  from windows),
covered as (
  select *, bool_or(repeated) over (partition by doc_id order by place rows between 19 preceding and current row) as gone
  from judged),
kept as (
  select doc_id, count(*) filter (where gone) as n_removed, list(word order by place) filter (where not gone) as words
  from covered group by doc_id)
select t.doc_id, cast(len(t.words) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
  sha256(coalesce(array_to_string(k.words, ' '), '')) as kept_sha256
from texts t left join kept k using (doc_id)"""

MIX = r"""
with sizes as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents),
sources as (
  select *, cast([3, 1, 2][place % 3 + 1] as double) as weight, cast(2 * source_size as double) as cap
  from (
    select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as place
    from sizes group by source) s),
levels as (
  select *, (cast(sum(source_size) over () as double) * 1.5
      - coalesce(sum(cap) over (order by cap / weight, place rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by cap / weight, place rows between current row and unbounded following) as level
  from sources),
targets as (
  select source, place, source_size, case when cap <= level * weight then cap else weight * (
    select level from levels where cap > level * weight order by cap / weight, place limit 1) end as target
  from levels),
plan as (
  select all_targets, block, cast(ceil(all_targets / block) as bigint) as slots
  from (
    select all_targets, greatest(1, cast(ceil(all_targets / 1048576) as bigint)) as block
    from (select cast(sum(cast(target as decimal(38, 6))) as double) as all_targets from targets) t) b),
shares as (
  select *, coalesce(lag(until) over (order by place), 0) as since
  from (
    select place, target, cast(round(sum(target) over (order by place) / all_targets * 4294967296) as bigint) as until
    from targets, plan) s),
filled as (
  select place, slot
  from (select slot, slot * 2654435769 % 4294967296 as point
        from (select unnest(range((select slots from plan))) as slot) r) p
  join shares on point >= since and point < until),
turns as (
  select place, greatest(count(slot), 1) as turns from shares left join filled using (place) where target > 0 group by place),
blocks as (
  select place, turn, cast(turn as hugeint) * cast(round(target) as bigint) // turns as begin,
    cast(turn + 1 as hugeint) * cast(round(target) as bigint) // turns as behind
  from (select place, target, turns, unnest(range(turns)) as turn from turns join targets using (place)) t),
laid as (
  select row_number() over () as id, doc_id, size, d.source, source_size, target, place,
    cast(sum(size) over (partition by place order by md5(cast(doc_id as varchar)), size rows unbounded preceding) as bigint)
      as until
  from sizes d join targets t on d.source is not distinct from t.source),
places as (
  select id, place, until - size + pass * source_size as first, until + pass * source_size as last
  from laid, (select unnest([0, 1]) as pass) p where size > 0),
takings as (
  select id, cast(sum(least(last, behind) - greatest(first, begin)) as bigint) as taken
  from places p join blocks b on p.place = b.place and b.begin < p.last and b.behind > p.first group by id)
select doc_id, size, source, source_size, target, coalesce(taken, 0) as taken
from laid left join takings using (id)"""

TREES = r"""
with near as (
  select doc_id, coalesce(text, '') as own, coalesce(
      lead(coalesce(text, '')) over (order by doc_id), first_value(coalesce(text, '')) over (order by doc_id)) as next
  from documents),
texts as (
  select doc_id, own, next, length(own) - length(own) // 2 as kept, length(own) // 2 as half from near),
edited as (
  select doc_id, length(own) as n_chars, own, next, substring(own, 1, kept) || substring(next, 1, half) as edited from texts),
leaves as (
  select doc_id, n_chars, sha256(edited) as edited_sha256,
    [[[md5(p) for p in regexp_extract_all(line, '(?s).{1,32}')] for line in string_split(t, chr(10))]
     for t in [own, edited, next]] as trees
  from edited),
nodes as (
  select *, [[sha256(coalesce(array_to_string(part, ','), '')) for part in tree] for tree in trees[1:2]] as paragraphs,
    [list_distinct(flatten(tree)) for tree in trees] as parts
  from leaves),
roots as (
  select *, [sha256(array_to_string([sha256(array_to_string(level[8 * i + 1 : 8 * i + 8], ','))
      for i in range((len(level) - 1) // 8 + 1)], ',')) for level in paragraphs] as root
  from nodes)
select doc_id, n_chars, edited_sha256, root[1] as fingerprint, root[2] as edited_fingerprint,
  case when len(parts[1]) + len(parts[2]) = 0 then 1.0::double
    else len(list_intersect(parts[1], parts[2])) * 2.0::double / (len(parts[1]) + len(parts[2])) end as near_edited,
  case when len(parts[1]) + len(parts[3]) = 0 then 1.0::double
    else len(list_intersect(parts[1], parts[3])) * 2.0::double / (len(parts[1]) + len(parts[3])) end as near_next
from roots"""

COLLOCATIONS = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
spoken as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
totals as (
  select lang, cast(sum(len(words)) as bigint) as n from spoken group by lang),
places as (
  select lang, words, size, unnest(range(1, len(words) - size + 2)) as place
  from spoken, (select unnest([1, 2, 3, 4]) as size) s where len(words) >= size),
phrases as (
  select lang, size, words[place : place + size - 1] as words, count(*) as f from places group by all having f >= 30),
candidates as (
  select lang, size, words, f as a, unnest(range(1, size)) as k from phrases where size > 1),
cuts as (
  select c.*, one.f as l, two.f as r, cast(2000000 as hugeint) * a // (one.f + two.f) as score
  from candidates c
  join phrases one on one.lang = c.lang and one.words = c.words[1 : c.k]
  join phrases two on two.lang = c.lang and two.words = c.words[c.k + 1 : c.size]),
lowest as (
  select * from cuts qualify row_number() over (partition by lang, words order by score, k) = 1),
parts as (
  select lang, words, a, n, unnest(range(1, size - n + 2)) as i
  from lowest, (select unnest([2, 3]) as n) t where n < size),
holders as (
  select lang, words[i : i + n - 1] as words, max(a) as longer from parts group by all),
alone as (
  select l.* from lowest l left join holders h on h.lang = l.lang and h.words = l.words
  where longer is null or cast(100 as hugeint) * longer < cast(80 as hugeint) * a),
ranked as (
  select lang, array_to_string(words, ' ') as phrase, a, l, r, cast(score as bigint) as score,
    row_number() over (partition by lang order by score desc, a desc, array_to_string(words, ' ')) as rank
  from alone)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000"""

ORACLE = {
    "op13_phrase_collocations": COLLOCATIONS,
    "op4_substring_dedup": SUBSTRINGS,
    "op5_source_mixing": MIX,
    "op6_merkle_fingerprints": TREES,
}
