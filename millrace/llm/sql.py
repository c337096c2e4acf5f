"""The same questions in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from millrace.llm import mixing, slots, substring
from millrace.llm.common import WORD

WORDS = f"regexp_extract_all(coalesce(text, ''), '{WORD}')"


def mix(weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, block: int = mixing.BLOCK, seed: str = "mix") -> str:
    """Targets by rounds of resharing, seats by listing all quotients, blocks by the order of their digests."""
    weight = f"[{', '.join(map(str, weights))}][((number % {len(weights)}) + 1)::int]"

    def seats(votes: str, total: str, words: str, by: str, source: str) -> str:
        """The first ``total`` quotients of each ``by``; a party has as many as its words, twice, fill."""
        return (
            f"select {by}, party, count(*) filter (place <= seats) as got from ("
            f"select *, row_number() over (partition by {by} order by quotient desc, party) as place from ("
            f"select {by}, party, {total} as seats, {votes} / (2 * unnest(range(((2 * {words} + {block - 1}) // {block})::bigint)) + 1) as quotient "
            f"from {source} where {votes} > 0)) group by all"
        )

    return f"""
with recursive sized as (
  select doc_id, source, len({WORDS})::bigint as size,
         md5('{seed}/' || md5(length(d) || ':' || d || length(s) || ':' || s || coalesce(text, ''))) as o, text
  from (select *, coalesce(doc_id::varchar, 'null') as d, coalesce(source, 'null') as s from documents)
), per_source as (
  select *, row_number() over (order by source is null, encode(source)) - 1 as number from (
    select source, sum(size)::bigint as words, count(*) as rows from sized group by source)
), weighed as (select *, {weight}::double as weight from per_source
), rounds as (
  select number, words, weight, {share} * sum(words) over () as total, {share} * sum(words) over () as unfixed,
         null::double as fixed, 0 as round
  from weighed
  union all
  select number, words, weight, total, total - sum(coalesce(now_fixed, 0)) over (), now_fixed, round + 1
  from (
    select *, case when fixed is not null then fixed
                   when unfixed * weight / sum(case when fixed is null then weight end) over () > {mixing.TIMES} * words
                   then {mixing.TIMES}::double * words end as now_fixed
    from rounds where round < (select count(*) from per_source))
), targets as (
  select number, coalesce(fixed, unfixed * weight / sum(case when fixed is null then weight end) over ()) as target
  from rounds where round = (select count(*) from per_source)
), sources as (
  select w.*, t.target,
         greatest(1, -(-words // {mixing.SHARD_WORDS}), -(-rows // {mixing.SHARD_ROWS})) as shards
  from weighed w join targets t using (number)
), source_votes as (
  select 0 as everything, number as party, target as votes, words, round_even((sum(target) over ()) / {block}, 0)::bigint as seats from sources
), source_seats as ({seats("votes", "seats", "words", "everything", "source_votes")}
), placed as (
  select d.*, s.number, s.words as source_size, s.target, ('0x' || substr(o, 1, 8))::bigint % s.shards as shard
  from sized d join sources s on d.source is not distinct from s.source
), cells as (
  select number, shard as party, sum(size)::double as votes, sum(size)::bigint as words, coalesce(any_value(g.got), 0) as seats
  from placed left join source_seats g on g.party = number group by number, shard
), cell_seats as ({seats("votes", "seats", "words", "number", "cells")}
), quotas as (
  select c.number, c.party as shard, c.words, least(coalesce(g.got, 0) * {block}, {mixing.TIMES} * c.words)::bigint as quota
  from cells c left join cell_seats g using (number, party)
), blocks as (
  select *, sum(length) over (partition by number, shard order by digest rows between unbounded preceding and current row) - length as before from (
    select number, shard, quota % greatest(words, 1) as rest, b, least({block}, words - b * {block}) as length,
           md5('{seed}/' || number || '/' || shard || '/' || b) as digest
    from (select *, unnest(range((words + {block - 1}) // {block})) as b from quotas))
), taken as (
  select number, shard, b * {block} as first, b * {block} + greatest(0, least(length, rest - before)) as after from blocks where rest > before
), lined as (
  select *, sum(size) over (partition by number, shard order by o, doc_id rows between unbounded preceding and current row) - size as start from placed
), more as (
  select l.doc_id, l.number, sum(least(l.start + l.size, t.after) - greatest(l.start, t.first)) as words
  from lined l join taken t on l.number = t.number and l.shard = t.shard and t.first < l.start + l.size and t.after > l.start group by all
)
select l.doc_id, l.size, l.source_size, l.target,
       (case when q.words > 0 then q.quota // q.words else 0 end * l.size + coalesce(m.words, 0))::bigint as taken
from lined l join quotas q using (number, shard) left join more m on m.doc_id = l.doc_id and m.number = l.number"""


def shards(count: int = 16, n_slots: int = slots.SLOTS) -> str:
    """CRC-32 by its table, which is made by its rule; slots by MD5; places by counting."""
    return f"""
with crc_table as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) as t
), sized as (
  select doc_id, coalesce(octet_length(encode(text)), 0)::bigint + 1 as size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint) as bytes,
         (('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 8))::bigint % {n_slots})::int as virtual_slot
  from documents
), summed as (
  select doc_id, size, virtual_slot,
         xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)::bigint as text_crc32
  from sized, crc_table
), slot_map as (
  select s::int as virtual_slot, (s % {count})::int as shard,
         row_number() over (partition by s % {count} order by md5(s::varchar), s) <= ceil({n_slots} / {count + 1}.0) as stays
  from range({n_slots}) r(s)
)
select doc_id, size, text_crc32, 'key' as law, m.shard,
       row_number() over (partition by m.shard order by virtual_slot, doc_id nulls first, size, text_crc32) - 1 as slot,
       case when stays then m.shard else {count} end::int as grown_shard, virtual_slot
from summed join slot_map m using (virtual_slot)"""


def repeats(window: int = substring.WINDOW) -> str:
    """Every window as text, the repeated ones by counting, and the words that none of them covers."""
    return f"""
with split as (
  select row_number() over () as r, doc_id, {WORDS} as w from documents
), windows as (
  select r, i, md5(array_to_string(w[i : i + {window - 1}], ' ')) as digest
  from (select r, w, unnest(range(1, len(w) - {window - 2})) as i from split where len(w) >= {window})
), repeated as (
  select r, i from (select r, i, count(*) over (partition by digest) as n from windows) where n > 1
), covered as (
  select r, list(distinct place) as places from (select r, unnest(range(i, i + {window})) as place from repeated) group by r
), kept as (
  select doc_id, w, case when places is null then w
    else list_filter(w, lambda x, i: not list_contains(places, i)) end as k
  from (select s.doc_id, s.w, c.places from split s left join covered c using (r))
)
select doc_id, len(w)::bigint as n_words, (len(w) - len(k))::bigint as n_removed, sha256(array_to_string(k, ' ')) as kept_sha256 from kept"""


def infill() -> str:
    """Tokens as a list, parts as slices of it; the restored text is the text."""
    return """
with cut as (
  select doc_id, coalesce(text, '') as text, sha256('42:' || doc_id) as h,
         regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') as t
  from documents
), drawn as (
  select *, len(t)::bigint as n, [('0x' || substr(h, 1 + 8 * k, 8))::bigint for k in [0, 1, 2, 3]] as draw from cut
), formed as (
  select *, least(draw[1] % (n + 1), draw[2] % (n + 1)) as a, greatest(draw[1] % (n + 1), draw[2] % (n + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or draw[3] % 100 >= 50
              then 'plain' when draw[4] % 100 < 80 then 'spm' else 'psm' end as form
  from drawn
), parts as (
  select *, array_to_string(t[1 : a], '') as prefix, array_to_string(t[a + 1 : b], '') as middle, array_to_string(t[b + 1 :], '') as suffix
  from formed
)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end::bigint as prefix_chars,
       case when form <> 'plain' then length(middle) end::bigint as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from parts"""


def lexical(top: int = 10) -> str:
    """All terms of all texts, counted and joined."""
    terms = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
with doc as (
  select row_number() over () as r, doc_id, {terms} as t from documents
), one as (
  select count(*) as n_docs, sum(len(t))::bigint as n_terms from doc where len(t) > 0
), posting as (
  select r, term, count(*) as tf from (select r, unnest(t) as term from doc) group by all
), item as (
  select distinct item_id, unnest({terms}) as term from benchmark
), held as (
  select term, count(*) as df from posting where term in (select term from item) group by term
), weighed as (
  select term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::bigint as w from held, one
), measured as (
  select r, doc_id, 100 - 90 + ((90 * len(t)::bigint * n_docs) // n_terms) as m from doc, one where len(t) > 0
), scored as (
  select i.item_id, m.doc_id, p.r, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * m.m)))::bigint as score
  from item i join weighed w using (term) join posting p using (term) join measured m using (r) group by all
)
select item_id, rank::int as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
where rank <= {top}"""


def chat() -> str:
    """Turns put together in their order; the length of the template from its parts."""
    return """
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'
), written as (
  select *, '<|im_start|>' || replace(regexp_replace(role, '<(\\\\*)\\|', '<\\\\\\1|', 'g'), chr(10), '<|n|>') || chr(10)
            || regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g') || '<|im_end|>' || chr(10) as segment
  from turns
)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, md5(segment))) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, md5(segment)) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length(segment))::bigint as formatted_chars
from written group by conv_id"""
