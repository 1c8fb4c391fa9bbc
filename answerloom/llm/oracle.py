"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_OP1 = """
with recursive divisions as (
  select n, 0 as k, n::bigint as c from range(256) r(n)
  union all
  select n, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end
  from divisions where k < 8
), crcs as (
  select list(c order by n) as entries from divisions where k = 8
), d as (
  select doc_id, coalesce(text, '') as body,
         octet_length(encode(coalesce(text, '')))::bigint + 8 as size,
         substr(md5(coalesce(text, '')), 1, 14) as digest
  from documents
), t as (
  select *,
         coalesce(sum(size) over (order by digest, doc_id nulls first
           range unbounded preceding exclude group), 0)::hugeint as before,
         (sum(size) over ())::hugeint as total
  from d
), s as (
  select *, ((before * 24) // total)::int as shard,
         list_prepend(4294967295::bigint, list_transform(
           regexp_extract_all(hex(encode(body)), '..'), lambda x: ('0x' || x)::bigint)) as bytes
  from t
)
select doc_id, size,
       xor(list_reduce(bytes, lambda a, x: xor(a >> 8, entries[(xor(a, x) & 255) + 1])),
           4294967295) as text_crc32,
       'bytes' as law, shard,
       row_number() over (partition by shard order by digest, doc_id nulls first) - 1 as slot,
       null::int as grown_shard
from s, crcs
"""

_OP4 = """
with p as (
  select page_id, encode(coalesce(html, '')) as payload from pages
), d as (
  select page_id, octet_length(payload)::bigint as payload_bytes, sha1(payload) as digest,
         min(page_id) over (partition by payload) as first_id
  from p
), r as (
  select *, page_id is not distinct from first_id or first_id is null as response from d
)
select page_id, payload_bytes,
       translate(array_to_string(list_transform(range(8),
           lambda i: to_base(('0x' || substr(digest, 1 + 5 * i, 5))::bigint, 32, 4)), ''),
         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') as payload_digest,
       case when response then 'response' else 'revisit' end as record_type,
       case when not response then first_id end as refers_to
from r
"""

_OP6 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as point
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), s as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.point, c.point), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.point) = len(c.point)
  where q.vec_id % 50 = 0
)
select query_id,
       row_number() over (partition by query_id order by score desc, vec_id)::int as rank,
       vec_id, score
from s
qualify rank <= 5
"""

_OP8 = r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as body from documents
), w as (
  select *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from d
), b as (
  select *, len(words)::bigint as n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
         (length(body) - length(translate(body, '#*$%&|<>', '')))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines
  from w
), wins as (
  select r, unnest(range(1, n_words - 3)) as i,
         unnest(list_transform(range(1, n_words - 3), lambda i: list_slice(words, i, i + 4))) as win
  from b where n_words >= 5
), again as (
  select r, i from wins qualify count(*) over (partition by r, win) > 1
), reps as (
  select r, count(distinct i + k)::bigint as n_repeat_words
  from again, range(5) t(k) group by r
), s as (
  select b.*, coalesce(reps.n_repeat_words, 0) as n_repeat_words from b left join reps using (r)
), f as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from s
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed
         or 10 * n_symbols > n_words
         or 20 * n_dup_lines > 7 * len(lines)
         or word_chars < 2 * n_words or word_chars > 12 * n_words
         or 2 * len(regexp_extract_all(body, '\p{Lu}')) > word_chars
         or 2 * (length(body) - length(translate(body, '!?', ''))) > n_words
         or 5 * len(regexp_extract_all(body, '\p{L}')) < 2 * word_chars
         or 5 * len(list_filter(range(2, n_words + 1), lambda i: words[i] = words[i - 1])) > n_words
       ) as kept
from f
"""

_OP12 = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as bare
  from documents
), r as (
  select *, row_number() over (partition by bare order by chars desc, doc_id nulls last) as place,
         count(*) over (partition by bare) as group_size
  from d
), k as (
  select bare, doc_id as keep_id from r where place = 1
)
select doc_id, keep_id, group_size, place = 1 as kept, sha256(bare) as text_sha256
from r join k using (bare)
"""

_OP13 = r"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), w as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from p
), grams as (
  select lang, list_slice(words, i, i + k - 1) as g
  from (select lang, words, k, unnest(range(1, len(words) - k + 2)) as i
        from w, range(1, 5) t(k) where len(words) >= k)
), f as (
  select lang, g, count(*) as a from grams group by all
), c as (
  select * from f where a >= 30 and len(g) > 1
), totals as (
  select lang, sum(a)::bigint as n from f where len(g) = 1 group by lang
), cuts as (
  select c.lang, c.g, c.a, k, x.a as l, y.a as r,
         ((2000000::hugeint * c.a) // (x.a + y.a))::bigint as score
  from c, range(1, 4) t(k)
  join f x on x.lang = c.lang and x.g = list_slice(c.g, 1, k)
  join f y on y.lang = c.lang and y.g = list_slice(c.g, k + 1, len(c.g))
  where k < len(c.g)
), best as (
  select * from cuts qualify row_number() over (partition by lang, g order by score, k) = 1
), inner_parts as (
  select lang, list_slice(g, i, i + m - 1) as g, max(a) as most
  from (select lang, g, a, m, unnest(range(1, len(g) - m + 2)) as i
        from c, range(2, 4) t(m) where m < len(g))
  group by all
), kept as (
  select best.*, array_to_string(best.g, ' ') as phrase
  from best left join inner_parts using (lang, g)
  where most is null or 100 * most < 80 * best.a
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
       phrase, a, l, r, n, score
from kept join totals using (lang)
qualify rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op1_histogram_sort": _OP1,
    "op4_content_archive": _OP4,
    "op6_kdtree_topk": _OP6,
    "op8_rule_cascade": _OP8,
    "op12_digest_merge": _OP12,
    "op13_collocations": _OP13,
}
