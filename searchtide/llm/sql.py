"""SQL for those queries of this package that SQL can express."""

from __future__ import annotations


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


_SQL: dict[str, str] = {
    "op7_warc": """
with payloads as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as hex from pages
), spelled as (
  select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int, 1)), '') as payload_digest
  from payloads
), best as (
  select *, max(page_id) over (partition by payload_digest, payload_bytes) as best from spelled
)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  case when page_id = best then 'response' else 'revisit' end as record_type,
  case when page_id <> best then best end as refers_to
from best
""",
    "op9_mixing": r"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as h
  from documents
), sources as (
  select source, sum(size)::bigint as source_size, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint as w
  from docs group by source
), levels as (
  select *, 3 * source_size as cap,
    (sum(source_size) over () - coalesce(sum(3 * source_size) over (o rows between unbounded preceding and 1 preceding), 0))::double
      / sum(w) over (o rows between current row and unbounded following) as level
  from sources window o as (order by (3 * source_size) / w::double, source nulls last)
), targets as (
  select source, source_size, least(cap::double, coalesce(max(case when level <= cap / w::double then level end) over (), 0) * w) as target
  from levels
), plan as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as passes from targets
), units as (
  select source, h, sum(size)::bigint as words from docs group by all
), running as (
  select *, sum(words) over (partition by source order by h) as upto from units
), picked as (
  select r.source, r.h, p.source_size, p.target,
    p.passes + case when r.upto <= p.target - p.passes * p.source_size
      or (r.upto - r.words <= p.target - p.passes * p.source_size and 2 * (p.target - p.passes * p.source_size - (r.upto - r.words)) >= r.words)
      then 1 else 0 end as copies
  from running r join plan p on r.source is not distinct from p.source
)
select d.doc_id, d.size, p.source_size, p.target, (d.size * p.copies)::bigint as taken, p.copies::bigint as copies
from docs d join picked p on d.h = p.h and d.source is not distinct from p.source
""",
    "op11_importance_resampling": r"""
with crc as (
  select list(list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) order by i) as steps
  from range(256) r(i)
), texts as (
  select doc_id, 'd' as side, row_number() over () as r, text from documents
  union all select null, 'b', row_number() over (), text from benchmark
), words as (
  select side, r, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w
  from texts
), buckets as (
  select w, (xor(list_reduce(
      list_transform(range(strlen(w)), lambda k: ('0x' || substr(hex(encode(w)), (2 * k + 1)::int, 2))::bigint),
      lambda c, b: xor(c >> 8, steps[((xor(c, b) & 255) + 1)::int]), 4294967295), 4294967295) % 10000)::bigint as bucket
  from (select distinct w from words), crc
), counted as (
  select bucket, count(*) filter (where side = 'd') as s, count(*) filter (where side = 'b') as t from words join buckets using (w) group by bucket
), totals as (
  select sum(s)::double as s_all, sum(t)::double as t_all from counted
), gains as (
  select bucket, floor(1000 * ln((t + 1)::double * (s_all + 10000) / ((s + 1)::double * (t_all + 10000))))::bigint as gain from counted, totals
), weights as (
  select r, count(*) as n_features, sum(gain)::bigint as weight from words join buckets using (w) join gains using (bucket) where side = 'd' group by r
), scored as (
  select t.doc_id, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(t.doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
      / 4294967296::double))))::bigint as score
  from texts t left join weights using (r) where t.side = 'd'
), placed as (
  select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id nulls last) as place,
    count(*) over (partition by n_features >= 20) as n from scored
)
select doc_id, n_features, weight, score, case when n_features >= 20 and place <= 10 * n // 100 then place end as rank from placed
""",
    "op12_chat_formatting": r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), learned as (
  select *, case when role = 'assistant' then text else '' end as loss,
    -- both control strings, the role with its escapes, two line breaks, and the text with a backslash in each look-alike
    length('<|im_start|>' || regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') || chr(10)
      || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10)) as width
  from turns
)
select conv_id, count(*)::bigint as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first)) as turns_sha256,
  sum(length(loss))::bigint as loss_chars, sha256(string_agg(loss, '' order by turn nulls first)) as loss_sha256, sum(width)::bigint as formatted_chars
from learned group by conv_id
""",
}
