"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

BLANKS = "[\\x20\\x09-\\x0D]"

LINE_DEDUP = """
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as n
  from documents
),
keyed as (
  select doc_id, n, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
),
repeated as (
  select key, min(doc_id) as first from keyed where length(key) >= 10
  group by key having count(distinct doc_id) > 1
),
judged as (
  select k.*, r.first is null or r.first = k.doc_id as stays
  from keyed k left join repeated r using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (not stays) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by n) filter (stays), '')) as kept_sha256
from judged group by doc_id
"""

CHAT = """
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all
  select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
joined as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as said,
    coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '') as loss,
    sum(length('<|im_start|>') + length(replace(replace(role, '<|', '<||'), chr(10), '<|n|>'))
      + 1 + length(replace(text, '<|', '<||')) + length('<|im_end|>') + 1) as chars
  from rows_ group by conv_id
)
select conv_id, n_turns, sha256(said) as turns_sha256, length(loss) as loss_chars,
  sha256(loss) as loss_sha256, chars::bigint as formatted_chars
from joined
"""

DECONTAMINATION = """
with split as (
  select 'd' as kind, doc_id as id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
  union all
  select 'i', item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')
  from benchmark
),
windows as (
  select distinct id as item_id, least(len(w), 10) as size,
    array_to_string(w[s:s + least(len(w), 10) - 1], ' ') as said
  from split, unnest(generate_series(1, greatest(1, len(w) - 9))) as t(s)
  where kind = 'i' and len(w) > 0
),
sizes as (select distinct size from windows),
hits as (
  select d.id, s.size, t.s as start, x.item_id
  from split d, sizes s, unnest(generate_series(1, len(d.w) - s.size + 1)) as t(s), windows x
  where d.kind = 'd' and x.size = s.size and x.said = array_to_string(d.w[t.s:t.s + s.size - 1], ' ')
),
covered as (
  select id, count(distinct p) as n_hit
  from hits, unnest(generate_series(start, start + size - 1)) as t(p) group by id
),
named as (
  select id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct id, item_id::varchar as item from hits) group by id
)
select d.id as doc_id, len(d.w) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from split d left join covered c on c.id = d.id left join named n on n.id = d.id
where d.kind = 'd'
"""

JACCARD = """
with recursive split as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents
),
grams as (
  select distinct doc_id, array_to_string(w[s:s + 3], ' ') as gram
  from split, unnest(generate_series(1, greatest(1, len(w) - 3))) as t(s)
  where len(w) > 0
),
sizes as (select doc_id, count(*) as n, md5(string_agg(gram, chr(10) order by gram)) as same
  from grams group by doc_id),
classes as (select same, min(doc_id) as class_id, any_value(n) as n from sizes group by same),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared
  from grams a join grams b on a.gram = b.gram and a.doc_id < b.doc_id
  where a.doc_id in (select class_id from classes) and b.doc_id in (select class_id from classes)
  group by all
),
links as (
  select a, b from common join classes x on x.class_id = a join classes y on y.class_id = b
  where 100 * shared >= 85 * (x.n + y.n - shared)
),
both_ways as (select a, b from links union all select b, a from links),
reach as (
  select class_id as a, class_id as b from classes
  union
  select r.a, l.b from reach r join both_ways l on l.a = r.b
)
select d.doc_id, coalesce(s.n, 0) as n_shingles,
  coalesce((select min(r.b) from reach r where r.a = c.class_id), d.doc_id) as component_id,
  coalesce(c.class_id, d.doc_id) as class_id
from split d left join sizes s using (doc_id) left join classes c using (same)
"""

EXACT_DEDUP = f"""
with d as (
  select doc_id, length(coalesce(text, '')) as n,
    sha256(regexp_replace(coalesce(text, ''), '{BLANKS}', '', 'g')) as text_sha256
  from documents
)
select doc_id, first_value(doc_id) over w as keep_id,
  count(*) over (partition by text_sha256) as group_size,
  row_number() over w = 1 as kept, text_sha256
from d window w as (partition by text_sha256 order by n desc, doc_id)
"""

WARC = """
with digests as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
    sha1(coalesce(html, '')) as hex, min(page_id) over (partition by coalesce(html, '')) as first
  from pages
)
select page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::bigint >> (35 - 5 * (i % 8))) & 31)::int, 1)
    for i in range(32)], '') as payload_digest,
  if(page_id = first, 'response', 'revisit') as record_type,
  if(page_id = first, null, first) as refers_to,
  null::varchar as problem
from digests
"""

RESAMPLING = """
with recursive bits as (
  select n, 0 as k, n::bigint as c from range(256) t(n)
  union all
  select n, k + 1, if((c & 1) = 1, xor(c >> 1, 3988292384), c >> 1) from bits where k < 8
),
crc as (select list(c order by n) as steps from bits where k = 8),
split as (
  select 'd' as kind, doc_id as id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
  union all
  select 'b', item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')
  from benchmark
),
said as (select kind, id, unnest(w) as word from split),
vocabulary as (select word, hex(encode(word)) as code from (select distinct word from said)),
buckets as (
  select word, xor(4294967295, list_reduce(
      list_prepend(4294967295::bigint, [('0x' || substr(code, 2 * i - 1, 2))::bigint
        for i in range(1, 1 + length(code) // 2)]),
      lambda c, b: xor(steps[1 + (xor(c, b) & 255)], c >> 8))) % 10000 as bucket
  from vocabulary, crc
),
hits as (select kind, id, bucket from said join buckets using (word)),
totals as (
  select count(*) filter (kind = 'd') as all_s, count(*) filter (kind = 'b') as all_t from hits
),
gains as (
  select bucket, floor(1000 * ln((count(*) filter (kind = 'b') + 1) * (any_value(all_s) + 10000)
    / ((count(*) filter (kind = 'd') + 1) * (any_value(all_t) + 10000))))::bigint as gain
  from hits, totals group by bucket
),
weighed as (
  select id, floor(sum(gain) / count(*))::bigint as weight
  from hits join gains using (bucket) where kind = 'd' group by id
),
scored as (
  select s.id as doc_id, len(w) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('2024:' || s.id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from split s left join weighed using (id) where kind = 'd'
),
placed as (
  select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n
  from scored where n_features >= 20
)
select s.*, place as rank
from scored s left join placed p on p.doc_id = s.doc_id and place <= 10 * n // 100
"""

HARD_NEGATIVES = """
with vectors as (
  select vec_id, if(vec_id % 7 = 0, (label + 1) % 10, label) as label,
    [floor(256 * x::double)::bigint for x in embedding] as v
  from embeddings
  where label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
scores as (
  select a.vec_id as anchor_id, a.label as anchor_label, r.vec_id, r.label,
    list_sum([a.v[i] * r.v[i] for i in range(1, 1 + len(a.v))])::bigint as score
  from vectors a join vectors r on r.vec_id <> a.vec_id
  where a.vec_id % 100 = 0
),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score
  from scores where label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, positive_id,
  row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id)::int as rank,
  vec_id as negative_id, positive_score, score as negative_score
from positives p join scores s
  on s.anchor_id = p.anchor_id and label <> anchor_label
  and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""


def statements() -> dict[str, str]:
    return {"op1_line_dedup": LINE_DEDUP, "op2_chat_formatting": CHAT,
            "op3_ngram_jaccard_join": JACCARD, "op4_exact_dedup": EXACT_DEDUP,
            "op5_decontamination": DECONTAMINATION, "op11_warc": WARC,
            "op12_importance_resampling": RESAMPLING, "op13_hard_negatives": HARD_NEGATIVES}
