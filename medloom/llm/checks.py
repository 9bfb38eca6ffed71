"""DuckDB queries that the registered queries must equal, where SQL can say what they compute."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

CHECKS = {
    "op3_phrase_dedup": rf"""
with d as (select doc_id, {_WORDS.format(text="coalesce(text, '')")} ws from documents),
windows as (select doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) h from d, unnest(range(1, len(ws) - 33)) t(i)),
twice as (select h from windows group by h having count(*) > 1),
gone as (select distinct doc_id, i + k pos from windows join twice using (h), unnest(range(0, 35)) t(k)),
words as (select doc_id, i pos, ws[i] w from d, unnest(range(1, len(ws) + 1)) t(i)),
kept as (select doc_id, string_agg(w, ' ' order by pos) s from words anti join gone using (doc_id, pos) group by doc_id),
lost as (select doc_id, count(*) n from gone group by doc_id)
select d.doc_id, cast(len(ws) as bigint) n_words, coalesce(lost.n, 0) n_removed, sha256(coalesce(s, '')) kept_sha256
from d left join kept using (doc_id) left join lost using (doc_id)
""",
    "op4_suffix_dedup": """
with d as (select row_number() over () r, doc_id, encode(coalesce(text, '')) b from documents),
sized as (select *, octet_length(b) n from d),
windows as (select r, i, md5(b[i + 1 : i + 200]) k from sized, unnest(range(0, n - 199)) t(i)),
twice as (select k from windows group by k having count(*) > 1),
hit as (select r, i, i > lag(i, 1, -1000) over (partition by r order by i) + 200 fresh from windows join twice using (k)),
run as (select r, i, sum(cast(fresh as integer)) over (partition by r order by i) g from hit),
span as (select r, min(i) a, max(i) + 200 z from run group by r, g),
part as (
  select r, coalesce(lag(z) over (partition by r order by a), 0) s, a e from span
  union all select r, coalesce(max(z), 0), any_value(n) from sized left join span using (r) group by r
),
kept as (select r, unhex(string_agg(hex(b[s + 1 : e]), '' order by s)) k from part join sized using (r) group by r),
gone as (select r, sum(z - a) n_removed, count(*) n_spans from span group by r)
select doc_id, n n_bytes, cast(coalesce(n_removed, 0) as bigint) n_removed, coalesce(n_spans, 0) n_spans, sha256(k) kept_sha256
from sized join kept using (r) left join gone using (r)
""",
    "op7_jaccard_join": rf"""
with recursive d as (select doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')")} ws from documents),
grams as (select distinct doc_id, array_to_string(ws[i : i + 3], ' ') g from d, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) t(i) where len(ws) > 0),
sizes as (select doc_id, count(*) n from grams group by doc_id),
shared as (select a.doc_id x, b.doc_id y, count(*) i from grams a join grams b using (g) where a.doc_id <> b.doc_id group by x, y),
links as (select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * i >= 85 * (a.n + b.n - i)),
reached(node, start) as (
  select doc_id, doc_id from documents
  union
  select y, start from reached join links on x = node where start < y
)
select documents.doc_id, coalesce(n, 0) n_shingles, least component_id from documents left join sizes using (doc_id)
join (select node doc_id, min(start) least from reached group by node) using (doc_id)
""",
    "op8_exact_dedup": r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t from documents)
select doc_id, min(doc_id) over same keep_id, count(*) over same group_size, doc_id = min(doc_id) over same kept, sha256(t) text_sha256
from d window same as (partition by t)
""",
    "op11_hard_negatives": """
with sound as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as l,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as hugeint)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))
),
parts as (select vec_id, l, unnest(q) as x, unnest(range(len(q))) as i from sound),
pairs as (
  select a.vec_id as anchor, a.l as al, b.vec_id as other, b.l as bl, cast(sum(a.x * b.x) as bigint) as s
  from parts a join parts b on a.i = b.i and a.vec_id <> b.vec_id where a.vec_id % 50 = 0 group by all
),
positives as (
  select anchor, other as p, s as ps from pairs where al = bl qualify row_number() over (partition by anchor order by s desc, other) <= 5
)
select anchor as anchor_id, p as positive_id, cast(row_number() over w as integer) as rank, other as negative_id, ps as positive_score, s as negative_score
from positives join pairs using (anchor) where al <> bl and 50 * ps <= 100 * s and 100 * s <= 95 * ps
window w as (partition by anchor, p order by s desc, other) qualify row_number() over w <= 3
""",
}
