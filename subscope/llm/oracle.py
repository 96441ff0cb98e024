"""DuckDB SQL of the operators that SQL can express, each from the definition of its result."""

from __future__ import annotations

import string

_LOWERED = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

#: A string of 100 bytes covers its bytes unless this is the first place of the table that holds it.
REPEATS = r"""
with bytes as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
parts as (  -- overlapping by 99 bytes, so that no string is looked for from the start of a long text
    select doc_id, unnest(range(0, length(h) // 2 - 99, 1000)) as base, h from bytes where length(h) >= 200),
cuttings as (select doc_id, base, substr(h, 2 * base + 1, 2198) as part from parts),
starts as (select doc_id, base, part, unnest(range(0, length(part) // 2 - 99)) as inner_place from cuttings),
strings as (
    select doc_id, base + inner_place as place, substr(part, 2 * inner_place + 1, 200) as s from starts),
firsts as (select s, min((doc_id, place)) as first from strings group by s having count(*) > 1),
later as (select doc_id, place from strings join firsts using (s) where (doc_id, place) <> first),
marked as (
    select doc_id, place, coalesce(place > lag(place) over (partition by doc_id order by place) + 100, true) as opens from later),
numbered as (
    select doc_id, place, sum(opens::int) over (partition by doc_id order by place) as span from marked),
spans as (select doc_id, span, min(place) as low, max(place) + 100 as high from numbered group by doc_id, span),
before as (
    select *, coalesce(lag(high) over (partition by doc_id order by low), 0) as open_from from spans),
cut as (
    select doc_id, sum(high - low) as n_removed, count(*) as n_spans, max(high) as last_high,
           string_agg(substr(h, 2 * open_from + 1, 2 * (low - open_from)), '' order by low) as head
    from before join bytes using (doc_id) group by doc_id)
select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last_high, 0) + 1))) as kept_sha256
from bytes left join cut using (doc_id)
"""

#: All pairs that share a shingle, then everything within reach of each document.
SIMILAR = rf"""
with recursive words as (
    select doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
    select distinct doc_id, unnest(case
        when len(w) = 0 then []
        when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
    select x.doc_id as a, y.doc_id as b, count(*) as both_
    from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id group by all),
links as (
    select a, b from shared join sizes m on m.doc_id = a join sizes n on n.doc_id = b
    where 100 * both_ >= 80 * (m.n + n.n - both_)),
reach as (
    select doc_id as a, doc_id as b from documents
    union
    select reach.a, links.b from reach join links on reach.b = links.a)
select d.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(b) as component_id
from documents d left join sizes using (doc_id) join reach on reach.a = d.doc_id group by d.doc_id
"""

#: Every vector with every other one.
NEAR_VECTORS = """
with recursive vectors as (
    select vec_id, embedding::double[] as v from embeddings
    where len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
      and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links as (
    select x.vec_id as a, y.vec_id as b from vectors x join vectors y
    on x.vec_id <> y.vec_id and len(x.v) = len(y.v) and list_cosine_similarity(x.v, y.v) >= 0.95),
reach as (
    select vec_id as a, vec_id as b from embeddings
    union
    select reach.a, links.b from reach join links on reach.b = links.a),
parts as (select a as vec_id, min(b) as component_id from reach group by a),
degrees as (select a as vec_id, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from parts left join degrees using (vec_id)
"""

#: Counts of all phrases of one to five words; the scores in 128-bit integers.
COLLOCATIONS = rf"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) as p
    from documents),
words as (select lang, regexp_extract_all(p, '[^\x20\x09]+') as w from pieces),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as i from words),
places as (select lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) as k from starts),
counts as (
    select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as a from places group by all),
totals as (select lang, sum(a) as n from counts where k = 1 group by lang),
candidates as (select *, string_split(phrase, ' ') as w from counts where k >= 2 and a >= 100),
inner_places as (
    select lang, a, k, w, unnest(range(2, k)) as size from candidates),
inner_starts as (select *, unnest(range(1, k - size + 2)) as i from inner_places),
covers as (
    select lang, array_to_string(w[i:i + size - 1], ' ') as phrase, max(a) as longer from inner_starts group by all),
left_over as (
    select c.* from candidates c left join covers v on v.lang = c.lang and v.phrase = c.phrase
    where v.longer is null or 100 * v.longer < 100 * c.a),
cuts as (select *, unnest(range(1, k)) as cut from left_over),
scores as (
    select c.lang, c.phrase, c.a, x.a as l, y.a as r, n, cut,
           (1000::hugeint * c.a * n) // (x.a::hugeint * y.a) as score
    from cuts c join totals using (lang)
    join counts x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:cut], ' ')
    join counts y on y.lang = c.lang and y.phrase = array_to_string(c.w[cut + 1:c.k], ' ')),
lowest as (
    select * from scores qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest)
select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from ranked where rank <= 2000
"""

ORACLE_SQL = {
    "op1_suffix_dedup": REPEATS, "op8_ngram_join": SIMILAR, "op10_vector_graph": NEAR_VECTORS,
    "op13_collocations": COLLOCATIONS,
}
