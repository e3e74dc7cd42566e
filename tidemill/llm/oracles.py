"""DuckDB SQL that gives the rows of those queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

#: Targets by the closed form of the water level, and the sample by one running sum per source.
_SAMPLED = rf"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint size from documents
), base as (
  select *, row_number() over (partition by doc_id, source, size) - 1 copy from sized
), sources as (
  select source, sum(size)::bigint source_size, row_number() over (order by source nulls last) - 1 rank from sized group by source
), weighed as (
  select *, case rank % 3 when 0 then 5 when 1 then 2 else 1 end weight from sources
), filled as (
  select *, sum(source_size) over w - source_size lower_words, sum(weight) over () - (sum(weight) over w - weight) higher_weight,
         1.5::double * sum(source_size) over () total, row_number() over w n
  from weighed window w as (order by source_size / weight::double, source rows unbounded preceding)
), levels as (
  select arg_min((total - 2.0::double * lower_words) / higher_weight, n) lvl
  from filled where 2.0::double * source_size / weight >= (total - 2.0::double * lower_words) / higher_weight
), targets as (
  select source, source_size, least(2.0::double * source_size, lvl * weight) target from weighed, levels
), rates as (
  select *, case when source_size > 0 then target / source_size else 0 end ratio from targets
), parts as (
  select *, floor(ratio) whole, ratio - floor(ratio) f, target - floor(ratio) * source_size rest from rates
), drawn as (
  select b.*, p.source_size, p.target, p.whole, p.f, p.rest,
         (('0x' || substr(md5('mix|' || coalesce(doc_id::varchar, '') || '|' || coalesce(b.source, '') || '|' || size || '|' || copy), 1, 13))::bigint::double + 0.5)
           / 4503599627370496.0::double u
  from base b join parts p on b.source is not distinct from p.source
), odds as (
  select *, case when f > 0 then (u / (1 - u)) / (f / (1 - f)) end o from drawn
), ranks as (
  select *, o / (1 + o) c from odds
), ran as (
  select *, f > 0 and sum(size) over (partition by source order by c, doc_id, copy rows unbounded preceding) <= rest taken from ranks
), gap0 as (
  select source, any_value(rest) - coalesce(sum(size) filter (taken), 0) gap from ran where f > 0 group by source
), free0 as (
  select * from ran where f > 0 and not taken
)"""

#: One document more per source, the nearest to what is left, if it brings the total nearer.
_CLOSE = """, close{n} as (
  select r.source, r.doc_id, r.size, r.copy, g.gap - r.size gap from free{m} r join gap{m} g on r.source is not distinct from g.source
  where abs(g.gap - r.size) < g.gap
  qualify row_number() over (partition by r.source order by abs(g.gap - r.size), c, r.doc_id, r.size, r.copy) = 1
), gap{n} as (
  select source, gap from close{n}
), free{n} as (
  select * from free{m} r
  where not exists (select 1 from close{n} k where k.source is not distinct from r.source and k.doc_id is not distinct from r.doc_id and k.size = r.size and k.copy = r.copy)
)"""

MIX = _SAMPLED + "".join(_CLOSE.format(n=n, m=n - 1) for n in range(1, 5)) + """, closing as (
  select source, doc_id, size, copy from close1 union all select source, doc_id, size, copy from close2
  union all select source, doc_id, size, copy from close3 union all select source, doc_id, size, copy from close4
)
select r.doc_id, r.size, r.source_size, r.target, (r.size * (r.whole + (r.taken or c.size is not null)::int))::bigint taken
from ran r left join closing c on r.source is not distinct from c.source and r.doc_id is not distinct from c.doc_id and r.size = c.size and r.copy = c.copy
"""

#: Links by counting shared shingles of all pairs; components by spreading the least id.
NEAR_DEDUP = rf"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') w from documents
), shingles as (
  select distinct doc_id, unnest(case when len(w) >= 2 then list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) else w end) s from words
), sizes as (
  select doc_id, count(*) n from shingles group by doc_id
), shared as (
  select a.doc_id a, b.doc_id b, count(*) n from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
  select a, b from shared s join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * s.n >= 80 * (x.n + y.n - s.n)
), both_ways as (
  select a, b from links union select b, a from links
), reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union
  select r.doc_id, e.b from reach r join both_ways e on e.a = r.other
), named as (
  select doc_id, min(other) component_id from reach group by doc_id
)
select d.doc_id, coalesce(n, 0)::bigint n_shingles, component_id, d.doc_id = component_id kept
from documents d join named using (doc_id) left join sizes using (doc_id)
"""

#: All pairs.
NEAR_VECTORS = """
with recursive vectors as (
  select vec_id, embedding::double[] v from embeddings
), usable as (
  select vec_id, v from vectors
  where len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id a, b.vec_id b from usable a join usable b on a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.95
), reach(vec_id, other) as (
  select vec_id, vec_id from embeddings
  union
  select r.vec_id, l.b from reach r join links l on l.a = r.other
), named as (
  select vec_id, min(other) component_id from reach group by vec_id
), counted as (
  select a vec_id, count(*) n from links group by a
)
select n.vec_id, coalesce(c.n, 0)::bigint n_links, component_id, n.vec_id = component_id kept from named n left join counted c using (vec_id)
"""

#: Phrases of two and three words by their words; a piece is a list of words.
COLLOCATIONS = r"""
with pieces as (
  select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece
  from documents
), split as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from pieces
), one as (
  select lang, x, count(*) f from (select lang, unnest(w) x from split) group by all
), two as (
  select lang, g.x x, g.y y, count(*) f from (select lang, unnest(list_transform(range(1, len(w)), lambda i: {'x': w[i], 'y': w[i + 1]})) g from split) group by all having count(*) >= 10
), three as (
  select lang, g.x x, g.y y, g.z z, count(*) f
  from (select lang, unnest(list_transform(range(1, len(w) - 1), lambda i: {'x': w[i], 'y': w[i + 1], 'z': w[i + 2]})) g from split) group by all having count(*) >= 10
), inside as (
  select lang, x, y, max(f) g from (select lang, x, y, f from three union all select lang, y, z, f from three) group by all
), pairs as (
  select t.lang, t.x || ' ' || t.y phrase, t.f a, l.f l, r.f r, (1000000::hugeint * t.f * t.f) // (l.f::hugeint * r.f) score
  from two t join one l on l.lang = t.lang and l.x = t.x join one r on r.lang = t.lang and r.x = t.y
  left join inside i on i.lang = t.lang and i.x = t.x and i.y = t.y where i.g is null or 100 * i.g < 50 * t.f
), cuts as (
  select t.lang, t.x || ' ' || t.y || ' ' || t.z phrase, t.f a, h.f l1, hr.f r1, (1000000::hugeint * t.f * t.f) // (h.f::hugeint * hr.f) s1,
         tl.f l2, e.f r2, (1000000::hugeint * t.f * t.f) // (tl.f::hugeint * e.f) s2
  from three t join one h on h.lang = t.lang and h.x = t.x join one e on e.lang = t.lang and e.x = t.z
  join two hr on hr.lang = t.lang and hr.x = t.y and hr.y = t.z join two tl on tl.lang = t.lang and tl.x = t.x and tl.y = t.y
), phrases as (
  select * from pairs union all
  select lang, phrase, a, case when s2 < s1 then l2 else l1 end, case when s2 < s1 then r2 else r1 end, least(s1, s2) from cuts
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) rank from phrases
), words as (
  select lang, sum(f)::bigint n from one group by lang
)
select lang, rank, phrase, a, l, r, n, score::bigint score from ranked join words using (lang) where rank <= 2000
"""

#: Every score of every document that holds a term of the item.
SEARCH = r"""
with terms as (
  select row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) t
  from (select row_number() over () row, doc_id, text from documents)
), counted as (
  select row, doc_id, t, count(*) tf from terms group by all
), lengths as (
  select row, sum(tf)::bigint n from counted group by row
), totals as (
  select count(*) documents, sum(n)::bigint words from lengths
), weights as (
  select t, floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1)::double))::bigint w from counted, totals group by t
), asked as (
  select item, item_id, t, count(*) times from (
    select item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) t
    from (select row_number() over () item, item_id, text from benchmark)) group by all
), scored as (
  select item, item_id, row, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // words))))::bigint score
  from asked join weights using (t) join counted using (t) join lengths using (row), totals group by all
)
select item_id, rank::int rank, doc_id, score from (
  select *, row_number() over (partition by item order by score desc, doc_id) rank from scored where score > 0
) where rank <= 20
"""


def oracles() -> dict[str, str]:
    return {"op4_minhash_near_dedup": NEAR_DEDUP, "op8_embedding_near_dedup": NEAR_VECTORS, "op10_mix_sources": MIX, "op11_collocations": COLLOCATIONS, "op13_lexical_search": SEARCH}
