"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: Words of each document: ASCII white space separates them.
_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

REPEATS = f"""
with texts as (
  select doc_id, {_WORDS.format(text="coalesce(text, '')")} words from documents
), placed as (
  select doc_id, words, unnest(range(1, len(words) + 1)) place from texts
), starts as (
  select doc_id, words[place] word, place,
    case when place + 19 <= len(words) then array_to_string(words[place : place + 19], ' ') end content
  from placed
), marked as (
  select doc_id, word, place,
    (content is not null
      and row_number() over (partition by content order by doc_id, place) > 1)::int repeated
  from starts
), covered as (
  select doc_id, word, place,
    max(repeated) over (partition by doc_id order by place rows between 19 preceding and current row) gone
  from marked
), kept as (
  select doc_id, sum(gone) n_removed, string_agg(word, ' ' order by place) filter (where gone = 0) text
  from covered group by doc_id
)
select doc_id, len(words)::bigint n_words, coalesce(n_removed, 0)::bigint n_removed,
  sha256(coalesce(kept.text, '')) kept_sha256
from texts left join kept using (doc_id)
"""

NEAR_SETS = f"""
with recursive texts as (
  select doc_id, {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} words
  from documents
), sets as (
  select doc_id, list_distinct(case
    when len(words) = 0 then []
    when len(words) < 3 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i : i + 2], ' ')) end) shingles
  from texts
), members as (
  select doc_id, len(shingles) n, unnest(shingles) shingle from sets
), links as (
  select a.doc_id one, b.doc_id two
  from members a join members b on a.shingle = b.shingle and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n
  having 100 * count(*) >= 90 * (a.n + b.n - count(*))
), both_ways as (
  select one, two from links union all select two, one from links
), reached(doc_id, other) as (
  select doc_id, doc_id from sets
  union
  select reached.doc_id, both_ways.two from reached join both_ways on reached.other = both_ways.one
)
select doc_id, len(shingles)::bigint n_shingles, component_id
from sets join (select doc_id, min(other) component_id from reached group by doc_id) using (doc_id)
"""

_ASSIGNED = """select vec_id, p, x, least.d d, least.e e from (
    select vec_id, p, any_value(parts.x) x,
      min({{'d': list_inner_product(parts.x, parts.x) + list_inner_product(book.x, book.x)
        - 2 * list_inner_product(parts.x, book.x), 'e': e}}) least
    from parts join {book} book using (p) group by vec_id, p)"""

_IMPROVED = """
), near{n} as materialized ({assigned}
), sums{n} as (
  select p, e, i, floor(sum(c) / count(*)) mean
  from (select p, e, unnest(x) c, generate_subscripts(x, 1) i from near{n}) group by p, e, i
), book{next} as materialized (
  select p, e, coalesce(moved.x, book.x) x from book{n} book
  left join (select p, e, list(mean order by i) x from sums{n} group by p, e) moved using (p, e)"""

_ROUNDS = "".join(
    _IMPROVED.format(n=n, next=n + 1, assigned=_ASSIGNED.format(book=f"book{n}")) for n in range(4)
)

VECTOR_CODES = f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
  select vec_id, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] x from kept, unnest(range(4)) t(p)
), book0 as materialized (
  select p, row_number() over (partition by p order by vec_id) - 1 e, x from parts qualify e < 256{_ROUNDS}
), near4 as materialized ({_ASSIGNED.format(book="book4")}
), coded as (
  select vec_id, string_agg(printf('%02x', e), '' order by p) code, sum(d)::bigint error from near4 group by vec_id
), digest as (
  select sha256(string_agg(n::bigint::varchar, ',' order by p, e, i)) codebooks_sha256
  from (select p, e, unnest(x) n, generate_subscripts(x, 1) i from book4)
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, codebooks_sha256
from coded join kept using (vec_id), digest
"""

PHRASES = r"""
with pieces as (
  select coalesce(lang, 'und') lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) piece
  from documents
), words as (
  select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') w from pieces
), places as (
  select lang, w, unnest(range(1, len(w) + 1)) i from words
), counts as materialized (
  select lang, size, array_to_string(w[i : i + size - 1], ' ') phrase, w[i : i + size - 1] w, count(*)::hugeint f
  from places, unnest(range(1, 4)) s(size) where i + size - 1 <= len(w) group by all
), candidates as (
  select lang, size, phrase, w, f a from counts where size >= 2 and f >= 10
), cut as materialized (
  select lang, phrase, a, size, k, array_to_string(w[:k], ' ') head, array_to_string(w[k + 1 :], ' ') rest
  from (select *, unnest(range(1, size)) k from candidates)
), cuts as (
  select c.lang, c.phrase, c.a, k, l.f l, r.f r, (1000000 * a * a) // (l.f * r.f) score
  from cut c
  join counts l on l.lang = c.lang and l.phrase = head
  join counts r on r.lang = c.lang and r.phrase = rest
), least as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inside as (
  select lang, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) phrase, a longer
  from candidates where size = 3
), covered as (
  select distinct lang, phrase from candidates join inside using (lang, phrase) where 100 * longer >= 50 * a
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank
  from least anti join covered using (lang, phrase)
)
select lang, rank::bigint rank, phrase, a::bigint a, l::bigint l, r::bigint r, n, score::bigint score
from ranked join (select lang, sum(f)::bigint n from counts where size = 1 group by lang) using (lang)
where rank <= 2000
"""

ORACLES: dict[str, str] = {"op6_repeats": REPEATS, "op8_near_sets": NEAR_SETS, "op11_phrases": PHRASES, "op12_vector_codes": VECTOR_CODES}
