"""SQL that must give the rows of a query, where SQL can express it.

Quality rules, collocations, exact duplicates and centroids can; tokens, seeded hashes, fingerprints, models, scores by context and
file layouts are beyond it. Tests hold those against brute force.
"""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]"


def _normal(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({x}), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'))"


QUALITY = rf"""
with d as (
    select row_number() over () as rid, doc_id, text, coalesce(text, '') as t, coalesce(source, chr(1)) as host from documents
), w as (
    select *, regexp_extract_all(t, '{WORD}+') as words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines from d
), windows as (
    select rid, i, array_to_string(words[i:i + 4], ' ') as win from (select rid, words, unnest(range(1, len(words) - 3)) as i from w where len(words) >= 5)
), repeated as (
    select rid, count(distinct p) as n from (
        select rid, unnest(range(i, i + 5)) as p from (select rid, i, count(*) over (partition by rid, win) as c from windows) where c > 1) group by rid
), counted as (
    select w.*, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars,
        cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
        cast(coalesce(r.n, 0) as bigint) as n_repeat_words, list_transform(lines, lambda x: {_normal('x')}) as normals
    from w left join repeated r on r.rid = w.rid
), texts as (
    select rid, host, array_to_string(normals, chr(10)) as body, unnest(list_distinct(normals)) as line from counted
), hosts as (
    select host, count(distinct array_to_string(normals, chr(10))) as texts from counted group by host
), frequent as (
    select t.host, t.line from texts t join hosts h on h.host = t.host group by t.host, t.line, h.texts
    having count(distinct t.body) > 10 and count(distinct t.body) > 0.001::double * h.texts
), gone as (
    select rid, list(t.line) as gone from texts t join frequent f on f.host = t.host and f.line = t.line group by rid
), cut as (
    select c.*, g.gone, cast(case when g.gone is null then 0 else coalesce(list_sum(list_transform(
        list_filter(lines, lambda x: list_contains(g.gone, {_normal('x')})), lambda x: len(regexp_extract_all(x, '{WORD}+')))), 0) end as bigint) as removed_words,
        n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed
    from counted c left join gone g on g.rid = c.rid
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and not (removed_words > 0 and (n_words - removed_words < 10 or n_words - removed_words < 0.2::double * n_words)) as kept, removed_words,
    case when gone is null then text else array_to_string(list_filter(string_split(text, chr(10)), lambda x: not list_contains(gone, {_normal('x')})), chr(10)) end as clean_text
from cut"""


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

COLLOCATIONS = rf"""
with words as (
    select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w
    from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) as piece from documents)
), sized as (
    select lang, w, unnest(range(1, 5)) as size from words where len(w) > 0
), phrases as materialized (
    select lang, size, phrase, count(*) as f from (
        select lang, size, array_to_string(w[i:i + size - 1], ' ') as phrase from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i from sized where len(w) >= size))
    group by lang, size, phrase having count(*) >= 30
), candidates as (
    select lang, size, phrase, f as a, string_split(phrase, ' ') as w from phrases where size > 1
), cuts as (
    select c.*, k, array_to_string(w[1:k], ' ') as head, array_to_string(w[k + 1:], ' ') as tail from (select *, unnest(range(1, size)) as k from candidates) c
), scored as (
    select c.lang, c.phrase, c.a, c.k, x.f as l, y.f as r, cast((2000000::hugeint * c.a) // (x.f::hugeint + y.f) as bigint) as score
    from cuts c join phrases x on x.lang = c.lang and x.phrase = c.head join phrases y on y.lang = c.lang and y.phrase = c.tail
), best as (
    select * from (select *, row_number() over (partition by lang, phrase order by score, k) as rn from scored) where rn = 1
), longer as (
    select lang, phrase, max(a) as a from (
        select lang, array_to_string(w[i:i + size - 1], ' ') as phrase, a from (
            select lang, w, a, size, unnest(range(1, len(w) - size + 2)) as i from (select lang, w, a, unnest(range(2, size)) as size from candidates where size > 2)))
    group by lang, phrase
), ranked as (
    select b.*, row_number() over (partition by b.lang order by b.score desc, b.a desc, b.phrase) as rank
    from best b left join longer g on g.lang = b.lang and g.phrase = b.phrase where g.a is null or 100 * g.a < 80 * b.a
)
select r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score from ranked r
join (select lang, cast(sum(len(w)) as bigint) as n from words group by lang) t on t.lang = r.lang where r.rank <= 2000"""

EXACT = """
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
    row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
from (select doc_id, coalesce(text, '') as t from documents)"""


def _round(k: int) -> str:
    """The vectors' nearest centroids of c{k}, as n{k}."""
    return f"""n{k} as materialized (
    select rid, min(struct_pack(d := d, c := c)) as b from (
        select x.rid, c.c, cast(sum((x.x - c.x) * (x.x - c.x)) as bigint) as d from x join c{k} c on c.i = x.i group by x.rid, c.c) group by rid)"""


def _move(k: int) -> str:
    """Centroids c{k} after the move to the mean of what n{k - 1} gives them."""
    return f"""c{k} as materialized (
    select o.c, o.i, cast(coalesce((s.s - ((s.s % s.n) + s.n) % s.n) // s.n, o.x) as bigint) as x from c{k - 1} o left join (
        select n.b.c as c, x.i, sum(x.x) as s, count(*) as n from n{k - 1} n join x on x.rid = n.rid group by n.b.c, x.i) s on s.c = o.c and s.i = o.i)"""


CENTROIDS = f"""
with v as materialized (
    select row_number() over () as rid, vec_id, list_transform(embedding, lambda y: cast(floor(1024 * cast(y as double)) as bigint)) as v
    from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda y: y is null or not isfinite(y))) = 0
), x as materialized (
    select rid, unnest(range(1, 65)) as i, unnest(v) as x from v
), c0 as materialized (
    select c, unnest(range(1, 65)) as i, unnest(v) as x from (select v, row_number() over (order by sha256('3:' || vec_id), v) - 1 as c from v) where c < 8
), {_round(0)}, {", ".join(f"{_move(k)}, {_round(k)}" for k in range(1, 11))}
select v.vec_id, cast(n.b.c as int) as cluster, n.b.d as distance, cast(sum(n.b.d) over (partition by n.b.c) as bigint) as cluster_inertia, cast(sum(n.b.d) over () as bigint) as inertia, h.h as centroid_sha256
from n10 n join v on v.rid = n.rid join (select c, sha256(string_agg(cast(x as varchar), ',' order by i)) as h from c10 group by c) h on h.c = n.b.c"""
