"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

COLLOCATIONS = rf"""with pieces as (
  select lang, row_number() over () as id, regexp_extract_all(piece, '[^\x20\x09]+') as w from (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(text, '{_LETTERS}', '{_LETTERS.lower()}'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents where text is not null)),
runs as (select lang, w[i] as w1, w[i + 1] as w2, w[i + 2] as w3 from (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces)),
one as (select lang, w1, count(*) as f from runs group by all),
two as (select lang, w1, w2, count(*) as f from runs where w2 is not null group by all),
three as (select lang, w1, w2, w3, count(*) as f from runs where w3 is not null group by all having count(*) >= 10),
total as (select lang, sum(f) as n from one group by lang),
cuts as (
  select c.lang, c.w1 || ' ' || c.w2 as phrase, 1 as k, c.f as a, p.f as l, q.f as r from two c
    join one p on p.lang = c.lang and p.w1 = c.w1 join one q on q.lang = c.lang and q.w1 = c.w2
    where c.f >= 10 and not exists (select 1 from three t where t.lang = c.lang and 100 * t.f >= 50 * c.f
      and ((t.w1 = c.w1 and t.w2 = c.w2) or (t.w2 = c.w1 and t.w3 = c.w2)))
  union all select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, 1, c.f, p.f, q.f from three c
    join one p on p.lang = c.lang and p.w1 = c.w1 join two q on q.lang = c.lang and q.w1 = c.w2 and q.w2 = c.w3
  union all select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, 2, c.f, p.f, q.f from three c
    join two p on p.lang = c.lang and p.w1 = c.w1 and p.w2 = c.w2 join one q on q.lang = c.lang and q.w1 = c.w3),
scored as (select *, cast(1000000 * a::hugeint * a // (l::hugeint * r) as bigint) as score from cuts),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from lowest)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, score from ranked join total using (lang) where rank <= 2000"""


def _assigned(name: str, book: str) -> str:
    """Each part's nearest entry, ties to the lower index, as the least of distance * 64 + index."""
    return f"""{name} as materialized (select vec_id, part, cast(min(d * 64 + entry) % 64 as bigint) as entry, min(d) as error from (
  select x.vec_id, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v)) as d from parts x join {book} b on x.part = b.part and x.pos = b.pos group by all) group by all)"""


def _moved(name: str, book: str, assigned: str) -> str:
    return f"""{name} as materialized (select b.part, b.entry, b.pos, coalesce((s.total - ((s.total % s.n) + s.n) % s.n) // s.n, b.v) as v from {book} b left join (
  select x.part, a.entry, x.pos, sum(x.v) as total, count(*) as n from parts x join {assigned} a on x.vec_id = a.vec_id and x.part = a.part group by all) s
  on s.part = b.part and s.entry = b.entry and s.pos = b.pos)"""


VECTOR_CODES = f"""with kept as (select vec_id, label, embedding from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (select vec_id, i // (size // 16) as part, i % (size // 16) as pos, cast(floor(256 * cast(embedding[i + 1] as double)) as bigint) as v
  from (select vec_id, embedding, len(embedding) as size, unnest(range(0, len(embedding))) as i from kept)),
first as (select vec_id, row_number() over (order by vec_id) - 1 as entry from kept order by vec_id limit 64),
book0 as materialized (select part, entry, pos, v from parts join first using (vec_id)),
{_assigned("a0", "book0")}, {_moved("book1", "book0", "a0")},
{_assigned("a1", "book1")}, {_moved("book2", "book1", "a1")},
{_assigned("a2", "book2")},
coded as (select vec_id, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(error) as bigint) as error from a2 group by vec_id),
digest as (select sha256(string_agg(cast(v as varchar), ',' order by part, entry, pos)) as codebooks_sha256 from book2)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from coded join kept using (vec_id), digest"""
