"""The queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_OP1 = r"""
with parts as (
    select page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
    from pages),
ruled as (
    select *, case
        when (host = 'example.net' or ends_with(host, '.example.net'))
            and starts_with(path, '/en/') then 'example.net/en/'
        when (host = 'example.com' or ends_with(host, '.example.com'))
            and starts_with(path, '/de/') then 'example.com/de/'
        when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
        when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/'
        end as rule
    from parts)
select page_id, host, path, rule,
    case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict
from ruled
"""

_OP3 = r"""
with docs as (
    select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as w from documents),
items as (
    select item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') as w
    from benchmark),
dw as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as at from docs),
iw as (
    select item_id, len(w) as n, unnest(w) as word, generate_subscripts(w, 1) as at
    from items),
hits as (
    select doc_id, item_id, least(n, 13) as size, iw.at as place,
        count(*) over (partition by doc_id, item_id, dw.at - iw.at order by iw.at
            range between current row and 12 following) as matched
    from dw join iw using (word)),
kept as (select * from hits where matched >= ceil(size * 0.8 - 1e-9))
select doc_id, item_id, max(matched) as matched, max(size) as size from kept group by doc_id, item_id
"""

_OP5 = r"""
with rows as (
    select doc_id, length(coalesce(text, '')) as points,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as content
    from documents),
ranked as (
    select *, first_value(doc_id) over w as keep_id, row_number() over w as nth,
        count(*) over (partition by content) as group_size
    from rows window w as (partition by content order by points desc, doc_id nulls last))
select doc_id, keep_id, group_size, nth = 1 as kept, sha256(content) as text_sha256 from ranked
"""


_OP7 = r"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
    from conversations
    union all
    select -1, turn, role, '</s>[INST] ok [/INST]'
    from (values (0, 'user'), (1, 'assistant')) t(turn, role)),
escaped as (
    select *,
        regexp_replace(regexp_replace(replace(text, '\', '\\'),
            '<(\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>)', '<\\\1', 'g'),
            '\[(/?INST\])', '[\\\1', 'g') as shown_text,
        regexp_replace(regexp_replace(replace(role, '\', '\\'),
            '<(\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>)', '<\\\1', 'g'),
            '\[(/?INST\])', '[\\\1', 'g') as shown_role
    from rows)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    sum(length('<|im_start|><|im_sep|><|im_end|>') + length(shown_role) + length(shown_text))::bigint as formatted_chars
from escaped group by conv_id
"""


def _op11(k: int = 40, rounds: int = 5) -> str:
    """Centroid clustering by all distances: rounds unrolled, every vector against every centroid."""
    parts = [
        """with kept as (
    select row_number() over () as r, vec_id,
        list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
    from embeddings
    where len(embedding) = 64 and list_bool_and(list_transform(embedding,
        lambda x: x is not null and 256 * x::double >= 1 - 16777216 and 256 * x::double < 16777216))),
kx as (select r, unnest(v) as x, generate_subscripts(v, 1) as i from kept),
seeds as (
    select row_number() over (order by sha256('2:' || vec_id::varchar) nulls last, v) - 1 as c, v
    from kept order by sha256('2:' || vec_id::varchar) nulls last, v limit %d),
c0 as (select c, unnest(v) as x, generate_subscripts(v, 1) as i from seeds)""" % k
    ]
    for t in range(rounds + 1):
        parts.append(
            f"""d{t} as (
    select kx.r, c{t}.c, sum((kx.x - c{t}.x) * (kx.x - c{t}.x))::bigint as dist
    from kx join c{t} using (i) group by kx.r, c{t}.c),
a{t} as (select r, first(c order by dist, c) as c, min(dist) as dist from d{t} group by r)"""
        )
        if t < rounds:
            parts.append(
                f"""s{t} as (
    select a{t}.c, kx.i, sum(kx.x) as s, count(*) as n from a{t} join kx using (r) group by a{t}.c, kx.i),
c{t + 1} as (
    select c, i, ((s - ((s % n + n) % n)) // n)::bigint as x from s{t}
    union all select c, i, x from c{t} where c not in (select c from a{t}))"""
            )
    parts.append(
        f"""digests as (
    select c, sha256(string_agg(x::varchar, ',' order by i)) as centroid_sha256 from c{rounds} group by c),
inertias as (select c, sum(dist)::bigint as cluster_inertia from a{rounds} group by c)"""
    )
    body = ",\n".join(parts)
    return body + f"""
select kept.vec_id, a.c::integer as cluster, a.dist as distance, inertias.cluster_inertia,
    (sum(a.dist) over ())::bigint as inertia, digests.centroid_sha256
from a{rounds} a join kept using (r) join inertias using (c) join digests using (c)
"""


_OP13 = r"""
with docs as (
    select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as ts
    from documents),
occ as (
    select r, lang, source,
        translate(unnest(ts), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term
    from docs),
groups as (select distinct lang, source from docs),
vocab as (
    select lang, term, count(*) as lang_count from occ group by lang, term
    having count(distinct r) >= 3),
langs as (select lang, count(*) as v, sum(lang_count) as lang_total from vocab group by lang),
gc as (
    select lang, source, term, count(*) as cnt from occ semi join vocab using (lang, term)
    group by lang, source, term),
sized as (
    select g.lang, g.source, coalesce(l.v, 0) as v, coalesce(t.total, 0) as total,
        coalesce(l.lang_total, 0) as lang_total
    from groups g left join langs l using (lang)
    left join (select lang, source, sum(cnt) as total from gc group by lang, source) t using (lang, source)),
shares as (
    select s.lang, s.source, v.term, coalesce(gc.cnt, 0) as cnt,
        1 + (1000000000::hugeint * (coalesce(gc.cnt, 0) + 1)) // (s.total + s.v) as p,
        1 + (1000000000::hugeint * (v.lang_count + 1)) // (s.lang_total + s.v) as q
    from sized s join vocab v using (lang) left join gc using (lang, source, term)),
term_rows as (
    select lang, source, 'term' as part, term as item, ((p - q) * (p - q)) // q as value
    from shares where cnt > 0 and p > q),
pv as (
    select a.lang, a.source, b.source as other, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by a.lang, a.source, b.source),
pair_rows as (
    select sa.lang, sa.source, 'pair' as part, sb.source as item, coalesce(pv.value, 0) as value
    from sized sa join sized sb on sa.lang = sb.lang and sa.source <> sb.source
    left join pv on pv.lang = sa.lang and pv.source = sa.source and pv.other = sb.source),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
    from (select * from term_rows union all select * from pair_rows))
select lang, source, part, item, value::bigint as value, rank::integer as rank
from ranked where part = 'pair' or rank <= 200
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": _OP1, "op3_decontaminate": _OP3, "op5_exact_dedup": _OP5, "op7_chat_format": _OP7,
            "op11_centroids": _op11(), "op13_divergence": _OP13}
