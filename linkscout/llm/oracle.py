"""DuckDB SQL for the queries of this subpackage that SQL can express."""

SQL: dict[str, str] = {}

SQL["op4_substring_dedup"] = r"""
with docs as (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents
),
starts as (select doc_id, ws, unnest(range(1, len(ws) - 18)) as p from docs where len(ws) >= 20),
windows as (select doc_id, p, array_to_string(ws[p : p + 19], ' ') as g from starts),
later as (
    select doc_id, p from (select doc_id, p, row_number() over (partition by g order by doc_id, p) as r from windows) where r > 1
),
gone as (select distinct doc_id, p + k as i from later, (select unnest(range(20)) as k)),
each as (select doc_id, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as i from docs),
kept as (
    select doc_id, count(*) as n, string_agg(w, ' ' order by i) as t from each anti join gone using (doc_id, i) group by doc_id
)
select d.doc_id, len(d.ws) as n_words, len(d.ws) - coalesce(k.n, 0) as n_removed, sha256(coalesce(k.t, '')) as kept_sha256
from docs d left join kept k using (doc_id)
"""

SQL["op2_host_reputation"] = r"""
with recursive urls as (
    select p.page_id, p.url,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path, l.bad
    from pages p left join (select doc_id, max(case when quality = 0 or toxic = 1 then 1.0 else 0.0 end) as bad from labels group by doc_id) l
        on l.doc_id = p.page_id
),
hosts as (
    select host, array_to_string(string_split(host, '.')[-2:], '.') as domain, string_split(host, '.')[-1] as suffix,
        count(bad) as n, coalesce(sum(bad), 0) as x
    from urls group by host
),
domain_sums as (select domain, suffix, sum(n) as n, sum(x) as x from hosts group by all),
suffix_sums as (select suffix, sum(n) as n, sum(x) as x from hosts group by suffix),
s0 as (select *, (px - x + pk * pprior) / (pn - n + pk) as prior from (select *, (select sum(n) from hosts) as pn, (select sum(x) from hosts) as px, 0.5::double as pprior, 1.0::double as pk from suffix_sums) t),
s1 as (
    select sum(case when n > 0 then n * (x / n - prior) ** 2 - prior * (1 - prior) end) as over_,
        sum(case when n > 0 then (n - 1) * prior * (1 - prior) end) as room
    from s0
),
suffixes as (
    select t.*, least(case when room > 0 then case when over_ / room > 0 then least(greatest(room / over_ - 1, 1.0), 1000.0)
        else 1000.0 end else 10.0 end, pn - n + pk) as k
    from s0 t, s1
),
d0 as (select *, (px - x + pk * pprior) / (pn - n + pk) as prior from (select c.domain, c.n, c.x, p.n as pn, p.x as px, p.prior as pprior, p.k as pk from domain_sums c join suffixes p using (suffix)) t),
d1 as (
    select sum(case when n > 0 then n * (x / n - prior) ** 2 - prior * (1 - prior) end) as over_,
        sum(case when n > 0 then (n - 1) * prior * (1 - prior) end) as room
    from d0
),
domains as (
    select t.*, least(case when room > 0 then case when over_ / room > 0 then least(greatest(room / over_ - 1, 1.0), 1000.0)
        else 1000.0 end else 10.0 end, pn - n + pk) as k
    from d0 t, d1
),
h0 as (select *, (px - x + pk * pprior) / (pn - n + pk) as prior from (select c.host, c.n, c.x, p.n as pn, p.x as px, p.prior as pprior, p.k as pk from hosts c join domains p using (domain)) t),
h1 as (
    select sum(case when n > 0 then n * (x / n - prior) ** 2 - prior * (1 - prior) end) as over_,
        sum(case when n > 0 then (n - 1) * prior * (1 - prior) end) as room
    from h0
),
rated as (
    select t.*, least(case when room > 0 then case when over_ / room > 0 then least(greatest(room / over_ - 1, 1.0), 1000.0)
        else 1000.0 end else 10.0 end, pn - n + pk) as k
    from h0 t, h1
),
p3 as (select host, n, x, (x + k * prior) / (n + k) as mean, n + k as weight from rated),
p4 as (select *, mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) as bound from p3),
rules as (select * from (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) as r(rh, rp, v)),
fits as (
    select page_id, url, rh || rp as rule, v, row_number() over (partition by page_id, url order by length(rh || rp) desc) as best
    from (select distinct page_id, url, host, path from urls) join rules on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
)
select u.page_id, u.host, u.path, f.rule,
    coalesce(f.v, case when bound > 0.5 then 'block' else 'allow' end) as verdict, n::bigint as n_labelled, x::bigint as n_bad,
    floor(mean * 1e6 + 0.5) / 1e6 as mean, floor(bound * 1e6 + 0.5) / 1e6 as bound
from urls u join p4 using (host) left join (select * from fits where best = 1) f on f.page_id = u.page_id and f.url = u.url
"""

SQL["op6_source_mix"] = r"""
with recursive docs as (
    select doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as size,
        md5(concat_ws('|', doc_id::varchar, md5(coalesce(text, '')))) as turn
    from documents
),
sources as (
    select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as s from docs group by source
),
weighed as (select *, [3.0, 1.0, 2.0][((s - 1) % 3 + 1)::int]::double as w, 2.0::double * source_size as cap from sources),
levels as (
    select *, (1.5::double * sum(source_size) over () - coalesce(sum(cap) over (order by source_size / w, s rows between unbounded preceding and 1 preceding), 0))
        / sum(w) over (order by source_size / w, s rows between current row and unbounded following) as level
    from weighed
),
final as (select level from levels where level * w <= cap order by source_size / w, s limit 1),
aims as (select source, source_size, least(cap, (select level from final) * w) as target from levels),
placed as (
    select doc_id, d.source, size, source_size, target,
        coalesce(sum(size) over (partition by d.source order by turn, doc_id, size rows between unbounded preceding and 1 preceding), 0) as start
    from docs d join aims a on a.source is not distinct from d.source
),
blocks as (select source, floor(target)::bigint as words, (floor(target)::bigint + 999) // 1000 as n from aims),
bases as (
    select source, n, coalesce(sum(n) over (order by source nulls last rows between unbounded preceding and 1 preceding), 0)::bigint as base
    from blocks
),
total as (select coalesce(sum(n), 0)::bigint as total from blocks),
points as (select i as slot, (i * 1327217885) % 2147483648 * total // 2147483648 as part from total, (select unnest(range((select 2 * total + 2 from total))) as i)),
slots as (
    select source, slot, row_number() over (partition by source order by slot) - 1 as block
    from (select part, min(slot) as slot from points group by part) join bases on part >= base and part < base + n
)
select doc_id, size::bigint as size, source_size, target,
    (least(greatest(floor(target) - start, 0), size) + least(greatest(floor(target) - source_size - start, 0), size))::bigint as taken,
    case when size > 0 and start < floor(target) then slot end as first_slot
from placed p left join slots s on s.source is not distinct from p.source and s.block = start // 1000
"""

SQL["op10_warc"] = r"""
with payloads as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as h from pages
),
parts as (select h, unnest(range(8)) as i from (select distinct h from payloads)),
digits as (select h, i, ('0x' || substr(h, (5 * i + 1)::int, 5))::bigint as v from parts),
named as (
    select h, string_agg(
        substr(a, (v >> 15) % 32 + 1, 1) || substr(a, (v >> 10) % 32 + 1, 1) || substr(a, (v >> 5) % 32 + 1, 1) || substr(a, v % 32 + 1, 1),
        '' order by i
    ) as payload_digest
    from digits, (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' as a) group by h
),
firsts as (select h, min(page_id) as first_page from payloads group by h)
select page_id, payload_bytes, payload_digest, case when page_id > first_page then 'revisit' else 'response' end as record_type,
    case when page_id > first_page then first_page end as refers_to
from payloads join named using (h) join firsts using (h)
"""

#: Unsigned CRC-32 of an id's decimal digits, bit by bit.
CRC32 = r"""xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), range(8)), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)
), 4294967295::bigint)"""

SQL["op11_merkle_manifest"] = rf"""
with recursive docs as (
    select *, {CRC32} % 2 = 0 as even from documents
),
fields as (
    select doc_id, source, text, even,
        concat(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
            coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')) as head,
        case when even then replace(text, chr(10), '') else text end as changed
    from docs
),
leaves as (
    select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
        sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) as claim,
        row_number() over (partition by source order by doc_id) - 1 as pos
    from fields
),
inner_tree as (
    select source, 0 as level, pos, leaf as node, count(*) over (partition by source) as n from leaves
    union all
    select source, level, pos, node, count(*) over (partition by source) from (
        select source, level + 1 as level, pos // 3 as pos, sha256(string_agg(node, '' order by pos)) as node
        from inner_tree where n > 1 group by source, level, pos // 3
    )
),
subroots as (select source, node as subroot, level as height, row_number() over (order by source nulls first) - 1 as pos from inner_tree where n = 1),
outer_tree as (
    select 0 as level, pos, subroot as node, count(*) over () as n from subroots
    union all
    select level, pos, node, count(*) over () from (
        select level + 1 as level, pos // 3 as pos, sha256(string_agg(node, '' order by pos)) as node
        from outer_tree where n > 1 group by level, pos // 3
    )
),
total as (select level as height, node as root from outer_tree where n = 1),
steps as (
    select l.doc_id, t.level, l.pos // (3 ** t.level)::bigint as own, t.pos, t.node from leaves l
    join subroots s on s.source is not distinct from l.source
    join inner_tree t on t.source is not distinct from l.source and t.level < s.height
        and t.pos // 3 = l.pos // (3 ** (t.level + 1))::bigint
    union all
    select l.doc_id, s.height + t.level, s.pos // (3 ** t.level)::bigint, t.pos, t.node from leaves l
    join subroots s on s.source is not distinct from l.source
    join outer_tree t on t.level < (select height from total) and t.pos // 3 = s.pos // (3 ** (t.level + 1))::bigint
),
proofs as (select doc_id, string_agg(node, '' order by level, pos) as proof from steps where pos <> own group by doc_id),
sides as (
    select doc_id, level, coalesce(string_agg(node, '' order by pos) filter (pos < own), '') as before,
        coalesce(string_agg(node, '' order by pos) filter (pos > own), '') as after
    from steps group by doc_id, level
),
fold as (
    select doc_id, 0 as level, claim as node from leaves
    union all
    select doc_id, f.level + 1, sha256(before || node || after) from fold f join sides using (doc_id, level)
),
tips as (select doc_id, arg_max(node, level) as folded_root from fold group by doc_id)
select l.doc_id, l.leaf, s.subroot, root, sha256(coalesce(proof, '')) as proof_sha256, folded_root, folded_root = root as verified
from leaves l join subroots s on s.source is not distinct from l.source join tips using (doc_id) left join proofs using (doc_id), total
"""

SQL["op13_periodic_runs"] = rf"""
with docs as (
    select doc_id, {CRC32} as h, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
    from documents
),
sized as (
    select doc_id, ws, len(ws) as n, case when h % 10 = 0 and len(ws) > 0 then (h // 10) % len(ws) end as a, 3 + (h // 10) % 8 as part
    from docs
),
each as (
    select doc_id, n, i, ws[(case when i >= a then a + (i - a) % (1 + (n - a) // part) else i end) + 1] as w
    from (select doc_id, ws, n, a, part, unnest(range(n)) as i from sized)
),
pairs as (select x.doc_id, x.i, y.i - x.i as p from each x join each y on x.doc_id = y.doc_id and x.w = y.w and y.i > x.i and y.i - x.i <= x.n // 4),
islands as (select doc_id, p, i, i - row_number() over (partition by doc_id, p order by i) as k from pairs),
stretches as (select doc_id, p, min(i) as s, count(*) + p as l from islands group by doc_id, p, k having count(*) >= 3 * p and count(*) + p >= 6),
runs as (select doc_id, s, l, min(p) as p from stretches group by doc_id, s, l),
best as (select * from runs qualify row_number() over (partition by doc_id order by l / p desc, s, p) = 1),
spelled as (select doc_id, count(*) as n_runs, string_agg(s || ',' || l || ',' || p || chr(10), '' order by s, p) as t from runs group by doc_id),
gone as (select distinct doc_id, unnest(range(s + p, s + l)) as i from runs),
kept as (select doc_id, string_agg(w, ' ' order by i) as t from each anti join gone using (doc_id, i) group by doc_id)
select d.doc_id, coalesce(n_runs, 0) as n_runs, s as start, l as length, p as period, (1000 * l) // p as exponent_milli,
    sha256(coalesce(r.t, '')) as runs_sha256, sha256(coalesce(k.t, '')) as collapsed_sha256
from docs d left join spelled r using (doc_id) left join best using (doc_id) left join kept k using (doc_id)
"""
