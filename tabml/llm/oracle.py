"""DuckDB SQL for the corpus queries that SQL can express; written from the definitions, not from the operators."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_LOW = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RULES = ("base", "symbols", "lines", "length")


def quality() -> str:
    priors = ", ".join(
        f"sum({r})::double / sum(n) as m_{r}, sum({r}::double * {r} / n) - sum({r})::double * sum({r}) / sum(n) as s_{r}" for r in _RULES
    )
    # moments of the beta-binomial: between-host variance, at least 1e-6; its weight outweighs every host where it can't be told
    weights = ", ".join(
        f"""case when m_{r} * (1 - m_{r}) <= 0 or room <= 0 then 1e6
        else 1 / least(greatest((s_{r} - m_{r} * (1 - m_{r}) * (hosts - 1)) / (m_{r} * (1 - m_{r}) * room), 1e-6), 0.999) - 1 end as w_{r}, m_{r}"""
        for r in _RULES
    )
    rates = ", ".join(f"({r} + w_{r} * m_{r}) / (n + w_{r}) as rate_{r}" for r in _RULES)
    # two posterior deviations from the prior's mean make a host worse or better than usual
    margin = "2 * sqrt(greatest(rate_{0} * (1 - rate_{0}), 0::double) / (n + w_{0} + 1))"
    worse = "rate_{0} - " + margin + " > m_{0}"
    better = "rate_{0} + " + margin + " < m_{0}"
    tolerances = ", ".join(
        f"case when {worse.format('base')} or {worse.format(r)} then 1 when {better.format(r)} then 3 else 2 end as tol_{r}" for r in _RULES[1:]
    )
    return f"""
with base as (select row_number() over () as rid, doc_id, source, coalesce(text, '') as t from documents),
tok as (select *, regexp_extract_all(t, '{_WORD}') as ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as ls from base),
win as (select rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g from (select rid, ws, unnest(range(1, len(ws) - 1)) as i from tok)),
twice as (select rid, g from win group by rid, g having count(*) > 1),
covered as (select rid, count(distinct i + k) as n from win join twice using (rid, g), (select unnest([0, 1, 2]) as k) group by rid),
q as (select tok.*, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words
  from tok left join covered using (rid)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as f_base, 100 * n_symbols > 10 * n_words as f_symbols,
  100 * n_dup_lines > 30 * len(ls) as f_lines, word_chars < 3 * n_words or word_chars > 12 * n_words as f_length from q),
hosts as (select source as host, count(*) as n, {", ".join(f"sum(f_{r}::int) as {r}" for r in _RULES)} from f group by source),
moments as (select count(*) as hosts, sum(n) - sum(n::double * n) / sum(n) - (count(*) - 1) as room, {priors} from hosts),
prior as (select {weights} from moments),
rated as (select *, {rates} from hosts, prior),
verdict as (select host, rate_base > 0.9 as blocked, {tolerances} from rated),
weighed as (select *, case when f_symbols then 100::double * n_symbols / (10 * n_words) / tol_symbols else 0 end
  + case when f_lines then 100::double * n_dup_lines / (30 * len(ls)) / tol_lines else 0 end
  + case when f_length then greatest(3::double * n_words / word_chars, word_chars::double / (12 * n_words)) / tol_length else 0 end as excess
  from f join verdict on source is not distinct from host)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f_base as base_failed,
  not f_base and not blocked and excess <= 1 as kept
from weighed"""


def decontam() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
with item as (select item_id::varchar as item, regexp_extract_all({_LOW.format("text")}, '{word}') as ws from benchmark),
window_of as (select distinct item, least(13, len(ws)) as size, array_to_string(ws[i : i + 12], ' ') as g from (select *, unnest(range(1, greatest(len(ws) - 11, 2))) as i from item where len(ws) > 0)),
doc as (select row_number() over () as rid, doc_id, regexp_extract_all({_LOW.format("text")}, '{word}') as ws from documents),
sizes as (select distinct size from window_of),
gram as (select rid, size, i, array_to_string(ws[i : i + size - 1], ' ') as g from (select rid, ws, size, unnest(range(1, len(ws) - size + 2)) as i from doc, sizes)),
hit as (select rid, i, size, item from gram join window_of using (size, g)),
words as (select rid, count(distinct pos) as n_hit from (select rid, unnest(range(i, i + size)) as pos from hit) group by rid),
items as (select rid, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids from hit group by rid)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from doc left join words using (rid) left join items using (rid)"""


def neardup() -> str:
    return f"""
with recursive doc as (select doc_id, regexp_extract_all({_LOW.format("text")}, '{_WORD}') as ws from documents),
shingle as (select distinct doc_id, array_to_string(ws[i : i + 4], ' ') as g from (select *, unnest(range(1, greatest(len(ws) - 3, 2))) as i from doc where len(ws) > 0)),
size as (select doc_id, count(*) as n from shingle group by doc_id),
pair as (select a.doc_id as a, b.doc_id as b, count(*) as both_have from shingle a join shingle b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
link as (select a, b from pair join size x on x.doc_id = a join size y on y.doc_id = b where 100 * both_have >= 85 * (x.n + y.n - both_have)),
reach as (select doc_id as a, doc_id as b from doc union select reach.a, link.b from reach join link on link.a = reach.b),
least_of as (select a as doc_id, min(b) as component_id from reach group by a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept from least_of left join size using (doc_id)"""


def mixing() -> str:
    return f"""
with doc as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint as size,
  ('0x' || substr(md5(concat_ws('|', '0', doc_id::varchar, text)), 1, 11))::bigint as rank from documents),
src as (select source, sum(size)::bigint as n, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w from doc group by source),
ahead as (select *, coalesce(sum(3 * n) over before, 0) as used, coalesce(sum(w) over before, 0) as w_used, sum(n) over () as total, sum(w) over () as w_all
  from src window before as (order by n::double / w, source nulls last rows between unbounded preceding and 1 preceding)),
full_up as (select *, 3 * n * (w_all - w_used) <= (total - used) * w as capped from ahead),
rest as (select coalesce(sum(3 * n) filter (where capped), 0) as used, coalesce(sum(w) filter (where capped), 0) as w_used, max(total) as total, max(w_all) as w_all from full_up),
goal as (select source, n, case when capped then (3 * n)::double else ((rest.total - rest.used) * w)::double / (rest.w_all - rest.w_used)::double end as target from full_up, rest),
flow as (select *, case when n > 0 then least(round(target)::bigint, 3 * n) // n else 0 end as times, case when n > 0 then least(round(target)::bigint, 3 * n) % n else 0 end as part from goal),
spot as (select source, rank, sum(sum(size)) over (partition by source order by rank) as upto from doc group by source, rank),
cut as (select flow.source, coalesce(max(upto) filter (where upto <= part), 0) as low, min(upto) filter (where upto >= part) as high, any_value(part) as part
  from flow left join spot on flow.source is not distinct from spot.source group by flow.source),
edge as (select source, case when part - low <= high - part then low else high end as upto from cut)
select doc.doc_id, doc.size, flow.n as source_size, flow.target, (doc.size * (times + (times < 3 and edge.upto > 0 and spot.upto <= edge.upto)::int))::bigint as taken
from doc join flow on doc.source is not distinct from flow.source join edge on doc.source is not distinct from edge.source
join spot on doc.source is not distinct from spot.source and doc.rank = spot.rank"""


def quotes(source: str) -> str:
    bare = r"trim(regexp_replace(lower({0}), '[ \t\x0B\f\r]+', ' ', 'g'))"
    marks = r"^((?:[ \t]*>)*)"
    return f"""
with recursive message as (select row_number() over () as rid, * from (select distinct conv_id, turn, role, text from ({source}) s)),
split as (select *, string_split(coalesce(text, ''), chr(10)) as ls from message),
line as (select rid, conv_id, turn, i, ls[i] as raw, length(regexp_replace(regexp_extract(ls[i], '{marks}', 1), '[^>]', '', 'g')) as level,
  regexp_replace(regexp_replace(ls[i], '{marks}', ''), '^ ', '') as body from (select *, unnest(range(1, len(ls) + 1)) as i from split)),
told as (select *, level = 0 and regexp_matches(raw, 'wrote:[ \\t\\r]*$') and coalesce(lead(level) over w, 0) > 0 as attribution, coalesce(lag(level) over w, 0) as before
  from line window w as (partition by rid order by i)),
plain as (select rid, trim(coalesce(string_agg(body, chr(10) order by i) filter (where level = 0 and not attribution), '')) as text,
  count(*) filter (where level > 0) as n_quoted, count(*) filter (where level > 0 and level <> before) as n_passages from told group by rid),
own_part as (select conv_id, turn, {bare.format("body")} as b from told where level = 0 and not attribution
  union all select conv_id, turn, {bare.format("string_agg(body, ' ' order by i)")} from told where level = 0 and not attribution group by rid, conv_id, turn),
first_of as (select conv_id, b, min(turn) as origin from own_part where b <> '' group by 1, 2),
quoted as (select rid, conv_id, turn, level, i, {bare.format("body")} as b, i - row_number() over (partition by rid, level order by i) as run from told where level > 0),
passage as (select rid, conv_id, turn, level, run, count(*) as n, {bare.format("string_agg(b, ' ' order by i)")} as b from quoted group by all),
whole as (select p.*, case when f.origin < p.turn then f.origin end as origin from passage p left join first_of f on p.conv_id = f.conv_id and p.b = f.b),
byline as (select q.rid, q.conv_id, q.turn, q.level, q.run, q.b, row_number() over (partition by q.rid, q.level, q.run order by i) as k, case when f.origin < q.turn then f.origin end as origin
  from quoted q join whole w on q.rid = w.rid and q.level = w.level and q.run = w.run and w.origin is null left join first_of f on q.conv_id = f.conv_id and q.b = f.b where q.b <> ''),
lost as (select *, k - row_number() over (partition by rid, level, run order by k) as next_to from byline where origin is null),
said as (select conv_id, turn, ' ' || {bare.format("string_agg(body, ' ' order by i)")} || ' ' as b from told where level = 0 and not attribution group by rid, conv_id, turn),
part as (select rid, conv_id, turn, level, run, next_to, count(*) as n, string_agg(b, ' ' order by k) as b from lost group by all),
together as (select part.rid, part.conv_id, part.turn, level, run, next_to, n, min(said.turn) as origin
  from part left join said on part.conv_id = said.conv_id and said.turn < part.turn and contains(said.b, ' ' || part.b || ' ') group by all),
alone as (select l.conv_id, l.turn, l.level, l.rid, l.run, l.k, min(said.turn) as origin
  from lost l join together t on l.rid = t.rid and l.level = t.level and l.run = t.run and l.next_to = t.next_to and t.n > 1 and t.origin is null
  join said on l.conv_id = said.conv_id and said.turn < l.turn and contains(said.b, ' ' || l.b || ' ') group by all),
linked as (select conv_id, turn, level, n, origin from whole where origin is not null
  union all select conv_id, turn, level, 1, origin from byline where origin is not null
  union all select conv_id, turn, level, n, origin from together where origin is not null
  union all select conv_id, turn, level, 1, origin from alone),
votes as (select conv_id, turn, origin, sum(n) as n from linked where level = 1 and origin is not null group by 1, 2, 3),
reply as (select conv_id, turn, origin as parent from votes qualify row_number() over (partition by conv_id, turn order by n desc, origin desc) = 1),
walk as (select conv_id, turn, parent as up from reply union select walk.conv_id, walk.turn, reply.parent from walk join reply on walk.conv_id = reply.conv_id and walk.up = reply.turn),
root as (select conv_id, turn, min(up) as root from walk group by 1, 2),
found as (select conv_id, turn, coalesce(sum(n) filter (where origin is not null), 0)::bigint as n_linked from linked group by 1, 2)
select m.conv_id, m.turn, m.role, plain.text, n_passages, n_quoted, coalesce(n_linked, 0) as n_linked, parent as reply_to, coalesce(root, m.turn) as thread,
  concat('<|', coalesce(m.role, ''), '|>', chr(10), plain.text) as formatted
from message m join plain using (rid) left join found using (conv_id, turn) left join reply using (conv_id, turn) left join root using (conv_id, turn)"""


def line_dedup() -> str:
    return f"""
with doc as (select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
line as (select rid, doc_id, i, ls[i] as line, trim({_LOW.format("ls[i]")}, concat(chr(32), chr(9), chr(10), chr(11), chr(12), chr(13))) as k
  from (select *, unnest(range(1, len(ls) + 1)) as i from doc)),
shared as (select k, min(doc_id) as keeper from line where length(k) >= 10 group by k having count(distinct doc_id) + max((doc_id is null)::int) >= 2),
marked as (select line.*, shared.k is not null and doc_id is distinct from keeper as gone from line left join shared on line.k = shared.k)
select doc_id, count(*)::bigint as n_lines, (count(*) filter (where gone))::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by rid, doc_id"""


def trie() -> str:
    # crc32 of the decimal number, bit by bit
    step = "list_reduce(range(8), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(r, ascii(d)))"
    crc = f"xor(list_reduce(string_split(conv::varchar, ''), lambda r, d: {step}, 4294967295::bigint), 4294967295)"
    return f"""
with said as (select conv_id as conv, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos,
  struct_pack(role := coalesce(role, ''), said := coalesce(text, '')) as said from conversations where conv_id is not null),
whole as (select conv, list(said order by pos) as said from said group by conv),
heads as (select *, conv - conv % 100 as base, ({crc} % 6)::int as h from whole),
built as (select a.conv, list_concat(coalesce(b.said[1 : a.h], []), a.said[a.h + 1 :]) as path from heads a left join whole b on b.conv = a.base),
prefix as (select conv, len(path) as size, d, path[1 : d] as node from (select *, unnest(range(0, len(path) + 1)) as d from built)),
node as (select d, node, min(conv) as conv_id, count(*) as n_convs, any_value(case when d = 0 then 0 else length(node[d].said) end) as chars,
  string_agg(conv::varchar, ',' order by conv) filter (where size = d) as ends from prefix group by d, node),
up as (select n.*, p.conv_id as parent from node n left join node p on p.d = n.d - 1 and p.node = n.node[1 : n.d - 1]),
child as (select d - 1 as d, parent as conv_id, count(*) as n from up where d > 0 group by 1, 2),
flat as (select up.*, coalesce(child.n, 0) as n_children from up left join child on up.d = child.d and up.conv_id = child.conv_id),
over as (select f.n_children = 0 as leaf, (f.n_convs - 1) * f.chars as saved, k, f.node[1 : k] as top from (select *, unnest(range(0, d + 1)) as k from flat) f),
below as (select k, top, sum(leaf::int) as n_leaves, sum(saved) as saved from over group by k, top)
select conv_id, d::bigint as depth, parent as parent_conv_id, n_convs::bigint as n_convs, n_children::bigint as n_children, n_leaves::bigint as n_leaves,
  saved::bigint as saved_tokens, sha256(coalesce(ends, '')) as ends_sha256
from flat join below on flat.d = below.k and flat.node = below.top"""
