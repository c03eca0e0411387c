"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# A-Z lower-cased, then the words of digits, letters and non-ASCII code points
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op4_decontaminate"] = f"""
with d as (select doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') as w from documents),
b as (select item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') as w from benchmark),
bw as (select item_id, least(13, len(w)) as n, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i
       from b where len(w) > 0),
win as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as k from bw),
lens as (select distinct n from win),
dw as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from d),
hits as (select dw.doc_id, dw.i, win.n, win.item_id
         from dw join lens on dw.i + lens.n - 1 <= len(dw.w)
         join win on win.n = lens.n and win.k = array_to_string(dw.w[dw.i:dw.i + lens.n - 1], ' ')),
words as (select doc_id, count(distinct p) as n_hit
          from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from hits)) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
          from (select distinct doc_id, item_id from hits) group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(d.w) as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""


# words are runs of anything but the six ASCII white-space characters
_WORD = r"[^\x20\x09-\x0D]+"


def _mixing(block: int = 256, shards: int = 64, seed: int = 17, rounds: int = 24) -> str:
    def h52(text: str) -> str:
        return f"('0x' || substr(md5({text}), 1, 13))::bigint"

    return f"""
with recursive sizes as materialized (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint as size from documents),
by_source as (select source, sum(size)::bigint as source_size from sizes group by source),
numbered as (select *, row_number() over (order by source nulls last) - 1 as src from by_source),
weighed as (select *, (src % 3 + 1)::double as w, 3.0 * source_size::double as cap,
                   (sum(source_size) over ())::double as total from numbered),
levels as (select *, row_number() over o as rank,
                  (total - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))
                  / sum(w) over (o rows between current row and unbounded following) as level
           from weighed window o as (order by cap / w, src)),
picked as (select min(rank) as first from levels where level * w <= cap),
targets as materialized (
  select source, src, source_size,
         case when rank < first then cap else least((select level from levels, picked where rank = first) * w, cap)
         end as target from levels, picked),
plan as materialized (
  select *, passes * blocks + ceil(rest / {block}::double)::bigint as slots,
         case when rest > 0 then rest - (ceil(rest / {block}::double)::bigint - 1) * {block} end as last_words
  from (select *, ceil(source_size / {block}::double)::bigint as blocks, floor(target / source_size)::bigint as passes,
               round(target - floor(target / source_size) * source_size)::bigint as rest
        from targets where source_size > 0)),
slots as (select src, blocks, slots, last_words, unnest(range(slots)) as g from plan),
perm(src, g, blocks, slots, last_words, r, x) as (
  select src, g, blocks, slots, last_words, 0, g % blocks from slots
  union all
  select src, g, blocks, slots, last_words, r + 1,
         case when substr(md5(concat_ws(':', '{seed}', src, g // blocks, r + 1, greatest(x, partner))), 1, 1) >= '8'
              then partner else x end
  from (select *, ((({h52(f"concat_ws(':', '{seed}', src, g // blocks, r + 1)")} - x) % blocks) + blocks) % blocks
               as partner from perm where r < {rounds})),
taken as (select src, x as block, count(*) filter (last_words is null or g < slots - 1) as whole,
                 max(case when g = slots - 1 then last_words end) as part
          from perm where r = {rounds} group by src, x),
laid as materialized (
  select s.doc_id, s.size, t.src, t.source_size, t.target, row_number() over () as row_id,
         coalesce(sum(s.size) over (partition by t.src order by
           {h52("coalesce(s.doc_id::varchar, '')")} % (select ceil(sqrt(count(*)))::bigint from sizes), s.doc_id, s.size
           rows between unbounded preceding and 1 preceding), 0)::bigint as pos
  from sizes s join targets t on s.source is not distinct from t.source),
pieces as (select row_id, src, pos, size, unnest(range(pos // {block}, (pos + size - 1) // {block} + 1)) as block
           from laid where size > 0),
sums as (select row_id, sum(coalesce(whole, 0) * (e - b) + greatest(least(e, coalesce(part, 0)) - b, 0)) as taken
         from (select *, greatest(pos - block * {block}, 0) as b, least(pos + size - block * {block}, {block}) as e
               from pieces) p left join taken using (src, block) group by row_id)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken from laid left join sums using (row_id)
"""


ORACLES["op1_mixing"] = _mixing()

# page lines without surrounding ASCII white space; the site is the source
_TRIM = r"trim(line, e' \t\n\x0b\x0c\r')"
ORACLES["op5_lines"] = f"""
with rows as materialized (select row_number() over () as rid, doc_id, source, text from documents),
cut as (select rid, source, string_split(text, chr(10)) as parts from rows where text is not null),
l as materialized (select rid, source, pos, parts[pos] as line from
                   (select rid, source, parts, unnest(range(1, len(parts) + 1)) as pos from cut)),
t as materialized (select *, {_TRIM} as t from l),
pages as (select source, min(rid) as rid from rows where text is not null group by source, text),
counts as (select t.source, t, count(distinct rid) as pages from t join pages using (rid) where t <> ''
           group by t.source, t),
hosts as (select source, count(*) as host_pages from pages group by source),
bad as (select counts.source as s, t as b from counts join hosts on counts.source is not distinct from hosts.source
        where pages >= 5 and pages > 0.01 * host_pages),
marked as (select t.*, b is not null as dropped
           from t left join bad on t.source is not distinct from s and t.t = b),
sums as (select rid, count(*) filter (t <> '') as n_lines, count(*) filter (dropped) as n_dropped,
                coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '') as kept
         from marked group by rid)
select doc_id, coalesce(n_lines, 0)::bigint as n_lines, coalesce(n_dropped, 0)::bigint as n_dropped,
       md5(case when text is not null then kept end) as text_md5
from rows left join sums using (rid)
"""


def _near_duplicates(words: int, num: int, den: int, kept: str = "") -> str:
    """All pairs of documents that share a shingle, and the closure of the links."""
    return f"""
with recursive d as materialized (select doc_id, regexp_extract_all({_LOWER}, '{_WORD}') as w from documents),
places as (select doc_id, w, least({words}, len(w)) as k, unnest(range(1, len(w) - least({words}, len(w)) + 2)) as i
       from d where len(w) > 0),
s as materialized (select distinct doc_id, array_to_string(w[i:i + k - 1], ' ') as g from places),
n as materialized (select doc_id, count(*)::bigint as n from s group by doc_id),
shared as (select a.doc_id as u, b.doc_id as v, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id
         group by all),
links as materialized (select u, v from shared join n x on x.doc_id = u join n y on y.doc_id = v
                       where {den} * c >= {num} * (x.n + y.n - c)),
ways as materialized (select u, v from links union all select v, u from links),
reach(x, y) as (select doc_id, doc_id from n union select x, v from reach join ways on u = y),
least_of as (select x, min(y) as component_id from reach group by x)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(component_id, d.doc_id) as component_id{kept}
from d left join n using (doc_id) left join least_of on x = d.doc_id
"""


ORACLES["op6_jaccard"] = _near_duplicates(4, 85, 100)
ORACLES["op11_hyperminhash"] = _near_duplicates(
    5, 85, 100, ", coalesce(component_id, d.doc_id) = d.doc_id as kept")

# unsigned crc32 byte by byte; the table of the 256 remainders comes from the polynomial
_CRC_TABLE = """crc_table as materialized (
  select list(r order by i) as t
  from (select i, list_reduce(list_concat([i], range(8)), lambda c, k:
                 case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as r from range(256) x(i)))"""


def _crc32(letters: str) -> str:
    """crc32 of a string of code points below U+0800, as a list of its characters; needs ``t`` of crc_table."""
    octets = f"""flatten(list_transform({letters}, lambda x: case when unicode(x) < 128 then [unicode(x)::bigint]
                 else [192 + (unicode(x) >> 6)::bigint, 128 + (unicode(x) & 63)::bigint] end))"""
    return (f"xor(list_reduce(list_concat([4294967295], {octets}), "
            "lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)")


ORACLES["op12_conversations"] = f"""
with {_CRC_TABLE},
turns as materialized (
  select conv_id as c, md5(coalesce(role, '') || chr(1) || coalesce(text, '')) as turn_md5, length(coalesce(text, '')) as chars,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
own as materialized (select c, list(struct_pack(m := turn_md5, n := chars) order by pos) as turns from turns group by c),
rule as (select c, turns, {_crc32("string_split(c::varchar, '')")} % 6 as h from own, crc_table),
built as materialized (
  select rule.c, list_concat(coalesce(base.turns[:h], []), rule.turns[h + 1:]) as turns
  from rule left join own base on base.c = rule.c - rule.c % 100),
prefixes as materialized (
  select c, d, len(turns) as length, turns[d].n as chars,
         array_to_string(list_transform(turns[:d], lambda x: x.m), ',') as node,
         array_to_string(list_transform(turns[:d - 1], lambda x: x.m), ',') as parent
  from (select c, turns, unnest(range(len(turns) + 1)) as d from built)),
nodes as materialized (
  select node, d, any_value(case when d > 0 then parent end) as parent, min(c) as conv_id, count(*) as n_convs,
         (count(*) - 1) * coalesce(any_value(chars), 0) as own_saved,
         coalesce(string_agg(c::varchar, ',' order by c) filter (length = d), '') as ends
  from prefixes group by node, d),
childless as materialized (
  select n.node, n.d, n.own_saved, count(k.node) as n_children
  from nodes n left join nodes k on k.parent = n.node and k.d = n.d + 1 group by all),
above as (select distinct p.node, p.d, a.node as up, a.d as up_d
          from prefixes p join prefixes a on a.c = p.c and a.d <= p.d),
sums as (select up, up_d, count(*) filter (n_children = 0) as n_leaves, sum(own_saved) as saved_tokens
         from above join childless using (node, d) group by up, up_d)
select n.conv_id, n.d::bigint as depth, p.conv_id as parent_conv_id, n.n_convs::bigint as n_convs,
       n_children::bigint as n_children, n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens,
       sha256(n.ends) as ends_sha256
from nodes n join childless using (node, d) join sums on up = n.node and up_d = n.d
     left join nodes p on p.node = n.parent and p.d = n.d - 1
"""

# near words share what is left of them when one position is taken out
ORACLES["op13_spelling"] = f"""
with recursive {_CRC_TABLE},
runs as materialized (
  select doc_id, run, count(*) as c
  from (select doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents) group by all),
hashed as (select run, c, {_crc32("string_split(coalesce(doc_id::varchar, '') || ':' || run, '')")} as h
           from runs, crc_table),
seen as (select c, case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                        else run end as word from hashed),
v as materialized (select word, sum(c)::bigint as n from seen where length(word) >= 5 group by word having sum(c) >= 3),
cut as materialized (select word, n, i, substr(word, 1, i - 1) as a, substr(word, i + 1) as z
                     from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
shorter as (select distinct cut.word as longer, v.word as shorter, cut.n as longer_n, v.n as shorter_n
            from cut join v on v.word = a || z),
near as materialized (
  select x.word, y.word as other, y.n as other_n from cut x join cut y on x.i = y.i and x.a = y.a and x.z = y.z
  where x.word <> y.word
  union all select longer, shorter, shorter_n from shorter
  union all select shorter, longer, longer_n from shorter),
best as (select word, count(*)::bigint as n_near, arg_min(other, (-other_n, other)) as top, max(other_n) as top_n
         from near group by word),
forms as materialized (
  select v.word, n, coalesce(n_near, 0)::bigint as n_near, case when top_n >= 2 * n then top end as form,
         case when top_n >= 2 * n then top_n end::bigint as form_n from v left join best using (word)),
follow(word, far) as (select word, word from forms
                     union all select follow.word, form from follow join forms on forms.word = far where form is not null),
last_of as (select follow.word, far as root from follow join forms on forms.word = far where form is null)
select word, form, root, n, n_near, form_n from forms join last_of using (word)
"""
