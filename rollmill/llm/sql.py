"""DuckDB twins of the operators that SQL can express."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

TOP_K = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * x::double) as bigint)) as e
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, cast(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id
  where q.vec_id % 20 = 0)
select query_id, cast(rank as int) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) r
where rank <= 20
"""


def windows_sql(docs: str = "documents") -> str:
    """CTEs up to `hits` (doc_id, p): document words inside a window, and `found` (doc_id, item_id)."""
    words = f"list_filter(regexp_split_to_array({LOWER.format('coalesce(text, chr(32))')}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    return f"""
dw as (select doc_id, {words} as w from {docs}),
iw as (select item_id, {words} as w from benchmark),
win as (
  select distinct item_id, array_to_string(w[i:i + 9], ' ') as g, least(len(w), 10) as n
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from iw where len(w) > 0) x),
sizes as (select distinct n from win),
grams as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, sizes where len(w) >= n) x),
found as (select distinct doc_id, item_id, i, g.n as n from grams g join win on g.g = win.g and g.n = win.n),
hits as (select distinct doc_id, unnest(range(i, i + n)) as p from found)"""


DECONTAMINATE = f"""
with {windows_sql()},
h as (select doc_id, count(*) as n_hit from hits group by doc_id),
t as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from found) x group by doc_id)
select dw.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join h on h.doc_id = dw.doc_id left join t on t.doc_id = dw.doc_id
"""

SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def lines_sql(docs: str = "documents") -> str:
    """CTEs up to `kept` (doc_id, n_lines, n_dropped, text)."""
    return f"""
lines as (
  select doc_id, i, l[i] as line, {LOWER.format(f"trim(l[i], {SPACE})")} as k, len(l) as n
  from (select doc_id, l, unnest(range(1, len(l) + 1)) as i
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from {docs}) a) b),
shared as (
  select k, max(doc_id) as keeper from lines where length(k) >= 20 group by k having count(distinct doc_id) >= 3),
kept as (
  select doc_id, any_value(n) as n_lines, count(shared.k) filter (shared.keeper <> doc_id) as n_dropped,
         coalesce(string_agg(line, chr(10) order by i) filter (shared.k is null or shared.keeper = doc_id), '') as text
  from lines left join shared on lines.k = shared.k group by doc_id)"""


LINE_DEDUP = f"""
with {lines_sql()}
select doc_id, cast(n_lines as bigint) as n_lines, n_dropped, sha256(text) as kept_sha256 from kept
"""

# steps over the digits' bytes: a byte goes in, then eight shifts
CRC32 = """xor(list_reduce(flatten(list_transform(string_split(cast({} as varchar), ''), lambda d: [ascii(d)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda acc, s: case when s >= 0 then xor(acc, s) when acc & 1 = 1 then xor(acc >> 1, 3988292384) else acc >> 1 end, 4294967295::bigint), 4294967295::bigint)"""

PREFIX_TRIE = f"""
with o as (
  select conv_id, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} as x,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos
  from conversations where conv_id is not null),
c as (select conv_id, {CRC32.format('conv_id')} % 6 as h from (select distinct conv_id from o) x),
s as (
  select c.conv_id, 0 as own, pos, x from c join o on o.conv_id = c.conv_id - c.conv_id % 100 and pos < h
  union all select c.conv_id, 1, pos, x from c join o on o.conv_id = c.conv_id and pos >= h),
q as (
  select c.conv_id, coalesce(any_value(l.l), []) as q
  from c left join (select conv_id, list(x order by own, pos) as l from s group by conv_id) l on l.conv_id = c.conv_id group by c.conv_id),
p as (select conv_id, d, len(q) as n, q[1:d] as p from (select conv_id, q, unnest(range(0, len(q) + 1)) as d from q) y),
nodes as (
  select p, d, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * coalesce(length(p[-1].t), 0) as saved,
         coalesce(string_agg(conv_id, ',' order by conv_id) filter (d = n), '') as ends
  from p group by p, d),
kids as (select p[1:d - 1] as p, count(*) as n_children from nodes where d > 0 group by all),
own as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids on kids.p = nodes.p),
totals as (
  select p[1:k] as p, sum(saved) as saved, sum(case when n_children = 0 then 1 else 0 end) as n_leaves
  from (select p, saved, n_children, unnest(range(0, d + 1)) as k from own) z group by all)
select own.conv_id, own.d as depth, up.conv_id as parent_conv_id, own.n_convs, n_children, cast(n_leaves as bigint) as n_leaves,
       cast(totals.saved as bigint) as saved_tokens, sha256(own.ends) as ends_sha256
from own join totals on totals.p = own.p left join nodes up on own.d > 0 and up.p = own.p[1:own.d - 1]
"""

ORACLE_SQL = {
    "op2_mtree": TOP_K,
    "op6_decontaminate": DECONTAMINATE,
    "op9_line_dedup": LINE_DEDUP,
    "op12_prefix_trie": PREFIX_TRIE,
}
