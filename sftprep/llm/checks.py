"""The corpus queries in SQL for a second engine, where SQL can express them."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

NEAR_DEDUP = rf"""
with recursive t as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as w
  from documents),
sh as materialized (
  select distinct doc_id, unnest(case
    when len(w) = 0 then []::varchar[]
    when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    end) as s
  from t),
n as (select doc_id, count(*) as n from sh group by 1),
shared as (select s from sh group by s having count(*) > 1),
sh2 as materialized (select * from sh semi join shared using (s)),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from sh2 a join sh2 b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as materialized (
  select a, b from pairs join n na on na.doc_id = a join n nb on nb.doc_id = b
  where 100 * common >= 75 * (na.n + nb.n - common)),
sides as (select a as x, b as y from links union select b, a from links),
reach as (
  select doc_id as x, doc_id as y from documents
  union select r.x, s.y from reach r join sides s on r.y = s.x),
comp as (select x as doc_id, min(y) as component_id from reach group by 1)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join n using (doc_id) join comp on comp.doc_id = d.doc_id
"""

LINE_DEDUP = r"""
with l as (select doc_id, unnest(range(len(x))) as pos, unnest(x) as line from (select doc_id, string_split(text, chr(10)) x from documents where text is not null)),
w as (select doc_id, pos, list_filter(regexp_split_to_array(line,'[ \t\x0b\x0c\r]+'), lambda x: x <> '') as w from l),
k as (select doc_id, pos, w, array_to_string(w,' ') as line from w where len(w)>0),
f as (select line, any_value(w) w, min((doc_id, pos)) as first_ from k group by 1),
big as (select line, if(len(w)>=8, w, string_split(line,'')) w, first_, len(w)>=8 as wordy from f where len(w)>=8 or length(line)>=16),
u as (select line, w, first_, wordy, len(w) n from big),
v as materialized (select line, first_, wordy, n, p, if(wordy, array_to_string(list_concat(w[1:p-1], w[p+1:]),' '), array_to_string(list_concat(w[1:p-1], w[p+1:]),'')) d from (select *, unnest(range(1,n+1)) p from u)),
near as (
 select a.line from v a join (select d,p,n,wordy,min(first_) m from v group by 1,2,3,4) b on a.d=b.d and a.p=b.p and a.n=b.n and a.wordy=b.wordy where a.first_>b.m
 union select case when v.first_>s.first_ then v.line else s.line end from v join u s on v.d=s.line and v.wordy=s.wordy),
j as (select k.doc_id, k.pos, f.first_ < (k.doc_id, k.pos) as copy, n.line is not null as near from k join f using(line) left join near n using(line)),
g as (select doc_id, list(pos) filter(copy or near) gone, count(*) filter(copy) n_copies, count(*) filter(near and not copy) n_near from j group by 1)
select d.doc_id, sha256(array_to_string(list_filter(string_split(d.text,chr(10)), lambda x,i: not coalesce(list_contains(gone,i-1),false)), chr(10))) as kept_sha256,
 len(string_split(d.text,chr(10)))::bigint n_lines, coalesce(n_copies,0) n_copies, coalesce(n_near,0) n_near
from documents d left join g using(doc_id)
"""

EXACT_DEDUP = r"""
with t as (select doc_id, regexp_replace(coalesce(text,''),'[\x20\x09-\x0D]+',' ','g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
 doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256 from t
"""

SUBSTRING_DEDUP = r"""
with t as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (select doc_id, w, unnest(range(1, len(w) - 18)) as pos from t where len(w) >= 20),
windows as (select doc_id, pos, sha256(array_to_string(w[pos:pos + 19], ' ')) as h from starts),
firsts as (select h, min((doc_id, pos)) as first_one from windows group by h),
again as (select doc_id, pos from windows join firsts using (h) where (doc_id, pos) > first_one),
words as (select doc_id, w, unnest(range(1, len(w) + 1)) as pos from t),
marked as (
  select words.doc_id, words.pos, words.w[words.pos] as word, coalesce(max(again.pos) over (
    partition by words.doc_id order by words.pos rows between 19 preceding and current row), 0) > 0 as gone
  from words left join again using (doc_id, pos)),
kept as (
  select doc_id, count(*) filter (gone) as n_removed,
    coalesce(string_agg(word, ' ' order by pos) filter (not gone), '') as kept
  from marked group by doc_id)
select t.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from t left join kept using (doc_id)
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERMS = rf"""regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')"""

RANKED_SEARCH = f"""
with q as (select item_id, unnest({_TERMS}) as term from benchmark),
asked as (select item_id, term, count(*) as n from q group by 1, 2),
d as (select doc_id, {_TERMS} as w from documents),
totals as (select count(*) filter (len(w) > 0) as n_docs, sum(len(w))::bigint as n_terms from d),
hits as materialized (
  select doc_id, len(w)::bigint as n, term, count(*) as tf
  from (select doc_id, w, unnest(w) as term from d) semi join asked using (term) group by all),
weights as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w
  from hits, totals group by term, n_docs),
scores as (
  select item_id, doc_id, sum(asked.n * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * hits.n * n_docs) // n_terms))))::bigint as score
  from hits join asked using (term) join weights using (term), totals group by 1, 2),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
  from scores where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20
"""

# crc32 of the id as text: eight shifts after each byte, marked by -1.
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
  string_split(c::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: case when x >= 0 then xor(a, x)
    else xor(a >> 1, case when a & 1 = 1 then 3988292384::bigint else 0::bigint end) end), 4294967295::bigint)"""

CONVERSATION_TRIE = f"""
with own as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos
  from conversations where conv_id is not null),
convs as (select c, c - c % 100 as base, {_CRC} % 6 as h from (select distinct c from own)),
again as (
  select convs.c, 0 as part, pos, role, text from convs join own on own.c = base and pos < h
  union all select own.c, 1, pos, role, text from own join convs using (c) where pos >= h),
turns as (
  select c, row_number() over (partition by c order by part, pos) as depth, length(text) as chars,
    sha256(concat(length(role), ':', role, text)) as item from again),
paths as materialized (
  select c, depth, chars, sha256(string_agg(item, '') over (partition by c order by depth)) as name from turns
  union all select c, 0, 0, '' from convs),
nodes as materialized (
  select depth, name, min(c) as owner, count(*) as n_convs, (count(*) - 1) * any_value(chars) as saved
  from paths group by 1, 2),
way as materialized (select c, depth, owner from paths join nodes using (depth, name)),
tree as materialized (
  select nodes.*, way.owner as parent from nodes left join way on way.c = nodes.owner and way.depth = nodes.depth - 1),
children as (select parent as owner, depth - 1 as depth, count(*) as n from tree where depth > 0 group by 1, 2),
below as (
  select way.owner, way.depth, sum(saved)::bigint as saved, count(*) filter (children.n is null) as leaves
  from tree left join children using (owner, depth) join way on way.c = tree.owner and way.depth <= tree.depth
  group by 1, 2),
ends as (
  select depth, name, sha256(string_agg(c::varchar, ',' order by c)) as sha
  from paths join (select c, max(depth) as depth from paths group by 1) using (c, depth) group by 1, 2)
select owner as conv_id, depth::bigint as depth, parent as parent_conv_id, n_convs, coalesce(children.n, 0) as n_children,
  leaves as n_leaves, below.saved as saved_tokens, coalesce(sha, sha256('')) as ends_sha256
from tree join below using (owner, depth) left join children using (owner, depth) left join ends using (depth, name)
"""

CHECKS = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_minhash_near_dedup": NEAR_DEDUP,
    "op6_exact_dedup": EXACT_DEDUP,
    "op9_substring_dedup": SUBSTRING_DEDUP,
    "op11_ranked_search": RANKED_SEARCH,
    "op13_conversation_trie": CONVERSATION_TRIE,
}
