"""SQL for DuckDB with the rows of the queries that SQL can express.

Sharding needs CRC-32, SimHash needs XXH64, and the learned models and the page
renderer are not relational: those queries are tested against brute force instead.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op7_line_dedup"] = r"""
with lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos
  from documents where text is not null
), windows as (
  select doc_id, pos, line as l1, lead(line, 1) over w as l2, lead(line, 2) over w as l3
  from lines window w as (partition by doc_id order by pos)
), later as (
  select doc_id, pos
  from (select *, row_number() over (partition by l1, l2, l3 order by doc_id, pos) as turn from windows where l3 is not null)
  where turn > 1
), covered as (
  select distinct doc_id, unnest([pos, pos + 1, pos + 2]) as pos from later
), kept as (
  select l.doc_id, count(*) as n_lines, count(c.pos) as n_removed,
         coalesce(string_agg(l.line, chr(10) order by l.pos) filter (c.pos is null), '') as text
  from lines l left join covered c on l.doc_id = c.doc_id and l.pos = c.pos
  group by l.doc_id
)
select d.doc_id, coalesce(k.n_lines, 0)::bigint as n_lines, coalesce(k.n_removed, 0)::bigint as n_removed, k.text
from documents d left join kept k on d.doc_id = k.doc_id
"""

ORACLE["op8_mixing"] = r"""
with docs as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         (('0x' || substr(md5('mix' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint::double + 0.5)
           / 4503599627370496.0::double as u
  from documents
), sized as (
  select source, sum(size)::bigint as source_size from docs group by source
), weighted as (
  select *, [5.0::double, 2.0::double, 1.0::double][((row_number() over (order by source nulls last) - 1) % 3) + 1] as weight,
         source_size * 2.0::double as cap
  from sized
), levelled as (
  select *, cap / weight as reached,
         (sum(source_size) over ()::bigint * 1.5::double
           - coalesce(sum(cap) over (order by cap / weight, source nulls last
               rows between unbounded preceding and 1 preceding), 0.0::double))
         / sum(weight) over (order by cap / weight, source nulls last
               rows between current row and unbounded following) as level
  from weighted
), final as (
  select min(reached) as first_reached from levelled where reached > level
), targets as (
  select source, source_size,
         coalesce(least(cap, weight * (select max(level) from levelled, final where reached = first_reached)), cap) as target
  from levelled
), planned as (
  select *, target - certain * source_size as rest
  from (select *, floor(case when source_size > 0 then target / source_size else 0 end)::bigint as certain from targets)
), counted as (
  select source, size, count(*)::hugeint as n from docs where size > 0 group by source, size
), level_of as (
  select c.source, c.size, coalesce(sum(c.n * c.size) over larger, 0)::double as full_words,
         (p.rest - coalesce(sum(c.n * c.size) over larger, 0)::double)
           / (sum(c.n * c.size * c.size) over others)::double as level
  from counted c join planned p on c.source is not distinct from p.source
  window larger as (partition by c.source order by c.size desc rows between unbounded preceding and 1 preceding),
         others as (partition by c.source order by c.size desc rows between current row and unbounded following)
), levels as (
  select source, max(size) as full_above, max_by(level, size) as level, max_by(full_words, size) as full_words
  from level_of where level * size < 1 group by source
), odds as (
  select d.doc_id, d.source, d.size, d.u, p.source_size, p.target, p.certain, p.rest - l.full_words as rest,
         d.size > coalesce(l.full_above, 0) as full_,
         case when d.size > 0 and d.size <= l.full_above and l.level > 0 then l.level * d.size end as pi
  from docs d join planned p on d.source is not distinct from p.source
  left join levels l on d.source is not distinct from l.source
), ranked as (
  -- Odds of the uniform number over odds of inclusion.
  select *, d.u / (1 - d.u) * (1 - d.pi) / d.pi as quotient from odds d
), filled as (
  select *, sum(size) over (partition by source, pi is null order by quotient, doc_id) - size / 2.0::double as middle
  from ranked
)
select doc_id, size, source_size, target,
       (size * (certain + case when full_ or (pi is not null and middle <= rest) then 1 else 0 end))::bigint as taken
from filled
"""

ORACLE["op9_exact_dedup"] = r"""
with docs as (
  select doc_id, length(coalesce(text, '')) as points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents
)
select doc_id, first_value(doc_id) over best as keep_id,
       count(*) over (partition by norm) as group_size,
       doc_id = first_value(doc_id) over best as kept,
       sha256(norm) as text_sha256
from docs
window best as (partition by norm order by points desc, doc_id)
"""

ORACLE["op10_decontamination"] = r"""
with items as (
  select item_id::varchar as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark
), windows as (
  select distinct item, n, list_slice(words, i, i + n - 1) as piece
  from (select item, words, least(10, len(words)) as n,
               unnest(range(1, greatest(len(words) - 10, 0) + 2)) as i
        from items where len(words) > 0)
), docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents
), starts as (
  select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as i
  from docs, (select distinct n from windows) where len(words) >= n
), found as (
  select s.doc_id, s.i, s.n, w.item
  from starts s join windows w on s.n = w.n and list_slice(s.words, s.i, s.i + s.n - 1) = w.piece
), hit as (
  select doc_id, count(distinct w) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as w from found) group by doc_id
), owners as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct doc_id, item from found) group by doc_id
)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit,
       coalesce(o.n_items, 0)::bigint as n_items, sha256(coalesce(o.names, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 as contaminated
from docs d left join hit h on d.doc_id = h.doc_id left join owners o on d.doc_id = o.doc_id
"""

ORACLE["op11_lexical_search"] = r"""
with docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), items as (
  select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), asked as (
  select item_id, term, count(*) as times from items group by item_id, term
), corpus as (
  select count(*) as n_docs, sum(len(terms))::bigint as n_terms from docs where len(terms) > 0
), counts as (
  select doc_id, term, count(*) as tf, any_value(n) as n
  from (select doc_id, len(terms)::bigint as n, unnest(terms) as term from docs) group by doc_id, term
), weights as (
  select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from counts, corpus where term in (select term from asked) group by term
), scored as (
  select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::bigint as score
  from asked join counts using (term) join weights using (term), corpus
  group by item_id, doc_id
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::integer as rank, doc_id, score
  from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""

ORACLE["op12_prefix_trie"] = r"""
with turns as (
  select conv_id, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) as said,
         row_number() over (partition by conv_id order by turn nulls first) as pos
  from conversations where conv_id is not null
), ids as (
  select conv_id, conv_id - conv_id % 100 as family,
         xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, bit: case when x % 2 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)), 4294967295::bigint) % 6 as head
  from (select distinct conv_id from turns)
), placed as (
  select i.conv_id, t.pos, t.said from ids i join turns t on t.conv_id = i.family and t.pos <= i.head
  union all
  select i.conv_id, t.pos, t.said from ids i join turns t on t.conv_id = i.conv_id and t.pos > i.head
), whole as (
  select i.conv_id, coalesce(list(p.said order by p.pos) filter (p.pos is not null), []) as said
  from ids i left join placed p on i.conv_id = p.conv_id group by i.conv_id
), prefixes as (
  select conv_id, d, list_slice(said, 1, d) as prefix, d = len(said) as here
  from (select *, unnest(range(0, len(said) + 1)) as d from whole)
), nodes as (
  select prefix, d as depth, min(conv_id) as conv_id, count(*) as n_convs,
         (count(*) - 1) * (case when d = 0 then 0 else length(prefix[d].text) end) as saved,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (here), '')) as ends_sha256
  from prefixes group by prefix, d
), children as (
  select list_slice(prefix, 1, depth - 1) as prefix, depth - 1 as depth, count(*) as n_children
  from nodes where depth > 0 group by all
), counted as (
  select n.*, coalesce(c.n_children, 0) as n_children
  from nodes n left join children c on n.depth = c.depth and n.prefix = c.prefix
), above as (
  select list_slice(prefix, 1, d) as prefix, d as depth, saved, n_children
  from (select *, unnest(range(0, depth + 1)) as d from counted)
), subtrees as (
  select prefix, depth, sum(saved)::bigint as saved_tokens, count(*) filter (n_children = 0) as n_leaves
  from above group by prefix, depth
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
from counted n
join subtrees s on n.depth = s.depth and n.prefix = s.prefix
left join nodes p on p.depth = n.depth - 1 and p.prefix = list_slice(n.prefix, 1, n.depth - 1)
"""
