"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from jobweave.llm.queries import MIX, SHARD_BYTES

HASH = "('0x' || substr(md5({}), 1, 15))::bigint"

#: The splitting tree: each level halves the shards of a node, in exact numbers and in the order of a hash.
TREE = "".join(
    f"""        ), tree{level + 1} as (
            select sk, block, copy,
                   case when place <= round(n * {half} / {2 * half}) then low else low + {half} end as low
            from (
                select *, count(*) over (partition by low) as n, row_number() over (partition by low order by
                       {HASH.format(f"concat_ws(chr(1), '{MIX.seed + 100 + level}', sk, block::varchar, copy::varchar)")},
                       sk, block, copy) as place
                from tree{level}
            )
"""
    for level, half in enumerate((4, 2, 1)))
ORDER = HASH.format(f"concat_ws(chr(1), '{MIX.seed + 1}', coalesce(doc_id::varchar, chr(0)), i::varchar)")

#: Letters beyond ASCII of the test tables, as single bytes: DuckDB's edit distance counts bytes.
LETTERS = "äöüßàâæçéèêëîïôœùûñáíóú"
ONE_BYTE = " || ".join(f"chr({i})" for i in [*range(1, 9), *range(14, 14 + len(LETTERS) - 8)])

ORACLES = {
    "op4_line_dedup": f"""
        with lines as (
            select doc_id, unnest(string_split(text, chr(10))) as line,
                   unnest(range(len(string_split(text, chr(10))))) as no
            from documents where text is not null
        ), judged as (
            select doc_id, no, line, regexp_matches(line, '[^\x20\x09-\x0D]') as judged from lines
        ), firsts as (
            select line, min((doc_id, no)) as first from judged where judged group by line
        ), long as (
            select line, first, length(line) as n, translate(line, '{LETTERS}', {ONE_BYTE}) as bytes from firsts where length(line) >= 20
        ), late as (
            select distinct b.line from long a join long b on a.n between b.n - 2 and b.n + 2
            where a.first < b.first
                  and (contains(b.line, substr(a.line, 1, a.n // 3)) or contains(b.line, substr(a.line, a.n // 3 + 1, a.n // 3))
                       or contains(b.line, substr(a.line, 2 * (a.n // 3) + 1)))
                  and levenshtein(a.bytes, b.bytes) <= 2
        ), kept as (
            select j.doc_id, j.no, j.line, j.judged and (l.line is not null or (j.doc_id, j.no) <> f.first) as gone
            from judged j left join firsts f on j.line = f.line left join late l on j.line = l.line
        )
        select d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::int as n_lines,
               coalesce(count(*) filter (k.gone), 0)::int as n_removed,
               sha256(coalesce(string_agg(k.line, chr(10) order by k.no) filter (not coalesce(k.gone, false)), '')) as kept_sha256
        from documents d left join kept k on d.doc_id = k.doc_id group by d.doc_id, d.text
    """,
    # ``kept`` is null where a cut splits a character; no document of the small tables has such a cut.
    "op5_suffix_array": r"""
        with texts as (
            select doc_id, encode(coalesce(text, '')) as raw, octet_length(encode(coalesce(text, '')))::bigint as n from documents
        ), windows as (
            select doc_id, p, case when p + 400 <= n then hash(array_slice(raw, p + 1, p + 400)) end as h
            from (select doc_id, raw, n, unnest(range(n)) as p from texts)
        ), judged as (
            select doc_id, p, h is not null and count(*) over (partition by h) > 1 as again from windows
        ), covered as (
            select doc_id, p, max(case when again then p end) over (
                partition by doc_id order by p rows between 399 preceding and current row) is not null as gone
            from judged
        ), islands as (
            select doc_id, gone, min(p) as first, max(p) as last
            from (select *, p - row_number() over (partition by doc_id, gone order by p) as island from covered)
            group by doc_id, gone, island
        ), kept as (
            select t.doc_id, any_value(t.n) as n_bytes,
                   coalesce(sum(last - first + 1) filter (gone), 0)::bigint as n_removed, count(*) filter (gone) as n_spans,
                   unhex(coalesce(string_agg(hex(array_slice(raw, first + 1, last + 1)), '' order by first) filter (not gone), '')) as kept
            from texts t left join islands i on t.doc_id = i.doc_id group by t.doc_id
        )
        select doc_id, n_bytes, n_removed, n_spans, sha256(kept) as kept_sha256, n_removed > 0 as removed, try(decode(kept)) as kept from kept
    """,
    "op7_sharding": f"""
        with docs as (
            select doc_id, coalesce(octet_length(encode(text)), 0)::bigint as n_bytes,
                   {HASH.format("coalesce(doc_id::varchar, chr(0))")} as h
            from documents
        ), levels as (
            select *, (h >> (60 - depth)) as prefix from docs, range(61) r(depth)
        ), buckets as (
            select depth, prefix from levels group by depth, prefix
            having sum(n_bytes) <= {SHARD_BYTES} or min(h) = max(h)
        ), leaves as (
            select l.doc_id, l.n_bytes, min(l.depth) as depth, arg_min(l.prefix, l.depth) as prefix
            from levels l join buckets b on l.depth = b.depth and l.prefix = b.prefix
            group by l.doc_id, l.n_bytes, l.h
        )
        select doc_id, n_bytes, depth::int as depth,
               case when depth = 0 then '' else lpad(bin(prefix), depth::int, '0') end as shard
        from leaves
    """,
    "op9_mixing": f"""
        with recursive docs as (
            select doc_id, case when source is null then '1' else '0' || source end as sk,
                   coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
                   {HASH.format(f"concat_ws(chr(1), '{MIX.seed}', coalesce(doc_id::varchar, chr(0)))")} as h
            from documents
        ), units as (
            select sk, h, h % {MIX.blocks} as block, sum(size)::bigint as size from docs group by sk, h
        ), sources as (
            select sk, sum(size)::bigint as source_size,
                   ([{", ".join(f"{w}.0::double" for w in MIX.weights)}])[(row_number() over (order by sk) - 1) % {len(MIX.weights)} + 1] as w
            from units group by sk
        ), rounds as (
            select 0 as round, sk, source_size, w, false as capped,
                   sum(source_size) over () * {MIX.total_share}::double / sum(w) over () as level
            from sources
            union all
            select round + 1, sk, source_size, w, capped,
                   (sum(source_size) over () * {MIX.total_share}::double
                    - coalesce(sum({MIX.most}.0::double * source_size) filter (capped) over (), 0))
                   / sum(w) filter (not capped) over ()
            from (select * replace (capped or level * w > {MIX.most}.0::double * source_size as capped) from rounds)
            where round < (select count(*) from sources)
        ), targets as (
            select sk, source_size,
                   case when capped then {MIX.most}.0::double * source_size else level * w end as target,
                   case when source_size > 0 then floor(target / source_size) else 0 end as copies,
                   target - copies * source_size as need
            from rounds where round = (select count(*) from sources)
        ), blocks as (
            select u.sk, u.block, any_value(t.need) as need, sum(u.size) as bsize,
                   sum(sum(u.size)) over (partition by u.sk order by u.block) as upto
            from units u join targets t on u.sk = t.sk group by u.sk, u.block
        ), edge as (
            select sk, block, need - upto + bsize as gap from blocks where upto > need and upto - bsize < need
        ), chosen as (
            select * from (
                select u.sk, u.h, u.size, e.gap, sum(u.size) over (partition by u.sk, u.block order by u.h) as upto
                from units u join edge e on u.sk = e.sk and u.block = e.block
            ) where upto <= gap
        ), gaps as (
            select e.sk, e.block, e.gap - coalesce(sum(c.size), 0) as gap
            from edge e left join chosen c on e.sk = c.sk group by e.sk, e.block, e.gap
        ), best as (
            select u.sk, arg_min(u.h, (abs(g.gap - u.size), u.h)) as h, min(abs(g.gap - u.size)) as off, any_value(g.gap) as gap
            from units u join gaps g on u.sk = g.sk and u.block >= g.block
            where u.size > 0 and not exists (select 1 from chosen c where c.sk = u.sk and c.h = u.h)
            group by u.sk
        ), extra as (
            select sk, h from chosen union select sk, h from best where off < gap
            union select u.sk, u.h from units u join blocks b on u.sk = b.sk and u.block = b.block where b.upto <= b.need
        ), quotas as (
            select b.sk, b.block, any_value(t.copies)::int + max((b.upto <= b.need or p.block is not null)::int) as quota
            from blocks b join targets t on b.sk = t.sk
            left join (select distinct u.sk, u.block from units u join extra e on u.sk = e.sk and u.h = e.h) p
                on p.sk = b.sk and p.block = b.block
            group by b.sk, b.block
        ), tree0 as (
            select sk, block, unnest(range(1, quota + 1)) as copy, 0 as low from quotas
{TREE}        ), shards as (
            select sk, block, list(low order by copy) as shards from tree3 group by sk, block
        ), drawn as (
            select d.doc_id, d.size, t.source_size, t.target,
                   (t.copies + (e.h is not null)::int)::int as draws, s.shards
            from docs d join targets t on d.sk = t.sk left join extra e on d.sk = e.sk and d.h = e.h
            left join shards s on s.sk = d.sk and s.block = d.h % {MIX.blocks}
        )
        select doc_id, size, source_size, target, (size * draws)::bigint as taken,
               coalesce(array_to_string(shards[1 : draws], ','), '') as shards,
               coalesce(array_to_string(list_transform(range(draws), lambda i: {ORDER}), ','), '') as order_in_shard
        from drawn
    """,
    "op10_chat_format": r"""
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
        )
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
               sum(length('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10))
                   + len(regexp_extract_all(text, '<\\*\|')))::bigint as formatted_chars
        from turns group by conv_id
    """,
    "op12_filter_audit": r"""
        with tested as (
            select coalesce(lang, '') as part, doc_id, coalesce(text, '') as t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
            from documents
        ), masks as (
            select part, doc_id,
                   (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int
                   + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::int
                   + 8 * regexp_matches(t, '[#$%&*|]')::int
                   + 16 * coalesce(min(doc_id) over (partition by t) < doc_id, false)::int as mask
            from tested
        ), known as (
            select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
            from labels group by doc_id
        ), kinds as (
            select part, mask, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n
            from masks m left join known k on m.doc_id = k.doc_id group by all
        ), filters as (
            select unnest(['A', 'B', 'C', 'D', 'E']) as f
        ), orders as (
            select a.f || b.f || c.f || d.f || e.f as filter_order from filters a, filters b, filters c, filters d, filters e
            where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
        ), steps as (
            select filter_order, step, 1 << (ascii(filter_order[step]) - 65) as own,
                   list_sum([1 << (ascii(filter_order[k]) - 65) for k in range(1, step)]) as earlier
            from orders, range(1, 6) r(step)
        ), counted as (
            select part, filter_order, step, own,
                   sum(case when mask & own = 0 and mask & coalesce(earlier, 0)::int = 0 then n else 0 end) as kept,
                   sum(case when mask & own <> 0 and mask & coalesce(earlier, 0)::int = 0 then n else 0 end) as removed,
                   sum(case when mask & own <> 0 and mask & coalesce(earlier, 0)::int <> 0 then n else 0 end) as redundant,
                   sum(case when mask = own then n else 0 end) as unique_fails,
                   sum(case when good and mask & own <> 0 and mask & coalesce(earlier, 0)::int = 0 then n else 0 end) as good_lost,
                   sum(case when toxic and mask & own <> 0 and mask & coalesce(earlier, 0)::int = 0 then n else 0 end) as toxic_lost
            from kinds, steps group by part, filter_order, step, own
        )
        select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
               redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
               toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, own))::bigint as shapley
        from counted
    """,
    "op13_collocations": r"""
        with pieces as (
            select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) as piece
            from documents
        ), lists as (
            select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
        ), starts as (
            select lang, w, unnest(range(1, len(w) + 1)) as i from lists
        ), counts as (
            select lang, array_to_string(w[i : i + size - 1], ' ') as phrase, size, count(*) as a
            from starts, range(1, 4) r(size) where i + size - 1 <= len(w) group by all
        ), cut as materialized (
            select lang, phrase, a, k, array_to_string(string_split(phrase, ' ')[1 : k], ' ') as p,
                   array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') as q
            from counts, range(1, 3) r(k) where size > k and a >= 10
        ), known as materialized (
            select lang, phrase, a from counts where a >= 10
        ), cuts as (
            select c.lang, c.phrase, c.a, k, x.a as l, y.a as r,
                   1000000::hugeint * c.a * c.a // (x.a::hugeint * y.a) as score
            from cut c join known x on c.lang = x.lang and c.p = x.phrase join known y on c.lang = y.lang and c.q = y.phrase
        ), scored as (
            select lang, phrase, a, arg_min(struct_pack(score, l, r), (score, k)) as cut from cuts group by lang, phrase, a
        ), covers as (
            select lang, part, max(a) as a from (
                select lang, a, unnest([array_to_string(string_split(phrase, ' ')[1 : 2], ' '),
                                        array_to_string(string_split(phrase, ' ')[2 : 3], ' ')]) as part
                from scored where len(string_split(phrase, ' ')) = 3
            ) group by lang, part
        ), kept as (
            select s.* from scored s left join covers c on c.lang = s.lang and c.part = s.phrase
            where c.a is null or 100 * c.a < 50 * s.a
        ), ranked as (
            select *, row_number() over (partition by lang order by cut.score desc, a desc, encode(phrase)) as rank from kept
        ), totals as (
            select lang, sum(len(w))::bigint as n from lists group by lang
        )
        select k.lang, rank, phrase, a, cut.l as l, cut.r as r, n, cut.score::bigint as score
        from ranked k join totals t on k.lang = t.lang where rank <= 2000
    """,
}
