"""DuckDB SQL of the longer queries."""

UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text."""
    shift = "xor(b >> 1, case when b & 1 = 1 then 3988292384 else 0 end)"
    byte = f"list_reduce(range(8), lambda b, k: {shift}, xor(c, ascii(x)::bigint) & 255)"
    return f"xor(list_reduce(string_split({text}, ''), lambda c, x: xor(c >> 8, {byte}), 4294967295::bigint), 4294967295)"


def tagged(*values: str) -> str:
    return " || ".join(f"coalesce(strlen({v}::varchar) || ':' || {v}, '-')" for v in values)


MERKLE = f"""
with recursive docs as (
  select doc_id, lang, sha256({tagged("doc_id", "source", "lang", "n_chars", "text")}) leaf,
    sha256({tagged("doc_id", "source", "lang", "n_chars", f"translate(text, {UPPER}, {LOWER})")}) lowered,
    {crc32("doc_id::varchar")} % 3 = 0 tampered
  from documents),
placed as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 place, count(*) over (partition by lang) n
  from docs),
nodes as (
  select lang, 0 level, place, leaf h, n from placed
  union all
  select lang, level + 1, place // 8, sha256(string_agg(h, '' order by place)), (n + 7) // 8
  from nodes where n > 1 group by lang, level, place // 8, n),
subroots as (
  select lang, h, row_number() over (order by lang nulls first) - 1 place, count(*) over () n from nodes where n = 1),
tops as (
  select 0 level, place, h, n from subroots
  union all
  select level + 1, place // 8, sha256(string_agg(h, '' order by place)), (n + 7) // 8
  from tops where n > 1 group by level, place // 8, n),
ways as (
  select lang, place leaf_place, 0 level, place, n, case when tampered then lowered else leaf end h, '' proof from placed
  union all
  select w.lang, w.leaf_place, w.level + 1, w.place // 8, (w.n + 7) // 8,
    sha256(string_agg(case when x.place = w.place then w.h else x.h end, '' order by x.place)),
    w.proof || coalesce(string_agg(x.h, '' order by x.place) filter (where x.place <> w.place), '')
  from ways w join nodes x on x.lang is not distinct from w.lang and x.level = w.level and x.place // 8 = w.place // 8
  where w.n > 1 group by w.lang, w.leaf_place, w.level, w.place, w.n, w.h, w.proof),
upper as (
  select w.lang, w.leaf_place, 0 level, s.place, s.n, w.h, w.proof, s.h subroot
  from ways w join subroots s on s.lang is not distinct from w.lang where w.n = 1
  union all
  select w.lang, w.leaf_place, w.level + 1, w.place // 8, (w.n + 7) // 8,
    sha256(string_agg(case when x.place = w.place then w.h else x.h end, '' order by x.place)),
    w.proof || coalesce(string_agg(x.h, '' order by x.place) filter (where x.place <> w.place), ''), w.subroot
  from upper w join tops x on x.level = w.level and x.place // 8 = w.place // 8
  where w.n > 1 group by w.lang, w.leaf_place, w.level, w.place, w.n, w.h, w.proof, w.subroot)
select p.doc_id, p.leaf, u.subroot, t.h root, sha256(u.proof) proof_sha256, u.h folded_root, u.h = t.h verified
from placed p join upper u on u.lang is not distinct from p.lang and u.leaf_place = p.place and u.n = 1
join tops t on t.n = 1
"""

REPEATS = r"""
with docs as (
  select row_number() over () rid, doc_id, coalesce(doc_id, -9223372036854775808) id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') words
  from documents),
starts as (select rid, id, words, unnest(range(1, len(words) - 18)) s from docs),
windows as (select rid, id, s, array_to_string(words[s:s + 19], ' ') w from starts),
judged as (select rid, s, row(id, s) > min(row(id, s)) over (partition by w) later from windows),
gone as (select distinct rid, unnest(range(s, s + 20)) p from judged where later),
placed as (select rid, unnest(words) word, generate_subscripts(words, 1) p from docs),
kept as (
  select p.rid, string_agg(p.word, ' ' order by p.p) kept, count(*) n
  from placed p anti join gone g on g.rid = p.rid and g.p = p.p group by p.rid)
select d.doc_id, len(d.words) n_words, len(d.words) - coalesce(k.n, 0) n_removed, sha256(coalesce(k.kept, '')) kept_sha256
from docs d left join kept k using (rid)
"""


def repair_options() -> str:
    """Each edit of a turn, after an insertion or not: state, insertion, state then, edit, initial asked for, state after."""
    keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    role = {2: "user", 3: "assistant"}
    rows = [(p, "", "", "D", "", p, "") for p in after]
    for p in after:
        for at, label, inserted in ((p, "", ""), (after[p], "I", role[after[p]] + ":")):
            rows += [(p, label, inserted, "K", r, q, "") for (m, r), q in keep.items() if m == at]
            rows.append((p, label, inserted, "R", "", after[at], role[after[at]]))
    return ", ".join(map(str, rows))


REPAIR = rf"""
with recursive source as (
  select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
    {crc32("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 kind
  from conversations),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end role,
    case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end text,
    unnest(range(case when kind = 3 then 2 else 1 end)) copy
  from source where kind <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) i from damaged),
turns as (
  select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
      when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 'truncated' end fault,
    lag(role[1:1]) over (partition by conv_id order by i) || role[1:1] pair, count(*) over (partition by conv_id) n
  from placed),
options(p, ins, inserted, e, r, q, becomes) as (values {repair_options()}),
paths as (
  select distinct conv_id, n, 0::bigint i, 0 p, row(0::bigint, '', []::varchar[]) best from turns
  union all
  select v.conv_id, v.n, v.i + 1, o.q,
    min(row(
      v.best[1] + 3 * len(o.ins) + case o.e when 'K' then 0 when 'R' then 3 else 4 end
        + case when o.e <> 'D' and t.fault = 'truncated' then 3 else 0 end,
      v.best[2] || o.ins || o.e,
      v.best[3] || case when o.ins = '' then [] else [o.inserted] end
        || case o.e when 'D' then [] when 'K' then [t.role || ':' || t.text] else [o.becomes || ':' || t.text] end))
  from paths v join turns t on t.conv_id is not distinct from v.conv_id and t.i = v.i + 1 join options o on o.p = v.p
  where (o.e = 'D' or t.fault is null or t.fault = 'truncated') and (o.e <> 'K' or o.r = t.role[1:1])
  group by v.conv_id, v.n, v.i, o.q),
tails(p, tail, lines) as (values (0, '', []::varchar[]), (1, 'II', ['user:', 'assistant:']), (2, 'I', ['assistant:']), (3, '', [])),
chosen as (
  select conv_id, min(row(best[1] + 3 * len(tail), best[2] || tail, best[3] || lines)) best
  from paths join tails using (p) where i = n group by conv_id),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count_if(fault = 'blank') blank,
    count_if(fault = 'duplicate') duplicate, count_if(fault = 'truncated') truncated,
    count_if(pair not in ('su', 'ua', 'au')) illegal
  from turns group by conv_id),
ids as (select distinct conv_id from conversations)
select d.conv_id, coalesce(c.gaps, 0) gaps, coalesce(c.blank, 0) blank, coalesce(c.duplicate, 0) duplicate,
  coalesce(c.truncated, 0) truncated, coalesce(c.illegal, 0) illegal, coalesce(b.best[1], 0) cost,
  coalesce(b.best[2], '') audit, sha256(coalesce(array_to_string(b.best[3], chr(10)), '')) repaired_sha256
from ids d left join counted c on c.conv_id is not distinct from d.conv_id
left join chosen b on b.conv_id is not distinct from d.conv_id
"""
