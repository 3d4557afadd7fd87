"""SQL that checks the operators SQL can express."""

from __future__ import annotations

from spendlake.llm.quality_rules import FENCE_RANGES, MAX_REPEAT_PERCENT, MIN_WORDS, PRIOR_TEXTS, SLACK

_WORD = r"[^\x20\x09-\x0D]+"

_QUALITY = rf"""
with texts as (
    select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t from documents
), split as (
    select r, regexp_extract_all(t, '{_WORD}') as w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as l
    from texts
), placed as (
    select r, unnest(w) as word, unnest(range(len(w))) as i from split
), grams as (
    select r, i, word, lead(word) over o as word2, lead(word, 2) over o as word3 from placed window o as (partition by r order by i)
), twice as (
    select r, i from grams where word3 is not null qualify count(*) over (partition by r, word, word2, word3) > 1
), repeats as (
    select r, count(distinct i + d) as n from twice, (values (0), (1), (2)) as v(d) group by r
), measured as (
    select t.r, doc_id, lang, source, len(w)::bigint as n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        (len(l) - list_unique(l))::bigint as n_dup_lines, coalesce(p.n, 0)::bigint as n_repeat_words
    from texts t join split s on t.r = s.r left join repeats p on t.r = p.r
), judged as (
    select *, n_words < {MIN_WORDS} or n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} as base_failed from measured
), long as (
    select r, lang, source, base_failed, 'symbols' as measure, n_symbols * 1000 // n_words as v from judged where n_words > 0
    union all select r, lang, source, base_failed, 'repeats', n_repeat_words * 1000 // n_words from judged where n_words > 0
    union all select r, lang, source, base_failed, 'dup_lines', n_dup_lines * 1000 // n_words from judged where n_words > 0
    union all select r, lang, source, base_failed, 'word_length', word_chars * 1000 // n_words from judged where n_words > 0
), shifted as (
    select *, greatest(length(bin(v)) - 5, 0)::bigint as shift from long where not base_failed
), cells as (
    select lang, source, measure, (shift * 64 + (v >> shift))::bigint as cell, count(*) as n from shifted group by all
), merged as (
    select lang, measure, cell, sum(n) as n from cells group by all
), language_sizes as (
    select lang, measure, sum(n) as size from merged group by all
), blended as (
    select lang, source, measure, cell, sum(n) as n from (
        select c.lang, c.source, c.measure, c.cell, c.n::hugeint * s.size as n
        from cells c join language_sizes s on c.lang is not distinct from s.lang and c.measure = s.measure
        union all
        select g.lang, g.source, g.measure, m.cell, m.n::hugeint * {PRIOR_TEXTS}
        from (select distinct lang, source, measure from cells) g
        join merged m on g.lang is not distinct from m.lang and g.measure = m.measure
    ) group by all
), own as (
    select lang, source, measure, (cell % 64) << (cell // 64) as v,
        sum(n) over (partition by lang, source, measure order by cell) as upto,
        sum(n) over (partition by lang, source, measure) as size from blended
), quartiles as (
    select lang, source, measure, min(v) filter (upto * 4 >= size) as q1, min(v) filter (upto * 4 >= size * 3) as q3
    from own group by all
), slack as (
    select * from (values {", ".join(f"('{name}', {value})" for name, value in SLACK.items())}) as s(measure, slack)
), chosen as (
    select o.lang, o.source, o.measure, slack, q1, q3 from quartiles o join slack s on o.measure = s.measure
), failed as (
    select distinct l.r from long l join chosen c on l.measure = c.measure
        and l.lang is not distinct from c.lang and l.source is not distinct from c.source
    where l.v > q3 + (q3 - q1) * {FENCE_RANGES} + slack
        or (l.measure = 'word_length' and l.v < q1 - (q3 - q1) * {FENCE_RANGES} - slack)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and r not in (select r from failed) as kept
from judged
"""


def _crc32(text: str) -> str:
    """CRC-32 of an expression of plain ASCII: each byte is taken in, and -1 stands for a step of one bit after it."""
    steps = ", ".join(["-1"] * 8)
    listed = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: [ord(({text})[i]), {steps}]))"
    step = "case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end"
    return f"xor(list_reduce([4294967295]::bigint[] || {listed}::bigint[], lambda c, x: {step}), 4294967295)"


_SHOWN = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"

_REPAIR = rf"""
with recursive source as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as t, {_crc32(f"({_SHOWN})")} % 20 as k
    from conversations
), damaged as (
    select conv_id, turn, case k when 4 then 'user' else role end as role,
        case k when 1 then '' when 2 then regexp_replace(t, '[.!?]', '', 'g') else t end as t
    from source, (values (0), (1)) as v(copy) where k <> 0 and (copy = 0 or k = 3)
), numbered as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(t)) as pos from damaged
), seen as (
    select *, row_number() over (partition by conv_id, role, t order by pos) > 1 as again,
        not regexp_matches(t, '[^ 	-
]') as blank, lag(role) over (partition by conv_id order by pos) as before
    from numbered
), faults as (
    select *, not blank and again as duplicate,
        not blank and not again and not regexp_matches(t, '[.!?][ 	-
]*$') as truncated,
        coalesce(left(before, 1) || left(role, 1) not in ('su', 'ua', 'au'), false) as illegal
    from seen
), counts as (
    select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
        count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
        count(*) filter (truncated) as truncated, count(*) filter (illegal) as illegal
    from faults group by conv_id
), inserts as (
    select * from (values (0, 0, ''), (1, 1, ''), (2, 2, ''), (3, 3, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 2, 'I'),
        (1, 3, 'II'), (2, 3, 'I'), (3, 2, 'I')) as v(state, behind, edits)
), steps as (
    select * from (values ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)) as v(initial, state, behind)
), following as (
    select * from (values (0, 2), (1, 2), (2, 3), (3, 2)) as v(state, behind)
), edits as (
    select f.conv_id, f.pos, n.state, n.state as behind, 'D' as edit, 4 as cost from faults f, following n
    union all
    select f.conv_id, f.pos, s.state, s.behind, 'K', case when truncated then 3 else 0 end
    from faults f join steps s on left(f.role, 1) = s.initial where not blank and not duplicate
    union all
    select f.conv_id, f.pos, n.state, n.behind, 'R', case when truncated then 6 else 3 end
    from faults f, following n where not blank and not duplicate
), reached as (
    select conv_id, 0::bigint as pos, 0 as state, {{'cost': 0::bigint, 'audit': ''}} as best from counts
    union all
    select r.conv_id, e.pos, e.behind,
        min({{'cost': (r.best.cost + 3 * length(i.edits) + e.cost)::bigint, 'audit': r.best.audit || i.edits || e.edit}})
    from reached r join inserts i on r.state = i.state
    join edits e on e.conv_id is not distinct from r.conv_id and e.pos = r.pos + 1 and e.state = i.behind
    group by r.conv_id, e.pos, e.behind
), goals as (
    select r.conv_id, min({{'cost': (r.best.cost + 3 * length(i.edits))::bigint, 'audit': r.best.audit || i.edits}}) as best
    from reached r join inserts i on r.state = i.state join counts c on r.conv_id is not distinct from c.conv_id and r.pos = c.n
    where i.behind in (0, 3) group by r.conv_id
), letters as (
    select conv_id, unnest(string_split(best.audit, '')) as edit, unnest(range(length(best.audit))) as i
    from goals where best.audit <> ''
), placed as (
    select *, count(*) filter (edit <> 'I') over o as pos, count(*) filter (edit <> 'D') over o as place
    from letters window o as (partition by conv_id order by i)
), outputs as (
    select p.*, f.role, f.t, first(p.edit = 'K' and left(f.role, 1) = 's') over (partition by p.conv_id order by place) as has_system
    from placed p left join faults f on p.edit <> 'I' and p.conv_id is not distinct from f.conv_id and p.pos = f.pos
    where p.edit <> 'D'
), lines as (
    select conv_id, place, case when edit = 'K' then role
        when (place - has_system::int) % 2 = 1 then 'user' else 'assistant' end
        || ':' || case when edit = 'I' then '' else t end as line
    from outputs
), hashes as (
    select conv_id, sha256(string_agg(line, chr(10) order by place)) as hash from lines group by conv_id
)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(g.best.cost, 0) as cost,
    coalesce(g.best.audit, '') as audit, coalesce(hash, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on o.conv_id is not distinct from c.conv_id
left join goals g on o.conv_id is not distinct from g.conv_id
left join hashes h on o.conv_id is not distinct from h.conv_id
"""

def _utf8_crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of an expression."""
    steps = ", ".join(["-1"] * 8)
    one = f"('0x' || substr(hex({text}), 2 * i + 1, 2))::bigint"
    listed = f"flatten(list_transform(range(0, length(hex({text})) // 2), lambda i: [{one}, {steps}]))"
    step = "case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end"
    return f"xor(list_reduce([4294967295]::bigint[] || {listed}::bigint[], lambda c, x: {step}), 4294967295)"


_SPELLING = rf"""
with recursive runs as (
    select r, doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
    from (select row_number() over () as r, doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run from documents)
), counted as (
    select doc_id, run, count(*) as n from runs where length(run) >= 5 group by all
), summed as (
    select run, n, {_utf8_crc32("(coalesce(doc_id::varchar, '') || ':' || run)")} as h from counted
), results as (
    select case when h % 97 <> 0 then run
        else left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) end as word, n
    from summed
), words as (
    select word, sum(n)::bigint as n from results where length(word) >= 5 group by word having sum(n) >= 3
), cuts as (
    select word, n, i, left(word, i) || substr(word, i + 2) as rest
    from (select word, n, unnest(range(length(word)))::int as i from words)
), near as (
    select a.word, a.n, b.word as other, b.n as other_n from cuts a join cuts b
    on a.rest = b.rest and a.i = b.i and length(a.word) = length(b.word) and a.word <> b.word
    union select a.word, a.n, b.word, b.n from cuts a join words b on a.rest = b.word
    union select b.word, b.n, a.word, a.n from cuts a join words b on a.rest = b.word
), best as (
    select word, count(*) as n_near, first(other order by other_n desc, other) as other, max(other_n) as other_n
    from near group by word
), formed as (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when other_n >= 2 * w.n then other end as form,
        case when other_n >= 2 * w.n then other_n end as form_n
    from words w left join best b on w.word = b.word
), chain as (
    select word, word as root, 0 as steps from words
    union all
    select c.word, f.form, steps + 1 from chain c join formed f on c.root = f.word where f.form is not null
)
select f.word, form, root, n, n_near, form_n
from formed f join (select word, arg_max(root, steps) as root from chain group by word) c on f.word = c.word
"""

_NGRAMS = rf"""
with recursive texts as (
    select row_number() over () as r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as w
    from documents
), placed as (
    select r, unnest(w) as word, unnest(range(len(w))) as i, len(w) as size from texts where len(w) >= 4
), grams as (
    select r, word || ' ' || lead(word) over o || ' ' || lead(word, 2) over o || ' ' || lead(word, 3) over o as gram
    from placed window o as (partition by r order by i)
    union all select r, array_to_string(w, ' ') from texts where len(w) between 1 and 3
), shingles as (
    select distinct r, gram from grams where gram is not null
), sizes as (
    select r, count(*) as n, md5(string_agg(gram, chr(10) order by gram)) as whole from shingles group by r
), sets as (
    select whole, min(r) as r, any_value(n) as n from sizes group by whole
), held as (
    select s.r, n, gram from sets s join shingles g on s.r = g.r
), meets as (
    select a.r, b.r as other, a.n, b.n as other_n, count(*) as shared
    from held a join held b on a.gram = b.gram and a.r < b.r and 100 * a.n >= 85 * b.n and 100 * b.n >= 85 * a.n group by all
), links as (
    select r, other from meets where 100 * shared >= 85 * (n + other_n - shared)
), both_ways as (
    select r, other from links union all select other, r from links
), reach as (
    select r, r as other from sets union select h.r, b.other from reach h join both_ways b on h.other = b.r
), least as (
    select z.whole, min(t.doc_id) as doc_id from sizes z join texts t on z.r = t.r group by z.whole
), component as (
    select s.whole, min(l.doc_id) as component_id
    from sets s join reach h on s.r = h.r join sets o on o.r = h.other join least l on l.whole = o.whole group by s.whole
)
select t.doc_id, coalesce(z.n, 0) as n_shingles, case when z.n is null then t.doc_id else c.component_id end as component_id
from texts t left join sizes z on t.r = z.r left join component c on z.whole = c.whole
"""

ORACLES: dict[str, str] = {
    "op7_quality_rules": _QUALITY,
    "op11_conversation_repair": _REPAIR,
    "op12_ngram_join": _NGRAMS,
    "op13_spelling_variants": _SPELLING,
}
