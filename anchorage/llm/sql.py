"""DuckDB SQL for the operators that SQL can express, over whole tables."""

import re

from anchorage.llm.licenses import WHOLE
from anchorage.llm.quality import BOILERPLATE, LEAST_KEPT, SHORT_LINE

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# words of ASCII digits and letters and of everything beyond ASCII
WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

JACCARD = f"""
with recursive w as materialized (select doc_id, {WORDS} as w from documents),
s as materialized (
    select doc_id, list_sort(list_distinct(case when len(w) < 5 then [array_to_string(w, ' ')] else
        list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as s
    from w where len(w) > 0
),
c as materialized (select s, min(doc_id) as class_id from s group by s),
g as materialized (select class_id, len(s) as n, unnest(s) as x from c),
p as (
    select a.class_id as a, b.class_id as b from g a join g b on a.x = b.x and a.class_id < b.class_id
    group by a.class_id, b.class_id, a.n, b.n having 5 * count(*) >= 4 * (a.n + b.n - count(*))
),
e as materialized (select a, b from p union all select b, a from p),
reach(a, b) as (select a, b from e union select r.a, e.b from reach r join e on r.b = e.a),
l as (select a, count(*) as n_links from e group by a),
r as (select a, least(a, min(b)) as group_id from reach group by a)
select d.doc_id, coalesce(c.class_id, d.doc_id) as class_id, coalesce(n_links, 0)::bigint as n_links,
    coalesce(group_id, c.class_id, d.doc_id) as group_id
from documents d left join s on s.doc_id = d.doc_id left join c on c.s = s.s
    left join l on l.a = c.class_id left join r on r.a = c.class_id
"""

SPACE = r"[\x20\x09-\x0D]"


def _solid(x):
    return f"length(regexp_replace({x}, '{SPACE}', '', 'g'))"


def _symbols(x):
    return f"(length({x}) - length(translate({x}, '#*$%&|<>', '')))"


QUALITY = rf"""
with t as materialized (select doc_id, coalesce(text, '') as t from documents),
w as materialized (select doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from t),
i as (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w where len(w) >= 3),
v as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n from i),
r as (
    select doc_id, count(distinct i + k) as n_repeat_words
    from (select doc_id, i, unnest([0, 1, 2]) as k from v where n > 1) group by doc_id
),
x as materialized (
    select doc_id, unnest(string_split(t, chr(10))) as x from t
),
y as (
    select doc_id, x, {_solid("x")} as solid, {_symbols("x")} as symbols,
        len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) as n,
        length(x) - length(translate(x, '|', '')) as bars,
        (length(x) - length(replace(x, '!!', ''))) / 2.0 as shouts,
        regexp_matches(regexp_replace(x, '{SPACE}+$', ''), '[.!?:;…)"”»]$') as ended,
        regexp_matches(translate(x, '{UPPER}', '{LOWER}'), '{"|".join(BOILERPLATE)}') as furniture
    from x
),
z as (
    select *, solid > 0 and (5 * symbols >= solid or 3 * shouts >= greatest(n, 1) or (n < 4 and not ended)
        or (bars >= 2 and 3 * bars >= n - bars) or (n <= {SHORT_LINE} and furniture)) as fails
    from y
),
l as (
    select doc_id, count(*) filter (solid > 0) as n_lines, count(*) filter (fails) as n_removed,
        count(*) filter (solid > 0) - count(distinct x) filter (solid > 0) as n_dup_lines,
        coalesce(sum(solid) filter (fails), 0)::bigint as lost_chars
    from z group by doc_id
),
b as (
    select doc_id, len(w)::bigint as n_words, {_solid("t")}::bigint as word_chars, {_symbols("t")}::bigint as n_symbols,
        n_dup_lines::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
        n_lines::bigint as n_lines, n_removed::bigint as n_removed, lost_chars
    from t join w using (doc_id) join l using (doc_id) left join r using (doc_id)
),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from b)
select *, not base_failed and word_chars - lost_chars >= {LEAST_KEPT} * word_chars as kept from f
"""

SUFFIXES = """
with b as materialized (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as materialized (
    select doc_id, p, substr(h, 2 * p + 1, 100) as s
    from (select doc_id, h, unnest(range(0, greatest(strlen(h) // 2 - 49, 0))) as p from b)
),
m as (select s, min(doc_id) as first_doc from w group by s having min(doc_id) < max(doc_id)),
hit as (select doc_id, p from w join m using (s) where doc_id > first_doc),
run as (
    select doc_id, p, sum(starts) over (partition by doc_id order by p) as run
    from (select doc_id, p, case when p <= lag(p) over (partition by doc_id order by p) + 50 then 0 else 1 end as starts from hit)
),
gone as (select doc_id, run, min(p) as a, max(p) + 50 as b from run group by doc_id, run),
edge as (
    select doc_id, a, b, lag(b, 1, 0) over (partition by doc_id order by a) as before,
        row_number() over (partition by doc_id order by a desc) = 1 as last
    from gone
),
kept as (
    select e.doc_id, sum(e.b - e.a)::bigint as n_removed, count(*) as n_spans,
        string_agg(substr(h, 2 * before + 1, 2 * (a - before)) || case when last then substr(h, 2 * e.b + 1) else '' end, '' order by a) as h
    from edge e join b on b.doc_id = e.doc_id group by e.doc_id
)
select b.doc_id, (strlen(b.h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
    coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(kept.h, b.h))) as kept_sha256
from b left join kept using (doc_id)
"""

_PHRASES = "[{'p': 'gnu general public license', 'l': 'gpl'}, {'p': 'apache license', 'l': 'apache'}, {'p': 'cc by', 'l': 'cc-by'}, {'p': 'mit license', 'l': 'mit'}]"
# the templates as patterns over words that single spaces join, one before and one after
_PATTERNS = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "gpl-notice": "licensed under the (terms of the )?gnu (lesser )?general public license (as published by the free software foundation (either )?)?version [^ ]+",
    "mit-notice": "(released )?(licensed )?under the (terms of the )?mit license",
    "cc-by-notice": "licensed under (a )?(the )?(creative commons )?cc by (nc )?(sa )?(nd )?[^ ]+ 0",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files (the software )?to deal in the software without restriction",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "spdx-tag": "spdx license identifier [^ ]+",
    "copyright-notice": "copyright (c )?([^ ]+ ){1,2}(by )?([^ ]+ ){1,8}all rights reserved",
}


def _pattern(template):
    """A template of a whole text as a pattern; each word brings the space after it."""
    marks = {"[[": "(", "]]": ")?"}
    words = (marks.get(m) or re.sub(r"\{\{(\d+)\.\.(\d+)\}\}", r"([^ ]+ ){\1,\2}", m if "{" in m else m + " ") for m in template.split())
    return "".join(words)


_MATCHES = ", ".join(
    f"case when regexp_matches(j, ' {p}') then '{label}' end"
    for label, p in [*((label, p + " ") for label, p in _PATTERNS.items()), *((label, _pattern(t)) for label, t in WHOLE)]
)

LICENSES = f"""
with w as materialized (select doc_id, {WORDS} as w from documents),
t as materialized (select doc_id, w, ' ' || array_to_string(w, ' ') || ' ' as j from w),
i as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from t where len(w) > 0),
q as (select unnest({_PHRASES}, recursive := true)),
m as (
    select doc_id, i - 1 as i, l from i join q
        on w[i] = string_split(p, ' ')[1] and array_to_string(w[i:i + len(string_split(p, ' ')) - 1], ' ') = p
),
b as (
    select doc_id, count(*) as n_base, min(i) as first_word, max(i) as last_word, list_sort(list_distinct(list(l))) as base
    from m group by doc_id
),
x as (select doc_id, len(w)::bigint as n_words, list_filter([{_MATCHES}], lambda y: y is not null) as own from t)
select doc_id, n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
    last_word::bigint as last_word, array_to_string(coalesce(base, []), ',') as base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), own))), ',') as labels,
    case when len(own) > 0 then 1.0 when n_base > 0 then 0.5 else 0.0 end::double as score
from x left join b using (doc_id)
"""



def _crc32(x):
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    step = "lambda y, k: xor(y >> 1, 3988292384 * (y & 1))"
    chars = f"list_transform(range(1, length({x}) + 1), lambda i: ascii(({x})[i])::bigint)"
    taken = f"list_reduce(list_prepend(xor(c, x), range(8)), {step})"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {chars}), lambda c, x: {taken}), 4294967295)"


def _field(x):
    return f"coalesce(strlen(({x})::varchar) || ':' || ({x})::varchar, '-')"


def _digest(text):
    return f"sha256({' || '.join(map(_field, ['doc_id', 'source', 'lang', 'n_chars', text]))})"


def _tree(leaves):
    return f"""
    select g, 0 as level, i, h, count(*) over (partition by g) as n from {leaves}
    union all
    select g, level + 1, i // 8, sha256(string_agg(h, '' order by i)), (n + 7) // 8
    from {{}} where n > 1 group by g, level, i // 8, n
    """


MERKLE = f"""
with recursive d as materialized (
    select doc_id, lang as g, {_digest("text")} as h, case when {_crc32("doc_id::varchar")} % 3 = 0
        then {_digest(f"translate(text, '{UPPER}', '{LOWER}')")} else {_digest("text")} end as claim
    from documents
),
l as materialized (select *, row_number() over (partition by g order by doc_id nulls first, h) - 1 as i from d),
t(g, level, i, h, n) as ({_tree("l").format("t")}),
s as materialized (
    select 0 as g, g as lang, h, row_number() over (order by g nulls first) - 1 as i from t where n = 1
),
u(g, level, i, h, n) as ({_tree("s").format("u")}),
steps as (
    select l.g, l.i as leaf, 0 as tree, t.level, t.i, t.h, l.i >> (3 * t.level) as own
    from l join t on t.g is not distinct from l.g and t.n > 1 and t.i // 8 = l.i >> (3 * t.level + 3)
    union all
    select s.lang, l.i, 1, u.level, u.i, u.h, s.i >> (3 * u.level)
    from s join l on l.g is not distinct from s.lang join u on u.n > 1 and u.i // 8 = s.i >> (3 * u.level + 3)
),
runs as (
    select g, leaf, tree, level, coalesce(string_agg(h, '' order by i) filter (i < own), '') as a,
        coalesce(string_agg(h, '' order by i) filter (i > own), '') as b
    from steps group by g, leaf, tree, level
),
p as (
    select g, leaf, string_agg(a || b, '' order by tree, level) as siblings, list(a || '|' || b order by tree, level) as path
    from runs group by g, leaf
),
f as (
    select l.doc_id, l.h as leaf, s.h as subroot, (select h from u where n = 1) as root,
        sha256(coalesce(siblings, '')) as proof_sha256, list_reduce(list_prepend(claim, coalesce(path, [])),
            lambda own, x: sha256(split_part(x, '|', 1) || own || split_part(x, '|', 2))) as folded_root
    from l join s on s.lang is not distinct from l.g left join p on p.g is not distinct from l.g and p.leaf = l.i
)
select *, folded_root = root as verified from f
"""

TRIE = f"""
with o as materialized (
    select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as i,
        {{'r': coalesce(role, ''), 't': coalesce(text, '')}} as x
    from conversations where conv_id is not null
),
own as (select c, list(x order by i) as x from o group by c),
h as (select *, c - c % 100 as base, {_crc32("c::varchar")} % 6 as h from own),
p as materialized (
    select h.c, list_concat(coalesce(b.x[1:h.h], []), h.x[h.h + 1:]) as x from h left join own b on b.c = h.base
),
m as (select c, d, x[1:d] as x, len(x) = d as ended from (select c, x, unnest(range(0, len(x) + 1)) as d from p)),
n as materialized (
    select d, x, min(c) as conv_id, count(*) as n_convs, string_agg(c::varchar, ',' order by c) filter (ended) as ends
    from m group by d, x
),
k as (select d - 1 as d, x[1:d - 1] as x, count(*) as n_children from n where d > 0 group by all),
v as (
    select n.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * coalesce(length(n.x[n.d].t), 0) as own
    from n left join k on k.d = n.d and k.x = n.x
),
s as (
    select a as d, x[1:a] as x, count(*) filter (n_children = 0) as n_leaves, sum(own)::bigint as saved_tokens
    from (select *, unnest(range(0, d + 1)) as a from v) group by all
)
select v.conv_id, v.d as depth, up.conv_id as parent_conv_id, v.n_convs, v.n_children::bigint as n_children, s.n_leaves,
    s.saved_tokens, sha256(coalesce(v.ends, '')) as ends_sha256
from v join s on s.d = v.d and s.x = v.x left join n up on v.d > 0 and up.d = v.d - 1 and up.x = v.x[1:v.d - 1]
"""

WINDOWS = r"""
with w as materialized (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
),
i as (select doc_id, w, unnest(range(1, len(w) - 18)) as i from w where len(w) >= 20),
x as (
    select doc_id, i, row_number() over (partition by w[i:i + 19] order by doc_id, i) as n from i
),
gone as (select distinct doc_id, i from (select doc_id, i + unnest(range(0, 20)) as i from x where n > 1)),
g as (select doc_id, count(*) as n, list(i) as gone from gone group by doc_id),
e as (
    select doc_id, count(*) as n_spans
    from (select doc_id, i, lag(i) over (partition by doc_id order by i) as before from gone)
    where before is null or before < i - 1 group by doc_id
)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
    sha256(array_to_string(case when n is null then w else list_filter(w, lambda y, k: not list_contains(gone, k)) end, ' ')) as kept_sha256
from w left join g using (doc_id) left join e using (doc_id)
"""

ORACLES = {
    "op1_ngram_jaccard_join": JACCARD,
    "op4_quality_rules": QUALITY,
    "op8_suffix_dedup": SUFFIXES,
    "op10_license_scans": LICENSES,
    "op11_merkle_manifest": MERKLE,
    "op12_conversation_trie": TRIE,
    "op13_substring_dedup": WINDOWS,
}
