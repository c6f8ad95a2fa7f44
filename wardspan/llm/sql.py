"""SQL forms of the corpus queries, for DuckDB."""


OP1 = r"""
with recursive
words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
    from documents
),
sets as (
    select doc_id, case when len(w) >= 5
        then list_distinct(list_transform(range(1, len(w) - 3), lambda i : array_to_string(w[i : i + 4], ' ')))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
    from words
),
items as (select doc_id, len(s) as n, unnest(s) as g from sets),
shared as (select g from items group by g having count(*) > 1),
pairs as (
    select x.doc_id as a, y.doc_id as b, any_value(x.n) as n, any_value(y.n) as m, count(*) as c
    from items x join items y on x.g = y.g and x.doc_id < y.doc_id
    where x.g in (select g from shared) group by 1, 2
),
linked as (select a, b from pairs where 100 * c >= 80 * (n + m - c)),
links as (select a, b from linked union select b, a from linked),
reach(node, component) as (
    select doc_id, doc_id from sets
    union
    select l.b, r.component from reach r join links l on l.a = r.node where r.component < l.b
)
select doc_id, cast(len(s) as bigint) as n_shingles,
    (select min(component) from reach where node = doc_id) as component_id
from sets
"""

_WORDS = r"""
words as (
    select {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from {table}
)"""

OP4 = (
    "with "
    + _WORDS.format(key="doc_id", table="documents")
    + r""",
templates(label, t, k, place, base) as (
    select label, string_split(t, ' '), string_split(k, ' '), place, base from (values
        ('cc-by', 'cc by', 'cc by', 0, true),
        ('gpl', 'general public license', 'general public license', 0, true),
        ('reserved', 'all rights reserved', 'all rights reserved', 0, true),
        ('mit', 'released under the mit license', 'mit license', 3, false),
        ('mit', 'permission is hereby granted free of charge to any person obtaining a copy',
            'permission is hereby granted free of charge', 0, false),
        ('apache-2.0', 'licensed under the apache license version 2 0', 'apache license version 2 0', 3, false),
        ('bsd', 'redistribution and use in source and binary forms with or without modification',
            'redistribution and use in source and binary forms', 0, false),
        ('cc-by-nc', 'licensed under cc by nc 4 0', 'cc by nc', 2, false),
        ('cc-by-sa', 'licensed under cc by sa 4 0', 'cc by sa', 2, false),
        ('cc0-1.0', 'creative commons cc0 1 0 universal', 'cc0 1 0', 2, false),
        ('gpl-2.0', 'licensed under the gnu general public license version 2', 'general public license version 2', 4, false),
        ('gpl-3.0', 'licensed under the gnu general public license version 3', 'general public license version 3', 4, false),
        ('lgpl', 'gnu lesser general public license', 'lesser general public license', 1, false),
        ('mpl-2.0', 'subject to the terms of the mozilla public license v 2 0', 'mozilla public license', 5, false),
        ('unlicense', 'this is free and unencumbered software released into the public domain',
            'free and unencumbered software', 2, false)
    ) as v(label, t, k, place, base)
),
spots as (
    select doc_id, label, t, w, place, base,
        unnest(list_filter(range(len(w) - len(k) + 1), lambda i : w[i + 1 : i + len(k)] = k)) as i
    from words, templates where list_has_all(w, k)
),
found as (
    select doc_id, label, base, i - place as start,
        len(list_filter(range(len(t)), lambda j : i - place + j >= 0 and w[i - place + j + 1] = t[j + 1])) / len(t) as share
    from spots
),
by_doc as (
    select doc_id, count(*) filter (base) as n_base, min(start) filter (base) as first_word,
        max(start) filter (base) as last_word,
        string_agg(distinct label, ',' order by label) filter (base) as base_labels,
        string_agg(distinct label, ',' order by label) as labels, max(share) as score
    from found group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
    coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
from words left join by_doc using (doc_id)
"""
)

OP5 = (
    "with "
    + _WORDS.format(key="doc_id", table="documents")
    + ", "
    + _WORDS.format(key="item_id", table="benchmark").replace("words as", "item_words as")
    + r""",
windows as (
    select distinct item_id, least(10, len(w)) as size,
        unnest(list_transform(range(len(w) - least(10, len(w)) + 1),
            lambda i : array_to_string(w[i + 1 : i + least(10, len(w))], ' '))) as g
    from item_words where len(w) > 0
),
sizes as (select distinct size from windows),
grams as (
    select doc_id, size, unnest(range(len(w) - size + 1)) as i,
        unnest(list_transform(range(len(w) - size + 1), lambda i : array_to_string(w[i + 1 : i + size], ' '))) as g
    from words, sizes where len(w) >= size
),
hits as (select doc_id, i, size, item_id from grams join windows using (size, g)),
hit_words as (select distinct doc_id, unnest(range(i, i + size)) as word from (select distinct doc_id, i, size from hits)),
counted as (select doc_id, count(*) as n_hit from hit_words group by doc_id),
named as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join counted using (doc_id) left join named using (doc_id)
"""
)

OP13 = r"""
with
pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, sum(len(w)) as n from words group by lang),
lengths as (select unnest(range(1, 6)) as k),
grams as (
    select lang, k, unnest(list_transform(range(len(w) - k + 1), lambda i : w[i + 1 : i + k])) as g
    from words, lengths where len(w) >= k
),
counted as (select lang, k, g, count(*) as f from grams group by lang, k, g having count(*) >= 100),
longer as (
    select lang, g[1 : k - 1] as g, f from counted where k > 2
    union all select lang, g[2 : k] as g, f from counted where k > 2
),
covered as (select lang, g, max(f) as f from longer group by lang, g),
kept as (
    select c.* from counted c left join covered o on c.lang = o.lang and c.g = o.g
    where c.k > 1 and (o.f is null or 100 * o.f < 100 * c.f)
),
cuts as (
    select c.lang, c.g, c.f as a, l.f as l, r.f as r, cast(n as bigint) as n, j.k as cut,
        (1000::hugeint * c.f::hugeint * n::hugeint) // (l.f::hugeint * r.f::hugeint) as score
    from kept c join lengths j on j.k < c.k
        join counted l on l.lang = c.lang and l.g = c.g[1 : j.k]
        join counted r on r.lang = c.lang and r.g = c.g[j.k + 1 : c.k]
        join totals t on t.lang = c.lang
),
lowest as (select *, row_number() over (partition by lang, g order by score, cut) as place from cuts),
ranked as (
    select lang, array_to_string(g, ' ') as phrase, a, l, r, n, cast(score as bigint) as score,
        row_number() over (partition by lang order by score desc, a desc, array_to_string(g, ' ')) as rank
    from lowest where place = 1
)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""

SQL = {
    "op1_jaccard_join": OP1,
    "op4_licences": OP4,
    "op5_decontaminate": OP5,
    "op13_collocations": OP13,
}
