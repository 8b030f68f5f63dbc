"""DuckDB SQL for the queries that SQL can express. Words are what white space of ASCII separates."""

from __future__ import annotations

from .quality_rules import BOILERPLATE, ENDS, NAVIGATION, SEPARATORS

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _quoted(x: str) -> str:
    return x.replace("'", "''")


def op1() -> str:
    symbols = r"length(regexp_replace({0}, '[^#*$%&|<>]', '', 'g'))"
    separators = f"length(regexp_replace(line, '[^{SEPARATORS}]', '', 'g'))"
    ends = "[" + "".join("\\" + c if c in "]\\^-" else c for c in ENDS) + "]$"
    phrases = " + ".join(f"(length(low) - length(replace(low, '{_quoted(p)}', ''))) // {len(p)}" for p in BOILERPLATE)
    marks = r"length(regexp_replace(line, '[^!-/:-@\[-\x60\x7B-~]', '', 'g'))"
    names = ", ".join(f"'{n}'" for n in NAVIGATION)
    return rf"""
with d as (select doc_id, coalesce(text, '') as text, {WORDS.format("coalesce(text, '')")} as w from documents),
l as (select doc_id, i, trim(line, E' \t\n\v\f\r') as line, translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low, line as raw, len({WORDS.format("line")}) as k
  from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from d)),
j as (select *, k > 0 and ({symbols.format("line")} > k or 3 * {marks} > 2 * length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) or ({separators} >= 3 and 3 * {separators} >= k)
    or (not regexp_matches(line, '{_quoted(ends)}') and k <= 4 and len(list_filter({WORDS.format("low")}, lambda x: x not in ({names}))) = 0)
    or k <= 12 * ({phrases})) as bad,
  k > 0 and row_number() over (partition by doc_id, raw order by i) > 1 as dup from l),
ll as (select doc_id, count_if(dup) as n_dup_lines, count_if(bad) as n_bad_lines, coalesce(sum(k) filter (bad), 0) as n_lost_words from j group by doc_id),
p as (select doc_id, unnest(w) as a, generate_subscripts(w, 1) as i from d),
t as (select doc_id, i, a, lead(a) over o as b, lead(a, 2) over o as c from p window o as (partition by doc_id order by i)),
r as (select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from t where c is not null),
q as (select doc_id, count(distinct i + s) as n_repeat_words from r, (values (0), (1), (2)) v(s) where n > 1 group by doc_id),
o as (select doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars, {symbols.format("text")}::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words, n_bad_lines::bigint as n_bad_lines, n_lost_words::bigint as n_lost_words
  from d join ll using (doc_id) left join q using (doc_id))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * n_lost_words <= 50 * n_words as kept from o"""


OP10 = r"""
with l as (select doc_id, i, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), E' \t\n\v\f\r') as k
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents)),
s as (select k, min(doc_id) as owner from l where length(k) >= 10 group by k having count(distinct doc_id) > 1),
f as (select l.*, coalesce(doc_id > owner, false) as gone from l left join s using (k))
select doc_id, count(*) as n_lines, count_if(gone)::bigint as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from f group by doc_id"""


OP2 = """
with recursive v as (select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
e as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v) where list_cosine_similarity(a.v, b.v) >= 0.98),
n as (select a as vec_id, count(*) as n from e group by a),
r(node, c) as (select vec_id, vec_id from embeddings union select e.b, r.c from r join e on r.node = e.a),
m as (select node as vec_id, min(c) as component_id from r group by node)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept from m left join n using (vec_id)"""


OP3 = rf"""
with w as (select doc_id, {WORDS.format("coalesce(text, '')")} as w from documents),
s as (select doc_id, unnest(range(1, len(w) - 33)) as i, w from w where len(w) >= 35),
h as (select doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) as x from s),
r as (select doc_id, i from h where x in (select x from h group by x having count(*) > 1)),
g as (select doc_id, list_distinct(flatten(list(range(i, i + 35)))) as gone from r group by doc_id),
p as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from w),
c as (select doc_id, unnest(gone) as i from g),
k as (select p.doc_id, p.i, word from p anti join c on p.doc_id = c.doc_id and p.i = c.i),
t as (select doc_id, string_agg(word, ' ' order by i) as kept from k group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(len(gone), 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join g using (doc_id) left join t using (doc_id)"""


OP5 = rf"""
with recursive w as (select doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents),
s as (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
  else list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) end) as x from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.x = b.x and a.doc_id <> b.doc_id group by all),
e as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
r(node, c) as (select doc_id, doc_id from documents union select e.b, r.c from r join e on r.node = e.a),
m as (select node as doc_id, min(c) as component_id from r group by node)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept from m left join n using (doc_id)"""


#: CRC-32 bit by bit, as DuckDB has no function for it; node keys are lists of turn digests.
OP12 = r"""
with t as (select conv_id, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) || '-' || length(coalesce(text, '')) as k, length(coalesce(text, '')) as n, row_number() over
  (partition by conv_id order by turn nulls first, coalesce(role, ''), substr(coalesce(text, ''), 1, 64), md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as p
  from conversations where conv_id is not null),
c as (select conv_id, conv_id - conv_id % 100 as root, xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))) % 6 as h from (select distinct conv_id from t)),
r as (select c.conv_id, p, k, n from c join t on t.conv_id = c.root and t.p < h
  union all select c.conv_id, p - h + (select count(*) from t x where x.conv_id = c.root and x.p < h), k, n from c join t on t.conv_id = c.conv_id and t.p >= h),
s as (select c.conv_id, coalesce(list(k order by p) filter (p is not null), []) as ks, coalesce(list(n order by p) filter (p is not null), []) as ns from c left join r using (conv_id) group by c.conv_id),
m as (select conv_id, d, md5(array_to_string(ks[1:d], ',')) as node, case when d > 0 then md5(array_to_string(ks[1:d - 1], ',')) end as up, coalesce(ns[d], 0) as n, d = len(ks) as ends
  from (select *, unnest(range(0, len(ks) + 1)) as d from s)),
g as (select node, d, up, min(conv_id) as conv_id, count(*) as n_convs, any_value(n) as n, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256 from m group by node, d, up),
k as (select up, d - 1 as d, count(*) as n from g where d > 0 group by all),
o as (select g.*, coalesce(k.n, 0) as n_children from g left join k on k.up = g.node and k.d = g.d),
z as (select m.node, m.d, count_if(n_children = 0) as n_leaves, sum((n_convs - 1) * o.n) as saved from o join m on m.conv_id = o.conv_id and m.d <= o.d group by all)
select o.conv_id, o.d::bigint as depth, p.conv_id as parent_conv_id, o.n_convs, o.n_children, n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, o.ends_sha256
from o join z on z.node = o.node and z.d = o.d left join o p on p.node = o.up and p.d = o.d - 1"""


#: Words carry their language, so that joins go by words alone.
OP13 = r"""
with d as (select coalesce(lang, 'und') as lang, string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?' || chr(11) || chr(12) || chr(13), 'abcdefghijklmnopqrstuvwxyz' || repeat(chr(10), 9)), chr(10)) as ps from documents),
w as (select lang, regexp_extract_all(unnest(ps), '[^\x20\x09]+') as w from d),
k as (select lang, list_transform(w, lambda x: x || chr(10) || lang) as w from w),
o as (select lang, unnest(w) as x, unnest(w[2:]) as y, unnest(w[3:]) as z from k),
g as (select lang, x, y, z, count(*) as f from o where x is not null group by all),
f1 as (select lang, x, sum(f)::bigint as f from g group by all),
f2 as (select lang, x, y, sum(f)::bigint as f from g where y is not null group by all),
f3 as (select lang, x, y, z, f from g where z is not null and f >= 10),
n as (select lang, sum(f)::bigint as n from f1 group by lang),
s2 as (select c.lang, concat_ws(' ', split_part(c.x, chr(10), 1), split_part(c.y, chr(10), 1)) as phrase, c.x as p, c.y as q, c.f as a, 1 as j, u.f as l, v.f as r from f2 c join f1 u on u.x = c.x join f1 v on v.x = c.y where c.f >= 10),
s3 as (select c.lang, concat_ws(' ', split_part(c.x, chr(10), 1), split_part(c.y, chr(10), 1), split_part(c.z, chr(10), 1)) as phrase, c.f as a, 1 as j, u.f as l, v.f as r from f3 c join f1 u on u.x = c.x join f2 v on v.x = c.y and v.y = c.z
  union all select c.lang, concat_ws(' ', split_part(c.x, chr(10), 1), split_part(c.y, chr(10), 1), split_part(c.z, chr(10), 1)), c.f, 2, u.f, v.f from f3 c join f2 u on u.x = c.x and u.y = c.y join f1 v on v.x = c.z),
m as (select lang, p, q, max(f) as f from (select lang, x as p, y as q, f from f3 union all select lang, y, z, f from f3) group by all),
s as (select lang, phrase, a, j, l, r from s3 union all select s2.lang, phrase, a, j, l, r from s2 left join m on m.p = s2.p and m.q = s2.q where m.f is null or 100 * m.f < 50 * a),
b as (select *, ((1000000::hugeint * a * a) // (l::hugeint * r))::bigint as score from s qualify row_number() over (partition by lang, phrase order by score, j) = 1)
select b.lang, row_number() over (partition by b.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from b join n on n.lang = b.lang qualify rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": op1(), "op2_embedding_dedup": OP2, "op3_substring_dedup": OP3, "op5_minhash_dedup": OP5, "op10_line_dedup": OP10, "op12_prefix_trie": OP12, "op13_collocations": OP13}
