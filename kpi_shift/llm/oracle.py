"""DuckDB SQL for the operators that SQL can express, over whole tables and texts, written the long way."""

from __future__ import annotations

from kpi_shift.llm.licenses import RULES, SENTENCES

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _plain_words(table: str, key: str) -> str:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"select {key}, regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), '{pattern}') as w from {table}"


CONTAMINATION = rf"""
with d as ({_plain_words("documents", "doc_id")}),
b as ({_plain_words("benchmark", "item_id")}),
item_windows as (
  select distinct item_id, n, array_to_string(w[i + 1 : i + n], ' ') as win
  from (select item_id, w, n, unnest(range(len(w) - n + 1)) as i from (select *, least(13, len(w)) as n from b) where n > 0)),
doc_windows as (
  select doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') as win
  from (select doc_id, w, n, unnest(range(len(w) - n + 1)) as i from d, (select distinct n from item_windows) where len(w) >= n)),
found as (select x.doc_id, x.i, x.n, y.item_id from doc_windows x join item_windows y on x.n = y.n and x.win = y.win),
hits as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(i, i + n)) as pos from found) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hits using (doc_id) left join items using (doc_id)"""

_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

NEAR_DUPLICATES = rf"""
with recursive d as (select doc_id, {_SPACED} as w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i + 1 : i + 5], ' ') as s
  from (select doc_id, w, unnest(range(greatest(1, len(w) - 4))) as i from d where len(w) > 0)),
sizes as (select doc_id, count(*) as n, md5(string_agg(s, '|' order by s)) as content from shingles group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as n from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select c.x, c.y, b.content, a.content as own from common c join sizes a on a.doc_id = c.x join sizes b on b.doc_id = c.y
  where c.n * 10 >= 8 * (a.n + b.n - c.n)),
reach as (select doc_id as x, doc_id as y from documents union select reach.x, links.y from reach join links on links.x = reach.y)
select r.doc_id, r.class_id, coalesce(l.n_links, 0) as n_links, coalesce(l.n_texts, 0) as n_texts
from (select x as doc_id, min(y) as class_id from reach group by x) r
left join (select x, count(*) as n_links, count(distinct case when content <> own then content end) as n_texts from links group by x) l
  on l.x = r.doc_id"""

REPEATS = rf"""
with d as (select doc_id, {_SPACED} as w from documents),
windows as (
  select doc_id, i, md5(array_to_string(w[i + 1 : i + 50], ' ')) as win
  from (select doc_id, w, unnest(range(len(w) - 49)) as i from d where len(w) >= 50)),
firsts as (select win, min(doc_id) as first_id from windows group by win),
gone as (
  select distinct doc_id, unnest(range(i, i + 50)) as pos from windows join firsts using (win) where first_id < doc_id),
words as (select doc_id, unnest(w) as word, unnest(range(len(w))) as pos from d),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by pos) as text
  from words anti join gone using (doc_id, pos) group by doc_id)
select d.doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from d left join kept using (doc_id)"""


_BLANKS = r"[\x20\x09-\x0D]"

LINES = rf"""
with cut as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
each_line as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as i from cut),
keyed as (
  select doc_id, i, line, translate(regexp_replace(line, '^{_BLANKS}+|{_BLANKS}+$', '', 'g'), '{_CAPITALS}', '{_SMALL}') as key
  from each_line),
shared as (select key, max(doc_id) as last_id from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
judged as (select k.doc_id, i, line, coalesce(k.doc_id < last_id, false) as gone from keyed k left join shared using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from judged group by doc_id"""

INFILL = r"""
with d as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as units,
    sha256('7:' || cast(doc_id as varchar)) as h from documents),
drawn as (
  select *, len(units) as n, [('0x' || substr(h, 8 * k + 1, 8))::ubigint for k in range(4)] as x,
    t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') as plain from d),
cut as (
  select *, least(x[1] % (n + 1), x[2] % (n + 1)) as low, greatest(x[1] % (n + 1), x[2] % (n + 1)) as high,
    case when plain then 'plain' when x[4] % 100 < 50 then 'spm' else 'psm' end as form from drawn),
parts as (
  select doc_id, t, n, form, array_to_string(units[1 : low], '') as p, array_to_string(units[low + 1 : high], '') as m,
    array_to_string(units[high + 1 :], '') as s from cut),
made as (
  select *, case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end as made from parts),
read as (select *, instr(made, '<P>') as at_p, instr(made, '<S>') as at_s, instr(made, '<M>') as at_m from made)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars,
  case when form <> 'plain' then length(m) end as middle_chars, sha256(made) as output_sha256,
  sha256(case form when 'plain' then made
    when 'psm' then substr(made, 4, at_s - 4) || substr(made, at_m + 3) || substr(made, at_s + 3, at_m - at_s - 3)
    else substr(made, at_p + 3, at_m - at_p - 3) || substr(made, at_m + 3) || substr(made, 4, at_p - 4) end) as restored_sha256
from read"""

SPELLING = rf"""
with recursive crc as (
  select list(v order by i) as entries from (
    select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, x: case when v % 2 = 1 then xor(v >> 1, 3988292384) else v >> 1 end) as v
    from (select unnest(range(256)) as i))),
runs as (
  select doc_id, run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), '[a-z\x{{00C0}}-\x{{00FF}}]+')) as run
    from documents) where length(run) >= 5 group by all),
named as (
  select run, n, flatten(list_transform(string_split(cast(doc_id as varchar) || ':' || run, ''), lambda c:
    case when unicode(c) < 128 then [cast(unicode(c) as bigint)] else [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] end)) as bytes from runs),
hashed as (
  select run, n, xor(4294967295, list_reduce(list_concat([4294967295], bytes),
    lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]))) as h from named, crc),
words as (
  select word, cast(sum(n) as bigint) as n from (
    select n, case when h % 97 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from hashed)
  where length(word) >= 5 group by word having sum(n) >= 3),
less as (
  select word, i, left(word, i - 1) || substr(word, i + 1) as rest from (select word, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select l.word as a, w.word as b from less l join words w on l.rest = w.word
  union select w.word, l.word from less l join words w on l.rest = w.word
  union select x.word, y.word from less x join less y on x.i = y.i and x.rest = y.rest and x.word <> y.word),
best as (
  select a, count(*) as n_near, max(n) as most, arg_min(b, (-n, b)) as b from near join words on word = b group by a),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when most >= 2 * w.n then b end as form, case when most >= 2 * w.n then most end as form_n
  from words w left join best on a = w.word),
steps as (
  select word as start, word as at_word from forms
  union select s.start, f.form from steps s join forms f on f.word = s.at_word where f.form is not null)
select f.word, f.form, r.at_word as root, f.n, f.n_near, f.form_n
from forms f join steps r on r.start = f.word join forms e on e.word = r.at_word where e.form is null"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _reading(name: str, gap: str) -> str:
    """Common table expressions: sentences of one reading with their identifiers, and what each rule finds."""
    kept = rf"regexp_replace(text, 'spdx-license-identifier\s*:\s*([a-z0-9.+-]+)', chr(1) || 'spdx license identifier \1' || chr(1), 'gi')"
    kept = rf"regexp_replace({kept}, '\bv\.[ \t\n\r]+([0-9])', 'v.\1', 'gi')"
    cut = rf"regexp_replace(regexp_replace({kept}, '{gap}', chr(1), 'g'), '([.!?:])\s+', '\1' || chr(1), 'g')"
    words = r"regexp_replace(regexp_replace(lower(raw), '[^\p{L}\p{N}.,+]+', ' ', 'g'), ' +([.,])', '\1', 'g')"
    cases = []
    for identifier, pattern in SENTENCES:
        value = f"'<{identifier}>'"
        if "(\\d\\.\\d)" in pattern or identifier == "spdx":
            value = f"'<{identifier} ' || replace(trim(regexp_extract(s, {_text(f'^(?:{pattern})$')}, 1)), ' ', '-') || '>'"
        cases.append(f"when regexp_full_match(s, {_text(pattern)}) then {value}")
    steps = [
        f"{name}_cut as (select doc_id, string_split({cut}, chr(1)) as parts from texts)",
        f"{name}_raw as (select doc_id, unnest(parts) as raw, generate_subscripts(parts, 1) as i from {name}_cut)",
        rf"{name}_s as (select doc_id, i, regexp_replace({words}, '^[ .,]+|[ .,]+$', '', 'g') as s from {name}_raw)",
        f"{name}_told as (select doc_id, i, case {' '.join(cases)} end as id from {name}_s where s <> '')",
        f"{name}_0 as (select doc_id, string_agg(id, '' order by i) as rest, count(*) as n from {name}_told where id is not null group by doc_id)",
    ]
    for k, (licence, pattern) in enumerate(RULES):
        prefix, group = (licence.removesuffix("$1"), 1) if licence.endswith("$1") else (licence, 0)
        found = f"unnest(regexp_extract_all(rest, {_text(pattern)}, {group}))"
        value = f"{_text(prefix)} || v" if group else _text(prefix)
        steps.append(f"{name}_hit{k} as (select doc_id, {value} as licence from (select doc_id, {found} as v from {name}_{k}))")
        steps.append(f"{name}_{k + 1} as (select doc_id, regexp_replace(rest, {_text(pattern)}, '|', 'g') as rest from {name}_{k})")
    return ",\n".join(steps)


def license_scan() -> str:
    hits = " union ".join(f"select doc_id, licence from {r}_hit{k}" for r in ("line", "across") for k in range(len(RULES)))
    return rf"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
{_reading("line", r"\s*\n\s*")},
{_reading("across", r"\n\s*\n\s*")},
found as (select doc_id, string_agg(licence, ',' order by licence) as licenses from ({hits}) group by doc_id)
select d.doc_id, coalesce(f.licenses, '') as licenses,
  case when coalesce(a.n, 0) > coalesce(l.n, 0) then a.rest else coalesce(l.rest, '') end as sentence_ids
from documents d left join found f using (doc_id) left join line_0 l using (doc_id) left join across_0 a using (doc_id)"""


ORACLE = {
    "op8_license_scan": license_scan(),
    "op6_decontamination": CONTAMINATION,
    "op7_ngram_jaccard_join": NEAR_DUPLICATES,
    "op9_substring_dedup": REPEATS,
    "op11_line_dedup": LINES,
    "op12_fill_in_middle": INFILL,
    "op13_spelling_variants": SPELLING,
}
