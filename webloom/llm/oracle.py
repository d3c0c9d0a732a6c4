"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_FOLD = "replace(strip_accents(lower(text)), 'ς', 'σ')"
_BLANKS = "\\s\\x{85}\\x{A0}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
_GAP, _NO_GAP = f"[{_BLANKS}]", f"[^{_BLANKS}]"
_FOLDED = f"regexp_replace({_FOLD}, '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_WORDS = f"""list_filter(list_transform(regexp_split_to_array({_FOLD}, '[\\s\\x{{85}}\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+'), lambda w: regexp_replace(w, '[^\\p{{L}}\\p{{N}}]+', '', 'g')), lambda w: w <> '')"""

_SITE_LINES = r"""
l as (select doc_id, url_host_registered_domain as site, unnest(string_split(text, chr(10))) as line, unnest(range(1, len(string_split(text, chr(10))) + 1)) as line_no from documents),
n as (select doc_id, site, line_no, line, trim(regexp_replace(regexp_replace(replace(strip_accents(lower(line)), 'ς', 'σ'), '[\s\x{85}\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'), '\p{Nd}+', '0', 'g')) as norm
      from l where len(regexp_replace(line, '[^\p{L}]+', '', 'g')) >= 10 and site is not null),
f as (select site, norm, count(distinct doc_id) as n_documents, count(*) as n_lines, arg_min(line, doc_id * 1000000 + line_no) as line from n group by site, norm having count(distinct doc_id) >= 5)"""
_REPEATS = f"""
w as (select doc_id, _WORDS_ as ws from documents),
t as (select doc_id, len(ws) as n, unnest(range(1, len(ws) - 3)) as i, ws from w where len(ws) >= 5),
g as (select doc_id, n, i, array_to_string(ws[i:i+4], ' ') as gram from t),
r as (select doc_id, n, i from (select *, row_number() over (partition by doc_id, gram order by i) as k from g) where k > 1),
c as (select distinct doc_id, n, i + j as at from r, (select unnest(range(5)) as j)),
s as (select doc_id, n, count(*) as again from c group by doc_id, n)""".replace("_WORDS_", _WORDS)
_LEAKS = f"""
b as (select item_id, {_WORDS} as ws from benchmark),
bg as (select item_id, i, array_to_string(ws[i:i+11], ' ') as gram from (select item_id, ws, unnest(range(1, len(ws) - 10)) as i from b where len(ws) >= 12)),
d as (select doc_id, text, {_WORDS} as ws from documents),
dg as (select doc_id, i, array_to_string(ws[i:i+11], ' ') as gram from (select doc_id, ws, unnest(range(1, len(ws) - 10)) as i from d where len(ws) >= 12)),
hit as (select distinct doc_id, item_id, dg.i, dg.i - bg.i as shift from dg join bg using (gram)),
span as (select doc_id, item_id, min(i) as first, count(*) + 11 as n_words from (select *, i - row_number() over (partition by doc_id, item_id, shift order by i) as run from hit) group by doc_id, item_id, shift, run)"""

#: Lines with their words, and the sentence ends of each: a run of ending signs before white space, a closing sign or the
#: end of the line, unless it stands after white space or dots only.
_LEVELS = f"""
l as (select doc_id, unnest(string_split(text, chr(10))) as text from documents where text is not null),
m as (select doc_id, text, {_WORDS} as ws, regexp_extract_all(text, '[.!?;…]+|[^.!?;…]+') as parts from l),
k as (select doc_id, ws, len(list_filter(range(1, len(parts) + 1), lambda i: regexp_matches(parts[i], '^[.!?;…]') and (i = len(parts) or regexp_matches(parts[i + 1], '^[{_BLANKS}"''»”)]')) and (i = 1 or not regexp_matches(parts[i - 1], '[{_BLANKS}]$') or regexp_matches(parts[i], '[!?;…].')))) as ends,
      not regexp_matches(text, '[.!?;…»”"'')][{_BLANKS}]*$') as open from m),
s as (select doc_id, flatten(list(ws) filter (ends > 0 and len(ws) >= 5)) as ws, coalesce(sum(ends + open::int) filter (ends > 0 and len(ws) >= 5), 0) as n, flatten(list(ws)) as all_ws, count(*) filter (len(ws) > 0) as all_n from k group by doc_id),
f as materialized (select doc_id, case when n > 0 then ws else all_ws end as ws, case when n > 0 then n else all_n end as n from s),
top as materialized (select word from (select doc_id, unnest(list_distinct(ws)) as word from f) group by word order by count(*) desc, word limit 1000),
u as (select doc_id, count(*) as n_words, count(*) filter (top.word is null) as odd from (select doc_id, unnest(ws) as word from f) w left join top on top.word = w.word group by doc_id),
g as materialized (select d.doc_id, coalesce(n_words, 0) as n_words, case when n_words > 0 then n else 0 end::bigint as n_sentences, coalesce(1 - (n_words - odd) / n_words, 0)::double as odd, coalesce(n_words / n, 0)::double as size from documents d left join f using (doc_id) left join u using (doc_id)),
x as (select odd as a, ln(greatest(size, 1)) as b, reading_grade::double as y from g join labels using (doc_id) where n_words > 0 and reading_grade is not null),
e as (select count(*)::double as n, sum(a) as a, sum(b) as b, sum(a * a) as aa, sum(a * b) as ab, sum(b * b) as bb, sum(y) as y, sum(a * y) as ya, sum(b * y) as yb from x),
r as (select n * (1 + 1e-6) as n, a, b, aa + 1e-6 * n as aa, ab, bb + 1e-6 * n as bb, y, ya, yb from e),
q as (select case when n < 30 then -4.2 else (y * (aa * bb - ab * ab) - a * (ya * bb - ab * yb) + b * (ya * ab - aa * yb)) / d end as w0, case when n < 30 then 1.5 else (n * (ya * bb - ab * yb) - y * (a * bb - ab * b) + b * (a * yb - ya * b)) / d end as w1,
      case when n < 30 then 4.1 else (n * (aa * yb - ya * ab) - a * (a * yb - ya * b) + y * (a * ab - aa * b)) / d end as w2 from (select *, n * (aa * bb - ab * ab) - a * (a * bb - ab * b) + b * (a * ab - aa * b) as d from r))"""

SQL = {
    "p10_levels": f"with {_LEVELS} select doc_id, n_words, n_sentences, round(odd, 6) as unfamiliar_share, round(size, 6) as words_per_sentence, case when n_words > 0 then round(least(greatest(w0 + w1 * odd + w2 * ln(greatest(size, 1)), 0), 16), 3) end as level from g, q",
    "p3_found": f"with {_REPEATS} select doc_id from s where 3 * again >= n",
    "p3_shares": f"with {_REPEATS} select w.doc_id, len(ws)::bigint as n_words, round(coalesce(again / len(ws), 0)::double, 6) as repeated_share from w left join s on s.doc_id = w.doc_id",
    "p4_found": f"with {_SITE_LINES} select doc_id, line_no from n semi join f using (site, norm)",
    "p4_lines": f"with {_SITE_LINES} select site as url_host_registered_domain, line, n_documents, n_lines, round(n_documents / size, 6) as document_share from f join (select url_host_registered_domain as site, count(text) as size from documents group by 1) using (site)",
    "p4_cleaned": f"with {_SITE_LINES}, gone as (select doc_id, line_no from n semi join f using (site, norm)), kept as (select l.doc_id, string_agg(line, chr(10) order by l.line_no) filter (g.doc_id is null) as text, count(g.doc_id) as n_removed from l left join gone g on l.doc_id = g.doc_id and l.line_no = g.line_no group by l.doc_id) select d.doc_id, coalesce(n_removed, 0) as n_removed, case when d.text is not null then coalesce(k.text, '') end as text from documents d left join kept k on d.doc_id = k.doc_id",
    "p8_found": f"with {_LEAKS} select distinct doc_id, item_id from span",
    "p8_items": f"with {_LEAKS} select item_id, count(distinct doc_id) as n_documents, max(n_words) as longest_words from span group by item_id",
    # The text is cut into words and what stands between them; words of a span go, and all that stands inside it.
    "p8_cleaned": f"""with {_LEAKS},
u as (select doc_id, list(distinct {{a: first, n: n_words}}) as spans from span group by doc_id),
p as (select d.doc_id, d.text, spans, regexp_extract_all(d.text, '{_GAP}+|{_NO_GAP}+') as parts from d join u using (doc_id)),
q as (select doc_id, spans, k, parts[k] as part, {_FOLDED.replace('text', 'parts[k]')} as word from (select doc_id, spans, parts, unnest(range(1, len(parts) + 1)) as k from p)),
o as (select *, sum(case when not regexp_full_match(part, '{_GAP}+') and word <> '' then 1 else 0 end) over (partition by doc_id order by k) as pos, not regexp_full_match(part, '{_GAP}+') and word <> '' as is_word from q),
e as (select doc_id, k, is_word, len(list_filter(spans, lambda s: pos >= s.a and pos < s.a + s.n - case when is_word then 0 else 1 end)) > 0 as inside, len(list_filter(spans, lambda s: pos = s.a and is_word)) > 0 as opens, len(list_filter(spans, lambda s: pos = s.a + s.n - 1 and is_word)) > 0 as closes, len(list_filter(spans, lambda s: pos > s.a and pos < s.a + s.n - 1 and is_word)) > 0 as middle, part from o),
x as (select doc_id, string_agg(case when not inside then part when not is_word then '' when middle then '' when opens and closes then regexp_extract(part, '^[^\\p{{L}}\\p{{N}}]*') || regexp_extract(part, '[^\\p{{L}}\\p{{N}}]*$') when opens then regexp_extract(part, '^[^\\p{{L}}\\p{{N}}]*') when closes then regexp_extract(part, '[^\\p{{L}}\\p{{N}}]*$') else '' end, '' order by k) as text from e group by doc_id)
select d.doc_id, coalesce(len(spans), 0)::bigint as n_spans, case when spans is null then d.text else x.text end as text from d left join u using (doc_id) left join x using (doc_id)""",
    "p10_profile": f"with {_LEVELS}, v as (select doc_id, case when n_words > 0 then round(least(greatest(w0 + w1 * odd + w2 * ln(greatest(size, 1)), 0), 16), 3) end as level from g, q) select source, n_documents, round(mean, 3) as mean_level, qs[1] as quartile_1, qs[2] as quartile_2, qs[3] as quartile_3 from (select lower(trim(source)) as source, count(*) as n_documents, avg(level) as mean, quantile_disc(level, [0.25, 0.5, 0.75]) as qs from v join documents using (doc_id) group by 1)",
}
