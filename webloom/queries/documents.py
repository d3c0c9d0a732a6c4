"""Queries of the document side: addresses, page text, language, repetition, quality, formatters, dedup, pipeline."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions.text import TOKEN, is_word, rounded, tokens
from webloom.operators import cleanup, html, language, minhash, quality, repetition, url
from webloom.plans import pipeline
from webloom.plans.profile import GREEK
from webloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
#: Example block lists for the address queries.
LISTS = replace(GREEK, blocked_domains=("pylikon.example",), blocked_hosts=("m.taralorape.example",), hard_words=("amp",), soft_words=("forum", "proionta", "html", "blog", "id"), banned_parts=("kalikri", "exampleblog"))


def docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents", spread=True)


def _verdicts(s: SparkSession, d: str) -> DataFrame:
    return docs(s, d).select("doc_id", url.host(F.col("url")).alias("host"), url.verdict(F.col("url"), F.col("url_host_registered_domain"), LISTS).alias("verdict"))


def _tokens(s: SparkSession, d: str) -> DataFrame:
    t = docs(s, d).select("doc_id", tokens(F.col("text")).alias("t"))
    return t.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.size(F.filter("t", is_word)).cast("bigint").alias("n_words"), F.md5(F.array_join("t", " ")).alias("digest"))


def _best(s: SparkSession, d: str) -> DataFrame:
    return language.scores(docs(s, d).select("doc_id", "text"))


def _grams(s: SparkSession, d: str, *names: str) -> DataFrame:
    return repetition.ngram_fractions(docs(s, d).select("doc_id", "text")).select("doc_id", *names).withColumns(rounded(*names))


def _judged(s: SparkSession, d: str) -> DataFrame:
    return quality.judged(docs(s, d).select("doc_id", "text"), n_grams=False, by_language=False).select("doc_id", "reason")


def _labels(s: SparkSession, d: str) -> DataFrame:
    """Pass rate of the quality filters by human quality mark (means of two marks are rounded down)."""
    marks = table(s, d, "labels").where("quality is not null").groupBy("doc_id").agg(F.floor(F.avg("quality")).alias("quality"))
    return _judged(s, d).join(marks, "doc_id").groupBy("quality").agg(F.count(F.lit(1)).alias("n_documents"), F.sum(F.col("reason").isNull().cast("bigint")).alias("n_passed"))


def _lists(s: SparkSession) -> dict[str, DataFrame]:
    """The example block lists as tables."""
    lists = {"domain": LISTS.blocked_domains, "host": LISTS.blocked_hosts}
    return {k: s.createDataFrame([(x,) for x in v], "entry string") for k, v in lists.items()}


def _by_tables(s: SparkSession, d: str) -> DataFrame:
    own = docs(s, d).select("doc_id", "url", "url_host_registered_domain")
    words_only = replace(LISTS, blocked_domains=(), blocked_hosts=())
    return url.banned(own, _lists(s), words_only).select("doc_id", url.host(F.col("url")).alias("host"), F.col("ban").alias("verdict"))


def _restored(s: SparkSession, d: str) -> DataFrame:
    """Texts that the formatter's undoing of wrongly read UTF-8 changes."""
    own = docs(s, d).select("doc_id", "text").withColumn("before", F.col("text"))
    return cleanup.repaired(own).where(F.col("text") != F.col("before")).select("doc_id", "text")


LINE_SHARES = ("terminal_frac", "short_frac", "char_dup_frac", "new_line_ratio")
WORD_SHARES = ("avg_word_length", "alpha_ratio", "hash_ratio", "ellipsis_ratio", "bullet_frac", "ellipsis_frac")
PIECE_SHARES = ("dup_line_frac", "dup_line_char_frac", "dup_para_frac", "dup_para_char_frac")


def _signed(s: SparkSession, d: str) -> DataFrame:
    return minhash.signatures(docs(s, d)).select("doc_id", F.md5(F.array_join("signature", ",")).alias("digest"), F.col("signature")[0].alias("first"), F.col("signature")[111].alias("last"))


def _banded(s: SparkSession, d: str) -> DataFrame:
    return minhash.bands(minhash.signatures(docs(s, d)))


def _kept(s: SparkSession, d: str) -> DataFrame:
    own = docs(s, d)
    return minhash.keep_one(own, minhash.clusters(own, portable=True, least=None))


def _removed(s: SparkSession, d: str) -> DataFrame:
    return minhash.removed(docs(s, d), _kept(s, d)).select("doc_id")


QUERIES: dict[str, Query] = {
    "url_filter": _verdicts,
    "html_extract_text": lambda s, d: table(s, d, "pages").select("page_id", html.plain_text(F.col("html")).alias("text")),
    "html_extract_density": lambda s, d: html.density(table(s, d, "pages", spread=True)),
    "url_filter_tables": _by_tables,
    "tokens_words": _tokens,
    "lang_score": lambda s, d: _best(s, d).select("doc_id", "language", "language_score").withColumns(rounded("language_score")),
    "lang_script": lambda s, d: _best(s, d).select("doc_id", "language_script"),
    "lang_threshold": lambda s, d: language.above_threshold(_best(s, d)).select("doc_id", "language_score").withColumns(rounded("language_score")),
    "lang_top_pairs": lambda s, d: language.top_pairs(_best(s, d)).withColumns(rounded("score")),
    "rep_lines_paragraphs": lambda s, d: repetition.repeated_pieces(docs(s, d)).withColumns(rounded(*PIECE_SHARES)),
    "rep_top_ngrams": lambda s, d: _grams(s, d, "top_2", "top_3", "top_4"),
    "rep_dup_ngrams": lambda s, d: _grams(s, d, *[f"dup_{n}" for n in range(5, 11)]),
    "qual_lines": lambda s, d: quality.line_measures(docs(s, d).select("doc_id", "text")).drop("text").withColumns(rounded(*LINE_SHARES)),
    "qual_words": lambda s, d: quality.word_measures(docs(s, d).select("doc_id", "text")).drop("text").withColumns(rounded(*WORD_SHARES)),
    "quality_first_reason": _judged,
    "quality_against_labels": _labels,
    "repair_text": lambda s, d: cleanup.repaired(table(s, d, "pages", spread=True).select("page_id", F.col("html").alias("text")), encoding=False),
    "repair_encoding": _restored,
    "redact_addresses": lambda s, d: docs(s, d).select("doc_id", cleanup.redact_addresses(F.col("text")).alias("text")),
    "symbol_lines": lambda s, d: docs(s, d).select("doc_id", cleanup.symbol_lines(F.regexp_replace("text", ":: ", "\n|\n||\n")).alias("text")),
    "exact_dedup_docs": lambda s, d: minhash.exact_clusters(docs(s, d)),
    "minhash_signature": _signed,
    "minhash_bands": _banded,
    "minhash_pairs": lambda s, d: minhash.pairs(_banded(s, d)),
    "minhash_clusters": lambda s, d: minhash.clusters(docs(s, d), portable=True, least=None),
    "minhash_dedup": _kept,
    "minhash_removed": _removed,
    "minhash_similar": lambda s, d: minhash.clusters(docs(s, d), portable=True),
    "pipeline_reasons": lambda s, d: pipeline.reasons(docs(s, d)),
    "pipeline_reasons_no_ngrams": lambda s, d: pipeline.reasons(docs(s, d), LISTS, n_grams=False),
    "pipeline_stage1": lambda s, d: pipeline.stage_one(docs(s, d)).select("doc_id", "text"),
    "pipeline_full": lambda s, d: pipeline.full(docs(s, d)),
}


def _lit(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _list(xs: tuple[str, ...]) -> str:
    return "[" + ", ".join(map(_lit, xs)) + "]"


def _ratio(a: str, b: str) -> str:
    return f"(case when {b} > 0 then ({a})::double / ({b}) else 0 end)::double"


def _rounded(sql: str, names: tuple[str, ...]) -> str:
    return f"select * replace ({', '.join(f'round({n}, 6) as {n}' for n in names)}) from ({sql})"


TOK = f"regexp_extract_all(text, {_lit(TOKEN)})"
WORDS = f"list_filter({TOK}, lambda w: regexp_matches(w, '^[\\p{{L}}\\p{{N}}_]'))"
SHOWN = "list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\r\\f]'))"
HOST = "lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1))"
URL_WORDS = "list_filter(regexp_split_to_array(lower(url), '[^a-z0-9]+'), lambda w: w <> '')"
VERDICT = f"""case when url_host_registered_domain in ({', '.join(map(_lit, LISTS.blocked_domains))}) then 'domain' when {HOST} in ({', '.join(map(_lit, LISTS.blocked_hosts))}) then 'host'
 when list_has_any({URL_WORDS}, {_list(LISTS.hard_words)}) then 'hard_word' when len(list_intersect(list_distinct({URL_WORDS}), {_list(LISTS.soft_words)})) >= {LISTS.soft_limit} then 'soft_words'
 when regexp_matches(regexp_replace(lower(url), '[^a-z0-9]+', '', 'g'), {_lit('|'.join(LISTS.banned_parts))}) then 'part' end"""
NAMES = sorted(GREEK.profiles)
_folded = {n: tuple(w.replace("ς", "σ") for w in GREEK.profiles[n]) for n in NAMES}
COUNTS = ", ".join(f"len(list_filter(w, lambda x: list_contains({_list(_folded[n])}, x)))::bigint as n_{n}" for n in NAMES)
LANG = f"""with w as (select doc_id, list_transform({WORDS}, lambda x: replace(lower(x), 'ς', 'σ')) as w from documents), n as (select doc_id, {COUNTS} from w),
t as (select *, {' + '.join(f'n_{n}' for n in NAMES)} as total from n), s as (select doc_id, {', '.join(f'{_ratio(f"n_{n}", "total")} as s_{n}' for n in NAMES)} from t),
g as (select *, greatest({', '.join(f's_{n}' for n in NAMES)}) as top from s),
lang as (select doc_id, case when top = 0 then 'und' {' '.join(f"when s_{n} = top then '{n}'" for n in NAMES)} end as language, top as language_score from g)"""


def _dups(pattern: str) -> str:
    return f"list_filter(regexp_split_to_array(text, '{pattern}'), lambda x: x <> '')"


def _chars(a: str) -> str:
    return f"coalesce(list_sum(list_transform({a}, lambda x: length(x))), 0)::bigint"


PIECES = f"""select doc_id, {_ratio('len(l) - len(list_distinct(l))', 'len(l)')} as dup_line_frac, {_ratio(f"{_chars('l')} - {_chars('list_distinct(l)')}", 'length(text)')} as dup_line_char_frac,
{_ratio('len(p) - len(list_distinct(p))', 'len(p)')} as dup_para_frac, {_ratio(f"{_chars('p')} - {_chars('list_distinct(p)')}", 'length(text)')} as dup_para_char_frac
from (select doc_id, text, {_dups(chr(92) + 'n+')} as l, {_dups(chr(92) + 'n{2,}')} as p from documents)"""
_VISIBLE = "' ' || chr(9) || chr(12) || chr(13)"
LINES = f"""select doc_id, len(l)::bigint as n_lines, {_ratio(f"len(list_filter(l, lambda x: right(rtrim(x, {_VISIBLE}), 1) in ('.', '!', '?', '…', ';', ':', chr(34), '»')))", 'len(l)')} as terminal_frac,
{_ratio('len(list_filter(l, lambda x: length(x) <= 30))', 'len(l)')} as short_frac, {_ratio(f"{_chars('l')} - {_chars('list_distinct(l)')}", "length(replace(text, chr(10), ''))")} as char_dup_frac,
{_ratio("length(text) - length(replace(text, chr(10), ''))", 'n_words')} as new_line_ratio from (select doc_id, text, {SHOWN} as l, len({WORDS}) as n_words from documents)"""
QWORDS = f"""select doc_id, len(w)::bigint as n_words, {_ratio(_chars('w'), 'len(w)')} as avg_word_length, {_ratio("len(list_filter(t, lambda x: regexp_matches(x, '\\p{L}')))", 'len(t)')} as alpha_ratio,
{_ratio("length(text) - length(replace(text, '#', ''))", 'len(w)')} as hash_ratio, {_ratio("len(regexp_extract_all(text, '[.]{3}|…'))", 'len(w)')} as ellipsis_ratio,
len(list_intersect(list_distinct(w), {_list(GREEK.stop_words)}))::bigint as n_stop_words, {_ratio("len(list_filter(l, lambda x: left(ltrim(x, ' ' || chr(9)), 1) in ('•', '‣', '▪', '◦', '●', '→', '*', '-')))", 'len(l)')} as bullet_frac,
{_ratio(f"len(list_filter(l, lambda x: ends_with(rtrim(x, {_VISIBLE}), '...') or ends_with(rtrim(x, {_VISIBLE}), '…')))", 'len(l)')} as ellipsis_frac from (select doc_id, text, {TOK} as t, {WORDS} as w, {SHOWN} as l from documents)"""
REASON = f"""select l.doc_id, case when dup_line_frac > {GREEK.dup_line_frac} then 'dup_line_frac' when n_lines = 0 then 'empty' when terminal_frac < {GREEK.line_punct} then 'line_punct'
when short_frac > {GREEK.short_line_frac} then 'short_lines' when char_dup_frac > {GREEK.char_dup} then 'char_dup' when new_line_ratio > {GREEK.new_line_ratio} then 'new_lines' when n_words < {GREEK.min_words} then 'few_words'
when n_words > {GREEK.max_words} then 'many_words' when not avg_word_length between {GREEK.min_avg_word_length} and {GREEK.max_avg_word_length} then 'word_length' when hash_ratio > {GREEK.max_symbol_ratio} then 'hashes'
when ellipsis_ratio > {GREEK.max_symbol_ratio} then 'ellipses' when bullet_frac > {GREEK.max_bullet_frac} then 'bullets' when ellipsis_frac > {GREEK.max_ellipsis_frac} then 'ellipsis_lines'
when alpha_ratio < {GREEK.min_alpha_ratio} then 'alpha' when n_stop_words < {GREEK.min_stop_words} then 'stop_words' end as reason
from ({PIECES}) p join ({LINES}) l using (doc_id) join ({QWORDS}) w using (doc_id)"""


def _top(n: int) -> str:
    """The most frequent n-gram, the first in the text of equals: its characters times its count."""
    gram = f"array_to_string(w[i:i+{n - 1}], ' ')"
    return f"""select doc_id, max_by(length(gram) * c, c * 10000000 - first) as chars from (select doc_id, gram, count(*) as c, min(i) as first from (select doc_id, i, {gram} as gram from
(select doc_id, w, unnest(range(1, len(w) - {n - 2})) as i from tok where len(w) >= {n})) group by doc_id, gram) group by doc_id"""


def _dup(n: int) -> str:
    """The greedy scan over the n-grams that occur more than once: one is remembered where it is met first, skipped over after that."""
    return f"""select doc_id, (list_reduce(list_prepend({{pos: 0::bigint, gram: ''::varchar, size: 0::bigint, known: []::varchar[], free: 0::bigint, total: 0::bigint}}, l), lambda a, x:
case when x.pos < a.free then a when list_contains(a.known, x.gram) then {{pos: x.pos, gram: x.gram, size: x.size, known: a.known, free: x.pos + {n}, total: a.total + x.size}}
else {{pos: x.pos, gram: x.gram, size: x.size, known: list_append(a.known, x.gram), free: a.free, total: a.total}} end)).total as chars
from (select doc_id, list({{pos: i, gram: gram, size: size, known: []::varchar[], free: 0::bigint, total: 0::bigint}} order by i) as l from
(select doc_id, i::bigint as i, md5(array_to_string(g, chr(1))) as gram, length(array_to_string(g, ''))::bigint as size, count(*) over (partition by doc_id, array_to_string(g, chr(1))) as c from (select doc_id, i, w[i:i+{n - 1}] as g from (select doc_id, w, unnest(range(1, len(w) - {n - 2})) as i from tok where len(w) >= {n})))
where c > 1 group by doc_id)"""


GRAMS = [*(("top", n) for n in (2, 3, 4)), *(("dup", n) for n in range(5, 11))]


def _gram_tables(which: list[tuple[str, int]]) -> str:
    """Tables of a WITH clause: tok, one a measure, and gram with all shares of each document."""
    each = ", ".join(f"{k}{n} as materialized ({_top(n) if k == 'top' else _dup(n)})" for k, n in which)
    shares = ", ".join(f"{_ratio(f'coalesce({k}{n}.chars, 0)', 'length(text)')} as {k}_{n}" for k, n in which)
    return f"tok as materialized (select doc_id, {TOK} as w from documents), {each}, gram as (select d.doc_id, {shares} from documents d {' '.join(f'left join {k}{n} on d.doc_id = {k}{n}.doc_id' for k, n in which)})"


def _gram_query(which: list[tuple[str, int]]) -> str:
    return f"with {_gram_tables(which)} {_rounded('select * from gram', tuple(f'{k}_{n}' for k, n in which))}"


_GRAM_LIMITS = {**{("top", n): x for n, x in GREEK.top_n_grams}, **{("dup", n): x for n, x in GREEK.dup_n_grams}}
GRAM_REASON = "case " + " ".join(f"when {k}_{n} > {x} then '{k}_{n}_gram'" for (k, n), x in _GRAM_LIMITS.items()) + " end"

_AB = minhash.permutations()
_PLAIN = f"regexp_replace(translate(lower(text), 'άέήίϊΐόύϋΰώς', 'αεηιιιουυυωσ'), '\\p{{Nd}}+', '0', 'g')"
SIG = f"""w as materialized (select doc_id, regexp_extract_all({_PLAIN}, '[\\p{{L}}\\p{{N}}]+') as w from documents),
h as materialized (select doc_id, ('0x' || md5(g)[1:7])::bigint as h from (select distinct doc_id, array_to_string(w[i:i+4], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from w where len(w) >= 5))),
sig as materialized (select doc_id, [{', '.join(f'min(({a} * h + {b}) % {minhash.PRIME})' for a, b in _AB)}] as signature from h group by doc_id)"""
BANDS = f"{SIG}, band as materialized (select doc_id, k::int as band, md5(array_to_string(signature[k*8+1:k*8+8], ',')) as bucket from (select doc_id, signature, unnest(range(0, 14)) as k from sig))"
PAIRS = f"{BANDS}, pair as materialized (select distinct u, doc_id as v from band join (select band, bucket, min(doc_id) as u from band group by all having count(*) > 1) using (band, bucket) where doc_id > u)"
_COMPONENTS = ", edge as (select u, v from pair union select v, u from pair), reach(doc_id, other) as (select u, u from edge union select r.doc_id, e.v from reach r join edge e on r.other = e.u), comp as materialized (select doc_id, min(other) as cluster_id from reach group by doc_id), clus as materialized (select d.doc_id, coalesce(c.cluster_id, d.doc_id) as cluster_id, count(*) over (partition by coalesce(c.cluster_id, d.doc_id)) as cluster_size from documents d left join comp c on d.doc_id = c.doc_id)"
CLUSTERS = PAIRS + _COMPONENTS
#: All pairs of a bucket, with the shingles they share counted one by one.
SIMILAR = f"""{BANDS}, cand as (select distinct a.doc_id as u, b.doc_id as v from band a join band b on a.band = b.band and a.bucket = b.bucket and a.doc_id < b.doc_id),
sh as materialized (select distinct doc_id, array_to_string(w[i:i+4], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from w where len(w) >= 5)), size as (select doc_id, count(*) as n from sh group by doc_id),
met as (select u, v, count(*) as n from cand join sh a on a.doc_id = u join sh b on b.doc_id = v and a.g = b.g group by u, v), pair as materialized (select u, v from met join size a on a.doc_id = u join size b on b.doc_id = v where met.n * 10 >= 8 * (a.n + b.n - met.n)){_COMPONENTS}"""
KEPT = "select doc_id, cluster_id, cluster_size from (select doc_id, cluster_id, cluster_size, row_number() over (partition by cluster_id order by warc_filename, warc_record_offset, doc_id) as k from clus c join documents d using (doc_id)) where k = 1"

_TAGS = ["script", "style", "head", "nav", "footer", "aside", "form", "noscript"]


def _unescaped(x: str) -> str:
    """Named entities that the tables hold, decoded once."""
    for name, cp in (("lt", 60), ("gt", 62), ("quot", 34), ("apos", 39), ("nbsp", 160), ("amp", 38)):
        x = f"replace({x}, '&{name};', chr({cp}))"
    return x


def _bare(x: str) -> str:
    x = f"regexp_replace({x}, '<!--(.|\\n)*?-->', ' ', 'g')"
    for t in _TAGS:
        x = f"regexp_replace({x}, '<{t}(\\s[^>]*)?>(.|\\n)*?</{t}\\s*>', ' ', 'gi')"
    x = f"regexp_replace({x}, '</?(p|div|br|h1|h2|h3|h4|h5|h6|li|tr|ul|ol|table|article|section|main|blockquote)([\\s/][^>]*)?>', chr(10), 'gi')"
    x = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for name, to in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{to}')"
    return x


#: Line by line: spaces collapsed, empty lines dropped.
PLAIN = f"select page_id, array_to_string(list_filter(list_transform(string_split({_bare('html')}, chr(10)), lambda x: trim(regexp_replace(x, '[ \\t\\r\\f]+', ' ', 'g'), ' ')), lambda x: x <> ''), chr(10)) as text from pages"
#: Runs of digits and full stops are looked at one by one: four numbers up to 255, split at the stops, that are no private range.
REDACTED = """with m as (select doc_id, text is null as none, regexp_extract_all(regexp_replace(text, '[0-9A-Za-z._%+-]+@[0-9A-Za-z-]+([.][0-9A-Za-z-]+)*[.][A-Za-z]{2,}', '<email>', 'g'), '[0-9.]+|[^0-9.]+') as runs from documents),
r as (select doc_id, none, list_transform(runs, lambda r: {run: r, n: case when regexp_matches(r, '^[.]*[0-9]{1,3}([.][0-9]{1,3}){3}[.]*$') then list_transform(string_split(trim(r, '.'), '.'), lambda o: case when length(o) > 1 and o[1] = '0' then 999 else o::int end) else [999, 0, 0, 0] end}) as runs from m)
select doc_id, case when not none then array_to_string(list_transform(runs, lambda r: case when list_max(r.n) > 255 or r.n[1] in (0, 10, 127) or r.n[1] >= 240 or (r.n[1] = 192 and r.n[2] = 168) or (r.n[1] = 169 and r.n[2] = 254) or (r.n[1] = 172 and r.n[2] between 16 and 31)
 or (r.n[1] = 100 and r.n[2] between 64 and 127) or (r.n[1] = 198 and r.n[2] in (18, 19)) or r.n[1:3] in ([192, 0, 2], [198, 51, 100], [203, 0, 113]) then r.run else regexp_replace(r.run, '[0-9][0-9.]*[0-9]', '<ip>') end), '') end as text from r"""
#: Lines of bars only are left out; a run of them at the start or the end leaves a line break.
SYMBOLS = """with l as (select doc_id, string_split(replace(text, ':: ', chr(10) || '|' || chr(10) || '||' || chr(10)), chr(10)) as l from documents), k as (select doc_id, l, list_filter(l, lambda x: x = '' or replace(x, '|', '') <> '') as kept from l)
select doc_id, case when l[1] <> '' and replace(l[1], '|', '') = '' then chr(10) else '' end || array_to_string(kept, chr(10)) || case when len(kept) > 0 and l[-1] <> '' and replace(l[-1], '|', '') = '' then chr(10) else '' end as text from k"""

SQL: dict[str, str] = {
    "url_filter": f"select doc_id, {HOST} as host, {VERDICT} as verdict from documents",
    "html_extract_text": PLAIN,
    "url_filter_tables": f"select doc_id, {HOST} as host, {VERDICT} as verdict from documents",
    "tokens_words": f"select doc_id, len(t)::bigint as n_tokens, len(list_filter(t, lambda w: regexp_matches(w, '^[\\p{{L}}\\p{{N}}_]')))::bigint as n_words, md5(array_to_string(t, ' ')) as digest from (select doc_id, {TOK} as t from documents)",
    "lang_score": f"{LANG} select * replace (round(language_score, 6) as language_score) from lang",
    "lang_script": "select doc_id, case when g >= l and g >= c and g > 0 then 'Grek' when l >= c and l > 0 then 'Latn' when c > 0 then 'Cyrl' else 'Zyyy' end as language_script from (select doc_id, len(regexp_extract_all(text, '\\p{Greek}')) as g, len(regexp_extract_all(text, '\\p{Latin}')) as l, len(regexp_extract_all(text, '\\p{Cyrillic}')) as c from documents)",
    "lang_threshold": f"{LANG} select doc_id, round(language_score, 6) as language_score from lang where language = 'ell' and language_score >= {GREEK.language_score}",
    "lang_top_pairs": f"{LANG} select * replace (round(score, 6) as score) from ({' union all '.join(f'select doc_id, {_lit(n)} as lang_code, s_{n} as score from s' for n in NAMES)}) where score > {GREEK.keep_pairs}",
    "rep_lines_paragraphs": _rounded(PIECES, PIECE_SHARES),
    "rep_top_ngrams": _gram_query(GRAMS[:3]),
    "rep_dup_ngrams": _gram_query(GRAMS[3:]),
    "qual_lines": _rounded(LINES, LINE_SHARES),
    "qual_words": _rounded(QWORDS, WORD_SHARES),
    "quality_first_reason": REASON,
    "quality_against_labels": f"select quality, count(*) as n_documents, sum((reason is null)::bigint)::bigint as n_passed from ({REASON}) r join (select doc_id, floor(avg(quality))::bigint as quality from labels where quality is not null group by doc_id) using (doc_id) group by quality",
    "repair_text": f"select page_id, regexp_replace(regexp_replace(replace(replace({_unescaped(_unescaped('html'))}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '\\x1B\\[[0-9;]*[A-Za-z]', '', 'g'), '[\\x00-\\x08\\x0B\\x0E-\\x1F\\x7F\\x{{FEFF}}]', '', 'g') as text from pages",
    "redact_addresses": REDACTED,
    "symbol_lines": SYMBOLS,
    "exact_dedup_docs": "select md5(text) as text_hash, min(doc_id) as doc_id, count(*) as n_copies from documents group by 1",
    "minhash_signature": f"with {SIG} select doc_id, md5(array_to_string(signature, ',')) as digest, signature[1] as first, signature[112] as last from sig",
    "minhash_bands": f"with {BANDS} select * from band",
    "minhash_pairs": f"with {PAIRS} select * from pair",
    "minhash_clusters": f"with recursive {CLUSTERS} select * from clus",
    "minhash_similar": f"with recursive {SIMILAR} select * from clus",
    "minhash_dedup": f"with recursive {CLUSTERS} {KEPT}",
    "minhash_removed": f"with recursive {CLUSTERS} select doc_id from documents where doc_id not in (select doc_id from ({KEPT}))",
    "pipeline_reasons_no_ngrams": f"{LANG}, r as ({REASON}), v as (select doc_id, {VERDICT} as verdict from documents) select doc_id, case when verdict is not null then 'url_' || verdict when not (language = 'ell' and language_score >= {GREEK.language_score}) then 'language' else reason end as reason from v join lang using (doc_id) join r using (doc_id)",
    "pipeline_reasons": f"{LANG}, r as ({REASON}), {_gram_tables(GRAMS)} select doc_id, case when not (language = 'ell' and language_score >= {GREEK.language_score}) then 'language' when reason = 'dup_line_frac' then reason else coalesce({GRAM_REASON}, reason) end as reason from gram join lang using (doc_id) join r using (doc_id)",
}
