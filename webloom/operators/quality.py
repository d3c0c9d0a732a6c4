"""Quality measures of documents from lines and words; every filter is a measure and a threshold.

`line_measures` and `word_measures` are built-in expressions. `judged` tests all filters in one Arrow pass that cuts each
text into tokens once and stops at the first filter that drops it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.functions.arrow import map_rows
from webloom.functions.text import is_word, lines, ratio, shown, tokens
from webloom.operators import language
from webloom.operators.cleanup import format_text
from webloom.operators.repetition import dup_ngram_chars, tokenize, top_ngram_chars
from webloom.plans.profile import GREEK, Profile

TERMINAL_CHARS = ".!?…;:\"»"
TERMINAL = f"[{TERMINAL_CHARS}][ \\t\\r\\f]*\\z"
BULLET = "^[ \\t]*[•‣▪◦●→*-]"
ELLIPSIS = "\\.\\.\\.|…"


def line_measures(docs: DataFrame, profile: Profile = GREEK) -> DataFrame:
    """All columns, and n_lines (shown) and shares: terminal punctuation, short lines, repeated characters, line breaks a word."""
    own = docs.select("*", F.filter(lines(F.col("text")), shown).alias("l"), F.size(F.filter(tokens(F.col("text")), is_word)).cast("bigint").alias("nw"))
    once = F.array_distinct("l")

    def chars(a: Column) -> Column:
        return F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + F.length(x))

    n = F.size("l").cast("bigint")
    size = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "\n", ""))
    breaks = F.length(F.coalesce("text", F.lit(""))) - size
    return own.select(
        *docs.columns,
        n.alias("n_lines"),
        ratio(F.size(F.filter("l", lambda x: x.rlike(TERMINAL))).cast("bigint"), n).alias("terminal_frac"),
        ratio(F.size(F.filter("l", lambda x: F.length(x) <= profile.short_line_length)).cast("bigint"), n).alias("short_frac"),
        ratio(chars(F.col("l")) - chars(once), size).alias("char_dup_frac"),
        ratio(breaks, F.col("nw")).alias("new_line_ratio"),
    )


def word_measures(docs: DataFrame, profile: Profile = GREEK) -> DataFrame:
    """All columns, and words, mean word length, alphabetic share of tokens, symbols a word, stop words, bullet and ellipsis shares of lines."""
    own = docs.select("*", tokens(F.col("text")).alias("t"), F.filter(lines(F.col("text")), shown).alias("l"))
    own = own.withColumn("w", F.filter("t", is_word))
    nw, nt, nl = (F.size(c).cast("bigint") for c in ("w", "t", "l"))
    letters = F.aggregate("w", F.lit(0).cast("bigint"), lambda s, x: s + F.length(x))
    alpha = F.size(F.filter("t", lambda x: x.rlike("\\p{L}"))).cast("bigint")
    stops = F.array(*map(F.lit, profile.stop_words))

    def count(pattern: str) -> Column:
        return F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(pattern), F.lit(0))).cast("bigint")

    return own.select(
        *docs.columns,
        nw.alias("n_words"),
        ratio(letters, nw).alias("avg_word_length"),
        ratio(alpha, nt).alias("alpha_ratio"),
        ratio(count("#"), nw).alias("hash_ratio"),
        ratio(count(ELLIPSIS), nw).alias("ellipsis_ratio"),
        F.size(F.array_intersect(F.array_distinct("w"), stops)).cast("bigint").alias("n_stop_words"),
        ratio(F.size(F.filter("l", lambda x: x.rlike(BULLET))).cast("bigint"), nl).alias("bullet_frac"),
        ratio(F.size(F.filter("l", lambda x: x.rlike(f"({ELLIPSIS})[ \\t\\r\\f]*\\z"))).cast("bigint"), nl).alias("ellipsis_frac"),
    )


_SHOWN = re.compile(r"[^ \t\n\r\f]")
_BULLET, _ELLIPSIS, _ALPHA = re.compile(BULLET), re.compile(ELLIPSIS), regex.compile(r"\p{L}")
_BLANKS = " \t\r\f"


def _share(a: float, b: float) -> float:
    return a / b if b > 0 else 0.0


def _repeats(pieces: list[str]) -> tuple[int, int, int]:
    once = set(pieces)
    return len(pieces), len(pieces) - len(once), sum(map(len, pieces)) - sum(map(len, once))


def first_reason(text: str | None, words: list[str], profile: Profile = GREEK, n_grams: bool = True) -> str | None:
    """The first test in pipeline order that drops the text, or None. A threshold of 0 skips its test.

    `words` are the text's tokens; null texts count as empty.
    """
    text = text or ""
    size = len(text)
    for split, count, chars in (("\n{2,}", "dup_para_frac", "dup_para_char_frac"), ("\n+", "dup_line_frac", "dup_line_char_frac")):
        by_count, by_chars = getattr(profile, count), getattr(profile, chars)
        if by_count or by_chars:
            n, again, long = _repeats([x for x in re.split(split, text) if x])
            if by_count and _share(again, n) > by_count:
                return count
            if by_chars and _share(long, size) > by_chars:
                return chars
    if n_grams:
        for name, pairs, measure in (("top", profile.top_n_grams, top_ngram_chars), ("dup", profile.dup_n_grams, dup_ngram_chars)):
            for n, most in pairs:
                if most and _share(measure(words, n), size) > most:
                    return f"{name}_{n}_gram"
    shown_lines = [x for x in text.split("\n") if _SHOWN.search(x)]
    n = len(shown_lines)
    if not n:
        return "empty"
    ends = [x.rstrip(_BLANKS) for x in shown_lines]
    if sum(x[-1:] in TERMINAL_CHARS for x in ends) / n < profile.line_punct:
        return "line_punct"
    if profile.short_line_frac and sum(len(x) <= profile.short_line_length for x in shown_lines) / n > profile.short_line_frac:
        return "short_lines"
    breaks = text.count("\n")
    if _share(_repeats(shown_lines)[2], size - breaks) > profile.char_dup:
        return "char_dup"
    own = [w for w in words if w[0].isalnum() or w[0] == "_" or len(w) > 1]
    k = len(own)
    if _share(breaks, k) > profile.new_line_ratio:
        return "new_lines"
    if k < profile.min_words:
        return "few_words"
    if k > profile.max_words:
        return "many_words"
    if not profile.min_avg_word_length <= sum(map(len, own)) / k <= profile.max_avg_word_length:
        return "word_length"
    if text.count("#") / k > profile.max_symbol_ratio:
        return "hashes"
    if len(_ELLIPSIS.findall(text)) / k > profile.max_symbol_ratio:
        return "ellipses"
    if sum(bool(_BULLET.match(x)) for x in shown_lines) / n > profile.max_bullet_frac:
        return "bullets"
    if sum(x.endswith(("...", "…")) for x in ends) / n > profile.max_ellipsis_frac:
        return "ellipsis_lines"
    if _share(sum(1 for w in words if w.isalpha() or _ALPHA.search(w)), len(words)) < profile.min_alpha_ratio:
        return "alpha"
    if len(set(own) & set(profile.stop_words)) < profile.min_stop_words:
        return "stop_words"
    return None


def judged(docs: DataFrame, profile: Profile = GREEK, n_grams: bool = True, scorer: Callable[[], language.Scorer] | None = None, by_language: bool = True, formatted: bool = False) -> DataFrame:
    """All columns, and language, language_score, language_script and `reason`: what drops the document, null for survivors.

    A column `ban` in the input names what the address filter found; such texts are not read. With `formatted`, survivors'
    texts come out formatted and those of dropped documents as null, so that only survivors' texts leave the pass.
    One narrow pass: each text is cut into tokens once, for language, repetition and quality alike.
    """
    factory = scorer or language.word_scorer(profile)
    names = docs.columns
    at, ban = names.index("text"), names.index("ban") if "ban" in names else None

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        score = factory()

        def f(*columns: list[Any]) -> Iterator[tuple[Any, ...]]:
            for row in zip(*columns, strict=True):
                text, label, top, script = row[at], None, None, None
                if ban is not None and row[ban] is not None:
                    reason: str | None = f"url_{row[ban]}"
                else:
                    words = tokenize(text)
                    reason = None
                    if by_language:
                        (label, top), script = language.best(score(text or "", words)), language.script_of(text)
                        if label != profile.language or top < profile.language_score:
                            reason = "language"
                    reason = reason or first_reason(text, words, profile, n_grams)
                if formatted:
                    row = (*row[:at], format_text(text) if reason is None and text is not None else None, *row[at + 1 :])
                yield *row, label, top, script, reason

        return f

    extra = [("language", T.StringType()), ("language_score", T.DoubleType()), ("language_script", T.StringType()), ("reason", T.StringType())]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in extra]])
    return map_rows(docs, names, schema, make)
