"""Repetition measures of documents: repeated lines and paragraphs, frequent and repeated n-grams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from typing import Any

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.functions.arrow import map_rows
from webloom.functions.text import TOKEN, ratio
from webloom.plans.profile import GREEK, Profile


def _pieces(text: Column, pattern: str) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), pattern), lambda x: x != "")


def duplicates(text: Column, pattern: str) -> tuple[Column, Column, Column]:
    """(pieces, repeated pieces, characters of repeated pieces); a piece is repeated if it stood before."""
    pieces = _pieces(text, pattern)
    once = F.array_distinct(pieces)

    def chars(a: Column) -> Column:
        return F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + F.length(x))

    return F.size(pieces).cast("bigint"), (F.size(pieces) - F.size(once)).cast("bigint"), chars(pieces) - chars(once)


def repeated_pieces(docs: DataFrame) -> DataFrame:
    """doc_id, and shares of repeated lines and paragraphs, by number and by characters of the text."""
    return docs.select("doc_id", *piece_columns())


def piece_columns() -> list[Column]:
    n, dup, chars = duplicates(F.col("text"), "\n+")
    pn, pdup, pchars = duplicates(F.col("text"), "\n{2,}")
    size = F.length(F.coalesce("text", F.lit("")))
    return [ratio(dup, n).alias("dup_line_frac"), ratio(chars, size).alias("dup_line_char_frac"), ratio(pdup, pn).alias("dup_para_frac"), ratio(pchars, size).alias("dup_para_char_frac")]


_TOKEN = regex.compile(TOKEN)


def tokenize(text: str | None) -> list[str]:
    return _TOKEN.findall(text) if text else []


def top_ngram_chars(words: list[str], n: int) -> int:
    """Characters of the most frequent n-gram (words joined by a space; the first in the text wins a tie) times its count."""
    if len(words) < n:
        return 0
    grams = Counter(zip(*(words[i:] for i in range(n)), strict=False))
    gram, count = max(grams.items(), key=lambda x: x[1])  # insertion order breaks ties
    return (sum(map(len, gram)) + n - 1) * count


def dup_ngram_chars(words: list[str], n: int) -> int:
    """Greedy scan: n words seen before add their characters and are skipped, others are remembered."""
    seen: set[tuple[str, ...]] = set()
    total = i = 0
    while i < len(words) - n + 1:
        gram = tuple(words[i : i + n])
        if gram in seen:
            total += sum(map(len, gram))
            i += n
        else:
            seen.add(gram)
            i += 1
    return total


def ngram_fractions(docs: DataFrame, profile: Profile = GREEK) -> DataFrame:
    """All columns but text, and top_<n> and dup_<n>: shares of the text's characters; 0 for empty and null texts.

    One narrow pass for all n; it also keeps later filters from being pushed below and evaluated twice.
    """
    tops, dups = [n for n, _ in profile.top_n_grams], [n for n, _ in profile.dup_n_grams]
    names = [f"top_{n}" for n in tops] + [f"dup_{n}" for n in dups]
    rest = [c for c in docs.columns if c != "text"]

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        def f(texts: list[str | None], *columns: list[Any]) -> Iterator[tuple[Any, ...]]:
            for text, *row in zip(texts, *columns, strict=True):
                w, size = tokenize(text), len(text or "")
                yield *row, *[top_ngram_chars(w, n) / size if size else 0.0 for n in tops], *[dup_ngram_chars(w, n) / size if size else 0.0 for n in dups]

        return f

    schema = T.StructType([*[docs.schema[c] for c in rest], *[T.StructField(n, T.DoubleType()) for n in names]])
    return map_rows(docs, ["text", *rest], schema, make)
