"""Language scores of documents by frequent words; a model-backed scorer can take the same place."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.functions.arrow import map_rows
from webloom.operators.repetition import tokenize
from webloom.plans.profile import GREEK, Profile

#: What a scorer gives for a text and its tokens: (language, score) in order of name.
Scorer = Callable[[str, list[str]], list[tuple[str, float]]]
_SCRIPTS = {"Grek": regex.compile(r"\p{Greek}"), "Latn": regex.compile(r"\p{Latin}"), "Cyrl": regex.compile(r"\p{Cyrillic}")}


def word_scorer(profile: Profile = GREEK) -> Callable[[], Scorer]:
    """A factory, called once a task, of scorers by share of each language's frequent words among all such words found."""

    def make() -> Scorer:
        names = sorted(profile.profiles)
        owners: dict[str, list[int]] = {}
        for k, n in enumerate(names):
            for w in {w.replace("ς", "σ") for w in profile.profiles[n]}:
                owners.setdefault(w, []).append(k)

        def score(_: str, tokens: list[str]) -> list[tuple[str, float]]:
            found = [0] * len(names)
            for w in tokens:
                for k in owners.get(w.lower().replace("ς", "σ"), ()):
                    found[k] += 1
            total = sum(found)
            return [(n, x / total if total else 0.0) for n, x in zip(names, found, strict=True)]

        return score

    return make


def best(scored: list[tuple[str, float]]) -> tuple[str, float]:
    """The language of the highest score, ties by order; und and 0 where nothing scores."""
    top = max((s for _, s in scored), default=0.0)
    return next((n for n, s in scored if s == top), "und") if top > 0 else "und", top


def script_of(text: str | None) -> str:
    """The script of most letters (Grek, Latn, Cyrl; ties in this order), Zyyy without any of them."""
    if not text:
        return "Zyyy"
    n = {k: len(p.findall(text)) for k, p in _SCRIPTS.items()}
    top = max(n, key=lambda k: n[k])
    return top if n[top] else "Zyyy"


def scores(docs: DataFrame, profile: Profile = GREEK, scorer: Callable[[], Scorer] | None = None) -> DataFrame:
    """All columns, and `scores` (language -> score), `language`, `language_score` and `language_script`.

    The highest score wins, ties by name; und and 0 where nothing scores, as in null and empty texts. One Arrow pass.
    """
    factory = scorer or word_scorer(profile)
    at = docs.columns.index("text")

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        score = factory()

        def f(*columns: list[Any]) -> Iterator[tuple[Any, ...]]:
            for row in zip(*columns, strict=True):
                found = score(row[at] or "", tokenize(row[at]))
                yield *row, found, *best(found), script_of(row[at])

        return f

    schema = T.StructType([*docs.schema.fields, T.StructField("scores", T.MapType(T.StringType(), T.DoubleType())), T.StructField("language", T.StringType()), T.StructField("language_score", T.DoubleType()), T.StructField("language_script", T.StringType())])
    return map_rows(docs, docs.columns, schema, make)


def passes(profile: Profile = GREEK) -> Column:
    return (F.col("language") == profile.language) & (F.coalesce("language_score", F.lit(0.0)) >= profile.language_score)


def above_threshold(scored: DataFrame, profile: Profile = GREEK) -> DataFrame:
    return scored.where(passes(profile))


def top_pairs(scored: DataFrame, profile: Profile = GREEK) -> DataFrame:
    """Languages with a score above the keeping threshold: doc_id, lang_code, score."""
    return scored.select("doc_id", F.explode(F.map_filter("scores", lambda _, v: v > profile.keep_pairs)).alias("lang_code", "score"))
