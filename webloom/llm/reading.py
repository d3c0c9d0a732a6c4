"""Problem 10: reading level of each document.

Familiar-word formula: share of words outside a high-frequency list plus average sentence length. The list holds the
FAMILIAR words that stand in most documents of the corpus (ties by the word), counted over all documents with partial
counts in each task, so that only (word, documents) pairs are shuffled. The list is bounded by its parameter and
broadcast. Weights turn the two figures into a school grade; they are least squares over all human marks, found from
sums that Spark aggregates, so no mark is collected. Words and sentences are taken from lines that hold sentences, as
menus, tables and keyword strings say nothing about difficulty; a document without such a line is measured over all its
lines, each line a sentence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import documents, fold_tasks, map_rows, table, words
from webloom.session import cut

FAMILIAR = 1000
MIN_WORDS = 5
#: Different words that a task holds before it gives out their counts.
HELD_WORDS = 500_000
#: Weights (constant, unfamiliar share, log of words per sentence) where there are fewer than 30 marks.
DEFAULT = (-4.2, 1.5, 4.1)
END = re.compile(r"(?<![.\s])[.!?;…]+(?=[\s\"'»”)]|$)")


def sentences(text: str) -> tuple[list[str], int]:
    """Folded words and the number of sentences of the lines that hold sentences."""
    ws: list[str] = []
    n = 0
    lines = text.split("\n")
    for line in lines:
        k = len(END.findall(line))
        if k:
            own = words(line)
            if len(own) >= MIN_WORDS:
                ws += own
                n += k + (line.rstrip()[-1:] not in ".!?;…»”\"')")
    if not n:
        for line in lines:
            own = words(line)
            ws += own
            n += bool(own)
    return ws, n


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(word, n_documents) over all documents, counted in each task before the shuffle."""

    def make() -> tuple[Callable[..., bool], Callable[[], Iterator[tuple[str, int]]]]:
        seen: Counter[str] = Counter()

        def add(texts: list[str | None]) -> bool:
            for text in texts:
                if text:
                    seen.update(set(sentences(text)[0]))
            return len(seen) > HELD_WORDS

        def drain() -> Iterator[tuple[str, int]]:
            yield from seen.items()
            seen.clear()

        return add, drain

    return fold_tasks(docs, ["text"], "word string, n bigint", make).groupBy("word").agg(F.sum("n").alias("n_documents"))


def familiar_words(docs: DataFrame, size: int = FAMILIAR) -> list[str]:
    """The `size` words with the highest document frequency."""
    return [r[0] for r in document_frequencies(docs).orderBy(F.desc("n_documents"), "word").limit(size).collect()]


FIGURES = "doc_id bigint, n_words bigint, n_sentences bigint, unfamiliar_share double, words_per_sentence double"


def figures(docs: DataFrame, familiar: list[str]) -> DataFrame:
    """One row a document: words, sentences, unfamiliar share, words per sentence; zeros for null and empty texts."""
    held = docs.sparkSession.sparkContext.broadcast(familiar)

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        known = frozenset(held.value)

        def f(ids: list[int], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, text in zip(ids, texts, strict=True):
                ws, n = sentences(text) if text else ([], 0)
                if ws:
                    yield i, len(ws), n, 1 - sum(map(known.__contains__, ws)) / len(ws), len(ws) / n
                else:
                    yield i, 0, 0, 0.0, 0.0

        return f

    return map_rows(docs, ["doc_id", "text"], FIGURES, make)


FEATURES = 3


def _marked(measured: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[Column], Column]:
    """Documents with words and their marks, the three figures of the formula and the mark."""
    x = [F.lit(1.0), F.col("unfamiliar_share"), F.log(F.greatest("words_per_sentence", F.lit(1.0)))]
    met = measured.where("n_words > 0").join(labels.where("reading_grade is not null").select("doc_id", "reading_grade"), "doc_id")
    return met, x, F.col("reading_grade").cast("double")


def _sums(x: list[Column], y: Column) -> list[Column]:
    return [*[F.sum(a * b).alias(f"s{i}{j}") for i, a in enumerate(x) for j, b in enumerate(x)], *[F.sum(a * y).alias(f"t{i}") for i, a in enumerate(x)]]


def _solved(a: np.ndarray, b: np.ndarray) -> tuple[float, float, float]:
    """Least squares from sums; DEFAULT for fewer than 30 marks."""
    if a[0, 0] < 30:
        return DEFAULT
    return tuple(float(v) for v in np.linalg.solve(a + np.eye(FEATURES) * 1e-6 * a[0, 0], b))


def _arrays(row: Any) -> tuple[np.ndarray, np.ndarray]:
    return np.array([[row[f"s{i}{j}"] or 0.0 for j in range(FEATURES)] for i in range(FEATURES)]), np.array([row[f"t{i}"] or 0.0 for i in range(FEATURES)])


def weights(measured: DataFrame, labels: DataFrame) -> tuple[float, float, float]:
    """Least squares of reading_grade on (1, unfamiliar share, log words per sentence) over all marks."""
    met, x, y = _marked(measured, labels)
    return _solved(*_arrays(met.agg(*_sums(x, y)).first()))


def held_out(measured: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """(n_marks, correlation, mean_error) of levels given by weights that were fitted without the marked document.

    Documents fall into folds by hash; each fold's weights come from the sums of the others. Null figures without marks, and no correlation of marks or
    levels that are all alike.
    """
    met, x, y = _marked(measured, labels)
    met = met.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(folds)).cast("int"))
    by = {r["fold"]: _arrays(r) for r in met.groupBy("fold").agg(*_sums(x, y)).collect()}
    zero = (np.zeros((FEATURES, FEATURES)), np.zeros(FEATURES))
    others = {k: _solved(sum((v[0] for f, v in by.items() if f != k), zero[0]), sum((v[1] for f, v in by.items() if f != k), zero[1])) for k in range(folds)}
    guess = F.coalesce(*[F.when(F.col("fold") == k, F.least(F.greatest(sum((F.lit(w) * c for w, c in zip(own, x, strict=True)), F.lit(0.0)), F.lit(0.0)), F.lit(16.0))) for k, own in others.items()])
    got = met.select(guess.alias("guess"), y.alias("mark"))
    return got.agg(F.count(F.lit(1)).alias("n_marks"), F.round(F.try_divide(F.covar_pop("guess", "mark"), F.stddev_pop("guess") * F.stddev_pop("mark")), 3).alias("correlation"), F.round(F.avg(F.abs(F.col("guess") - F.col("mark"))), 3).alias("mean_error"))


def level(w: tuple[float, float, float]) -> Column:
    raw = F.lit(w[0]) + F.lit(w[1]) * F.col("unfamiliar_share") + F.lit(w[2]) * F.log(F.greatest("words_per_sentence", F.lit(1.0)))
    return F.when(F.col("n_words") > 0, F.round(F.least(F.greatest(raw, F.lit(0.0)), F.lit(16.0)), 3))


def levels(docs: DataFrame, labels: DataFrame, size: int = FAMILIAR) -> DataFrame:
    """doc_id, source, words, sentences, unfamiliar share, words per sentence, level (about a school grade; null without words)."""
    measured = cut(figures(docs, familiar_words(docs, size)))
    own = measured.withColumn("level", level(weights(measured, labels)))
    return own.select("doc_id", "n_words", "n_sentences", F.round("unfamiliar_share", 6).alias("unfamiliar_share"), F.round("words_per_sentence", 6).alias("words_per_sentence"), "level")


def p10_levels(spark: SparkSession, d: str) -> DataFrame:
    return levels(documents(spark, d), table(spark, d, "labels"))


def p10_profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents and quartiles of the level by source (spelling of sources folded)."""
    docs = documents(spark, d)
    own = levels(docs, table(spark, d, "labels")).join(docs.select("doc_id", F.lower(F.trim("source")).alias("source")), "doc_id")
    q = F.percentile_approx("level", [0.25, 0.5, 0.75], 1000)
    return own.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.avg("level").alias("mean_level"), q.alias("q")).select("source", "n_documents", F.round("mean_level", 3).alias("mean_level"), *[F.col("q")[i].alias(f"quartile_{i + 1}") for i in range(3)])


def p10_fit(spark: SparkSession, d: str) -> DataFrame:
    """How well the formula meets marks it was not fitted to."""
    docs = documents(spark, d)
    return held_out(cut(figures(docs, familiar_words(docs))), table(spark, d, "labels"))
