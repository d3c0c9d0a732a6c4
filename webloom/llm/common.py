"""Folding of text and tables that the operators share."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession

from webloom.functions.arrow import fold_tasks, map_rows
from webloom.sources.tables import table

__all__ = ["LINES", "WORDS", "documents", "fold", "fold_line", "fold_tasks", "map_rows", "plain_words", "table", "words"]


class _Fold(dict):
    """Code point -> folded text, filled as characters are met; at most one entry a code point."""

    def __init__(self, keep_others: bool) -> None:
        super().__init__()
        self.keep_others = keep_others

    def __missing__(self, cp: int) -> str | None:
        ch = chr(cp)
        if ch.isspace():
            out: str | None = " "
        else:
            base = "".join(c for c in unicodedata.normalize("NFD", ch.lower()) if unicodedata.category(c) != "Mn")
            base = base.replace("ς", "σ")
            out = base if self.keep_others or base.isalnum() else None
            if not out:
                out = None
        self[cp] = out
        return out


WORDS, LINES = _Fold(False), _Fold(True)


class _Known(dict):
    """Word -> folded word, as most words of a text have been met before; bounded, and without very long ones."""

    MOST, LONGEST = 1 << 17, 64

    def __init__(self, table: _Fold) -> None:
        super().__init__()
        self.table = table

    def __missing__(self, word: str) -> str:
        out = word.translate(self.table)
        if len(word) <= self.LONGEST:
            if len(self) >= self.MOST:
                self.clear()
            self[word] = out
        return out


_WORD, _LINE = _Known(WORDS), _Known(LINES)


def plain_words(pieces: list[str]) -> list[str]:
    """Pieces of a text between white space, reduced to letters and digits, without case, accents and final sigma; none of others."""
    return [x for x in map(_WORD.__getitem__, pieces) if x]


def words(text: str | None) -> list[str]:
    """The words of a text: what stands between white space, as `plain_words` gives it."""
    return plain_words(text.split()) if text else []


def fold(text: str) -> str:
    """Text without case, accents and final sigma; every white space character is a space."""
    return text.translate(LINES)


def fold_line(line: str) -> str:
    """A line folded, with single spaces and none at its ends."""
    return " ".join([x for x in map(_LINE.__getitem__, line.split()) if x])


def documents(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "documents", spread=True)
