"""Text expressions shared by the operators; all are built-in and stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = " \\t\\n\\r\\f"
TOKEN = f"[\\p{{L}}\\p{{N}}_]+|[^{BLANK}\\p{{L}}\\p{{N}}_]"
WORD = "^[\\p{L}\\p{N}_]"


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double; 0 where b is 0 or null. Not rounded, as thresholds are compared with it."""
    return F.when(b > 0, a.cast("double") / b).otherwise(0.0)


def rounded(*names: str) -> dict[str, Column]:
    """Columns rounded to 6 digits, for output only."""
    return {n: F.round(n, 6) for n in names}


def tokens(text: Column) -> Column:
    """Words and single other visible characters, in order; an empty array for null and empty text."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))


def is_word(token: Column) -> Column:
    return token.rlike(WORD)


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def shown(line: Column) -> Column:
    """A line with something visible in it."""
    return line.rlike(f"[^{BLANK}]")
