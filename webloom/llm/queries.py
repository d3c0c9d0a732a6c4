"""All queries of the subpackage, by name, with SQL where it can express them on whole tables."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from webloom.llm.oracle import SQL

MODULES = ["pii", "language", "repetition", "site_lines", "boilerplate", "quality", "mojibake", "leakage", "mixing", "reading"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for m in MODULES:
        module = importlib.import_module(f"webloom.llm.{m}")
        out |= {k: f for k, f in vars(module).items() if k[0] == "p" and k[1:].split("_")[0].isdigit()}
    return dict(sorted(out.items(), key=lambda x: (int(x[0][1:].split("_")[0]), x[0])))


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
