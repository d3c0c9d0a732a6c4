"""Formatters that run on documents that are kept: repair, redaction of addresses, symbol lines."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.entities import html5
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions.arrow import map_rows
from webloom.functions.encoding import undo_utf8

EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)*\\.[A-Za-z]{2,}"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Address ranges that are not public.
_PRIVATE = "(?:0|10|127|24[0-9]|25[0-5])\\.|192\\.168\\.|169\\.254\\.|172\\.(?:1[6-9]|2[0-9]|3[01])\\.|100\\.(?:6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])\\.|192\\.0\\.2\\.|198\\.1[89]\\.|198\\.51\\.100\\.|203\\.0\\.113\\."
#: An IPv4 address that is no part of a longer row of numbers; a full stop may follow it. Nothing around it is consumed.
PUBLIC_IP = f"(?<![0-9])(?<![0-9]\\.)(?!{_PRIVATE}){_OCTET}(?:\\.{_OCTET}){{3}}(?![0-9])(?!\\.[0-9])"

_ENTITY = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_ESCAPE = re.compile("\x1b\\[[0-9;]*[A-Za-z]")
_CONTROL = re.compile("[\x00-\x08\x0b\x0e-\x1f\x7f﻿]|[\ud800-\udfff]")


def _entity(m: re.Match[str]) -> str:
    name = m[1]
    if name[0] != "#":
        return html5.get(name + ";", m[0])
    cp = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
    if 0x80 <= cp < 0xA0:  # such references mean the characters of cp1252, as browsers read them
        return bytes([cp]).decode("cp1252", "ignore")
    return chr(cp) if 0 < cp < 0x110000 and not 0xD800 <= cp < 0xE000 else ""


def repair_text(text: str, encoding: bool = True) -> str:
    """Entities decoded twice (they come doubly escaped), with `encoding` UTF-8 read wrongly restored, terminal escapes,
    control characters and byte order marks dropped, line ends as line feeds."""
    if "&" in text:
        text = _ENTITY.sub(_entity, _ENTITY.sub(_entity, text))
    if encoding and not text.isascii():
        text = undo_utf8(text)
    return _CONTROL.sub("", _ESCAPE.sub("", text).replace("\r\n", "\n").replace("\r", "\n"))


def repaired(docs: DataFrame, column: str = "text", encoding: bool = True) -> DataFrame:
    """All columns, with `column` repaired; null stays null. One narrow pass."""
    at = docs.columns.index(column)

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        def f(*columns: list[Any]) -> Iterator[tuple[Any, ...]]:
            for row in zip(*columns, strict=True):
                yield *row[:at], None if row[at] is None else repair_text(row[at], encoding), *row[at + 1 :]

        return f

    return map_rows(docs, docs.columns, docs.schema, make)


def redact_addresses(text: Column) -> Column:
    """E-mail addresses and public IPv4 addresses become one fixed placeholder each; private ranges stay."""
    return F.regexp_replace(F.regexp_replace(text, EMAIL, "<email>"), PUBLIC_IP, "<ip>")


def symbol_lines(text: Column, symbols: str = "|") -> Column:
    """A run of lines made only of the symbols becomes one line break."""
    return F.regexp_replace(text, symbol_pattern(symbols), "\n")


def symbol_pattern(symbols: str = "|") -> str:
    cls = "[" + "".join("\\" + s for s in symbols) + "]"
    return f"(?:^|\n)(?:{cls}+(?:\n|$))+"


_EMAIL_RE, _IP_RE, _SYMBOLS_RE = re.compile(EMAIL), re.compile(PUBLIC_IP), re.compile(symbol_pattern().replace("$", r"\Z"))


def format_text(text: str) -> str:
    """Repair, redaction and symbol lines, in this order: the same as the columns above, for one text in a pass."""
    text = repair_text(text)
    if "@" in text:
        text = _EMAIL_RE.sub("<email>", text)
    text = _IP_RE.sub("<ip>", text)
    return _SYMBOLS_RE.sub("\n", text) if "|" in text else text
