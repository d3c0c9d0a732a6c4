"""Undoing one common damage of text: UTF-8 bytes that were read as a single-byte encoding."""

from __future__ import annotations

import re
from collections.abc import Callable

_ROUNDS = 3


def _characters(encoding: str) -> list[str]:
    """The character of each byte; bytes an encoding leaves undefined stand for themselves."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


def _undoer(encoding: str, least: int) -> Callable[[str], str]:
    """A function that reads back runs of at least `least` characters that form valid UTF-8 in the given encoding."""
    chars = _characters(encoding)
    to_byte = {ord(c): b for b, c in enumerate(chars)} | ({b: b for b in range(0x80, 0xA0)})

    def some(lo: int, hi: int) -> str:
        return "[" + "".join(re.escape(c) for c in {*chars[lo : hi + 1], *(chr(b) for b in range(lo, min(hi, 0x9F) + 1))}) + "]"

    tail = some(0x80, 0xBF)
    run = re.compile(f"(?:{some(0xC2, 0xDF)}{tail}|{some(0xE0, 0xEF)}{tail}{{2}}|{some(0xF0, 0xF4)}{tail}{{3}}){{{least},}}")

    def back(m: re.Match[str]) -> str:
        try:
            return m[0].translate(to_byte).encode("latin-1").decode("utf-8")
        except UnicodeError:
            return m[0]

    return lambda text: run.sub(back, text)


# In Greek encodings a capital letter and a sign may stand together by right, so one pair alone proves nothing there.
_LATIN, _WINDOWS, _ISO = _undoer("cp1252", 1), _undoer("cp1253", 2), _undoer("iso8859-7", 2)
_CONTROLS = re.compile("[\x80-\x9f]")


def undo_utf8(text: str) -> str:
    """The text with such runs restored, also where it happened up to three times; other text is given back as it is.

    Some signs stand for different bytes in the two Greek encodings; only one of them leaves control characters.
    """
    for _ in range(_ROUNDS):
        before = text
        for undo in (_LATIN, _ISO, _WINDOWS) if _CONTROLS.search(text) else (_LATIN, _WINDOWS, _ISO):
            text = undo(text)
        if text == before:
            break
    return text
