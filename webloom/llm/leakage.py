"""Problem 8: evaluation texts leaking into training text.

The normalised 12-word windows of the test items form a sorted array of 64-bit hashes that is broadcast. Training windows
are scanned in one narrow pass and every hit is verified word by word. The array is bounded: items are taken in blocks of
at most BLOCK_WINDOWS windows, each block scans all documents in the same way, so a test set of any size is treated alike.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import WORDS, documents, map_rows, table, words

N = 12
#: Windows of one broadcast block: 16 bytes each and a word's number, and the words themselves.
BLOCK_WINDOWS = 1_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """The numbers of n neighbouring words as a number in base BASE modulo 2**64, at each place."""
    m = len(ids) - n + 1
    out = np.zeros(max(m, 0), np.uint64)
    if m > 0:
        mixed = ids.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        for k in range(n):
            out = out * BASE + mixed[k : k + m]
    return out


class Block:
    """Windows of some items as arrays: words are numbered from 1, items lie end to end, windows are sorted by hash."""

    def __init__(self, items: list[tuple[int, list[str]]], n: int = N) -> None:
        number: dict[str, int] = {}
        lists = [np.fromiter((number.setdefault(w, len(number) + 1) for w in ws), np.int32, len(ws)) for _, ws in items]
        self.n, self.vocabulary, self.items = n, list(number), np.array([i for i, _ in items], np.int64)
        self.starts = np.cumsum([0, *map(len, lists)]).astype(np.int64)
        self.ids = np.concatenate([*lists, np.zeros(0, np.int32)])
        hashes = [window_hashes(x, n) for x in lists]
        places = np.concatenate([*[a + np.arange(len(h)) for a, h in zip(self.starts, hashes, strict=False)], np.zeros(0, np.int64)]).astype(np.int64)
        whole = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        order = np.argsort(whole, kind="stable")
        self.sorted, self.places = whole[order], places[order]

    def scanner(self) -> Callable[[list[str]], list[tuple[int, int, int]]]:
        """A function of a document's words: (item, first word in the document, words) of each verified maximal match."""
        get = {w: k for k, w in enumerate(self.vocabulary, 1)}.get
        n = self.n

        def hits(ws: list[str]) -> list[tuple[int, int, int]]:
            if len(ws) < n or not len(self.sorted):
                return []
            ids = np.fromiter((get(w, 0) for w in ws), np.int32, len(ws))
            h = window_hashes(ids, n)
            lo = np.searchsorted(self.sorted, h, "left")
            lo[lo == len(self.sorted)] = 0
            spans: dict[tuple[int, int], list[int]] = defaultdict(list)
            for p in np.flatnonzero(self.sorted[lo] == h).tolist():
                for q in self.places[lo[p] : np.searchsorted(self.sorted, h[p], "right")].tolist():
                    if np.array_equal(ids[p : p + n], self.ids[q : q + n]):
                        k = int(np.searchsorted(self.starts, q, "right")) - 1
                        spans[k, p - q].append(p)
            out = []
            for (k, _), ps in spans.items():
                start = last = ps[0]
                for p in [*ps[1:], None]:
                    if p is None or p != last + 1:
                        out.append((int(self.items[k]), start, last - start + n))
                        start = p
                    last = p
            return out

        return hits


def blocks(items: DataFrame, n: int, most: int) -> Iterator[Block]:
    """The items, each once, in blocks of at most `most` windows; a longer item is a block of its own.

    Items without an id or with fewer than n words are left out. One block at a time is held on the driver.
    """
    held: list[tuple[int, list[str]]] = []
    total = 0
    for i, text in items.where("item_id is not null and text is not null").select("item_id", "text").distinct().toLocalIterator():
        ws = words(text)
        size = len(ws) - n + 1
        if size < 1:
            continue
        if held and total + size > most:
            yield Block(held, n)
            held, total = [], 0
        held.append((i, ws))
        total += size
    if held:
        yield Block(held, n)


SPANS = "doc_id bigint, item_id bigint, first_word bigint, n_words bigint"


def scan(docs: DataFrame, items: DataFrame, n: int = N, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Maximal matches: doc_id, item_id, first_word (from 0), n_words. Null, empty and short texts and items match nothing."""
    sc = docs.sparkSession.sparkContext

    def one(block: Block) -> DataFrame:
        held = sc.broadcast(block)

        def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
            hits = held.value.scanner()

            def f(ids: list[int], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
                for i, text in zip(ids, texts, strict=True):
                    for item, first, length in hits(words(text)):
                        yield i, item, first, length

            return f

        return map_rows(docs, ["doc_id", "text"], SPANS, make)

    found = [one(b) for b in blocks(items, n, block_windows)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], SPANS)


def found(docs: DataFrame, items: DataFrame, n: int = N) -> DataFrame:
    return scan(docs, items, n).select("doc_id", "item_id").distinct()


def report(docs: DataFrame, items: DataFrame, n: int = N) -> DataFrame:
    """Each test item that leaked: documents, longest match in words."""
    return scan(docs, items, n).groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_documents"), F.max("n_words").alias("longest_words"))


def decontaminated(docs: DataFrame, items: DataFrame, n: int = N, whole: bool = False) -> DataFrame:
    """Documents without leaked spans (or without leaking documents, if `whole`): doc_id, n_spans, text.

    A span goes from its first to its last word, with what stands between them; a null text stays null.
    """
    spans = scan(docs, items, n).groupBy("doc_id").agg(F.collect_set(F.struct("first_word", "n_words")).alias("spans"))
    joined = docs.select("doc_id", "text").join(spans, "doc_id", "left")
    if whole:
        return joined.where("spans is null").select("doc_id", F.lit(0).cast("bigint").alias("n_spans"), "text")

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        def f(ids: list[int], texts: list[str | None], cuts: list[Any]) -> Iterator[tuple[Any, ...]]:
            for i, text, cut in zip(ids, texts, cuts, strict=True):
                yield i, len(cut or []), text if not cut or text is None else without(text, [(s["first_word"], s["n_words"]) for s in cut])

        return f

    return map_rows(joined, ["doc_id", "text", "spans"], "doc_id bigint, n_spans bigint, text string", make)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given spans of (first word, words)."""
    at, inside, bounds = -1, False, []
    for p, ch in enumerate(text):
        folded = WORDS[ord(ch)]
        if folded == " ":
            inside = False
        elif folded:
            if not inside:
                at, inside = at + 1, True
                bounds.append([p, p + 1])
            bounds[-1][1] = p + 1
    out, last = [], 0
    for first, n in sorted(spans):
        a, b = bounds[first][0], bounds[first + n - 1][1]
        if a > last:
            out.append(text[last:a])
        last = max(last, b)
    return "".join([*out, text[last:]])


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return found(documents(spark, d), table(spark, d, "benchmark"))


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    return report(documents(spark, d), table(spark, d, "benchmark"))


def p8_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return decontaminated(documents(spark, d), table(spark, d, "benchmark"))
