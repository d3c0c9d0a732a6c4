"""Problem 3: repetition inside a single document.

Compression bands. A document is turned into one code of 8 bytes a run of five words; codes look random, so zstandard can
save nothing on a new run and saves some bytes on each run that has begun before. The ratio over the whole document
decides: above a limit that depends on its length a third of the words cannot stand in repeated runs (see `limit`), at or
below it the share is measured exactly. Ratios of the folded text, over the whole document and over fixed chunks, tell
incompressible text by limits that depend on length too. Everything happens in one narrow pass; nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import documents, map_rows, words

CHUNK_BYTES = 2048
RUN = 5
#: A document is repetitive if this many times its repeated words are at least its words.
PARTS = 3
CODE_BYTES = 8
#: Bytes saved at least on a code that stood before: a match of 8 bytes costs at most 6.
SAVED = 2
#: Bytes of headers and tables at most, once and for each block.
OVERHEAD, BLOCK_OVERHEAD, BLOCK = 60, 4, 1 << 17
#: A block that would save less than this part is stored as it is.
RAW = 1 / 64
#: The largest window; a longer document is measured without the bands.
WINDOW_LOG = 27
#: (bytes of folded text up to, ratio that is incompressible at or above it).
INCOMPRESSIBLE = [(150, 1.2), (400, 1.1), (1000, 0.95), (3000, 0.9), (10_000, 0.85), (math.inf, 0.8)]


def limit(n: int) -> float:
    """The largest ratio that n codes can have if a third of the words stand in repeated runs.

    A word is in at most five runs, so at least a fifteenth of the codes stood before, and each saves SAVED bytes or more,
    but for blocks that save so little that they are stored raw. The search inserts every position into a tree over the
    whole document, so that no code that stood before is missed. Infinite where headers may outweigh what is saved and
    beyond the window: such documents are always measured.
    """
    size = n * CODE_BYTES
    blocks = -(-size // BLOCK)
    if size > 1 << WINDOW_LOG or SAVED * n / (RUN * PARTS) <= OVERHEAD:
        return math.inf
    lost = RAW * size if blocks > 1 else 0
    return (size - SAVED * n / (RUN * PARTS) + OVERHEAD + BLOCK_OVERHEAD * blocks + lost) / size


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_codes(ids: np.ndarray, run: int = RUN) -> np.ndarray:
    """A code for each run of `run` words (given by numbers); equal runs have equal codes."""
    n = max(len(ids) - run + 1, 0)
    each = _mixed(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros(n, np.uint64)
    for k in range(run):
        out = out * np.uint64(0x9FB21C651E98DF25) + each[k : k + n]
    return _mixed(out)


def compressor(size: int) -> zstandard.ZstdCompressor:
    """A compressor that looks at every position of data up to `size` bytes."""
    log = min(max((max(size, 1) - 1).bit_length(), 10), WINDOW_LOG)
    own = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_BTOPT, window_log=log, hash_log=min(max(log - 2, 8), 24), chain_log=min(log + 1, 28), search_log=6, min_match=4, target_length=64, write_content_size=0, write_checksum=0, write_dict_id=0)
    return zstandard.ZstdCompressor(compression_params=own)


def number_words(ws: list[str]) -> np.ndarray:
    number: dict[str, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int64, len(ws))


def ratios(compress: Callable[[bytes], bytes], data: bytes) -> tuple[float, float, float]:
    """Whole ratio, and the least and mean ratio of fixed chunks, the shorter last one with them; (1, 1, 1) of nothing."""
    if not data:
        return 1.0, 1.0, 1.0
    whole = len(compress(data)) / len(data)
    if len(data) <= CHUNK_BYTES:
        return whole, whole, whole
    parts = [data[i : i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES)]
    each = [len(compress(p)) / len(p) for p in parts]
    return whole, min(each), sum(each) / len(each)


def repeated_words(ids: np.ndarray, run: int = RUN) -> int:
    """Words in a run of `run` words that has begun earlier in the list; each counts once, in its later place."""
    n = len(ids) - run + 1
    if n < 2:
        return 0
    # Exact: pairs of run numbers are renumbered, so that equal numbers mean equal runs.
    key, base = ids, int(ids.max()) + 1
    for k in range(1, run):
        key = key[:-1] * base + ids[k:]
        _, key = np.unique(key, return_inverse=True)
    first = np.full(int(key.max()) + 1, n, np.int64)
    np.minimum.at(first, key, np.arange(n))
    again = first[key] < np.arange(n)
    if not again.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + run, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


SCHEMA = "doc_id bigint, n_words bigint, run_ratio double, verdict string, repeated_share double"
BANDS = "doc_id bigint, whole_ratio double, least_chunk_ratio double, mean_chunk_ratio double, incompressible boolean"


def measure(docs: DataFrame, columns: tuple[str, str] = ("doc_id", "text"), every: bool = True) -> DataFrame:
    """One row a document: the ratio of its run codes, verdict (repetitive, normal, empty) and the repeated share.

    `repeated_share` is exact. Without `every` it is null for documents whose ratio is above the limit, which are normal.
    Null and empty texts are `empty` with ratio 1 and share 0; texts below five words have share 0.
    """

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        by_size: dict[int, zstandard.ZstdCompressor] = {}

        def f(ids: list[int], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, text in zip(ids, texts, strict=True):
                ws = words(text)
                if not ws:
                    yield i, 0, 1.0, "empty", 0.0
                    continue
                numbers = number_words(ws)
                codes = run_codes(numbers)
                most, ratio = limit(len(codes)), 1.0
                if len(codes) and len(codes) * CODE_BYTES <= 1 << WINDOW_LOG:
                    data = codes.tobytes()
                    log = (len(data) - 1).bit_length()
                    if log not in by_size:
                        by_size[log] = compressor(1 << log)
                    ratio = len(by_size[log].compress(data)) / len(data)
                if ratio > most and not every:
                    yield i, len(ws), ratio, "normal", None
                    continue
                again = repeated_words(numbers)
                yield i, len(ws), ratio, "repetitive" if ratio <= most and again * PARTS >= len(ws) else "normal", again / len(ws)

        return f

    return map_rows(docs, list(columns), SCHEMA, make)


def bands(docs: DataFrame) -> DataFrame:
    """One row a document: ratios of its folded text as a whole and in chunks, and whether it is incompressible by either.

    Null and empty texts have ratios of 1 and are not incompressible.
    """

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        compress = zstandard.ZstdCompressor(level=3).compress

        def high(n: int) -> float:
            return next(x for top, x in INCOMPRESSIBLE if n <= top)

        def f(ids: list[int], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, text in zip(ids, texts, strict=True):
                data = " ".join(words(text)).encode()
                whole, least, mean = ratios(compress, data)
                yield i, whole, least, mean, bool(data) and (whole >= high(len(data)) or mean >= high(min(len(data), CHUNK_BYTES)))

        return f

    return map_rows(docs, ["doc_id", "text"], BANDS, make)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return measure(documents(spark, d), every=False).where("verdict = 'repetitive'").select("doc_id").distinct()


def p3_shares(spark: SparkSession, d: str) -> DataFrame:
    return measure(documents(spark, d)).select("doc_id", "n_words", F.round("repeated_share", 6).alias("repeated_share"))


def p3_bands(spark: SparkSession, d: str) -> DataFrame:
    return bands(documents(spark, d))
