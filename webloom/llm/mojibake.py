"""Problem 7: garbled text from wrong character encoding.

Adjacent character pairs are counted once a document over the whole corpus; a pair's weight is how far its contribution
to the mutual information of neighbours lies below a threshold, so pairs of one damaged document in a hundred are
improbable although their characters always go together. So that a fault of one site or one source stays improbable
however much it holds, pairs beyond ASCII count as if the group of sites or the source that has most of them were left
out. Maximum-scoring segments of these weights isolate improbable
runs, and inverse mappings (read back in the wrong encoding, decode in the right one) are tested only inside those runs
and kept where the corpus finds the result clearly more probable. Replacement characters are damage that cannot be undone.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import documents, fold_tasks, map_rows

CLASSES = 2048
PAIRS = CLASSES * CLASSES
#: Pairs that a task holds before it sums them up, and sums that it holds before it gives them out.
EVENTS = 4_000_000
#: A pair whose contribution to mutual information (p times PMI, nats) is below this is improbable.
THRESHOLD = 2e-4
#: Pairs below this share of all (document, pair) events need not be known; so at most 1 / LEAST pairs reach the driver.
LEAST = 2e-6
#: Sites and sources are counted in so many groups each; one that holds over HALF of all is no exception but the corpus.
GROUPS = 32
HALF = 0.5
SEGMENT_SCORE = 1.5
DROP = 6.0
#: Nats a decoded pair must gain on average over the run as it stands.
GAIN = 0.8
LOST = "�"

#: Encodings text may wrongly have been read in, and encodings it may really have been in.
READ_AS = ("cp1253", "cp1252", "latin-1", "iso8859-7", "cp1251")
WAS = ("utf-8", "cp1253", "iso8859-7")


def classes(text: str) -> np.ndarray:
    a = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16).astype(np.int32)
    return np.where(a < 1536, a, 1536 + (a & 511))


def pair_counts(docs: DataFrame) -> DataFrame:
    """(part, pair, n): documents in which each pair of neighbouring characters stands, by group of sites (part below GROUPS) and of sources.

    Counted in tasks, then summed; a task gives one row a group and pair, unless it holds more than EVENTS of them.
    """
    groups = [F.pmod(F.xxhash64(c), F.lit(GROUPS)).cast("int").alias(f"by_{c}") for c in ("url_host_registered_domain", "source")]

    def make() -> tuple[Callable[..., bool], Callable[[], Iterator[tuple[int, int, int]]]]:
        waiting: list[np.ndarray] = []  # keys, one an event
        summed: list[tuple[np.ndarray, np.ndarray]] = []  # keys in order, counts
        held = 0

        def settle() -> None:
            nonlocal held
            keys = np.concatenate([*waiting, *[k for k, _ in summed]])
            n = np.concatenate([np.ones(sum(map(len, waiting)), np.int64), *[n for _, n in summed]])
            keys, at = np.unique(keys, return_inverse=True)
            summed[:] = [(keys, np.bincount(at, n, len(keys)).astype(np.int64))]
            waiting.clear()
            held = 0

        def add(texts: list[str | None], sites: list[int], sources: list[int]) -> bool:
            nonlocal held
            for text, site, source in zip(texts, sites, sources, strict=True):
                if text and len(text) > 1:
                    c = classes(text)
                    at = np.unique(c[:-1] * CLASSES + c[1:]).astype(np.int64)
                    waiting.extend((at + site * PAIRS, at + (GROUPS + source) * PAIRS))
                    held += 2 * len(at)
            if held > EVENTS:
                settle()
            return bool(summed) and len(summed[0][0]) > EVENTS

        def drain() -> Iterator[tuple[int, int, int]]:
            if waiting:
                settle()
            for keys, n in summed:
                yield from zip((keys // PAIRS).tolist(), (keys % PAIRS).tolist(), n.tolist(), strict=True)
            summed.clear()

        return add, drain

    spread = docs.select("text", *groups)
    return fold_tasks(spread, spread.columns, "part int, pair int, n bigint", make).groupBy("part", "pair").agg(F.sum("n").alias("n"))


class Model:
    """Weights and log probabilities of character pairs, from (pair, n, n without the group that has most) arrays."""

    def __init__(self, pairs: np.ndarray, n: np.ndarray, rest: np.ndarray, total: int, left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD) -> None:
        p = n / max(total, 1)
        pmi = np.log(np.maximum(p, 1e-12) / np.maximum(left[pairs // CLASSES] * right[pairs % CLASSES] / max(total, 1) ** 2, 1e-12))
        self.floor = float(np.log(1e-7))
        self.logp = np.full(CLASSES * CLASSES, self.floor, np.float32)
        self.logp[pairs] = np.log(np.maximum(p, 1e-7))
        #: What text of the corpus has at least on average: each pair counts once a document, so rare ones weigh more.
        self.usual = float((n * self.logp[pairs]).sum() / max(n.sum(), 1))
        beyond = (pairs // CLASSES >= 128) & (pairs % CLASSES >= 128)
        p_rest = np.where(beyond, np.minimum(n, rest), n) / max(total, 1)
        self.elsewhere = np.full(CLASSES * CLASSES, self.floor, np.float32)
        self.elsewhere[pairs] = np.log(np.maximum(p_rest, 1e-7))
        self.weight = self._weights(pairs, p_rest, pmi, threshold)
        self.narrow = self._weights(pairs, p, pmi, threshold)
        self.seen: dict[str, str | None] = {}

    @staticmethod
    def _weights(pairs: np.ndarray, p: np.ndarray, pmi: np.ndarray, threshold: float) -> np.ndarray:
        weight = np.full(CLASSES * CLASSES, 3.0, np.float32)
        weight[pairs] = np.clip(np.log(threshold / np.maximum(p * np.maximum(pmi, 0.5), 1e-12)), -4, 3)
        square = weight.reshape(CLASSES, CLASSES)
        square[:128, :128] = np.minimum(square[:128, :128], -0.5)  # no wrong reading gives plain ASCII pairs
        return weight

    def pairs(self, text: str) -> np.ndarray:
        c = classes(text)
        return c[:-1] * CLASSES + c[1:]

    def mean(self, text: str) -> float:
        return float(self.logp[self.pairs(f" {text} ")].mean())

    def gains(self, now: str, candidate: str, was: str) -> bool:
        """Whether the candidate is clearly more probable, in the corpus or without the group that has most of a pair.

        The second must also give usual text: what only one site writes is improbable elsewhere without being damage.
        """
        usual = self.mean(candidate) >= self.usual
        for logp in (self.logp, self.elsewhere) if usual else (self.logp,):
            a, b = logp[self.pairs(f" {now} ")], logp[self.pairs(f" {candidate} ")]
            gain = float(b.mean()) - float(a.mean())
            # Fewer characters must not count as an improvement by themselves, nor one lucky pair in a long run.
            if gain >= GAIN or (was == "utf-8" and gain > 0 and float(b.sum()) - float(a.sum()) >= 6):
                return True
        return False


def segments(weights: list[float], drop: float = DROP, least: float = SEGMENT_SCORE) -> list[tuple[int, int]]:
    """Maximum-scoring segments [a, b): a segment ends where the running sum falls `drop` below its peak or to zero."""
    out: list[tuple[int, int]] = []
    total = peak = 0.0
    start = end = 0
    for i, w in enumerate(weights):
        if total <= 0:
            if w <= 0:
                continue
            total = peak = 0.0
            start = i
        total += w
        if total > peak:
            peak, end = total, i + 1
        if total <= 0 or total < peak - drop:
            if peak >= least:
                out.append((start, end))
            total = 0.0
            peak = 0.0
    if total > 0 and peak >= least:
        out.append((start, end))
    return out


class _Bytes(dict):
    """Character -> the byte it was read from; bytes an encoding leaves undefined stand for themselves, as browsers read them."""

    def __init__(self, encoding: str) -> None:
        super().__init__({b: b for b in range(256)} if encoding == "latin-1" else {b: b for b in range(0x80, 0xA0)})
        for b in range(256):
            try:
                self[ord(bytes([b]).decode(encoding))] = b
            except UnicodeDecodeError:
                self.setdefault(b, b)

    def __missing__(self, cp: int) -> int:
        self[cp] = 0x100
        return 0x100


_BYTES = {e: _Bytes(e) for e in READ_AS}
_HIGH = re.compile("[\x80-\xff]")
_UTF8 = re.compile("[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}|\xce(?= )")


def invert(text: str, read_as: str, was: str) -> str | None:
    """The text as it would have been, had it been read in `was`; None where too little of it fits."""
    raw = text.translate(_BYTES[read_as])
    if not _HIGH.search(raw):
        return None
    if was == "utf-8":
        fits = 0

        def decode(m: re.Match[str]) -> str:
            nonlocal fits
            s = m[0]
            fits += len(s)
            if s == "\xce":
                return "Π"
            try:
                return s.encode("latin-1").decode("utf-8")
            except UnicodeDecodeError:
                fits -= len(s)
                return s

        out, last = [], 0
        for m in _UTF8.finditer(raw):
            if m.start() > last:
                out.append(text[last : m.start()])
            out.append(decode(m))
            last = m.end()
        out.append(text[last:])
        return "".join(out) if fits else None
    if "Ā" in raw:
        return None
    try:
        out_text = raw.encode("latin-1").decode(was)
    except UnicodeDecodeError:
        return None
    letters = [c for c in out_text if c.isalpha() and c > "\x7f"]
    greek = sum("Ͱ" <= c <= "Ͽ" for c in letters)
    return out_text if greek >= 2 and greek >= 0.9 * len(letters) else None


def _runs(text: str, weights: np.ndarray) -> list[tuple[int, int]]:
    """Improbable runs of whole words."""
    runs: list[tuple[int, int]] = []
    if (weights > 0).any():
        for a, b in segments(weights.tolist()):
            a, b = max(a - 1, 0), min(b, len(text))  # pair i of the padded text ends at character i of the text
            while a > 0 and not text[a - 1].isspace():
                a -= 1
            while b < len(text) and not text[b].isspace():
                b += 1
            if runs and a <= runs[-1][1]:
                runs[-1] = (runs[-1][0], max(b, runs[-1][1]))
            else:
                runs.append((a, b))
    return runs


def repair(text: str, model: Model, depth: int = 3) -> tuple[str, list[tuple[int, int]], bool]:
    """(restored text, damaged runs of the given text, all restored)."""
    if not text:
        return text, [], True
    found: list[tuple[int, int, str]] = []
    if len(text) > 1:
        at = model.pairs(f" {text} ")
        wide = _runs(text, model.weight[at])
        # A run that no mapping fits may hold shorter ones that are improbable in the whole corpus.
        for runs in (wide, [r for r in _runs(text, model.narrow[at]) if r not in wide]) if wide else ():
            held = list(found)
            for a, b in runs:
                if any(a < y and x < b for x, y, _ in held):
                    continue
                run = text[a:b]
                if len(run) > 40:
                    best = _best(run, model, depth)
                elif run in model.seen:
                    best = model.seen[run]
                else:
                    if len(model.seen) > 100_000:
                        model.seen.clear()
                    best = model.seen[run] = _best(run, model, depth)
                if best is not None:
                    found.append((a, b, best))
    out, last, damaged, whole = [], 0, [], True
    for a, b, best in sorted(found):
        out += [text[last:a], best]
        last = b
        damaged.append((a, b))
    fixed = "".join([*out, text[last:]])
    if LOST in fixed:
        whole = False
        damaged += [(m.start(), m.end()) for m in re.finditer(f"{LOST}+", text)]
    return fixed, damaged, whole


def _best(run: str, model: Model, depth: int) -> str | None:
    """The most probable inverse mapping of a run, repeated while it gains; None if none gains enough."""
    now, changed = run, False
    for _ in range(depth):
        base = model.mean(now)
        options = []
        for read_as in READ_AS:
            for was in WAS:
                if read_as == was:
                    continue
                candidate = invert(now, read_as, was)
                if candidate is not None and candidate != now and model.gains(now, candidate, was):
                    options.append((model.mean(candidate), candidate))
        if not options:
            # Twice-read text may gain nothing in its first step.
            twice = [y for r in ("cp1252", "latin-1") if not changed and (x := invert(now, r, "utf-8")) and x != now for r2 in ("cp1252", "latin-1", "cp1253") if (y := invert(x, r2, "utf-8")) and y != x and model.mean(y) - base >= GAIN]
            if not twice:
                break
            options = [(model.mean(y), y) for y in twice]
        now, changed = max(options)[1], True
    return now if changed else None


def build(docs: DataFrame) -> tuple[np.ndarray, ...]:
    """What Model needs: pairs, counts, counts without the group that has most, total and marginal counts, all over the whole corpus."""
    parts = pair_counts(docs).persist()
    share = {r.part: r.n for r in parts.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    total = sum(n for part, n in share.items() if part < GROUPS)
    # An evenly spread pair has (n - own) / (1 - share) = n.
    others = F.create_map(*[F.lit(x) for part, n in share.items() for x in (part, 1 - n / max(total, 1))]) if share else F.lit(None)
    pair = parts.groupBy("pair").agg(F.sum(F.when(F.col("part") < GROUPS, F.col("n"))).alias("n"), F.collect_list(F.struct("part", F.col("n").alias("own"))).alias("by"))
    without = F.transform("by", lambda x: F.when(others[x["part"]] >= HALF, (F.col("n") - x["own"]) / others[x["part"]]) if share else F.lit(None).cast("double"))
    counts = pair.select("pair", "n", F.coalesce(F.array_min(without), F.col("n")).alias("rest")).persist()
    left, right = np.zeros(CLASSES), np.zeros(CLASSES)
    for side, col in ((left, F.floor(F.col("pair") / CLASSES)), (right, F.col("pair") % CLASSES)):
        for r in counts.groupBy(col.alias("c")).agg(F.sum("n").alias("n")).collect():
            side[int(r[0])] = r[1]
    kept = counts.where(F.col("n") >= max(1.0, LEAST * total)).toPandas()
    counts.unpersist()
    parts.unpersist()
    return kept["pair"].to_numpy(np.int64), kept["n"].to_numpy(np.float64), kept["rest"].to_numpy(np.float64), total, left, right


LINE = "doc_id bigint, line_no bigint, damaged string, restored string, complete boolean"


def damaged_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row a damaged line: doc_id, line_no, the line, the restored line and whether nothing stays lost.

    Null and empty texts have no lines; lines are independent of each other, however long.
    """
    parts = docs.sparkSession.sparkContext.broadcast(build(docs))

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        model = Model(*parts.value, threshold=threshold)

        def f(ids: list[int], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, text in zip(ids, texts, strict=True):
                if not text:
                    continue
                gained = np.concatenate(([0.0], np.cumsum(np.maximum(model.weight[model.pairs(f"\n{text}\n")], 0.0))))
                if gained[-1] < SEGMENT_SCORE and LOST not in text:
                    continue
                start = 0
                for k, line in enumerate(text.split("\n"), 1):
                    # Pairs that touch the line; the sum of what is improbable in them bounds every segment's score.
                    if gained[min(start + len(line) + 1, len(gained) - 1)] - gained[start] >= SEGMENT_SCORE - 1e-3 or LOST in line:
                        fixed, runs, whole = repair(line, model)
                        if runs:
                            yield i, k, line, fixed, whole
                    start += len(line) + 1

        return f

    return map_rows(docs, ["doc_id", "text"], LINE, make)


def restored(docs: DataFrame) -> DataFrame:
    """Every document with damaged lines put right: doc_id, n_damaged, n_lost, text."""
    parts = docs.sparkSession.sparkContext.broadcast(build(docs))

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        model = Model(*parts.value)

        def f(ids: list[int], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, text in zip(ids, texts, strict=True):
                n = lost = 0
                if text and (LOST in text or (model.weight[model.pairs(f"\n{text}\n")] > 0).any()):
                    lines = text.split("\n")
                    for k, line in enumerate(lines):
                        lines[k], runs, whole = repair(line, model)
                        n += bool(runs)
                        lost += bool(runs) and not whole
                    text = "\n".join(lines)
                yield i, n, lost, text

        return f

    return map_rows(docs, ["doc_id", "text"], "doc_id bigint, n_damaged bigint, n_lost bigint, text string", make)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return damaged_lines(documents(spark, d)).select("doc_id", "line_no")


def p7_lines(spark: SparkSession, d: str) -> DataFrame:
    return damaged_lines(documents(spark, d))


def p7_restored(spark: SparkSession, d: str) -> DataFrame:
    return restored(documents(spark, d))
