"""Problem 6: per-document text quality statistics.

Each line becomes one symbol of simple line statistics (share of common words, sentence end, digits, symbols, separators,
marker, length); a hidden Markov model labels it prose, list, table or junk. The model starts from stated beliefs about
each feature and is re-estimated by Baum-Welch on all documents: expected counts are summed in each task, over many
sequences at a time, and a task gives one small table. Labels of all lines are then found by forward-backward and added
up per document. Furniture lines (problem 5) and titles are left aside. Symbols come from the same pass over lines that
finds furniture; only small rows are shuffled, never texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import boilerplate
from webloom.llm.common import documents, fold_tasks, map_rows, plain_words, table
from webloom.session import cut

STATES = ("prose", "list", "table", "junk")
ITERATIONS = 3
#: Weight of the stated beliefs when the model is re-estimated: this part of all lines for each state, whatever the corpus' size.
PRIOR_SHARE = 0.08
#: Cells (lines times sequences) of one batch of sequences.
BATCH_CELLS = 200_000

#: Frequent function words, folded, of the corpus languages and of Greek in Latin letters.
COMMON = frozenset(
    """ο η το οι τα του τησ των τον την τουσ τισ και κι να θα δεν με σε για απο που στο στη στην στον στα στουσ στισ οτι ειναι ενα μια αλλα ομωσ οπωσ ωσ αν οταν καθωσ επειδη ωστε ενω αφου γιατι μασ σασ πριν υπαρχουν ητοι εχει κατω πανω διπλα μαζι μεσα ειπαν
    the a an of to in and or is are was were that which when but with for on at by from not this these there if under before after near all over without why how then given explain
    die der das und ist sind ein eine nicht fur wenn wir es gibt im am an den dem von zu mit nach ohne vor sie auf als bei
    le la les des du de et est sont un une que qui quand nous il y a mais dans sur avec pour sans pres apres avant par
    и са не без на в през че които ние когато всички има край след с за от да но като преди към
    ve bir bu icin ile butun tum vardi ama simdi cok daha gibi bugun arasinda boyunca once sonra olmadan yaninda
    o i h oi ta to tou toy ths tis tin thn tous toys twn ton kai ke na tha den me se gia apo pou poy sto sti stin sthn ston sta stous stoys stis oti einai alla omws otan giati mas sas prin pano panw dipla katw kato mazi exei ehei echei""".split()
)
_MARKER = re.compile(r"^\s*(?:[-–—•·*→☐▪◦>+]|\(?\d{1,3}[.)]\)?|[A-Za-zα-ω][.)])\s+")
_DELIMITERS = re.compile(r"[\t|;]|\s{2,}")
_CODE = re.compile(r"[{}<>=]|\);|\(\)|://")
_LAST = ".!?;…»\"')]"
_END = re.compile(r"[.!?;…][»\"')\]]*$")
_GLUE = ",#/|·"
_SPACED_DASH = re.compile(r"\s-\s")
_MIXED = re.compile(r"[a-zα-ωά-ώ][A-ZΑ-Ω]|[A-Za-z]\d|\d[A-Za-z]")

_DIGIT = re.compile(r"\d")
_ASCII = re.compile("[A-Za-z0-9]")
_DIGIT_TOKEN = re.compile(r"(?<!\S)[^\s\d]*\d")
_MIXED_TOKEN = re.compile(r"(?<!\S)\S*?(?:[a-zα-ωά-ώ][A-ZΑ-Ω]|[A-Za-z]\d|\d[A-Za-z])")
_DASH = re.compile(r"(?<!\S)[-–—|/·&»«>](?!\S)")

#: Features of a line and the belief P(feature | prose, list, table, junk) the model starts from.
FEATURES = {
    "common": (0.97, 0.12, 0.03, 0.04),
    "end": (0.85, 0.06, 0.06, 0.03),
    "digits": (0.02, 0.05, 0.75, 0.25),
    "odd": (0.01, 0.02, 0.05, 0.65),
    "split": (0.01, 0.04, 0.85, 0.12),
    "marker": (0.03, 0.85, 0.03, 0.08),
    "glued": (0.01, 0.03, 0.03, 0.45),
    "long": (0.80, 0.03, 0.08, 0.60),
}
NAMES = tuple(FEATURES)
STAY = 0.9


def line_features(line: str) -> tuple[int, int, int]:
    """(symbol, words, letters and digits): the features of a line as bits, and its words between white space."""
    pieces = line.split()
    n = len(pieces)
    if not n:
        return 0, 0, 0
    plain = plain_words(pieces)
    size = sum(map(len, plain))
    common = sum(map(COMMON.__contains__, plain))
    digits = len(_DIGIT_TOKEN.findall(line)) if _DIGIT.search(line) else 0
    bare = n - len(plain)  # tokens without a letter or digit
    odd = max(bare - len(_DASH.findall(line)), 0) if bare else 0
    if size + n > 14 * len(plain):
        odd += sum(len(w) > 25 for w in plain)
    if _ASCII.search(line) and _MIXED.search(line):
        odd += len(_MIXED_TOKEN.findall(line))
    shown = line.strip()
    # Single spaces alone stand between words: then only these signs can be delimiters.
    spaced = shown.count(" ") + 1 == n
    marks = any(map(line.__contains__, "\t|;"))
    bits = (
        common * 8 >= n and common > 0,
        shown[-1] in _LAST and bool(_END.search(shown)) and (len(plain) - digits) * 2 > n,
        digits * 4 >= n,
        odd * 5 >= n or (any(map(line.__contains__, "{}<>=)/")) and len(_CODE.findall(line)) >= 3),
        ((marks or not spaced) and n > 1 and not common * 5 >= n and len(_DELIMITERS.findall(shown)) * 4 >= n) or "...." in line or "____" in line or "……" in line,
        bool(_MARKER.match(line)),
        n >= 6 and not common * 5 >= n and (sum(map(line.count, _GLUE)) + (len(_SPACED_DASH.findall(line)) if "-" in line else 0)) * 5 >= n,
        n >= 9,
    )
    return sum(1 << i for i, b in enumerate(bits) if b), n, size


class Model:
    """Initial, transition and emission probabilities of the states."""

    def __init__(self) -> None:
        k = len(STATES)
        self.start = np.array([0.85, 0.05, 0.05, 0.05])
        self.move = np.full((k, k), (1 - STAY) / (k - 1))
        np.fill_diagonal(self.move, STAY)
        bits = (np.arange(1 << len(NAMES))[:, None] >> np.arange(len(NAMES))) & 1
        p = np.array([FEATURES[f] for f in NAMES])
        self.emit = np.stack([np.prod(np.where(bits, p[:, s], 1 - p[:, s]), 1) for s in range(k)])

    def posteriors(self, sequences: list[list[int]]) -> tuple[list[np.ndarray], np.ndarray]:
        """Forward-backward: of each sequence the (lines, states) probabilities, and the summed expected transitions.

        Sequences of like length go through together, padded to the longest; an empty one has no lines.
        """
        k = len(STATES)
        out: list[np.ndarray] = [np.zeros((0, k))] * len(sequences)
        pair = np.zeros((k, k))
        order = sorted((i for i, s in enumerate(sequences) if len(s)), key=lambda i: len(sequences[i]))
        a = 0
        while a < len(order):
            b = a + 1
            while b < len(order) and (b - a + 1) * len(sequences[order[b]]) <= BATCH_CELLS and len(sequences[order[b]]) <= 2 * len(sequences[order[a]]) + 8:
                b += 1
            some = order[a:b]
            a = b
            size = np.array([len(sequences[i]) for i in some])
            n = int(size[-1])
            seen = np.arange(n)[:, None] < size[None]
            e = np.ones((n, len(some), k))
            e[seen.T.nonzero()[1], seen.T.nonzero()[0]] = self.emit.T[np.concatenate([np.asarray(sequences[i], np.int64) for i in some])]
            f, back = np.empty_like(e), np.ones_like(e)
            v = self.start * e[0]
            f[0] = v / v.sum(1, keepdims=True)
            for t in range(1, n):
                v = (f[t - 1] @ self.move) * e[t]
                f[t] = np.where(seen[t][:, None], v / v.sum(1, keepdims=True), f[t - 1])
            for t in range(n - 2, -1, -1):
                w = e[t + 1] * back[t + 1]
                on = seen[t + 1]
                # Expected transitions of a step: from i to j in proportion to f_i move_ij w_j.
                total = ((f[t] @ self.move) * w).sum(1)
                pair += self.move * ((f[t] / total[:, None])[on].T @ w[on])
                v = w @ self.move.T
                back[t] = np.where(on[:, None], v / v.sum(1, keepdims=True), 1.0)
            g = f * back
            g /= g.sum(2, keepdims=True)
            for j, i in enumerate(some):
                out[i] = g[: size[j], j]
        return out, pair

    def expected(self, sequences: list[list[int]]) -> np.ndarray:
        """Expected counts of the sequences, flat: emissions, transitions, starts."""
        post, pair = self.posteriors(sequences)
        emit = np.zeros_like(self.emit)
        start = np.zeros(len(STATES))
        whole = [np.asarray(s, np.int64) for s in sequences if len(s)]
        if whole:
            g, at = np.concatenate([p for p in post if len(p)]), np.concatenate(whole)
            for k in range(len(STATES)):
                emit[k] = np.bincount(at, g[:, k], emit.shape[1])
            start = np.sum([p[0] for p in post if len(p)], 0)
        return np.concatenate([emit.ravel(), pair.ravel(), start])

    def updated(self, counts: np.ndarray) -> Model:
        """The model that expected counts and the stated beliefs, with their share of the lines as weight, give."""
        first, own, k = Model(), Model(), len(STATES)
        a, b = first.emit.size, first.emit.size + k * k
        weight = PRIOR_SHARE * max(counts[:a].sum(), 1.0)
        emit, move, start = counts[:a].reshape(first.emit.shape) + first.emit * weight, counts[a:b].reshape(k, k) + first.move * weight, counts[b:] + first.start * (PRIOR_SHARE * max(counts[b:].sum(), 1.0))
        own.emit, own.move, own.start = emit / emit.sum(1, keepdims=True), move / move.sum(1, keepdims=True), start / start.sum()
        return own

    def fit(self, sequences: list[list[int]], iterations: int = ITERATIONS) -> Model:
        """Baum-Welch on sequences at hand; `fitted` does the same over a frame."""
        own = self
        for _ in range(iterations):
            own = own.updated(own.expected(sequences))
        return own


def line_numbers(line: str, raw: str) -> tuple[int, int]:
    """What a line brings to the statistics, as two numbers: words and symbol, visible characters and letters and digits."""
    s, n, letters = line_features(line)
    return n << 8 | s, len("".join(raw.split())) << 32 | letters


BODY = "doc_id bigint, n_words bigint, n_chars bigint, n_letters bigint, n_lines bigint, n_ended bigint, n_common bigint, symbols array<smallint>, words array<int>"


def bodies(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """One row a document: figures of all its lines, and symbol and words of each line of its body.

    Furniture and a title (a first body line without sentence end) are not body. Null and empty texts have no lines.
    """

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        def f(ids: list[int], groups: list[list[dict[str, Any]]]) -> Iterator[tuple[Any, ...]]:
            for i, rows in zip(ids, groups, strict=True):
                gone = set(boilerplate.decide([(r["line_no"], r["full"], r["shape"], r["hit"], r["hit_top"]) for r in rows]))
                lines = sorted((r["line_no"], r["line_a"] & 255, r["line_a"] >> 8) for r in rows if r["line_no"] > 0 and r["line_a"] >> 8)
                body = [(s, n) for k, s, n in lines if k not in gone]
                if len(body) > 1 and not body[0][0] & 0b1111110 and body[0][0] & 1:
                    body = body[1:]
                both = [r["line_b"] for r in rows if r["line_no"] > 0]
                yield i, sum(n for _, _, n in lines), sum(x >> 32 for x in both), sum(x & 0xFFFFFFFF for x in both), len(lines), sum(s >> 1 & 1 for _, s, _ in lines), sum(s & 1 for _, s, _ in lines), [s for s, _ in body], [n for _, n in body]

        return f

    return map_rows(boilerplate.judged(docs, pages, line_numbers), ["doc_id", "rows"], BODY, make)


def fitted(found: DataFrame, iterations: int = ITERATIONS) -> Model:
    """Baum-Welch over all documents: each task sums expected counts, and at most one table's cells reach the driver a round."""
    sc = found.sparkSession.sparkContext
    model = Model()
    size = len(model.expected([]))
    for _ in range(iterations):
        held = sc.broadcast(model)

        def make(held: Any = held) -> tuple[Callable[..., bool], Callable[[], Iterator[tuple[int, float]]]]:
            own, sums = held.value, np.zeros(size)

            def add(sequences: list[list[int]]) -> bool:
                sums[:] += own.expected(sequences)
                return False

            def drain() -> Iterator[tuple[int, float]]:
                at = np.flatnonzero(sums)
                yield from zip(at.tolist(), sums[at].tolist(), strict=True)

            return add, drain

        sums = fold_tasks(found.where(F.size("symbols") > 0), ["symbols"], "cell int, n double", make, each=2048).groupBy("cell").agg(F.sum("n").alias("n")).collect()
        counts = np.zeros(size)
        for r in sums:
            counts[r["cell"]] = r["n"]
        model = model.updated(counts)
    return model


STATS = "doc_id bigint, n_words bigint, mean_word_length double, symbol_ratio double, ended_line_share double, common_line_share double, body_words bigint, prose_share double, list_share double, table_share double, junk_share double"


def statistics(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """One row a document: sizes, ratios, and the shares of its body's words that stand in prose, list, table and junk lines.

    Without body words the shares are 0.
    """
    found = cut(bodies(docs, pages))
    model = found.sparkSession.sparkContext.broadcast(fitted(found))

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        own = model.value

        def f(*columns: list[Any]) -> Iterator[tuple[Any, ...]]:
            post = own.posteriors(columns[7])[0]
            for i, total, chars, letters, lines, ended, common, _, words, p in zip(*columns, post, strict=True):
                n = sum(words)
                share = np.bincount(p.argmax(1), words, len(STATES)) / n if n else np.zeros(len(STATES))
                yield i, total, chars / max(total, 1), max(chars - letters, 0) / max(chars, 1), ended / max(lines, 1), common / max(lines, 1), n, *share.tolist()

        return f

    return map_rows(found, [x.split()[0] for x in BODY.split(", ")], STATS, make, each=2048)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return statistics(documents(spark, d), table(spark, d, "pages")).where("body_words > 0 and list_share + table_share + junk_share > 0.5").select("doc_id")


def p6_statistics(spark: SparkSession, d: str) -> DataFrame:
    return statistics(documents(spark, d), table(spark, d, "pages"))
