"""Problem 2: missing or wrong document language labels.

A byte convolutional network (multi-width filters, max pooling over positions, softmax) is trained here in numpy on
windows of labelled text and applied to batched windows of fixed length that cover every line. The labels are the
records' own single-code language lists: noisy, so after a first training the examples the network clearly contradicts
are left out and it is trained again. The sample is bounded: SAMPLE_DOCUMENTS labelled documents with the least hashes of
all, at most DOCUMENT_WINDOWS windows of each, also by least hash over all its lines, and MOST_WINDOWS of each script.
Everything else covers all rows. Prediction is one narrow pass; only per-document results meet the manifest.
"""

from __future__ import annotations

import io
import re
import warnings
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.llm.common import documents, map_rows, table

LANGUAGES = ("ell", "eng", "deu", "fra", "bul", "tur")
CODES = (*LANGUAGES, "none")
WINDOW = 128
MIN_LETTERS = 40
SAMPLE_DOCUMENTS = 8000
#: Windows of one document that may be examples.
DOCUMENT_WINDOWS = 12
#: Training windows of each script at most, and of no language.
MOST_WINDOWS = {"other": 9000, "greek": 2500, "cyrillic": 1500, "none": 1500}
EMBEDDING, FILTERS, WIDTHS = 12, 16, (2, 3, 4)
EPOCHS, BATCH, RATE, SEED = 4, 64, 0.004, 7
#: Letters of a line that may be an example.
LEAST_LETTERS = 20
#: A line whose letters are a smaller part of its visible characters is an example of no language.
LETTER_SHARE = 0.7
_OTHER = re.compile(r"[\W\d_]+")
_GREEK = re.compile("[\u0370-\u03ff\u1f00-\u1fff]")
_CYRILLIC = re.compile("[\u0400-\u04ff]")


def n_letters(line: str) -> int:
    return len(_OTHER.sub("", line))


def windows(line: str) -> np.ndarray:
    """The bytes of a line in windows of fixed length that cover all of it; the last ends with the line, a short one is padded."""
    raw = np.frombuffer(" ".join(line.split()).encode("utf-8", "replace"), np.uint8)
    n = len(raw)
    if n <= WINDOW:
        out = np.zeros((1, WINDOW), np.uint8)
        out[0, :n] = raw
        return out
    starts = list(range(0, n - WINDOW + 1, WINDOW))
    if starts[-1] + WINDOW < n:
        starts.append(n - WINDOW)
    return raw[np.array(starts)[:, None] + np.arange(WINDOW)]


class Network:
    """Embedding of bytes -> convolutions of several widths -> max over positions -> ReLU -> softmax."""

    def __init__(self, seed: int = SEED) -> None:
        r = np.random.default_rng(seed)
        self.p = {"emb": r.normal(0, 0.3, (256, EMBEDDING)), "out": r.normal(0, 0.1, (FILTERS * len(WIDTHS), len(CODES))), "bias": np.zeros(len(CODES))}
        for w in WIDTHS:
            self.p[f"w{w}"] = r.normal(0, (1 / (w * EMBEDDING)) ** 0.5, (w * EMBEDDING, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _step(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, g = self.p, {}
        e = p["emb"][x]
        pooled, kept = [], []
        for w in WIDTHS:
            n = WINDOW - w + 1
            cols = np.concatenate([e[:, k : k + n] for k in range(w)], axis=2)
            conv = cols @ p[f"w{w}"] + p[f"b{w}"]
            at = conv.argmax(1)
            top = np.take_along_axis(conv, at[:, None], 1)[:, 0]
            pooled.append(np.maximum(top, 0))
            kept.append((cols, at, top > 0))
        h = np.concatenate(pooled, 1)
        prob = _softmax(h @ p["out"] + p["bias"])
        d = prob
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        g["out"], g["bias"] = h.T @ d, d.sum(0)
        dh = d @ p["out"].T
        rows = np.arange(len(y))[:, None]
        g["emb"] = np.zeros_like(p["emb"])
        for j, (w, (cols, at, on)) in enumerate(zip(WIDTHS, kept, strict=True)):
            dt = dh[:, j * FILTERS : (j + 1) * FILTERS] * on
            picked = cols[rows, at]  # (batch, filter, width * embedding)
            g[f"w{w}"] = np.einsum("bfi,bf->if", picked, dt)
            g[f"b{w}"] = dt.sum(0)
            back = dt[:, :, None] * p[f"w{w}"].T[None]
            # Only the bytes at the maxima have a part in the result.
            for k in range(w):
                np.add.at(g["emb"], x[rows, at + k], back[:, :, k * EMBEDDING : (k + 1) * EMBEDDING])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Network:
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        t = 0
        for epoch in range(epochs):
            order = r.permutation(len(y))
            for at in range(0, len(y), BATCH):
                b = order[at : at + BATCH]
                t += 1
                rate = RATE * (1 - 0.8 * epoch / epochs)
                for k, g in self._step(x[b], y[b]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.999 * v2[k] + 0.001 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v2[k] / (1 - 0.999**t)) + 1e-7)).astype(np.float32)
        return self

    def prepared(self) -> Predictor:
        return Predictor(self.p)

    def saved(self) -> bytes:
        """The weights as a file, for use on other corpora."""
        out = io.BytesIO()
        np.savez_compressed(out, **self.p)
        return out.getvalue()

    @classmethod
    def loaded(cls, data: bytes) -> Network:
        own = cls()
        with np.load(io.BytesIO(data)) as f:
            own.p = {k: f[k] for k in own.p}
        return own


class Predictor:
    """The network for prediction: embedding and filters are folded into one table row a byte pair or byte, so that a
    convolution is a look-up and at most one addition; small batches keep the sums in the processor's cache."""

    def __init__(self, p: dict[str, np.ndarray]) -> None:
        self.p = p
        self.tables: dict[int, list[np.ndarray]] = {}
        for w in WIDTHS:
            one = [p["emb"] @ p[f"w{w}"][k * EMBEDDING : (k + 1) * EMBEDDING] for k in range(w)]
            pairs = [(a[:, None] + b[None]).reshape(-1, FILTERS) for a, b in zip(one[0::2], one[1::2], strict=False)]
            self.tables[w] = [np.ascontiguousarray(t, np.float32) for t in (*pairs, *one[len(pairs) * 2 :])]

    def __call__(self, x: np.ndarray, each: int = 32) -> np.ndarray:
        """Probabilities (windows, codes)."""
        out = np.empty((len(x), len(CODES)), np.float32)
        for a in range(0, len(x), each):
            part = x[a : a + each].astype(np.intp)
            pair = part[:, :-1] * 256 + part[:, 1:]
            pooled = []
            for w in WIDTHS:
                n = WINDOW - w + 1
                s = None
                for j, t in enumerate(self.tables[w]):
                    got = t.take(pair[:, 2 * j : 2 * j + n] if len(t) > 256 else part[:, w - 1 : w - 1 + n], axis=0)
                    s = got if s is None else np.add(s, got, out=s)
                pooled.append(np.maximum(s.max(1) + self.p[f"b{w}"], 0))
            out[a : a + each] = _softmax(np.concatenate(pooled, 1) @ self.p["out"] + self.p["bias"])
        return out


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def listed(manifest: DataFrame) -> DataFrame:
    """One row a record: warc_filename, warc_record_offset, codes (empty, null and `und` list nothing)."""
    codes = F.flatten(F.collect_set(F.split(F.regexp_replace(F.lower(F.coalesce("content_languages", F.lit(""))), "\\s+", ""), ",")))
    one = manifest.groupBy("warc_filename", "warc_record_offset").agg(codes.alias("codes"))
    return one.withColumn("codes", F.array_distinct(F.filter("codes", lambda c: (c != "") & (c != "und"))))


def labelled_windows(docs: DataFrame, manifest: DataFrame, size: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """(place, script, label, window) of the `size` documents with a single known code whose hashes are least.

    The records are chosen without their texts. All lines of a chosen document are read; DOCUMENT_WINDOWS of its windows
    with the least hashes are taken. Never empty while any such document has a line with enough letters.
    """
    single = listed(manifest).where((F.size("codes") == 1) & F.col("codes")[0].isin(*LANGUAGES)).select("warc_filename", "warc_record_offset", F.col("codes")[0].alias("label"))
    keys = docs.where("text is not null and doc_id is not null").select("doc_id", "warc_filename", "warc_record_offset").join(single, ["warc_filename", "warc_record_offset"])
    chosen = keys.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(size).select("doc_id", "label")
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # `size` rows of two short columns

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        def f(ids: list[int], labels: list[str], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, label, text in zip(ids, labels, texts, strict=True):
                found: dict[int, tuple[str, str, bytes]] = {}
                for line in (text or "").split("\n"):
                    k = n_letters(line)
                    if k < LEAST_LETTERS:
                        continue
                    odd = k < LETTER_SHARE * len("".join(line.split()))
                    kind = "none" if odd else script(line)
                    for w in windows(line):
                        raw = w.tobytes()
                        found[xxhash.xxh3_64_intdigest(raw, SEED ^ (i & 0xFFFFFFFF)) - (1 << 63)] = (kind, "none" if odd else label, raw)
                        if len(found) > 64 * DOCUMENT_WINDOWS:
                            found = dict(sorted(found.items())[:DOCUMENT_WINDOWS])
                for place, example in sorted(found.items())[:DOCUMENT_WINDOWS]:
                    yield place, *example

        return f

    return map_rows(picked, ["doc_id", "label", "text"], "place bigint, script string, label string, window binary", make)


def script(line: str) -> str:
    """The script of most letters: Greek, Cyrillic or other."""
    greek = len(_GREEK.findall(line))
    cyrillic = len(_CYRILLIC.findall(line))
    return max((greek, "greek"), (cyrillic, "cyrillic"), (n_letters(line) - greek - cyrillic, "other"))[1]


def examples(found: DataFrame, most: dict[str, int] = MOST_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """Windows and labels, at most so many of each script, by least hash. Within a script labels keep their proportions, as
    wrong labels are a minority there, while over all scripts rare ones would vanish."""
    limit = F.create_map(*[F.lit(x) for kv in most.items() for x in kv])[F.col("script")]
    k = F.row_number().over(Window.partitionBy("script").orderBy("place", "label", "window"))  # of a bounded sample
    rows = found.withColumn("k", k).where(F.col("k") <= limit).select("place", "label", "window").collect()
    rows.sort()
    if not rows:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64)
    return np.stack([np.frombuffer(bytes(r["window"]), np.uint8) for r in rows]), np.array([CODES.index(r["label"]) for r in rows], np.int64)


def train(x: np.ndarray, y: np.ndarray) -> Network | None:
    """Train, leave out the examples that the network contradicts, train again. None without an example."""
    if not len(y):
        return None
    first = Network().fit(x, y, 3)
    p = first.prepared()(x)
    keep = p[np.arange(len(y)), y] >= 0.35
    if len(set(y[keep])) < len(set(y)):
        keep = np.ones(len(y), bool)
    return first.fit(x[keep], y[keep], EPOCHS)


LINE_SCHEMA = "doc_id bigint, warc_filename string, warc_record_offset bigint, line_no bigint, lang_code string, confidence double, letters bigint"


def labelled_lines(docs: DataFrame, network: Network | None, min_letters: int = MIN_LETTERS) -> DataFrame:
    """Every line with enough letters: its language (or none) and confidence. Null and empty texts have no lines.

    Without a network, as nothing was labelled, every such line is `none` with confidence 0.
    """
    held = docs.sparkSession.sparkContext.broadcast(network.p if network else None)

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        p = held.value
        unknown = np.eye(len(CODES), dtype=np.float32)[-1:]
        predict = Predictor(p) if p else lambda x: np.repeat(unknown, len(x), 0)

        def f(ids: list[int], files: list[str | None], offsets: list[int | None], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            keys, parts = [], []

            def flush() -> Iterator[tuple[Any, ...]]:
                if not keys:
                    return
                prob = predict(np.concatenate(parts))
                a = 0
                for (i, file, offset, k, letters), w in zip(keys, parts, strict=True):
                    mean = prob[a : a + len(w)].mean(0) if len(w) > 1 else prob[a]
                    a += len(w)
                    best = int(mean.argmax())
                    yield i, file, offset, k, CODES[best], float(mean[best]) if p else 0.0, letters
                keys.clear()
                parts.clear()

            waiting = 0
            for i, file, offset, text in zip(ids, files, offsets, texts, strict=True):
                for k, line in enumerate((text or "").split("\n"), 1):
                    if len(line) >= min_letters and (letters := n_letters(line)) >= min_letters:
                        w = windows(line)
                        keys.append((i, file, offset, k, letters))
                        parts.append(w)
                        waiting += len(w)
                if waiting >= 2048:
                    yield from flush()
                    waiting = 0
            yield from flush()

        return f

    return map_rows(docs, ["doc_id", "warc_filename", "warc_record_offset", "text"], LINE_SCHEMA, make)


def fitted(docs: DataFrame, manifest: DataFrame) -> Network | None:
    """The network trained on the corpus's own labels; None, with a warning, if no document has a single known label."""
    network = train(*examples(labelled_windows(docs, manifest)))
    if network is None:
        warnings.warn("no labelled document to train on; every line stays without a language", stacklevel=2)
    return network


def document_languages(lines: DataFrame) -> DataFrame:
    """(doc_id, record, lang_code): lines, letters and mean confidence weighted by letters."""
    return lines.where("lang_code <> 'none'").groupBy("doc_id", "warc_filename", "warc_record_offset", "lang_code").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("letters").alias("letters"), (F.sum(F.col("confidence") * F.col("letters")) / F.sum("letters")).alias("confidence"), F.max("confidence").alias("best"))


def unlisted(docs: DataFrame, manifest: DataFrame, network: Network, least: float = 0.6) -> DataFrame:
    """(doc_id, lang_code) of languages that a document holds and its record does not list."""
    have = document_languages(labelled_lines(docs, network)).where(F.col("best") >= least)
    met = have.join(listed(manifest), ["warc_filename", "warc_record_offset"], "left")
    return met.where(F.col("codes").isNull() | ~F.expr("array_contains(codes, lang_code)")).select("doc_id", "lang_code").distinct()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    docs, manifest = documents(spark, d), table(spark, d, "manifest")
    return unlisted(docs, manifest, fitted(docs, manifest))


def p2_documents(spark: SparkSession, d: str) -> DataFrame:
    """Each document's main language with its confidence and its share of the letters of lines with a language."""
    docs, manifest = documents(spark, d), table(spark, d, "manifest")
    own = document_languages(labelled_lines(docs, fitted(docs, manifest)))
    by = own.groupBy("doc_id").agg(F.max_by(F.struct("lang_code", "confidence", "letters"), F.struct("letters", "lang_code")).alias("top"), F.sum("letters").alias("all"), F.count(F.lit(1)).alias("n_languages"))
    return docs.select("doc_id").join(by, "doc_id", "left").select("doc_id", F.coalesce("top.lang_code", F.lit("und")).alias("lang_code"), F.round(F.coalesce("top.confidence", F.lit(0.0)), 4).alias("confidence"), F.round(F.coalesce(F.col("top.letters") / F.col("all"), F.lit(0.0)), 4).alias("letter_share"), F.coalesce("n_languages", F.lit(0)).alias("n_languages"))


def p2_segments(spark: SparkSession, d: str) -> DataFrame:
    """Runs of neighbouring long lines in one language: doc_id, first and last line, language, confidence."""
    docs, manifest = documents(spark, d), table(spark, d, "manifest")
    lines = labelled_lines(docs, fitted(docs, manifest))
    w = Window.partitionBy("doc_id").orderBy("line_no")
    new = F.coalesce((F.lag("lang_code").over(w) != F.col("lang_code")).cast("int"), F.lit(1))
    run = lines.withColumn("new", new).withColumn("segment", F.sum("new").over(w))
    return run.groupBy("doc_id", "segment").agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), F.first("lang_code").alias("lang_code"), F.round(F.avg("confidence"), 4).alias("confidence"), F.sum("letters").alias("letters"))
