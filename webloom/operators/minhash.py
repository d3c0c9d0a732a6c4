"""Near-duplicate removal over a whole crawl: MinHash signatures, bands, components, one document a cluster.

Shingles have 64-bit hashes; a portable form with short hashes is what other engines can compute too. Bands only propose:
by default documents are near-duplicates if their sets of shingles have a Jaccard similarity of SIMILARITY or more.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.arrow import map_rows
from webloom.functions.joins import salted
from webloom.session import cut, small

BANDS, ROWS, SHINGLE, PRIME = 14, 8, 5, (1 << 31) - 1
SIMILARITY = 0.8
#: Odd numbers that spread 64-bit hashes.
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def permutations(n: int = BANDS * ROWS, seed: int = 1) -> list[tuple[int, int]]:
    """(a, b) of h -> (a h + b) mod PRIME, from a seeded generator."""
    r = random.Random(seed)
    return [(r.randrange(1, PRIME), r.randrange(PRIME)) for _ in range(n)]


_WORD = regex.compile(r"[\p{L}\p{N}]+")
_DIGITS = regex.compile(r"\p{Nd}+")
_MARK = str.maketrans("άέήίϊΐόύϋΰώς", "αεηιιιουυυωσ")


def normal_words(text: str | None) -> list[str]:
    """Words in lower case without accents and final sigma, runs of digits as 0."""
    return _WORD.findall(_DIGITS.sub("0", text.lower().translate(_MARK))) if text else []


def shingle_hashes(words: list[str], n: int = SHINGLE) -> np.ndarray:
    """28-bit hashes of the distinct shingles: 7 hexadecimal digits of MD5, which other engines give too."""
    grams = {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}
    return np.fromiter((int(hashlib.md5(g.encode(), usedforsecurity=False).hexdigest()[:7], 16) for g in grams), np.int64, len(grams))


def wide_hashes(words: list[str], n: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the distinct shingles, in order: each different word is hashed once, shingles are mixed from them."""
    m = len(words) - n + 1
    if m < 1:
        return np.zeros(0, np.uint64)
    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * MIX[0] + each[k : k + m]
    out = (out ^ (out >> np.uint64(29))) * MIX[1]
    return np.unique(out ^ (out >> np.uint64(32)))


def minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, each: int = 2048) -> np.ndarray:
    """Least of (a h + b) over the hashes for each (a, b): modulo PRIME for signed, modulo 2^64 for unsigned numbers."""
    wide = hashes.dtype == np.uint64
    out = np.full(len(a), np.iinfo(np.uint64).max if wide else PRIME, hashes.dtype)
    for i in range(0, len(hashes), each):
        mixed = hashes[i : i + each, None] * a + b
        np.minimum(out, (mixed if wide else mixed % PRIME).min(0), out=out)
    return out


def sketches(docs: DataFrame, portable: bool = False) -> DataFrame:
    """(doc_id, sketch, buckets) of documents with at least SHINGLE words: a digest of the set of shingles and one of each band. Narrow."""
    ab = permutations()
    r = random.Random(2)
    wide = [(r.getrandbits(64) | 1, r.getrandbits(64)) for _ in range(BANDS * ROWS)]

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        a, b = (np.array(x, np.int64 if portable else np.uint64) for x in zip(*(ab if portable else wide), strict=True))
        hashes = shingle_hashes if portable else wide_hashes

        def f(ids: list[int], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, text in zip(ids, texts, strict=True):
                h = hashes(normal_words(text))
                if len(h):
                    rows = minima(h, a, b)
                    yield i, xxhash.xxh3_128_digest(np.sort(h).tobytes()), [xxhash.xxh3_128_digest(bytes([k]) + rows[k * ROWS : (k + 1) * ROWS].tobytes()) for k in range(BANDS)]

        return f

    return map_rows(docs, ["doc_id", "text"], "doc_id bigint, sketch binary, buckets array<binary>", make)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, signature) of documents with at least SHINGLE words; narrow."""
    ab = permutations()

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        a, b = (np.array(x, np.int64) for x in zip(*ab, strict=True))

        def f(ids: list[int], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, text in zip(ids, texts, strict=True):
                h = shingle_hashes(normal_words(text))
                if len(h):
                    yield i, minima(h, a, b).tolist()

        return f

    return map_rows(docs, ["doc_id", "text"], "doc_id bigint, signature array<bigint>", make)


def bands(signed: DataFrame) -> DataFrame:
    """(doc_id, band, bucket): a bucket is the MD5 of a band's rows."""
    rows = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.struct(k.alias("band"), F.md5(F.array_join(F.slice("signature", k * ROWS + 1, ROWS), ",")).alias("bucket")))
    return signed.select("doc_id", F.explode(rows).alias("b")).select("doc_id", "b.band", "b.bucket")


def pairs(banded: DataFrame) -> DataFrame:
    """Star edges (u, v), u < v: every document of a bucket with the bucket's least. Same components as all pairs."""
    return _stars(banded, ["band", "bucket"]).distinct()


def _stars(rows: DataFrame, keys: list[str]) -> DataFrame:
    least = rows.groupBy(*keys).agg(F.min("doc_id").alias("u"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return salted(rows, least, keys, "inner", "doc_id").where(F.col("doc_id") > F.col("u")).select("u", F.col("doc_id").alias("v"))


def edges(sketched: DataFrame) -> DataFrame:
    """Star edges (u, v) by way of equal sketches: of each group of equal ones only the least document goes into buckets.

    So copies, however many, make one row a bucket; they are tied to their least document by one edge each.
    """
    return _copies(sketched).unionByName(_stars(_bucketed(sketched), ["bucket"])).distinct()


def _copies(sketched: DataFrame) -> DataFrame:
    return _stars(sketched.select("doc_id", "sketch"), ["sketch"])


def _bucketed(sketched: DataFrame) -> DataFrame:
    """(doc_id, bucket) of the least document of each sketch."""
    return sketched.groupBy("sketch").agg(F.min(F.struct("doc_id", "buckets")).alias("f")).select("f.doc_id", F.explode("f.buckets").alias("bucket"))


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, shingles): the distinct shingles' hashes. Narrow."""

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        def f(ids: list[int], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, text in zip(ids, texts, strict=True):
                yield i, wide_hashes(normal_words(text)).view(np.int64).tolist()

        return f

    return map_rows(docs, ["doc_id", "text"], "doc_id bigint, shingles array<bigint>", make)


#: Pairs of one document that one task verifies.
PAIRS_A_TASK = 2000


def similar(pairs: DataFrame, docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (u, v) whose sets of shingles have a Jaccard similarity of at least `least`, each set in full.

    Only sets of documents in pairs are made and moved. A document in many pairs is split over tasks.
    """
    pairs = cut(pairs.select("u", "v").distinct())
    ids = pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()
    sets = cut(shingle_sets(docs.select("doc_id", "text").join(small(cut(ids)), "doc_id", "left_semi")))
    busy = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / PAIRS_A_TASK).cast("int").alias("parts")).where("parts > 1")
    busy = F.broadcast(cut(busy))  # at most a PAIRS_A_TASK-th of the pairs
    one = F.coalesce("parts", F.lit(1))
    left = pairs.join(busy, "u", "left").withColumn("part", F.pmod(F.xxhash64("v"), one).cast("int")).drop("parts")
    by_u = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a")).join(busy, "u", "left").withColumn("part", F.explode(F.sequence(F.lit(0), one - 1))).drop("parts")
    met = left.join(sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b")), "v").join(by_u, ["u", "part"])
    both = F.size(F.array_intersect("a", "b"))
    enough = both + 1e-9 >= least * (F.size("a") + F.size("b") - both)  # a similarity of just `least` is enough
    return met.where((both > 0) & enough).select("u", "v")


def verified(docs: DataFrame, sketched: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, cluster_id) of the documents tied by copies and by pairs of a common bucket that are similar enough.

    In rounds: each open bucket's next document is compared with those after it that are in other clusters by now. A bucket
    is open while it holds two clusters and has a next document, so no pair of a bucket that could join two clusters is
    left out, yet pairs are never all made at once, and most buckets are one cluster after the first round.
    """
    copies = _copies(sketched)
    members = _bucketed(sketched)
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    opened = cut(salted(members, shared, ["bucket"], "left_semi", "doc_id").withColumn("cluster", F.col("doc_id")))
    ties = [cut(copies)]
    last = None
    while not opened.isEmpty():
        after = opened if last is None else salted(opened, last, ["bucket"], "inner", "doc_id").where(F.col("doc_id") > F.col("lead")).select(*opened.columns)
        lead = cut(after.groupBy("bucket").agg(F.min(F.struct("doc_id", "cluster")).alias("f")).select("bucket", F.col("f.doc_id").alias("lead"), F.col("f.cluster").alias("lead_cluster")))
        met = salted(after, lead, ["bucket"], "inner", "doc_id").where((F.col("doc_id") > F.col("lead")) & (F.col("cluster") != F.col("lead_cluster")))
        new = cut(similar(met.select(F.col("lead").alias("u"), F.col("doc_id").alias("v")), docs, least))
        last = lead.select("bucket", "lead")
        if not new.isEmpty():
            ties.append(new)
            # Clusters joined by the new pairs; the names of clusters are their least documents so far.
            named = opened.select(F.col("doc_id"), "cluster").distinct()
            ends = new.join(named.withColumnsRenamed({"doc_id": "u", "cluster": "cu"}), "u").join(named.withColumnsRenamed({"doc_id": "v", "cluster": "cv"}), "v")
            moved = components(ends.select(F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).where("u <> v").distinct()).withColumnsRenamed({"doc_id": "cluster", "cluster_id": "to"})
            opened = opened.join(small(moved), "cluster", "left").select("bucket", "doc_id", F.coalesce("to", "cluster").alias("cluster"))
        still = opened.groupBy("bucket").agg(F.min("cluster").alias("a"), F.max("cluster").alias("b"), F.max("doc_id").alias("end")).where("a <> b").join(last, "bucket").where(F.col("lead") < F.col("end")).select("bucket")
        opened = cut(salted(opened, still, ["bucket"], "left_semi", "doc_id").select("bucket", "doc_id", "cluster"))
    return components(reduce(DataFrame.unionByName, ties).distinct())


#: A vertex with this share of all edge ends, and this many, is met by broadcast; there are at most 1 / HOT_SHARE of them.
HOT_SHARE, HOT_EDGES = 1e-4, 1000


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, cluster_id): connected components by least label with short cuts; cluster_id is the least document.

    Each round takes the least label over the edges, then follows labels of labels, so long chains shrink by doubling.
    Labels only fall, so the rounds end by themselves when none changes. Rounds are cut by reliable checkpoints. The
    neighbours of a vertex with many edges are met by broadcasting its label, not in one task.
    """
    both = cut(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    ends = both.count()
    rest, busy = both, None
    if ends >= HOT_EDGES:
        hot = cut(both.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= max(HOT_EDGES, HOT_SHARE * ends)).select("v"))
        if not hot.isEmpty():
            busy, rest = (both.join(F.broadcast(hot), "v", how) for how in ("left_semi", "left_anti"))
    labels = cut(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")))
    while True:
        by_v = labels.withColumnRenamed("u", "v")
        met = rest.join(by_v, "v").select("u", "label")
        if busy is not None:
            met = met.unionByName(busy.join(F.broadcast(by_v.join(F.broadcast(hot), "v", "left_semi")), "v").select("u", "label"))
        near = met.groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, "u").select("u", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("u").alias("next"), F.col("label").alias("far"))
        new = cut(step.join(jump, "next", "left").select("u", "label", F.least("next", F.coalesce("far", "next")).alias("next")))
        if new.where("label <> next").isEmpty():
            return new.select(F.col("u").alias("doc_id"), F.col("next").alias("cluster_id"))
        labels = new.select("u", F.col("next").alias("label"))


def clusters(docs: DataFrame, portable: bool = False, least: float | None = SIMILARITY) -> DataFrame:
    """(doc_id, cluster_id, cluster_size) of every document; a document alone is its own cluster.

    With `least` as None every collision of a band ties two documents, whatever their similarity.
    """
    sketched = cut(sketches(docs, portable))
    found = components(edges(sketched)) if least is None else verified(docs, sketched, least)
    sizes = found.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("cluster_size"))
    return docs.select("doc_id").join(found.join(sizes, "cluster_id"), "doc_id", "left").select("doc_id", F.coalesce("cluster_id", "doc_id").alias("cluster_id"), F.coalesce("cluster_size", F.lit(1)).cast("bigint").alias("cluster_size"))


def keep_one(docs: DataFrame, clustered: DataFrame) -> DataFrame:
    """(doc_id, cluster_id, cluster_size) of the first document of each cluster by file, offset and id."""
    first = F.min(F.struct("warc_filename", "warc_record_offset", "doc_id"))
    met = clustered.join(docs.select("doc_id", "warc_filename", "warc_record_offset"), "doc_id")
    return met.groupBy("cluster_id").agg(first.alias("f"), F.max("cluster_size").alias("cluster_size")).select(F.col("f.doc_id").alias("doc_id"), "cluster_id", "cluster_size")


def removed(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Documents that are not kept, found as the difference on (file, offset)."""
    keys = docs.join(kept.select("doc_id"), "doc_id", "left_semi").select("warc_filename", "warc_record_offset")
    return docs.join(keys, ["warc_filename", "warc_record_offset"], "left_anti")


def exact_clusters(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_copies) of the first of each group of equal texts."""
    h = docs.select("doc_id", F.md5("text").alias("text_hash"))
    return h.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_copies"))
