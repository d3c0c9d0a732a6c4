"""Problem 9: mixing sources to target weights.

Sizes are tokens of a public tokenizer (its vocabulary file is a parameter). Every document of a source has the same
number of expected copies: what the source's share of the mix needs, at most its cap. A mix of at most `exact_total`
tokens meets every share; the mix is that large, but no larger than the corpus. If a greater size is given, a source that
cannot fill its share within its cap gives all it may, and the report shows by how much it falls short. Systematic
sampling then lays the expected copies of a source end to end, adds one random offset and emits a document once for each
integer boundary it crosses. Documents lie in order of their size, so that each size gives its part and the tokens chosen
differ from those expected by about one document; of OFFSETS random offsets of a source the one that comes nearest is added. The prefix sums are taken in two steps, within buckets (a class of sizes
and a hash) and over the buckets of a source, so that a source with a third of all rows is spread over all tasks.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom.llm.common import documents, fold_tasks, map_rows, table
from webloom.session import cut

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the pattern that cuts text before byte pairs are merged, as published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROWS_PER_BUCKET = 50_000
SEED = 20_240_601
#: Random offsets tried for each source; the one whose tokens come nearest to the source's part is taken.
OFFSETS = 64


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, source (spelling folded), n_tokens; a null or empty text has no tokens."""
    held = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, held.value.splitlines())}
        encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        def f(ids: list[int], sources: list[str | None], texts: list[str | None]) -> Iterator[tuple[Any, ...]]:
            for i, source, text in zip(ids, sources, texts, strict=True):
                yield i, source.strip().lower() if source else None, len(encode(text)) if text else 0

        return f

    return map_rows(docs, ["doc_id", "source", "text"], "doc_id bigint, source string, n_tokens bigint", make)


def _targets(targets: DataFrame) -> DataFrame:
    return targets.where("source is not null and target_share > 0").select(F.lower(F.trim("source")).alias("source"), "target_share", F.greatest("max_repeat", F.lit(1)).alias("max_repeat"))


def rates(sizes: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """One row a target source: tokens, documents, its reachable share and the expected copies of each document.

    Targets without documents have rate 0 and their share is divided among the others in proportion. `total` is the size
    of the mix in tokens, by default the tokens of all documents of target sources, but at most `exact_total`, the
    largest mix in which no source needs more than its cap.
    """
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_documents"))
    t = _targets(targets).join(have, "source", "left").fillna(0, ["n_tokens", "n_documents"])
    everywhere = Window.partitionBy()  # a row a target source
    here = F.col("n_tokens") > 0
    share = F.when(here, F.col("target_share") / F.sum(F.when(here, F.col("target_share"))).over(everywhere)).otherwise(0.0)
    t = t.withColumn("reachable_share", share)
    t = t.withColumn("exact_total", F.min(F.when(here, F.col("n_tokens") * F.col("max_repeat") / F.col("reachable_share"))).over(everywhere))
    size = F.lit(float(total)) if total is not None else F.least(F.sum("n_tokens").over(everywhere).cast("double"), F.col("exact_total"))
    return t.withColumn("rate", F.when(here, F.least(F.col("max_repeat").cast("double"), size * F.col("reachable_share") / F.col("n_tokens"))).otherwise(0.0))


def mix(sizes: DataFrame, rate: DataFrame, seed: int = SEED, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row a chosen repetition: doc_id, source, copy_no (from 1), n_tokens. Documents of no target source are left out."""
    largest = rate.agg(F.max("n_documents")).first()[0] or 0
    parts = max(1, -(-int(largest) // (rows_per_bucket * 8)))
    place = F.xxhash64("doc_id", F.lit(seed))
    # Classes of sizes are an eighth of a doubling wide; large ones are split by hash, and in order within each part.
    size_class = F.floor(F.log2(F.greatest("n_tokens", F.lit(1))) * 8).cast("bigint")
    rows = sizes.withColumn("place", place).withColumn("bucket", size_class * parts + F.pmod("place", F.lit(parts)))
    counts = rows.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.withColumn("before", before).join(rate.select("source", "rate", "max_repeat"), "source").select("source", "bucket", "before", "rate", "max_repeat")
    own = rows.join(starts, ["source", "bucket"])
    k = F.col("before") + F.row_number().over(Window.partitionBy("source", "bucket").orderBy("n_tokens", "place", "doc_id"))
    own = cut(own.select("doc_id", "source", "n_tokens", "rate", "max_repeat", k.alias("k")))

    def copies(offset: Column) -> Column:
        """Integer boundaries that a document crosses, at most its cap."""
        crossed = F.floor(F.col("k") * F.col("rate") + offset) - F.floor((F.col("k") - 1) * F.col("rate") + offset)
        return F.least(crossed, F.col("max_repeat").cast("bigint"))

    best = own.sparkSession.createDataFrame(list(nearest_offsets(own, seed).items()), "source string, offset double")
    chosen = own.join(F.broadcast(best), "source").withColumn("copies", copies(F.col("offset"))).where("copies > 0")
    return chosen.select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy_no"), "n_tokens")


def offsets_of(source: str, seed: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(f"{c} {source}", seed) / 2.0**64 for c in range(OFFSETS)])


def nearest_offsets(placed: DataFrame, seed: int) -> dict[str, float]:
    """Of OFFSETS random offsets of each source the one whose copies' tokens come nearest to the source's part of the mix.

    Tasks sum the tokens of each source and offset; a number for each reaches the driver.
    """

    def make() -> tuple[Callable[..., bool], Callable[[], Iterator[tuple[str, int, float]]]]:
        sums: dict[str, np.ndarray] = {}
        tried: dict[str, np.ndarray] = {}

        def add(sources: list[str], tokens: list[int], rates: list[float], most: list[int], ks: list[int]) -> bool:
            for source in set(sources):
                at = [i for i, s in enumerate(sources) if s == source]
                n, r, m, k = (np.array([x[i] for i in at], np.float64) for x in (tokens, rates, most, ks))
                if source not in sums:
                    sums[source], tried[source] = np.zeros(OFFSETS), offsets_of(source, seed)
                o = tried[source][:, None]
                crossed = np.minimum(np.floor(k * r + o) - np.floor((k - 1) * r + o), m)
                sums[source] += crossed @ n - (r * n).sum()
            return False

        def drain() -> Iterator[tuple[str, int, float]]:
            for source, x in sums.items():
                yield from ((source, c, float(v)) for c, v in enumerate(x))

        return add, drain

    found = fold_tasks(placed, ["source", "n_tokens", "rate", "max_repeat", "k"], "source string, c int, error double", make, each=4096)
    errors: dict[str, np.ndarray] = {}
    for r in found.groupBy("source", "c").agg(F.sum("error").alias("error")).collect():
        errors.setdefault(r["source"], np.zeros(OFFSETS))[r["c"]] = r["error"]
    # Rounded, as the order of sums may change their last digits.
    return {s: float(offsets_of(s, seed)[np.abs(e).round(3).argmin()]) for s, e in errors.items()}


def shares(mixed: DataFrame, rate: DataFrame) -> DataFrame:
    """The report: per target source its target, reachable and actual share, tokens, documents and copies."""
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("mix_tokens"), F.count(F.lit(1)).alias("n_copies"), F.max("copy_no").alias("most_copies"))
    own = rate.join(got, "source", "left").fillna(0, ["mix_tokens", "n_copies", "most_copies"])
    whole = F.sum("mix_tokens").over(Window.partitionBy())
    return own.select("source", "target_share", F.round("reachable_share", 6).alias("reachable_share"), F.round(F.when(whole > 0, F.col("mix_tokens") / whole).otherwise(0.0), 6).alias("actual_share"), "n_documents", "n_tokens", F.col("mix_tokens"), "n_copies", "most_copies", "max_repeat", F.round("exact_total").cast("bigint").alias("exact_total"))


def _prepared(spark: SparkSession, d: str, vocabulary: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    sizes = cut(token_counts(documents(spark, d), vocabulary))
    return sizes, rates(sizes, table(spark, d, "mix_targets"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mix(*_prepared(spark, d))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    sizes, rate = _prepared(spark, d)
    return shares(mix(sizes, rate), rate)
