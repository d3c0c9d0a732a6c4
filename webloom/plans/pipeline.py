"""The corpus pipeline: filters with a reason for each dropped document, formatters, whole-crawl dedup."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.operators import minhash, quality, url
from webloom.operators.language import Scorer
from webloom.plans.profile import GREEK, Profile
from webloom.session import cut, small

Lists = dict[str, DataFrame]


def judged(docs: DataFrame, profile: Profile = GREEK, n_grams: bool = True, lists: Lists | None = None, scorer: Callable[[], Scorer] | None = None, formatted: bool = False) -> DataFrame:
    """All columns, language labels and `reason`; one scan, one Arrow pass, no shuffle of texts."""
    return quality.judged(url.banned(docs, lists, profile), profile, n_grams, scorer, formatted=formatted).drop("ban")


def reasons(docs: DataFrame, profile: Profile = GREEK, n_grams: bool = True, lists: Lists | None = None) -> DataFrame:
    """(doc_id, reason): the first filter in pipeline order that drops a document, null for survivors."""
    own = docs.select("doc_id", "url", "url_host_registered_domain", "text")
    return judged(own, profile, n_grams, lists).select("doc_id", "reason")


def stage_one(docs: DataFrame, profile: Profile = GREEK, n_grams: bool = True, lists: Lists | None = None, scorer: Callable[[], Scorer] | None = None) -> DataFrame:
    """Surviving documents with formatted text: all columns of the input, language, language_score, language_script."""
    return judged(docs, profile, n_grams, lists, scorer, formatted=True).where("reason is null").drop("reason")


def deduplicated(docs: DataFrame) -> DataFrame:
    """Documents without near-duplicates, with cluster_id and cluster_size. `docs` is read twice, so give a stored table.

    Texts meet the documents to be removed and the sizes of clusters, both broadcast if they are few; most documents are
    in no cluster, so neither list holds them.
    """
    clustered = cut(minhash.clusters(docs).where("cluster_size > 1"))
    kept = cut(minhash.keep_one(docs, clustered))
    removed = clustered.join(kept.select("doc_id"), "doc_id", "left_anti").select("doc_id")
    left = docs.join(small(removed), "doc_id", "left_anti").join(small(kept), "doc_id", "left")
    return left.withColumns({"cluster_id": F.coalesce("cluster_id", "doc_id"), "cluster_size": F.coalesce("cluster_size", F.lit(1)).cast("bigint")})


def full(docs: DataFrame, profile: Profile = GREEK, n_grams: bool = True) -> DataFrame:
    """Stage one and near-duplicate removal: doc_id, url, text, cluster_id, cluster_size of the documents kept.

    Stage one runs once and is cut; signatures and the result are read from there.
    """
    own = docs.select("doc_id", "url", "url_host_registered_domain", "text", "warc_filename", "warc_record_offset")
    return deduplicated(cut(stage_one(own, profile, n_grams))).select("doc_id", "url", "text", "cluster_id", "cluster_size")
