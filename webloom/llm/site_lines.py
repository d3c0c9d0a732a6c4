"""Problem 4: lines repeated across the documents of one site.

Each line is normalised (case, accents, white space, digits of numbers) and hashed; a hash is counted once a document
within its site, partially on the map side, so that a site with a third of all rows costs one counter a task and
hash, not one task for the site. Lines at or above the threshold are joined back by (site, hash), each hash split by
document, so that a line that stands in a third of all documents is many tasks' work.
Only hashes, never texts, are shuffled until documents are rebuilt.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions.joins import salted
from webloom.llm.common import documents
from webloom.session import cut

MIN_LETTERS = 10
MIN_DOCUMENTS = 5
#: Least share of the site's documents; 0 asks for MIN_DOCUMENTS alone.
MIN_SHARE = 0.0


def _accents() -> tuple[str, str]:
    """Accented small letters of the Latin, Greek (polytonic too) and Cyrillic blocks and their base letters, by
    decomposition, and after them the combining marks of these scripts, which have no counterpart and so are dropped."""
    pairs = [("ς", "σ")]
    for lo, hi in ((0xC0, 0x250), (0x370, 0x530), (0x1E00, 0x2000)):
        for c in map(chr, range(lo, hi)):
            base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
            if c == c.lower() and len(base) == 1 and base != c:
                pairs.append((c, base))
    marks = "".join(map(chr, [*range(0x300, 0x370), *range(0x483, 0x488)]))
    return "".join(a for a, _ in pairs) + marks, "".join(b for _, b in pairs)


ACCENTED, BASE = _accents()


def normal_line(line: Column) -> Column:
    """A line without case, accents (also as combining marks), amount and kind of white space and the digits of its numbers."""
    plain = F.translate(F.lower(line), ACCENTED, BASE)
    return F.trim(F.regexp_replace(F.regexp_replace(plain, "(?U)\\s+", " "), "\\p{Nd}+", "0"))


def line_hashes(docs: DataFrame, min_letters: int = MIN_LETTERS) -> DataFrame:
    """One row a line with enough letters: doc_id, url_host_registered_domain, line_no, hash.

    A null or empty text has no lines; a null site is its own group and never has frequent lines.
    """
    lines = F.posexplode(F.split(F.col("text"), "\n"))
    rows = docs.where(F.col("text").isNotNull() & F.col("url_host_registered_domain").isNotNull()).select("doc_id", "url_host_registered_domain", lines.alias("at", "line"))
    letters = F.col("line").rlike(f"(?:\\p{{L}}[^\\p{{L}}]*){{{min_letters}}}")
    return rows.where(letters).select("doc_id", "url_host_registered_domain", (F.col("at") + 1).cast("bigint").alias("line_no"), F.xxhash64("url_host_registered_domain", normal_line(F.col("line"))).alias("hash"))


def site_sizes(docs: DataFrame) -> DataFrame:
    """(url_host_registered_domain, site_documents): documents with a text of each site."""
    own = docs.where(F.col("text").isNotNull() & F.col("url_host_registered_domain").isNotNull())
    return own.groupBy("url_host_registered_domain").agg(F.count(F.lit(1)).alias("site_documents"))


def frequent(docs: DataFrame, hashes: DataFrame, min_documents: int = MIN_DOCUMENTS, min_share: float = MIN_SHARE) -> DataFrame:
    """Hashes that stand in at least `min_documents` different documents and in `min_share` of the documents of their site.

    With them that number, their lines and their site. The number of different documents is found by two aggregations with
    map-side combine: (hash, doc), then hash.
    """
    once = hashes.groupBy("hash", "doc_id").agg(F.count(F.lit(1)).alias("times"), F.first("url_host_registered_domain").alias("url_host_registered_domain"))
    often = once.groupBy("hash").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("times").alias("n_lines"), F.first("url_host_registered_domain").alias("url_host_registered_domain")).where(F.col("n_documents") >= min_documents)
    if min_share <= 0:
        return often
    return salted(often, site_sizes(docs), ["url_host_registered_domain"], "inner", "hash").where(F.col("n_documents") >= min_share * F.col("site_documents")).drop("site_documents")


def found(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_letters: int = MIN_LETTERS, min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, line_no) of each excessively repeated line."""
    h = line_hashes(docs, min_letters)
    # Counting needs the site only where its size does. Lines are normalised once: only numbers are written.
    h = cut(h if min_share > 0 else h.withColumn("url_host_registered_domain", F.lit(None).cast("string")))
    return salted(h.select("doc_id", "line_no", "hash"), frequent(docs, h, min_documents, min_share).select("hash"), ["hash"], "left_semi", "doc_id").select("doc_id", "line_no")


def report(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_letters: int = MIN_LETTERS, min_share: float = MIN_SHARE) -> DataFrame:
    """The frequent lines of each site: site, one spelling (that of the least document and line), documents, lines, share of the site's documents."""
    h = cut(line_hashes(docs, min_letters))
    often = frequent(docs, h, min_documents, min_share)
    first = salted(h, often.select("hash"), ["hash"], "left_semi", "doc_id").groupBy("hash").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    spelled = first.select("hash", F.col("first.doc_id").alias("doc_id"), F.col("first.line_no").alias("line_no"))
    wanted = spelled.groupBy("doc_id").agg(F.collect_list(F.struct("hash", "line_no")).alias("wanted"))  # at most a document's lines
    met = docs.select("doc_id", "text").join(wanted, "doc_id")
    named = met.select(F.explode(F.transform("wanted", lambda w: F.struct(w["hash"].alias("hash"), F.element_at(F.split("text", "\n"), w["line_no"].cast("int")).alias("line")))).alias("n")).select("n.hash", "n.line")
    whole = salted(often.join(named, "hash"), site_sizes(docs), ["url_host_registered_domain"], "inner", "hash")
    return whole.select("url_host_registered_domain", "line", "n_documents", "n_lines", F.round(F.col("n_documents") / F.col("site_documents"), 6).alias("document_share"))


def cleaned(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, min_letters: int = MIN_LETTERS, min_share: float = MIN_SHARE) -> DataFrame:
    """Every document with its text rebuilt without the frequent lines: doc_id, n_removed, text.

    A document whose lines all go has an empty text; a null text stays null.
    """
    gone = found(docs, min_documents, min_letters, min_share).groupBy("doc_id").agg(F.collect_set(F.col("line_no").cast("int")).alias("gone"))
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("gone"), i + 1))
    return docs.select("doc_id", "text").join(gone, "doc_id", "left").select(
        "doc_id",
        F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return found(documents(spark, d))


def p4_lines(spark: SparkSession, d: str) -> DataFrame:
    return report(documents(spark, d))


def p4_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return cleaned(documents(spark, d))
