"""Filtering pages by their address."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.plans.profile import GREEK, Profile
from webloom.session import cut, small

#: Block lists as tables: the list's name and the column it is met by.
KEYS = {"domain": "url_host_registered_domain", "host": "_host", "url": "url"}


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^[a-zA-Z]+://([^/?#]+)", 1))


def words(url: Column) -> Column:
    return F.filter(F.split(F.lower(url), "[^a-z0-9]+"), lambda w: w != "")


def verdict(url: Column, domain: Column, profile: Profile = GREEK) -> Column:
    """The first rule that bans the page, or null. A null address passes; empty lists ban nothing.

    The lists are parts of the plan: for short ones. `banned` takes lists of any length as tables.
    """
    none = F.lit(False)

    def listed(c: Column, values: tuple[str, ...]) -> Column:
        return c.isin(*values) if values else none

    exact = F.when(listed(domain, profile.blocked_domains), "domain").when(listed(host(url), profile.blocked_hosts), "host").when(listed(url, profile.blocked_urls), "url")
    return F.coalesce(exact, by_words(url, profile))


def by_words(url: Column, profile: Profile) -> Column:
    """The first word rule that bans an address: a hard word, enough soft words, a banned part of it."""
    none = F.lit(False)
    hard = F.arrays_overlap(words(url), F.array(*map(F.lit, profile.hard_words))) if profile.hard_words else none
    soft = F.size(F.array_intersect(F.array_distinct(words(url)), F.array(*map(F.lit, profile.soft_words)))) >= profile.soft_limit if profile.soft_words else none
    part = F.regexp_replace(F.lower(url), "[^a-z0-9]+", "").rlike("|".join(map(re.escape, profile.banned_parts))) if profile.banned_parts else none
    return F.when(hard, "hard_word").when(soft, "soft_words").when(part, "part")


def banned(docs: DataFrame, lists: dict[str, DataFrame] | None = None, profile: Profile = GREEK) -> DataFrame:
    """All columns and `ban`: the first rule that bans the page, or null. `lists` holds tables (first column) by KEYS' names.

    Of each list only the entries that the documents have are kept, found on distinct keys without texts; they are
    broadcast if they are few, else met by a shuffle join. Repeated and null entries do no harm.
    """
    if not lists:
        return docs.withColumn("ban", verdict(F.col("url"), F.col("url_host_registered_domain"), profile))
    own = docs.withColumn("_host", host(F.col("url")))
    flags = []
    for name, key in KEYS.items():
        if name not in lists:
            continue
        entries = lists[name].select(F.col(lists[name].columns[0]).alias(key)).where(f"{key} is not null").distinct()
        met = cut(own.select(key).distinct().join(entries, key, "left_semi"))
        own = own.join(small(met.withColumn(f"_in_{name}", F.lit(True))), key, "left")
        flags.append(F.when(F.col(f"_in_{name}"), name))
    ban = F.coalesce(*flags, verdict(F.col("url"), F.col("url_host_registered_domain"), profile))
    return own.withColumn("ban", ban).select(*docs.columns, "ban")
