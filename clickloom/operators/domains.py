"""Top domains and the dense per-user domain vector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.urls import url_domain
from ..functions.vectors import dense_counts
from .visits import user_domain_counts

# Fixed value: width of the domain vector unless the caller sets another.
TOP_DOMAINS = 1000


def domain_counts(visits: DataFrame, strip: str = "prefix") -> DataFrame:
    """Visits per domain, ``(domain, count)``; the shuffle carries one row per task and domain."""
    return (
        visits.select(url_domain("url", strip).alias("domain"))
        .groupBy("domain")
        .agg(F.count("*").alias("count"))
    )


def domain_totals(counts: DataFrame) -> DataFrame:
    """The same from per-user counts, for jobs that hold those anyway."""
    return counts.groupBy("domain").agg(F.sum("cnt").alias("count"))


def top_domains(totals: DataFrame, n: int = TOP_DOMAINS) -> DataFrame:
    """The ``n`` most visited domains; equal counts are cut in alphabetical order.

    Visits without a domain sort last and are dropped behind the limit. A filter before it would
    be pushed below the counts, which could then no longer be shared with the per-user vectors.
    """
    unknown = F.col("domain").isNull()
    ordered = totals.orderBy(unknown, F.desc("count"), F.asc("domain")).limit(n)
    return ordered.filter(~unknown)


def vocabulary(top: DataFrame) -> DataFrame:
    """One row with the sorted array of the top domains, at most as long as their limit."""
    return top.agg(F.array_sort(F.collect_list("domain")).alias("domains"))


def user_domain_grid(counts: DataFrame, top: DataFrame) -> DataFrame:
    """``(uid, domain, position, cnt)``: the top domains each user visited.

    ``position`` is the 1-based place of the domain in the alphabetical vocabulary, which is what
    numbering every user's full list of top domains would give. Pairs without a visit are not
    written out: users times domains would grow with both.
    """
    places = vocabulary(top).select(F.posexplode("domains").alias("place", "domain"))
    return counts.join(places, "domain").select(
        "uid", "domain", (F.col("place") + 1).alias("position"), "cnt"
    )


def domain_vector(
    visits: DataFrame,
    n: int = TOP_DOMAINS,
    users: DataFrame | None = None,
    strip: str = "prefix",
) -> DataFrame:
    """``(uid, domain_features)``: visits of each user to the ``n`` top domains, in alphabetical
    order of the domains.

    Every user with a visit gets a vector, also one of zeros; with ``users`` those users get one
    and no others.
    Only counted (user, domain) pairs are shuffled. The positions of the at most ``n`` domains
    are broadcast, so ``n`` bounds both the broadcast and each user's collected entries.
    """
    counts = user_domain_counts(visits, strip)
    domains = vocabulary(top_domains(domain_totals(counts), n))
    positions = domains.select(F.posexplode("domains").alias("pos", "domain"))
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "cnt"))
    entries = (
        counts.join(F.broadcast(positions), "domain", "left")
        .groupBy("uid")
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    )
    if users is not None:
        known = users.select("uid").filter(F.col("uid").isNotNull()).distinct()
        entries = known.join(entries, "uid", "left")
    size = domains.select(F.size("domains")).scalar()
    return entries.select("uid", _vector(F.col("entries"), size).alias("domain_features"))


def _vector(entries: Column, size: Column) -> Column:
    blank = F.array_repeat(F.lit(0).cast("long"), size)
    return F.when(F.size(entries) > 0, dense_counts(entries, size)).otherwise(blank)
