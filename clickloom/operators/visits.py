"""Row-level operators on nested web logs and flat visits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.urls import url_domain


def explode_visits(logs: DataFrame, visits: str = "visits") -> DataFrame:
    """One row per visit: the other columns, ``timestamp`` and ``url``.

    Rows whose array is null or empty vanish.
    """
    others = [c for c in logs.columns if c != visits]
    return logs.select(*others, F.explode(visits).alias("visit")).select(
        *others, "visit.timestamp", "visit.url"
    )


def visit_domains(visits: Column | str = "visits", strip: str = "prefix") -> Column:
    """Domains of a nested visit array, in its order, without the URLs that have none."""
    visits = F.col(visits) if isinstance(visits, str) else visits
    domains = F.transform(visits, lambda v: url_domain(v["url"], strip))
    return F.filter(domains, lambda d: d.isNotNull())


def domain_tokens(logs: DataFrame, strip: str = "prefix") -> DataFrame:
    """Domain tokens of each log row: ``visits`` is replaced by ``domain_features``.

    Works on each row by itself, so a user with very many rows is never gathered in one task, and
    the same expression serves batch and stream. Rows without visits vanish, as in an explode.
    """
    others = [c for c in logs.columns if c != "visits"]
    return logs.filter(F.size("visits") > 0).select(
        *others, visit_domains("visits", strip).alias("domain_features")
    )


def restrict_to(rows: DataFrame, members: DataFrame, key: str = "uid") -> DataFrame:
    """Rows whose key occurs in ``members``; repeated members do not repeat rows."""
    return rows.join(members.select(key), key, "left_semi")


def union_logs(*logs: DataFrame) -> DataFrame:
    """All rows of logs with the same columns, matched by name."""
    return reduce(DataFrame.unionByName, logs)


def user_domain_counts(
    visits: DataFrame, strip: str = "prefix", keys: tuple[str, ...] = ("uid",)
) -> DataFrame:
    """Visits per user and domain, ``(*keys, domain, cnt)``; visits without a user are dropped.

    Counting first makes every later join and per-user collection work on one row per distinct
    pair: a hot user or domain has already collapsed in the map-side sums.
    """
    return (
        visits.filter(F.col(keys[0]).isNotNull())
        .select(*keys, url_domain("url", strip).alias("domain"))
        .groupBy(*keys, "domain")
        .agg(F.count("*").alias("cnt"))
    )
