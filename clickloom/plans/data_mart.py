"""Client data mart: shop categories viewed and site categories visited, per client."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.names import normalize_name
from ..functions.urls import url_host, url_domain
from ..operators.membership import Members
from ..operators.pivots import pivot_counts
from ..storage import Workspace


def shop_matrix(shop_visits: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """Views per user and shop category, columns ``shop_{category}``."""
    views = shop_visits.filter(F.col("event_type") == "view").select(
        "uid", normalize_name("shop_", "category").alias("category")
    )
    return pivot_counts(views, "category", values)


def web_category_counts(
    visits: DataFrame, domain_categories: DataFrame, key: str = "domain"
) -> DataFrame:
    """``(uid, category, cnt)``: visits to sites of each category.

    ``key="domain"`` looks the lower-case ``www``-less host up, ``key="host"`` the host as
    written. Visits are counted per user and host before the lookup, so the join moves one row
    per distinct pair; whether the categories are broadcast is decided by their measured size.
    """
    if key not in ("domain", "host"):
        raise ValueError("key is 'domain' or 'host'")
    site = url_domain("url") if key == "domain" else url_host("url")
    per_site = (
        visits.filter(F.col("uid").isNotNull())
        .select("uid", site.alias("domain"))
        .filter(F.col("domain").isNotNull())
        .groupBy("uid", "domain")
        .agg(F.count("*").alias("cnt"))
    )
    return (
        per_site.join(domain_categories, "domain")
        .select("uid", normalize_name("web_", "category").alias("category"), "cnt")
        .groupBy("uid", "category")
        .agg(F.sum("cnt").alias("cnt"))
    )


def web_matrix(
    visits: DataFrame,
    domain_categories: DataFrame,
    values: Sequence[str] | None = None,
    key: str = "domain",
) -> DataFrame:
    """Visits per user and site category, columns ``web_{category}``."""
    counts = web_category_counts(visits, domain_categories, key)
    return pivot_counts(counts, "category", values, weight="cnt")


def data_mart(
    clients: DataFrame,
    shop_visits: DataFrame,
    visits: DataFrame,
    domain_categories: DataFrame,
    shop_values: Sequence[str] | None = None,
    web_values: Sequence[str] | None = None,
    key: str = "domain",
) -> DataFrame:
    """All clients with their shop and web counts; clients without visits keep nulls.

    A log whose columns are stated loses the rows of users who are no clients while it is scanned
    (`Members`), so an unlisted category of theirs alone need not be an error; the left joins leave
    out the few that pass. Without stated columns every user's categories become columns, and the
    log stays whole. What is left is counted per user before it meets the clients.
    """
    members = None
    if shop_values is not None or web_values is not None:
        members = Members(clients, "uid", Workspace(clients.sparkSession))
    if shop_values is not None:
        shop_visits = members.reduce(shop_visits)
    if web_values is not None:
        visits = members.reduce(visits)
    shop = shop_matrix(shop_visits, shop_values)
    web = web_matrix(visits, domain_categories, web_values, key)
    return clients.join(shop, "uid", "left").join(web, "uid", "left")
