"""URL filter: host rules, then a path-template tree judged by its labelled purity.

A path's segments are generalised level by level. Runs of digits become ``#``. Below each node of a
host's tree the segments are children with counts of pages, labelled pages and bad labels. A child
stays a branch of its own only if it has enough pages and its share of bad labels differs from that
of its siblings by a two-proportion test; all others are variable or alike and merge into ``*``. So
a tree grows only where labels tell branches apart. A template is blocked when its share of bad
labels, smoothed towards that of its host and of all pages, reaches a limit.

Counts are summed map-side by host, prefix and segment, so a host with a third of all pages makes
few rows; the branches kept per level are staged and joined with the pages.

A null url, or one without ``://``, has an empty host and path. Pages without an id or label are
judged but add no label; a page counts as bad if any of its labels says so. Repeated pages count as
often as they occur. Without any label nothing is blocked but by a rule. Empty tables give empty
results, and only the named columns of the inputs are read, so clashing extra columns do no harm.
Segments below the deepest level count as one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..storage import Workspace

# Host up to the path, and path up to query or fragment.
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host, a slash and the start of a path; it holds for subdomains too."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


@dataclass(frozen=True)
class Settings:
    """``deviation`` is that of the test in standard deviations; ``weight`` the number of labels
    that the prior counts for; ``limit`` the share of bad labels that blocks."""

    levels: int = 8
    least_pages: int = 10
    least_labels: int = 5
    deviation: float = 2.0
    weight: float = 10.0
    limit: float = 0.5


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, _URL, 1)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, capitals, capitals.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.endswith("host", F.lit(f".{rule.host}"))
    return host & F.startswith("path", F.lit(rule.path))


def with_rules(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` of the longest rule that fits; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        rule = F.when(_fits(r), F.lit(r.pattern)).otherwise(rule)
        verdict = F.when(_fits(r), F.lit(r.verdict)).otherwise(verdict)
    return pages.withColumns({"rule": rule, "rule_verdict": verdict})


def segments(path: Column, levels: int) -> Column:
    """Segments with digits generalised; what lies below the last level is one segment."""
    plain = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "#"), "/"), lambda s: s != "")
    deep = F.concat(F.slice(plain, 1, levels - 1), F.array(F.lit("**")))
    return F.when(F.size(plain) > levels, deep).otherwise(plain)


def _branches(rows: DataFrame, level: int, settings: Settings) -> DataFrame:
    """``(host, prefix, segment)`` of the children that stay branches of their own."""
    inside = rows.filter(F.size("segments") > level)
    children = inside.groupBy(
        "host", "prefix", F.get("segments", F.lit(level)).alias("segment")
    ).agg(
        F.count("*").alias("n"),
        F.count("bad").alias("labels"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
    )
    nodes = children.groupBy("host", "prefix").agg(
        F.sum("labels").alias("all_labels"),
        F.sum("bad").alias("all_bad"),
    )
    others = F.col("all_labels") - F.col("labels")
    own_share = F.col("bad") / F.col("labels")
    other_share = (F.col("all_bad") - F.col("bad")) / others
    share = F.col("all_bad") / F.col("all_labels")
    spread = share * (1 - share) * (1 / F.col("labels") + 1 / others)
    differs = (own_share - other_share) ** 2 >= settings.deviation**2 * spread
    enough = (
        (F.col("n") >= settings.least_pages)
        & (F.col("labels") >= settings.least_labels)
        & (others >= settings.least_labels)
    )
    tested = children.join(nodes, ["host", "prefix"]).filter(enough)
    return tested.filter(differs & (own_share != other_share)).select(
        "host", "prefix", "segment"
    )


def with_templates(rows: DataFrame, settings: Settings, work: Workspace) -> DataFrame:
    """Add ``prefix``, the template of each page; ``rows`` has ``host``, ``segments``, ``bad``."""
    deepest = rows.agg(F.max(F.size("segments"))).first()[0] or 0
    rows = rows.withColumn("prefix", F.lit(""))
    for level in range(deepest):
        kept = work.stage(_branches(rows, level, settings), "url-branches").select(
            "host", "prefix", "segment", F.lit(True).alias("kept")
        )
        at = F.get("segments", F.lit(level))
        named = F.when(F.col("kept"), F.col("segment")).otherwise("*")
        rows = (
            rows.withColumn("segment", at)
            .join(kept, ["host", "prefix", "segment"], "left")
            .withColumn(
                "prefix",
                F.when(F.col("segment").isNull(), F.col("prefix")).otherwise(
                    F.concat("prefix", F.lit("/"), named)
                ),
            )
            .drop("segment", "kept")
        )
    return rows


def _blocked(rows: DataFrame, settings: Settings) -> DataFrame:
    """``(host, prefix)`` of the templates whose smoothed share of bad labels reaches the limit."""
    labelled = rows.filter("bad IS NOT NULL")
    templates = labelled.groupBy("host", "prefix").agg(
        F.count("*").alias("labels"), F.sum("bad").alias("bad")
    )
    hosts = templates.groupBy("host").agg(
        F.sum("labels").alias("host_labels"), F.sum("bad").alias("host_bad")
    )
    prior = labelled.agg(F.avg("bad")).scalar()
    k = settings.weight
    of_host = (F.col("host_bad") + k * prior) / (F.col("host_labels") + k)
    purity = (F.col("bad") + k * of_host) / (F.col("labels") + k)
    judged = templates.join(hosts, "host").filter(purity >= settings.limit)
    return judged.select("host", "prefix", F.lit(True).alias("blocked"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule],
    settings: Settings = Settings(),
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template)`` of every page.

    ``labels`` has ``page_id`` and ``bad``, 1 for a page that should be blocked and 0 for others.
    """
    bad = labels.dropna(subset=["page_id", "bad"]).groupBy("page_id").agg(F.max("bad").alias("bad"))
    with Workspace(pages.sparkSession) as work:
        parsed = pages.select(
            F.col(page_id).alias("page_id"),
            host_of(F.col(url)).alias("host"),
            path_of(F.col(url)).alias("path"),
        )
        parsed = with_rules(parsed, rules).withColumn(
            "segments", segments(F.col("path"), settings.levels)
        )
        rows = work.stage(parsed.join(bad, "page_id", "left"), "url-pages")
        templated = work.stage(with_templates(rows, settings, work), "url-templates")
        result = (
            templated.join(_blocked(templated, settings), ["host", "prefix"], "left")
            .withColumn("method", F.when(F.col("blocked"), "block").otherwise("allow"))
            .select(
                "page_id",
                "host",
                "path",
                "rule",
                F.coalesce("rule_verdict", "method").alias("verdict"),
                F.col("prefix").alias("template"),
            )
        )
        stored = work.stage(result, "url-verdicts")
        work.keep(stored)
    return stored
