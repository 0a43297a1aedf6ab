"""DuckDB equivalents of the queries in this folder that SQL can express."""

from __future__ import annotations

from collections.abc import Sequence


def url_filters(rules: Sequence, settings) -> str:
    """All levels of the template tree, written out one after another."""
    url = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    longest = sorted(rules, key=lambda r: (-len(r.pattern), r.pattern))
    fits = [
        (
            f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')",
            r,
        )
        for r in longest
    ]
    rule = " ".join(f"WHEN {f} THEN '{r.pattern}'" for f, r in fits)
    verdict = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in fits)
    levels, s = settings.levels, settings
    parts = [
        f"""parsed AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '{url}', 1), ''), '{capitals}', '{capitals.lower()}')
           AS host,
         coalesce(regexp_extract(url, '{url}', 2), '') AS path
  FROM pages)""",
        """plain AS (
  SELECT *, list_filter(string_split(regexp_replace(path, '[0-9]+', '#', 'g'), '/'),
                        lambda x: x <> '') AS segs
  FROM parsed)""",
        """bad_of AS (
  SELECT doc_id AS page_id, max(1 - quality) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id)""",
        f"""rows_0 AS (
  SELECT p.page_id, host, path, bad, '' AS prefix,
         CASE WHEN len(segs) > {levels} THEN list_concat(segs[1:{levels - 1}], ['**'])
              ELSE segs END AS segments
  FROM plain p LEFT JOIN bad_of b ON b.page_id = p.page_id)""",
    ]
    for k in range(levels):
        parts += [
            f"""children_{k} AS (
  SELECT host, prefix, segments[{k + 1}] AS segment, count(*) AS n, count(bad) AS l,
         coalesce(sum(bad), 0) AS b
  FROM rows_{k} WHERE len(segments) > {k} GROUP BY ALL)""",
            f"""nodes_{k} AS (
  SELECT host, prefix, sum(l) AS al, sum(b) AS ab FROM children_{k} GROUP BY ALL)""",
            f"""kept_{k} AS (
  SELECT c.host, c.prefix, c.segment
  FROM children_{k} c JOIN nodes_{k} d ON d.host = c.host AND d.prefix = c.prefix
  WHERE n >= {s.least_pages}
    AND l >= {s.least_labels} AND al - l >= {s.least_labels}
    AND b / l <> (ab - b) / (al - l)
    AND power(b / l - (ab - b) / (al - l), 2)
        >= {s.deviation**2} * ((ab / al) * (1 - ab / al) * (1 / l + 1 / (al - l))))""",
            f"""rows_{k + 1} AS (
  SELECT r.page_id, r.host, r.path, r.bad, r.segments,
         CASE WHEN len(r.segments) <= {k} THEN r.prefix
              ELSE r.prefix || '/' || coalesce(t.segment, '*') END AS prefix
  FROM rows_{k} r LEFT JOIN kept_{k} t
    ON t.host = r.host AND t.prefix = r.prefix AND t.segment = r.segments[{k + 1}])""",
        ]
    k = settings.weight
    parts += [
        f"""templates AS (
  SELECT host, prefix, count(*) AS l, sum(bad) AS b FROM rows_{levels} WHERE bad IS NOT NULL
  GROUP BY ALL)""",
        "hosts AS (SELECT host, sum(l) AS hl, sum(b) AS hb FROM templates GROUP BY host)",
        f"prior AS (SELECT avg(bad) AS p FROM rows_{levels})",
        f"""blocked AS (
  SELECT t.host, t.prefix
  FROM templates t JOIN hosts h ON h.host = t.host CROSS JOIN prior
  WHERE (b + {k} * ((hb + {k} * p) / (hl + {k}))) / (l + {k}) >= {s.limit})""",
    ]
    return f"""WITH {', '.join(parts)}
SELECT page_id, r.host, path, CASE {rule.replace('(host', '(r.host')} END AS rule,
       coalesce(CASE {verdict.replace('(host', '(r.host')} END,
                CASE WHEN b.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       r.prefix AS template
FROM rows_{levels} r LEFT JOIN blocked b ON b.host = r.host AND b.prefix = r.prefix"""
