"""DuckDB equivalents of the registered queries, on the same tables."""

from __future__ import annotations

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Parameters shared with the queries.
TOP_N = 20
PROBES = (3, 5, 12)
SHARES = (0.1, 0.25, 0.5, 0.9, 0.99)
BATCH_SIZE = 64
STUDY_WEIGHTS = (-1.5, 0.4, -0.3)
# Bias and one weight per vector dimension, some of them 0.
VECTOR_WEIGHTS = tuple((j * 7 % 11 - 5) / 10 for j in range(65))

WEEKDAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")
LANGS = ("de", "en", "es", "fr")
SOURCES = tuple(f"src{i}" for i in range(20))
PRODUCT_TYPES = ("economy", "large", "medium", "promo", "small", "standard")
NAME_FIRST = ("blue", "cold", "hot", "large", "new", "old", "red", "small")
NAME_SECOND = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
WEB_CATEGORIES = ("arts_and_entertainment", "home_and_garden", "news", "shopping")

HOST = r"regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)"
DOMAIN = rf"regexp_replace(lower({HOST}), '^www\.', '')"
MILLIS = "epoch_us(ts) // 1000"

TEXT_TIMES = """WITH written AS (
  SELECT event_id, CASE event_id % 8
    WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
    WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
    WHEN 2 THEN strftime(ts, '%d.%m.%Y %H:%M')
    WHEN 3 THEN strftime(ts, '%Y-%m-%d')
    WHEN 4 THEN strftime(ts, '%Y%m%d')
    WHEN 5 THEN '31.02.' || strftime(ts, '%Y') || ' 10:00'
    WHEN 6 THEN '  ' END AS text FROM events),
parsed AS (
  SELECT event_id, text, epoch_ms(coalesce(
    try_strptime(text, ['%Y-%m-%d %H:%M:%S', '%d.%m.%Y %H:%M', '%Y-%m-%d', '%Y%m%d']),
    CASE WHEN text LIKE '%+02:00' THEN
      try_strptime(left(text, 19), '%Y-%m-%dT%H:%M:%S') - INTERVAL 2 HOURS END)) AS millis
  FROM written)
SELECT event_id, text, millis,
  CASE WHEN text IS NULL THEN 'missing' WHEN trim(text) = '' THEN 'empty'
       WHEN millis IS NULL THEN 'no layout' END AS reason,
  strftime(epoch_ms(millis), '%Y-%m-%d') AS day FROM parsed"""
WEB = f"""web AS (
  SELECT CAST(e.user_id AS VARCHAR) AS uid, {MILLIS} AS timestamp, p.url, e.event_id, e.ts
  FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages))"""
COUNTS = f"""counts AS (
  SELECT uid, {DOMAIN} AS domain, count(*) AS cnt FROM web GROUP BY ALL)"""
TOP = f"""top AS (
  SELECT domain, sum(cnt)::BIGINT AS count FROM counts GROUP BY domain
  ORDER BY count DESC, domain LIMIT {TOP_N})"""
EVERY = """top AS (
  SELECT domain, sum(cnt)::BIGINT AS count FROM counts WHERE domain IS NOT NULL GROUP BY domain)"""
RANKED = """ranked AS (
  SELECT row_number() OVER (ORDER BY count DESC, domain) - 1 AS term, domain, count
  FROM (SELECT domain, sum(cnt)::BIGINT AS count FROM counts
        WHERE domain IS NOT NULL GROUP BY domain))"""
GRID = """grid AS (
  SELECT u.uid, t.domain, coalesce(c.cnt, 0) AS cnt
  FROM (SELECT DISTINCT uid FROM web) u CROSS JOIN top t
  LEFT JOIN counts c ON c.uid = u.uid AND c.domain = t.domain)"""
SHOP = f"""shop AS (
  SELECT CAST(e.user_id AS VARCHAR) AS uid,
         CASE e.event_type WHEN 'purchase' THEN 'buy' ELSE e.event_type END AS event_type,
         p.p_name AS category, p.p_type || '-' || (p.p_partkey % 10) AS item_id,
         {MILLIS} AS timestamp, strftime(ts, '%Y%m%d') AS date
  FROM events e JOIN part p ON p.p_partkey = e.event_id % (SELECT count(*) FROM part)
  WHERE e.event_type IN ('view', 'purchase'))"""
CLIENTS = """clients AS (
  SELECT CAST(c_custkey AS VARCHAR) AS uid, c_mktsegment AS segment, c_nationkey AS nation
  FROM customer)"""
CATEGORIES = f"""cats AS (
  SELECT domain, ['Arts and Entertainment', 'Home-and Garden', 'News', 'Shopping']
                 [length(domain) % 4 + 1] AS category
  FROM (SELECT DISTINCT {DOMAIN} AS domain FROM pages))"""
STUDY = """study AS (
  SELECT l.doc_id, d.n_chars, l.quality, d.lang, d.source,
         CASE WHEN l.doc_id % 17 = 0 THEN ' ' ELSE CAST(d.n_chars AS VARCHAR) END AS spent,
         l.toxic
  FROM labels l JOIN documents d USING (doc_id)),
clean AS (SELECT *, TRY_CAST(spent AS DOUBLE) AS "TotalSpent" FROM study)"""
SCORES = """scores AS (
  SELECT l.doc_id, l.toxic, 1 / (1 + exp(-(d.n_chars - 2500) / 1000.0::DOUBLE)) AS p
  FROM labels l JOIN documents d USING (doc_id))"""
RAW = """raw AS (
  SELECT vec_id, label, list_transform(range(10), lambda c:
         list_sum(list_transform(range(64), lambda j:
           embedding[j + 1]::DOUBLE * ((((c * 31 + j * 17) % 23) - 11) / 10.0::DOUBLE)))) AS scores
  FROM embeddings),
predicted AS (
  SELECT *, list_position(scores, list_max(scores)) - 1 AS predicted FROM raw)"""
LONG_RAW = """long_raw AS (
  SELECT vec_id, label, unnest(scores) AS s, generate_subscripts(scores, 1) - 1 AS pos FROM raw)"""
DAILY = """daily AS (
  SELECT dayofmonth(ts)::INTEGER AS epoch, count(*) AS n, round(avg(value), 1) AS metric
  FROM events GROUP BY 1)"""
VECTORS = """vectors AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
         generate_subscripts(embedding, 1) AS pos FROM embeddings)"""
PER_CLASS = """per_class AS (
  SELECT label, coalesce(hits / nullif(predicted, 0), 0.0) AS precision,
         coalesce(hits / nullif(support, 0), 0.0) AS recall,
         coalesce(2 * hits / nullif(predicted + support, 0), 0.0) AS f1, support
  FROM (SELECT label, sum(s)::BIGINT AS support, sum(q)::BIGINT AS predicted,
               sum(h)::BIGINT AS hits
        FROM (SELECT label, 1 AS s, 0 AS q, (label = predicted)::INT AS h FROM predicted
              UNION ALL SELECT predicted, 0, 1, 0 FROM predicted)
        GROUP BY label))"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _snake(text: str) -> str:
    return f"translate(lower({text}), ' -', '__')"


def _double_list(values) -> str:
    return "[" + ", ".join(f"{v!r}::DOUBLE" for v in values) + "]"


def _count_columns(column: str, values: list[str], weight: str = "1") -> str:
    return ", ".join(
        f"coalesce(sum({weight}) FILTER ({column} = '{v}'), 0)::BIGINT AS \"{v}\"" for v in values
    )


SHOP_VALUES = [f"shop_{a}_{b}" for a in NAME_FIRST for b in NAME_SECOND]
WEB_VALUES = [f"web_{c}" for c in WEB_CATEGORIES]
ITEM_VALUES = [f"{e}_{t}_{i}" for e in ("view", "buy") for t in PRODUCT_TYPES for i in range(10)]

SHOP_MATRIX = f"""shop_matrix AS (
  SELECT uid, {_count_columns("c", SHOP_VALUES)}
  FROM (SELECT uid, 'shop_' || {_snake("category")} AS c FROM shop WHERE event_type = 'view')
  GROUP BY uid)"""
ITEM_MATRIX = f"""item_matrix AS (
  SELECT uid, {_count_columns("c", ITEM_VALUES)}
  FROM (SELECT uid, event_type || '_' || {_snake("item_id")} AS c FROM shop) GROUP BY uid)"""
TIME_COLUMNS = ", ".join(
    [f"count(*) FILTER (lower(strftime(ts, '%a')) = '{d}') AS web_day_{d}" for d in WEEKDAYS]
    + [f"count(*) FILTER (hour(ts) = {h}) AS web_hour_{h}" for h in range(24)]
)
WORK = "count(*) FILTER (hour(ts) >= 9 AND hour(ts) < 18)"
EVENING = "count(*) FILTER (hour(ts) >= 18)"
FRACTIONS = (
    f"round({WORK} / count(*), 6) AS web_fraction_work_hours, "
    f"round({EVENING} / count(*), 6) AS web_fraction_evening_hours"
)
VECTOR = """vector AS (
  SELECT uid, string_agg(CAST(cnt AS VARCHAR), ',' ORDER BY domain) AS domain_features
  FROM grid GROUP BY uid)"""


def _category_counts(site: str) -> str:
    return f"""category_counts AS (
  SELECT uid, 'web_' || {_snake("category")} AS category, count(*) AS cnt
  FROM web JOIN cats ON cats.domain = {site} GROUP BY ALL)"""


WEB_MATRIX = f"""web_matrix AS (
  SELECT uid, {_count_columns("category", WEB_VALUES, "cnt")} FROM category_counts GROUP BY uid)"""


def _data_mart(site: str) -> str:
    return _with(
        WEB, CATEGORIES, _category_counts(site), SHOP, CLIENTS, SHOP_MATRIX, WEB_MATRIX,
        select="SELECT * FROM clients LEFT JOIN shop_matrix USING (uid) "
        "LEFT JOIN web_matrix USING (uid)",
    )


def _auc(score: str) -> str:
    """Share of positive-negative pairs in the right order, by mid-ranks."""
    return _with(
        SCORES,
        f"g AS (SELECT {score} AS s, sum(toxic) AS pos, sum(1 - toxic) AS neg "
        "FROM scores GROUP BY 1)",
        "w AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0) AS below FROM g)",
        select="SELECT round(sum(pos * (below + neg / 2.0::DOUBLE)) "
        "/ (sum(pos)::DOUBLE * sum(neg)::DOUBLE), 6) AS roc_auc FROM w",
    )


def _sources_and_filters() -> dict[str, str]:
    return {
        "read_source": "SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance "
        "FROM customer GROUP BY 1",
        "scan_json_visits": _with(WEB, select="SELECT uid, timestamp, url FROM web"),
        "parse_json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k "
        "FROM events",
        "scan_csv": "SELECT * FROM customer",
        "path_labels": "SELECT page_id, string_split(url, '/')[-2] AS folder, "
        "string_split(url, '/')[-1] AS file FROM pages",
        "file_manifest": _with(
            SHOP, select="SELECT DISTINCT '$date=' || date AS label, true AS filled FROM shop"
        ),
        "event_split": _with(
            SHOP,
            select="SELECT event_type AS tree, event_type, date, date AS folder, count(*) AS n, "
            "sum(timestamp)::BIGINT AS sum_timestamp FROM shop GROUP BY ALL",
        ),
        "topic_reload": _with(
            SHOP,
            select="SELECT event_type AS tree, event_type, date, date AS folder, count(*) AS n, "
            "sum(timestamp)::BIGINT AS sum_timestamp FROM shop GROUP BY ALL",
        ),
        "rows_to_json": _with(
            CLIENTS,
            select="SELECT CAST(to_json({'uid': uid, 'segment': segment, 'nation': nation}) "
            "AS VARCHAR) AS value, 'clients' AS topic FROM clients",
        ),
        "filter_views": "SELECT event_id, user_id, value FROM events WHERE event_type = 'view'",
        "filter_not_null": _with(
            STUDY,
            select='SELECT doc_id, "TotalSpent" FROM clean WHERE "TotalSpent" IS NOT NULL',
        ),
        "filter_null": _with(
            STUDY, select='SELECT doc_id, lang FROM clean WHERE "TotalSpent" IS NULL'
        ),
        "filter_in_set": "SELECT event_id, event_type, value FROM events "
        "WHERE event_type IN ('view', 'purchase') AND value > 10",
        "coerce_numeric": _with(STUDY, select='SELECT doc_id, "TotalSpent" FROM clean'),
        "impute_mean": _with(
            STUDY,
            select='SELECT doc_id, round(coalesce("TotalSpent", '
            '(SELECT avg("TotalSpent") FROM clean)), 6) AS "TotalSpent" FROM clean',
        ),
        "fill_zero": _with(
            STUDY,
            select='SELECT doc_id, coalesce("TotalSpent", 0) AS "TotalSpent", lang FROM clean',
        ),
        "null_census": _with(
            STUDY,
            select=" UNION ALL ".join(
                f"SELECT '{c}' AS feature, count(*) FILTER (\"{c}\" IS NULL) AS nulls FROM clean"
                for c in ("doc_id", "n_chars", "quality", "lang", "source", "TotalSpent", "toxic")
            ),
        ),
        "sample_rows": "SELECT doc_id, lang, source FROM documents "
        "ORDER BY md5('42-' || doc_id) LIMIT 8",
        "sample_share": "SELECT doc_id, lang, source FROM documents "
        "WHERE md5('42-' || doc_id)[1:8] < '1999999a'",
    }


def _functions() -> dict[str, str]:
    return {
        "url_domain": f"SELECT page_id, {HOST} AS host, {DOMAIN} AS domain FROM pages",
        "url_domain_legacy": f"SELECT page_id, regexp_replace(lower({HOST}), 'www.', '', 'g') "
        "AS domain FROM pages",
        "url_domain_literal": f"SELECT page_id, replace({HOST}, 'www.', '') AS domain FROM pages",
        "normalize_name": f"SELECT p_partkey, 'shop_' || {_snake('p_name')} AS name FROM part",
        "item_key": _with(
            SHOP,
            select=f"SELECT uid, timestamp, event_type || '_' || {_snake('item_id')} AS item "
            "FROM shop",
        ),
        "display_name": "SELECT p_partkey, list_aggregate(list_transform(string_split("
        "p_type || '_' || replace(p_name, ' ', '_'), '_'), "
        "lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') AS name FROM part",
        "utc_date": f"SELECT event_id, {MILLIS} AS timestamp, strftime(ts, '%Y%m%d') AS day, "
        "strftime(ts, '%Y-%m-%d') AS date_text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text, "
        "lower(strftime(ts, '%a')) AS weekday, hour(ts)::INTEGER AS hour FROM events",
        "text_times": TEXT_TIMES,
        "explode_visits": _with(
            WEB, select="SELECT uid, event_id // 1000 AS block, timestamp, url FROM web"
        ),
    }


def _joins_and_pivots() -> dict[str, str]:
    counts = "SELECT uid, category, cnt FROM category_counts"
    return {
        "union_visits": _with(SHOP, select="SELECT * FROM shop"),
        "visits_of_clients": _with(
            SHOP, CLIENTS,
            select="SELECT uid, category FROM shop WHERE event_type = 'view' "
            "AND uid IN (SELECT uid FROM clients)",
        ),
        "web_category_counts": _with(WEB, CATEGORIES, _category_counts(DOMAIN), select=counts),
        "web_category_counts_host": _with(WEB, CATEGORIES, _category_counts(HOST), select=counts),
        "shop_matrix": _with(SHOP, SHOP_MATRIX, select="SELECT * FROM shop_matrix"),
        "shop_counts": _with(
            SHOP,
            select=f"SELECT uid, 'shop_' || {_snake('category')} AS category, count(*) AS cnt "
            "FROM shop WHERE event_type = 'view' GROUP BY ALL",
        ),
        "web_matrix": _with(
            WEB, CATEGORIES, _category_counts(DOMAIN), WEB_MATRIX,
            select="SELECT * FROM web_matrix",
        ),
        "data_mart": _data_mart(DOMAIN),
        "data_mart_host": _data_mart(HOST),
        "user_item_matrix": _with(SHOP, ITEM_MATRIX, select="SELECT * FROM item_matrix"),
        "matrix_update": _with(SHOP, ITEM_MATRIX, select="SELECT * FROM item_matrix"),
        "matrix_snapshot_date": _with(SHOP, select="SELECT max(date) AS snapshot_date FROM shop"),
    }


def _web_features() -> dict[str, str]:
    probes = ", ".join(
        f"CAST(string_split(domain_features, ',')[{p}] AS BIGINT) AS col{p}" for p in PROBES
    )
    return {
        "domain_counts": _with(
            WEB, COUNTS,
            select="SELECT domain, sum(cnt)::BIGINT AS count FROM counts GROUP BY domain",
        ),
        "top_domains": _with(WEB, COUNTS, TOP, select="SELECT * FROM top"),
        "top_domain_vocab": _with(
            WEB, COUNTS, TOP,
            select="SELECT string_agg(domain, ',' ORDER BY domain) AS domains FROM top",
        ),
        "distinct_users": _with(
            WEB, select="SELECT count(uid) AS n, count(DISTINCT uid) AS n_distinct FROM web"
        ),
        "user_domain_grid": _with(
            WEB, COUNTS, TOP, GRID, select="SELECT uid, domain FROM grid WHERE cnt > 0"
        ),
        "domain_positions": _with(
            WEB, COUNTS, TOP, GRID,
            select="SELECT * FROM (SELECT uid, domain, "
            "row_number() OVER (PARTITION BY uid ORDER BY domain)::INTEGER AS position, cnt "
            "FROM grid) WHERE cnt > 0",
        ),
        "domain_vector": _with(WEB, COUNTS, TOP, GRID, VECTOR, select="SELECT * FROM vector"),
        "vector_probe": _with(
            WEB, COUNTS, TOP, GRID, VECTOR, select=f"SELECT uid, {probes} FROM vector"
        ),
        "web_day": _with(
            WEB,
            select="SELECT uid, " + TIME_COLUMNS.split(", count(*) FILTER (hour")[0]
            + " FROM web GROUP BY uid",
        ),
        "web_hour": _with(
            WEB,
            select="SELECT uid, "
            + ", ".join(f"count(*) FILTER (hour(ts) = {h}) AS web_hour_{h}" for h in range(24))
            + " FROM web GROUP BY uid",
        ),
        "work_evening": _with(
            WEB,
            select=f"SELECT uid, count(*) AS all_visit, {WORK} AS visit_work, "
            f"{EVENING} AS visit_evening, {FRACTIONS} FROM web GROUP BY uid",
        ),
        "feature_store": _with(
            WEB, COUNTS, TOP, GRID, VECTOR, SHOP, ITEM_MATRIX,
            f"times AS (SELECT uid, {FRACTIONS}, {TIME_COLUMNS} FROM web GROUP BY uid)",
            select="SELECT vector.uid, domain_features, times.* EXCLUDE (uid), "
            + ", ".join(f'coalesce(m."{c}", 0) AS "{c}"' for c in ITEM_VALUES)
            + " FROM vector JOIN times ON times.uid = vector.uid "
            "LEFT JOIN item_matrix m ON m.uid = vector.uid",
        ),
        "domain_tokens": _with(
            WEB,
            select=f"SELECT uid, event_id // 1000 AS block, "
            f"string_agg({DOMAIN}, ',' ORDER BY timestamp, url) AS domain_features "
            "FROM web GROUP BY ALL",
        ),
        "domain_dictionary": _with(
            WEB, COUNTS, RANKED,
            select="SELECT term, domain, count FROM ranked",
        ),
        "dictionary_cut": _with(
            WEB, COUNTS, RANKED,
            select="SELECT count(*) AS terms, sum(count)::BIGINT AS visits, "
            "count(*) FILTER (term >= size) AS terms_left_out, "
            "coalesce(sum(count) FILTER (term >= size), 0)::BIGINT AS visits_left_out "
            "FROM ranked, (SELECT count(*) // 2 AS size FROM ranked)",
        ),
        "bag_of_domains": _with(
            WEB, COUNTS, EVERY, GRID,
            select="SELECT g.uid, string_agg(CAST(g.cnt AS VARCHAR), ',' "
            "ORDER BY t.count DESC, t.domain) AS features "
            "FROM grid g JOIN top t USING (domain) GROUP BY g.uid",
        ),
    }


def _statistics() -> dict[str, str]:
    bins = """WITH s AS (
  SELECT min(n_chars)::DOUBLE AS lo, (max(n_chars) - min(n_chars)) / 30.0::DOUBLE AS w
  FROM documents),
hits AS (
  SELECT least(floor((n_chars::DOUBLE - lo) / w), 29)::INTEGER AS bin, count(*) AS n
  FROM documents, s GROUP BY 1)
SELECT r.bin::INTEGER AS bin, round(lo + r.bin * w, 6) AS low,
       round(lo + (r.bin + 1) * w, 6) AS high, coalesce(n, 0) AS n
FROM s, range(30) r(bin) LEFT JOIN hits ON hits.bin = r.bin"""
    box = """WITH q AS (
  SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS m,
         quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT round(any_value(q1), 6) AS q1, round(any_value(m), 6) AS median,
       round(any_value(q3), 6) AS q3,
       round(min(l_extendedprice) FILTER (l_extendedprice BETWEEN lo AND hi), 6) AS whisker_low,
       round(max(l_extendedprice) FILTER (l_extendedprice BETWEEN lo AND hi), 6) AS whisker_high,
       count(*) FILTER (l_extendedprice NOT BETWEEN lo AND hi) AS outliers
FROM lineitem, f"""
    return {
        "row_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", count(*) AS n FROM {t}" for t in TABLES
        ),
        "value_counts": _with(
            STUDY,
            select=" UNION ALL ".join(
                f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n "
                f"FROM study GROUP BY {c}"
                for c in ("lang", "source", "toxic")
            ),
        ),
        "class_balance": _with(
            STUDY,
            select="SELECT toxic, count(*) AS n, "
            "round(count(*) / (SELECT count(*) FROM study), 6) AS share FROM study GROUP BY 1",
        ),
        "histogram": bins,
        "boxplot": box,
        "quantiles": " UNION ALL ".join(
            f"SELECT {s}::DOUBLE AS share, round(quantile_cont(n_chars, {s}), 6)::DOUBLE AS value "
            "FROM documents"
            for s in SHARES
        ),
        "weighted_metric": _with(
            DAILY, select="SELECT round(sum(metric * n) / sum(n), 6) AS metric FROM daily"
        ),
        "best_epoch": _with(
            DAILY, select="SELECT * FROM daily ORDER BY metric DESC, epoch LIMIT 1"
        ),
    }


def _encoders_and_splits() -> dict[str, str]:
    levels = [("lang", v) for v in LANGS] + [("source", v) for v in SOURCES]
    return {
        "label_vocab": "SELECT (row_number() OVER (ORDER BY label) - 1)::INTEGER AS idx, label "
        "FROM (SELECT DISTINCT c_mktsegment AS label FROM customer)",
        "label_index": "SELECT CAST(c_custkey AS VARCHAR) AS uid, label FROM customer JOIN ("
        "SELECT c_mktsegment, (row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1)"
        "::DOUBLE AS label FROM customer GROUP BY 1) USING (c_mktsegment)",
        "ordered_target": _with(
            STUDY,
            select="SELECT doc_id, lang, source, toxic, "
            + ", ".join(
                f"round((coalesce(sum(toxic) OVER {c}_before, 0) + avg(toxic) OVER ()) / "
                f"(count(toxic) OVER {c}_before + 1), 9) AS {c}_target"
                for c in ("lang", "source")
            )
            + " FROM study WINDOW "
            + ", ".join(
                f"{c}_before AS (PARTITION BY {c} ORDER BY md5('7-' || doc_id) "
                "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
                for c in ("lang", "source")
            ),
        ),
        "target_encode": _with(
            STUDY,
            select="SELECT d.doc_id, d.source, round(coalesce(s.value, p.prior), 9) "
            "AS source_target FROM documents d ANTI JOIN labels l USING (doc_id) "
            "CROSS JOIN (SELECT avg(toxic) AS prior FROM study) p LEFT JOIN ("
            "SELECT source, (sum(toxic) + (SELECT avg(toxic) FROM study)) / (count(toxic) + 1) "
            "AS value FROM study GROUP BY source) s ON s.source IS NOT DISTINCT FROM d.source",
        ),
        "one_hot": _with(
            STUDY,
            select="SELECT doc_id, "
            + ", ".join(f"({c} = '{v}')::INTEGER AS {c}_{v}" for c, v in levels)
            + " FROM study",
        ),
        "standardize": _with(
            STUDY,
            select="SELECT doc_id, "
            + ", ".join(
                f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}"
                for c in ("n_chars", "quality")
            )
            + " FROM study",
        ),
        "train_test_split": "SELECT doc_id, CASE WHEN row_number() OVER ("
        "ORDER BY md5('42-' || doc_id)) <= floor(count(*) OVER () * 0.8::DOUBLE) "
        "THEN 'train' ELSE 'test' END AS part FROM documents",
        "stratified_split": "SELECT doc_id, lang, CASE WHEN row_number() OVER ("
        "PARTITION BY lang ORDER BY md5('42-' || doc_id)) <= "
        "ceil(count(*) OVER (PARTITION BY lang) * 0.25::DOUBLE) "
        "THEN 'test' ELSE 'train' END AS part FROM documents",
        "epoch_batches": _epoch("documents", 1, "doc_id"),
    }


def _models() -> dict[str, str]:
    """What SQL can decide about fitted models: hold-out rows, grids, folds, class counts."""
    study = "SELECT l.doc_id FROM labels l JOIN documents d USING (doc_id)"
    parts = f"""parts AS (
  SELECT doc_id, row_number() OVER (ORDER BY md5('42-' || doc_id))
                 <= floor(count(*) OVER () * 0.8::DOUBLE) AS train FROM ({study}))"""
    held = _with(parts, select="SELECT doc_id, true AS valid FROM parts WHERE NOT train")
    rows = "(SELECT count(*) FROM parts WHERE train) AS train_rows, true AS scored"
    head = """head AS (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42-' || vec_id))
         <= ceil(count(*) OVER (PARTITION BY label) * 0.25::DOUBLE) AS held FROM embeddings)"""

    def points(**values) -> str:
        lists = [f"(SELECT unnest({list(map(float, v))}::DOUBLE[]) AS {k})" for k, v in values.items()]
        return f"SELECT {', '.join(values)}, {rows} FROM {' CROSS JOIN '.join(lists)}"

    fold = "(('0x' || md5('fold-42-' || doc_id)[1:8])::BIGINT * 5 // 4294967296)::INTEGER"
    return {
        "submission": _with(
            parts, select="SELECT doc_id AS \"Id\", true AS valid FROM parts WHERE NOT train"
        ),
        "train_gender_age": _with(WEB, select="SELECT DISTINCT uid, true AS known FROM web"),
        "stream_score": _with(WEB, select="SELECT DISTINCT uid, true AS agrees FROM web"),
        "grid_search": _with(parts, select=points(c=(100, 10, 1, 0.1, 0.01, 0.001))),
        "gbt_churn": held,
        "gbt_grid": _with(
            parts,
            select=points(
                step=(0.03, 0.1), depth=(4, 6, 10), gain=(0.001, 0.003, 0.005, 0.007, 0.009)
            ),
        ),
        "rf_churn": _with(parts, select=points(trees=(50, 100, 500, 1000, 2000))),
        "elastic_net": "SELECT unnest(range(28))::INTEGER AS pos, true AS optimal",
        "cv_accuracy": f"SELECT {fold} AS fold, count(*) AS n, true AS accurate "
        f"FROM ({study}) GROUP BY 1",
        "own_model": _with(
            "vals AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, "
            "generate_subscripts(embedding, 1) AS pos FROM embeddings)",
            "means AS (SELECT label, pos, avg(v) AS mean FROM vals GROUP BY ALL)",
            "gaps AS (SELECT vec_id, m.label, sum((v - mean) * (v - mean)) AS gap "
            "FROM vals JOIN means m USING (pos) GROUP BY ALL)",
            select="SELECT vec_id, arg_min(label, gap) AS nearest, count(*)::INTEGER AS classes, "
            "round(min(gap), 4) AS distance FROM gaps GROUP BY vec_id",
        ),
        "linear_head": _with(
            head,
            select="SELECT vec_id, label, (SELECT count(DISTINCT label) FROM embeddings)::INTEGER "
            "AS classes, true AS named FROM head WHERE held",
        ),
        "linear_head_report": _with(
            head,
            select="SELECT CAST(label AS VARCHAR) AS label, count(*) AS support, true AS shares "
            "FROM head WHERE held GROUP BY ALL UNION ALL "
            "SELECT unnest(['macro avg', 'weighted avg']), (SELECT count(*) FROM head WHERE held), "
            "true",
        ),
    }


def _epoch(source: str, epoch: int, columns: str) -> str:
    return f"""SELECT {columns}, batch FROM (
  SELECT *, (row_number() OVER (ORDER BY md5('42-{epoch}-' || doc_id)) - 1) // {BATCH_SIZE}
            AS batch, count(*) OVER () AS total FROM {source})
WHERE (batch + 1) * {BATCH_SIZE} <= total"""


def _scores_and_metrics() -> dict[str, str]:
    weights = _double_list(VECTOR_WEIGHTS)
    w0, w1, w2 = STUDY_WEIGHTS
    logits = f"""logits AS (
  SELECT vec_id, label, 1 / (1 + exp(-(any_value(({weights})[1])
         + sum(x * ({weights})[pos + 1])))) AS p FROM vectors GROUP BY vec_id, label)"""
    mean = "avg(f1) AS f1, sum(support)::BIGINT AS support FROM per_class"
    weighted = {c: f"sum({c} * support) / sum(support)" for c in ("precision", "recall", "f1")}
    return {
        "logit_score": _with(
            VECTORS, logits,
            select="SELECT vec_id, round(p, 6) AS probability, p >= 0.5 AS predicted FROM logits",
        ),
        "enet_gradient": _with(
            VECTORS, logits,
            "terms AS (SELECT vec_id, pos, x FROM vectors UNION ALL "
            "SELECT vec_id, 0, 1 FROM embeddings)",
            "means AS (SELECT pos, avg((p - (label = 0)::INT) * x) AS g "
            "FROM terms JOIN logits USING (vec_id) GROUP BY pos)",
            f"weighted AS (SELECT pos, g, ({weights})[pos + 1] AS w FROM means)",
            select="SELECT pos::INTEGER AS pos, round(g + CASE WHEN pos > 0 "
            "THEN 0.1::DOUBLE * sign(w) + 0.2::DOUBLE * w ELSE 0 END, 6) AS gradient "
            "FROM weighted",
        ),
        "batch_loss": _with(
            STUDY,
            f"batches AS ({_epoch('study', 0, 'doc_id, toxic, n_chars, quality')})",
            f"scored AS (SELECT *, 1 / (1 + exp(-({w0}::DOUBLE + {w1}::DOUBLE * "
            f"((n_chars - 2500) / 1000.0::DOUBLE) + {w2}::DOUBLE * quality))) AS p FROM batches)",
            select="SELECT batch, count(*) AS n, round(-avg(toxic * ln(p) "
            "+ (1 - toxic) * ln(1 - p)), 6) AS loss FROM scored GROUP BY batch",
        ),
        "log_loss": _with(
            SCORES,
            "clipped AS (SELECT toxic, least(greatest(p, 1e-10::DOUBLE), 1 - 1e-10::DOUBLE) AS p "
            "FROM scores)",
            select="SELECT round(-avg(toxic * ln(p) + (1 - toxic) * ln(1 - p)), 6) AS log_loss "
            "FROM clipped",
        ),
        "roc_auc": _auc("p"),
        "roc_auc_hard": _auc("(p >= 0.5)::INT"),
        "softmax": _with(
            RAW, LONG_RAW,
            select="SELECT vec_id, pos::INTEGER AS pos, "
            "round(exp(s) / sum(exp(s)) OVER (PARTITION BY vec_id), 6) AS p FROM long_raw",
        ),
        "argmax_label": _with(
            RAW,
            select="SELECT vec_id, predicted::INTEGER AS class_index, "
            "CAST(predicted AS VARCHAR) AS class_name FROM predicted",
        ),
        "accuracy": _with(
            RAW,
            select="SELECT round(avg((label = predicted)::INT), 6) AS accuracy FROM predicted",
        ),
        "weighted_f1": _with(
            RAW, PER_CLASS,
            select=f"SELECT round({weighted['f1']}, 6) AS weighted_f1 FROM per_class",
        ),
        "classification_report": _with(
            RAW, PER_CLASS,
            "report AS (SELECT CAST(label AS VARCHAR) AS label, precision, recall, f1, support "
            "FROM per_class UNION ALL SELECT 'macro avg', avg(precision), avg(recall), "
            f"{mean} UNION ALL SELECT 'weighted avg', {weighted['precision']}, "
            f"{weighted['recall']}, {weighted['f1']}, sum(support)::BIGINT FROM per_class)",
            select="SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, "
            "round(f1, 6) AS f1, support FROM report",
        ),
        "cross_entropy": _with(
            RAW, LONG_RAW,
            "per_row AS (SELECT vec_id, ln(sum(exp(s))) - max(s) FILTER (pos = label) AS loss "
            "FROM long_raw GROUP BY vec_id)",
            select="SELECT round(avg(loss), 6) AS cross_entropy FROM per_row",
        ),
        "fixed_standardize": _with(
            VECTORS,
            "scaled AS (SELECT vec_id, pos - 1 AS pos, "
            "([0.485, 0.456, 0.406]::DOUBLE[])[(pos - 1) % 3 + 1] AS m, "
            "([0.229, 0.224, 0.225]::DOUBLE[])[(pos - 1) % 3 + 1] AS s, "
            "abs(x) * 255 / 255.0::DOUBLE AS v FROM vectors)",
            select="SELECT vec_id, pos::INTEGER AS pos, round((v - m) / s, 6) AS scaled, "
            "round(least(greatest((v - m) / s * s + m, 0), 1), 6) AS restored FROM scaled",
        ),
    }


def _streams() -> dict[str, str]:
    return {
        "stream_tokens_stateless": _with(
            WEB,
            select="SELECT uid, domain_features FROM (SELECT uid, event_id // 1000 AS block, "
            f"string_agg({DOMAIN}, ',' ORDER BY timestamp, url) AS domain_features "
            "FROM web GROUP BY ALL)",
        ),
        "counts_replay": _with(
            WEB, COUNTS, select="SELECT uid, domain, cnt FROM counts"
        ),
        "outbox_replay": _with(
            WEB, COUNTS, select="SELECT uid, domain, cnt FROM counts"
        ),
        "stream_tokens_stateful": _with(
            WEB, COUNTS, select="SELECT uid, domain, cnt FROM counts"
        ),
    }


def all_queries() -> dict[str, str]:
    """Name of a registered query to its SQL."""
    return {
        **_sources_and_filters(),
        **_functions(),
        **_joins_and_pivots(),
        **_web_features(),
        **_statistics(),
        **_encoders_and_splits(),
        **_scores_and_metrics(),
        **_streams(),
        **_models(),
    }
