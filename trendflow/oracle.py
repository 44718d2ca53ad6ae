"""DuckDB SQL that must return the same rows as each registered query.

Written independently of the Spark code from the operator definitions;
shared building blocks are CTE texts. DuckDB specifics: ``sum(bigint)``
is HUGEINT (cast back), integer text casts round (so text -> bigint goes
through an explicit integer pattern first), and ``/`` on integers is a
double division like Spark's.
"""

from __future__ import annotations


def _tolong(x: str) -> str:
    """Spark try_long: integer text exactly, else truncated double, else null."""
    return (f"coalesce(CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') "
            f"THEN try_cast(trim({x}) AS BIGINT) END, "
            f"CAST(trunc(try_cast({x} AS DOUBLE)) AS BIGINT))")


def _ratio(num: str) -> str:
    return f"CASE WHEN views > 0 THEN round(({num}) / views * 100, 4) ELSE 0.0 END"


def _exact_avg(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(28,4))) AS DOUBLE) / count({c})"


def _parse_date(c: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, '\\d{{2}}\\.\\d{{2}}\\.\\d{{2}}') "
            f"THEN CAST(try_strptime({c}, '%y.%d.%m') AS DATE) "
            f"ELSE try_cast({c} AS DATE) END")


FACTS = """facts AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
         l_discount, l_tax, l_shipdate, p_name, p_type, s_name, s_nationkey, n_name, r_name
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

STATS = """stats AS (
  SELECT CAST(l_partkey AS VARCHAR) AS video_id,
         CAST(l_shipdate AS DATE) AS trending_date_parsed,
         p_name AS title, s_name AS channel_title,
         CAST(CASE WHEN l_orderkey % 103 = 0 THEN 99 ELSE s_nationkey END AS BIGINT) AS category_id,
         CAST(floor(l_extendedprice) AS BIGINT) AS views,
         CAST(floor(l_quantity * 100) AS BIGINT) AS likes,
         CAST(round(l_discount * 100) AS BIGINT) AS dislikes,
         CAST(round(l_tax * 100) AS BIGINT) AS comment_count,
         lower(r_name) AS region
  FROM facts)"""

GAPS = """gaps AS (
  SELECT CAST(l_partkey AS VARCHAR) AS video_id,
         CAST(l_shipdate AS DATE) AS trending_date_parsed,
         CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE p_name END AS title,
         CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE s_name END AS channel_title,
         CAST(s_nationkey AS BIGINT) AS category_id,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL
              WHEN l_orderkey % 79 = 0 THEN 0
              WHEN l_orderkey % 73 = 0 THEN -CAST(floor(l_extendedprice) AS BIGINT)
              ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS views,
         CASE WHEN l_orderkey % 71 = 0 THEN NULL
              ELSE CAST(floor(l_quantity * 100) AS BIGINT) END AS likes,
         CASE WHEN l_orderkey % 67 = 0 THEN NULL
              ELSE CAST(round(l_discount * 100) AS BIGINT) END AS dislikes,
         CASE WHEN l_orderkey % 61 = 0 THEN NULL
              ELSE CAST(round(l_tax * 100) AS BIGINT) END AS comment_count,
         lower(r_name) AS region
  FROM facts)"""

SILVER = f"""metric AS (
  SELECT *, {_ratio('likes')} AS like_ratio,
         {_ratio('likes + dislikes + comment_count')} AS engagement_rate
  FROM stats),
silver AS (
  SELECT * FROM metric
  QUALIFY row_number() OVER (
    PARTITION BY video_id, region, trending_date_parsed
    ORDER BY views DESC NULLS LAST, likes DESC NULLS LAST, dislikes DESC NULLS LAST,
             comment_count DESC NULLS LAST, title ASC NULLS FIRST,
             channel_title ASC NULLS FIRST, category_id ASC NULLS FIRST,
             like_ratio ASC NULLS FIRST, engagement_rate ASC NULLS FIRST) = 1)"""

LOOKUP = """lookup AS (
  SELECT CAST(n_nationkey AS BIGINT) AS category_id, n_name AS category_name,
         lower(r_name) AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey),
lk AS (
  SELECT category_id, region, max(category_name) AS category_name
  FROM lookup GROUP BY category_id, region)"""

GOLD_IN = f"""{FACTS},
{STATS},
{SILVER},
{LOOKUP},
gold_in AS (
  SELECT s.*, coalesce(lk.category_name, 'Unknown') AS category_name
  FROM silver s LEFT JOIN lk ON s.category_id = lk.category_id AND s.region = lk.region)"""

CHANNELS = f"""ch AS (
  SELECT channel_title, region,
         count(DISTINCT video_id) AS total_videos,
         CAST(sum(views) AS BIGINT) AS total_views,
         CAST(sum(likes) AS BIGINT) AS total_likes,
         CAST(sum(comment_count) AS BIGINT) AS total_comments,
         avg(views) AS avg_views_per_video,
         {_exact_avg('engagement_rate')} AS avg_engagement_rate,
         max(views) AS peak_views,
         count(trending_date_parsed) AS times_trending,
         min(trending_date_parsed) AS first_trending,
         max(trending_date_parsed) AS last_trending,
         list_sort(list(DISTINCT category_name) FILTER (WHERE category_name IS NOT NULL))
           AS categories
  FROM gold_in GROUP BY channel_title, region),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY region
           ORDER BY total_views DESC NULLS LAST, channel_title ASC NULLS LAST) AS INTEGER)
           AS rank_in_region
  FROM ch)"""

CATEGORIES = f"""ca AS (
  SELECT category_name, category_id, region, trending_date_parsed,
         count(video_id) AS video_count,
         CAST(sum(views) AS BIGINT) AS total_views,
         CAST(sum(likes) AS BIGINT) AS total_likes,
         CAST(sum(comment_count) AS BIGINT) AS total_comments,
         {_exact_avg('engagement_rate')} AS avg_engagement_rate,
         count(DISTINCT channel_title) AS unique_channels
  FROM gold_in GROUP BY category_name, category_id, region, trending_date_parsed)
SELECT *, round(total_views / nullif(sum(total_views) OVER (PARTITION BY region, trending_date_parsed), 0) * 100, 2)
       AS view_share_pct
FROM ca"""

FLAT = """flat AS (
  SELECT CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS video_id,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS trending_date,
         p_name AS title, s_name AS channel_title,
         CASE WHEN l_orderkey % 53 = 0 THEN 'n/a' ELSE CAST(s_nationkey AS VARCHAR) END AS category_id,
         CAST(l_shipdate AS VARCHAR) AS publish_time, p_type AS tags,
         CASE WHEN l_orderkey % 97 = 0 THEN 'n/a'
              WHEN l_orderkey % 59 = 0 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) || '.75'
              ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) END AS views,
         CASE WHEN l_orderkey % 71 = 0 THEN NULL
              ELSE CAST(CAST(floor(l_quantity * 100) AS BIGINT) AS VARCHAR) END AS likes,
         CASE WHEN l_orderkey % 67 = 0 THEN ''
              ELSE CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) END AS dislikes,
         CAST(CAST(round(l_tax * 100) AS BIGINT) AS VARCHAR) AS comment_count,
         CAST(NULL AS VARCHAR) AS thumbnail_link,
         CASE WHEN l_linenumber = 1 THEN 'true' WHEN l_linenumber = 2 THEN 'maybe'
              ELSE 'false' END AS comments_disabled,
         'false' AS ratings_disabled, 'False' AS video_error_or_removed,
         p_type AS description, ' ' || upper(r_name) || ' ' AS region
  FROM facts)"""

TYPED = f"""typed AS (
  SELECT video_id, trending_date, title, channel_title, {_tolong('category_id')} AS category_id,
         publish_time, tags,
         coalesce({_tolong('views')}, 0) AS views, coalesce({_tolong('likes')}, 0) AS likes,
         coalesce({_tolong('dislikes')}, 0) AS dislikes,
         coalesce({_tolong('comment_count')}, 0) AS comment_count, thumbnail_link,
         try_cast(comments_disabled AS BOOLEAN) AS comments_disabled,
         try_cast(ratings_disabled AS BOOLEAN) AS ratings_disabled,
         try_cast(video_error_or_removed AS BOOLEAN) AS video_error_or_removed,
         description, lower(trim(region)) AS region
  FROM flat WHERE video_id IS NOT NULL),
cleansed AS (
  SELECT *, {_parse_date('trending_date')} AS trending_date_parsed,
         {_ratio('likes')} AS like_ratio,
         {_ratio('likes + dislikes + comment_count')} AS engagement_rate
  FROM typed)"""

DOCS = """items AS (
  SELECT lower(r_name) AS region, CAST(floor(s_suppkey / 50) AS BIGINT) AS page, s_suppkey AS pos,
         CASE WHEN s_suppkey % 17 = 0 THEN NULL
              WHEN s_suppkey % 13 = 0 THEN 'x' || CAST(s_suppkey AS VARCHAR)
              WHEN s_suppkey % 11 = 0 THEN CAST(s_nationkey AS VARCHAR) || '.5'
              ELSE CAST(s_nationkey AS VARCHAR) END AS id,
         CASE WHEN s_suppkey % 19 = 0 THEN NULL ELSE s_name END AS title
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

GS = """gs AS (
  SELECT count(*) AS n,
         CAST(count_if(video_id IS NULL) AS BIGINT) AS n_video_id, CAST(count_if(title IS NULL) AS BIGINT) AS n_title,
         CAST(count_if(channel_title IS NULL) AS BIGINT) AS n_channel_title, CAST(count_if(views IS NULL) AS BIGINT) AS n_views,
         CAST(count_if(region IS NULL) AS BIGINT) AS n_region,
         CAST(count_if(CAST(views AS DOUBLE) < 0) AS BIGINT) AS neg,
         CAST(count_if(CAST(views AS DOUBLE) > 50000000000) AS BIGINT) AS ext
  FROM gaps),
ls AS (
  SELECT count(*) AS n, CAST(count_if(category_id IS NULL) AS BIGINT) AS n_category_id,
         CAST(count_if(category_name IS NULL) AS BIGINT) AS n_category_name, CAST(count_if(region IS NULL) AS BIGINT) AS n_region
  FROM lookup)"""


def _null_row(table: str, agg: str, column: str) -> str:
    pct = f"CAST({agg}.n_{column} AS DOUBLE) * 100.0 / {agg}.n"
    return (f"SELECT 'nulls' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", "
            f"coalesce({pct} <= 5.0, false) AS passed, round({pct}, 2) AS value, "
            f"CAST(NULL AS BIGINT) AS negative, CAST(NULL AS BIGINT) AS extreme, "
            f"CAST(NULL AS VARCHAR) AS error, CAST(NULL AS VARCHAR) AS missing FROM {agg}")


def _table_rows(table: str, agg: str, cols: list[str]) -> list[str]:
    rows = [
        f"SELECT 'row_count' AS \"check\", '{table}' AS \"table\", CAST(NULL AS VARCHAR) AS \"column\", "
        f"n >= 10 AS passed, CAST(n AS DOUBLE) AS value, CAST(NULL AS BIGINT) AS negative, "
        f"CAST(NULL AS BIGINT) AS extreme, CAST(NULL AS VARCHAR) AS error, CAST(NULL AS VARCHAR) AS missing "
        f"FROM {agg}",
        f"SELECT 'schema', '{table}', CAST(NULL AS VARCHAR), true, CAST(NULL AS DOUBLE), "
        f"CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), '' FROM {agg}",
    ]
    rows += [_null_row(table, agg, c) for c in cols]
    return rows


DQ_ROWS = " UNION ALL ".join(
    _table_rows("clean_statistics", "gs", ["video_id", "title", "channel_title", "views", "region"])
    + ["SELECT 'view_range', 'clean_statistics', CAST(NULL AS VARCHAR), neg = 0 AND ext = 0, "
       "CAST(NULL AS DOUBLE), neg, ext, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM gs"]
    + _table_rows("clean_reference_data", "ls", ["category_id", "category_name", "region"])
)


ORACLE_SQL: dict[str, str] = {
    "region_prune_scan": f"""WITH {FACTS}, {STATS}
SELECT video_id, region, trending_date_parsed, views FROM stats
WHERE region IN ('america', 'asia', 'europe')""",

    "flat_cast": f"""WITH {FACTS}, {FLAT}, {TYPED}
SELECT * FROM cleansed""",

    "silver_statistics": f"""WITH {FACTS}, {FLAT}, {TYPED}
SELECT * FROM cleansed
QUALIFY row_number() OVER (
  PARTITION BY video_id, region, trending_date_parsed
  ORDER BY views DESC NULLS LAST, likes DESC NULLS LAST, dislikes DESC NULLS LAST,
           comment_count DESC NULLS LAST, trending_date ASC NULLS FIRST, title ASC NULLS FIRST,
           channel_title ASC NULLS FIRST, category_id ASC NULLS FIRST,
           publish_time ASC NULLS FIRST, tags ASC NULLS FIRST, thumbnail_link ASC NULLS FIRST,
           comments_disabled ASC NULLS FIRST, ratings_disabled ASC NULLS FIRST,
           video_error_or_removed ASC NULLS FIRST, description ASC NULLS FIRST,
           like_ratio ASC NULLS FIRST, engagement_rate ASC NULLS FIRST) = 1""",

    "reference_spellings": """WITH i AS (
  SELECT lower(r_name) AS region, s_suppkey AS page, s_nationkey AS category_id, s_name AS category_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE s_suppkey % 17 <> 0 AND s_suppkey % 13 <> 0 AND s_suppkey % 19 <> 0),
best AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY category_id, region ORDER BY page DESC) = 1)
SELECT CAST(category_id AS BIGINT) AS category_id, category_name, region, spelling
FROM best CROSS JOIN (VALUES ('renamed'), ('marked'), ('dotted')) AS s(spelling)""",

    "csv_bad_records": f"""WITH {FACTS}
SELECT lower(r_name) AS region,
       CASE WHEN l_orderkey % 37 = 0 THEN 'too few fields' WHEN l_orderkey % 41 = 0 THEN 'too many fields'
            ELSE 'no video id' END AS reason,
       count(*) AS n,
       max(CASE WHEN l_orderkey % 37 = 0 THEN 5 WHEN l_orderkey % 41 = 0 THEN 18 END) AS fields
FROM facts
WHERE l_orderkey % 37 = 0 OR l_orderkey % 41 = 0 OR l_orderkey % 101 = 0
GROUP BY 1, 2""",

    "bronze_incremental": f"""WITH {FACTS},
{FLAT.replace('SELECT CASE', 'SELECT CASE WHEN l_orderkey % 5 = 0 THEN 2 ELSE l_orderkey % 2 END AS delivered, CASE', 1)},
{TYPED.replace('SELECT video_id', 'SELECT delivered, video_id', 1)}
SELECT * EXCLUDE (delivered) FROM cleansed
QUALIFY row_number() OVER (
  PARTITION BY video_id, region, trending_date_parsed
  ORDER BY delivered DESC, views DESC, likes DESC, dislikes DESC, comment_count DESC, trending_date ASC NULLS FIRST,
           title ASC NULLS FIRST, channel_title ASC NULLS FIRST, category_id ASC NULLS FIRST,
           publish_time ASC NULLS FIRST, tags ASC NULLS FIRST, thumbnail_link ASC NULLS FIRST,
           comments_disabled ASC NULLS FIRST, ratings_disabled ASC NULLS FIRST,
           video_error_or_removed ASC NULLS FIRST, description ASC NULLS FIRST,
           like_ratio ASC NULLS FIRST, engagement_rate ASC NULLS FIRST) = 1""",

    "nested_flatten": f"""WITH {FACTS}
SELECT CAST(l_partkey AS VARCHAR) AS video_id,
       strftime(CAST(l_shipdate AS DATE), '%y.%d.%m') AS trending_date,
       p_name AS title, s_name AS channel_title, CAST(s_nationkey AS BIGINT) AS category_id,
       CAST(l_shipdate AS VARCHAR) AS publish_time, replace(p_type, ' ', '|') AS tags,
       CAST(floor(l_extendedprice) AS BIGINT) AS views,
       CAST(floor(l_quantity * 100) AS BIGINT) AS likes,
       CASE WHEN l_linenumber % 4 = 0 THEN 0 ELSE CAST(round(l_discount * 100) AS BIGINT) END AS dislikes,
       CAST(round(l_tax * 100) AS BIGINT) AS comment_count,
       'thumb/' || CAST(l_partkey AS VARCHAR) AS thumbnail_link,
       false AS comments_disabled, lower(r_name) AS region
FROM facts""",

    "trending_date_parse": f"""WITH raw AS (
  SELECT event_id,
         CASE event_id % 4 WHEN 0 THEN strftime(ts, '%y.%d.%m')
                           WHEN 1 THEN strftime(ts, '%Y-%m-%d')
                           WHEN 2 THEN '24.32.13' ELSE 'garbage' END AS trending_date
  FROM events)
SELECT event_id, trending_date, {_parse_date('trending_date')} AS trending_date_parsed FROM raw""",

    "metric_ratios": f"""WITH {FACTS}, {GAPS},
filled AS (
  SELECT video_id, region, trending_date_parsed, coalesce(views, 0) AS views,
         coalesce(likes, 0) AS likes, coalesce(dislikes, 0) AS dislikes,
         coalesce(comment_count, 0) AS comment_count
  FROM gaps)
SELECT *, {_ratio('likes')} AS like_ratio,
       {_ratio('likes + dislikes + comment_count')} AS engagement_rate
FROM filled""",

    "dedup_latest": f"""WITH {FACTS}, {STATS}, {SILVER}
SELECT * FROM silver""",

    "reference_explode": f"""WITH {DOCS},
coerced AS (
  SELECT region, page, pos, title, {_tolong('id')} AS category_id FROM items),
last_in_doc AS (
  SELECT * FROM coerced WHERE category_id IS NOT NULL AND title IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY region, page, category_id ORDER BY pos DESC) = 1)
SELECT category_id, title AS category_name, region FROM last_in_doc
QUALIFY row_number() OVER (PARTITION BY category_id, region ORDER BY page ASC, pos DESC) = 1""",

    "reference_report": f"""WITH {DOCS}
SELECT region, page, CASE WHEN page % 3 = 0 THEN count(*) ELSE 0 END AS items,
       CASE page % 3 WHEN 1 THEN 'unreadable JSON document'
                     WHEN 2 THEN 'no category items' END AS error
FROM items GROUP BY region, page""",

    "category_lookup_join": f"""WITH {GOLD_IN}
SELECT video_id, region, trending_date_parsed, category_id, category_name, views FROM gold_in""",

    "unmatched_categories": f"""WITH {FACTS}, {STATS}, {SILVER}, {LOOKUP}
SELECT CAST(count_if(lk.category_name IS NULL) AS BIGINT) AS unmatched_rows,
       CAST(count(*) AS BIGINT) AS joined_rows
FROM silver s LEFT JOIN lk ON s.category_id = lk.category_id AND s.region = lk.region""",

    "trending_analytics": f"""WITH {GOLD_IN}
SELECT region, trending_date_parsed,
       count(video_id) AS total_videos,
       CAST(sum(views) AS BIGINT) AS total_views,
       CAST(sum(likes) AS BIGINT) AS total_likes,
       CAST(sum(dislikes) AS BIGINT) AS total_dislikes,
       CAST(sum(comment_count) AS BIGINT) AS total_comments,
       avg(views) AS avg_views_per_video,
       {_exact_avg('like_ratio')} AS avg_like_ratio,
       {_exact_avg('engagement_rate')} AS avg_engagement_rate,
       max(views) AS max_views,
       count(DISTINCT channel_title) AS unique_channels,
       count(DISTINCT category_id) AS unique_categories
FROM gold_in GROUP BY region, trending_date_parsed""",

    "channel_analytics": f"""WITH {GOLD_IN}, {CHANNELS}
SELECT * FROM ranked""",

    "channel_top_k": f"""WITH {GOLD_IN}, {CHANNELS}
SELECT region, channel_title, total_views, rank_in_region FROM ranked WHERE rank_in_region <= 10""",

    "category_analytics": f"""WITH {GOLD_IN},
{CATEGORIES}""",

    "dq_inflight": f"""WITH {FACTS}, {GAPS}
SELECT CAST(count_if(video_id IS NULL) AS BIGINT) AS null_video_id, CAST(count_if(title IS NULL) AS BIGINT) AS null_title,
       CAST(count_if(channel_title IS NULL) AS BIGINT) AS null_channel_title, CAST(count_if(views IS NULL) AS BIGINT) AS null_views,
       CAST(count_if(views < 0) AS BIGINT) AS negative_views
FROM gaps""",

    "dq_report": f"""WITH {FACTS}, {GAPS}, {LOOKUP}, {GS}
{DQ_ROWS}""",

    "dq_verdict": f"""WITH {FACTS}, {GAPS}, {LOOKUP}, {GS},
report AS ({DQ_ROWS}
  UNION ALL SELECT 'table_read', 'clean_missing', NULL, false, NULL, NULL, NULL, 'missing', NULL)
SELECT coalesce(bool_and(passed), true) AS quality_passed, count(*) AS checks,
       CAST(count_if(NOT passed) AS BIGINT) AS failed_checks
FROM report""",

    "payload_envelope": """SELECT strftime(max(ts), '%Y%m%d_%H%M%S') AS ingestion_id,
       lower(event_type) AS region,
       strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') AS ingestion_timestamp,
       count(*) AS video_count, 'youtube_data_api_v3' AS source,
       strftime(max(ts), '%Y-%m-%d') AS date, strftime(max(ts), '%H') AS hour,
       CAST(floor(event_id / 50) AS BIGINT) AS page
FROM events GROUP BY event_type, CAST(floor(event_id / 50) AS BIGINT)""",

    "region_from_path": """WITH k AS (
  SELECT s_suppkey,
         CASE s_suppkey % 3
           WHEN 0 THEN 'landing/raw/region=' || replace(upper(r_name), ' ', '_') || '/s'
                       || CAST(s_suppkey AS VARCHAR) || '.json'
           WHEN 1 THEN 'landing/raw/region%3D' || replace(upper(r_name), ' ', '_')
                       || '/date%3D2024-01-01/s' || CAST(s_suppkey AS VARCHAR) || '.json'
           ELSE 'landing/raw/s' || CAST(s_suppkey AS VARCHAR) || '.json' END AS object_key
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT s_suppkey, object_key, url_decode(object_key) AS decoded_key,
       coalesce(nullif(lower(regexp_extract(url_decode(object_key), '(?:^|/)region=([^/=]*)', 1)), ''),
                'unknown') AS region
FROM k""",

    "pipeline_end_to_end": f"""WITH {FACTS.replace('facts AS', 'all_facts AS', 1)},
facts AS (SELECT * FROM all_facts WHERE l_orderkey % 2 = 0), {FLAT}, {TYPED},
api AS (
  SELECT CAST(l_partkey AS VARCHAR) AS video_id, p_name AS title, s_name AS channel_title,
         CAST(s_nationkey AS BIGINT) AS category_id, CAST(floor(l_extendedprice) AS BIGINT) AS views,
         CAST(floor(l_quantity * 100) AS BIGINT) AS likes,
         CASE WHEN l_linenumber % 4 = 0 THEN 0 ELSE CAST(round(l_discount * 100) AS BIGINT) END AS dislikes,
         CAST(round(l_tax * 100) AS BIGINT) AS comment_count, lower(r_name) AS region,
         CAST(l_shipdate AS DATE) AS trending_date_parsed
  FROM all_facts WHERE l_orderkey % 2 = 1),
both_formats AS (
  SELECT 1 AS delivered, video_id, title, channel_title, category_id, views, likes, dislikes,
         comment_count, region, trending_date_parsed, engagement_rate FROM cleansed
  UNION ALL
  SELECT 0, video_id, title, channel_title, category_id, views, likes, dislikes,
         comment_count, region, trending_date_parsed, {_ratio('likes + dislikes + comment_count')} FROM api),
silver AS (
  SELECT * FROM both_formats
  QUALIFY row_number() OVER (
    PARTITION BY video_id, region, trending_date_parsed
    ORDER BY delivered DESC, views DESC, likes DESC, dislikes DESC, comment_count DESC,
             title ASC NULLS FIRST, channel_title ASC NULLS FIRST, category_id ASC NULLS FIRST) = 1),
{LOOKUP},
gold_in AS (
  SELECT s.*, coalesce(lk.category_name, 'Unknown') AS category_name
  FROM silver s LEFT JOIN lk ON s.category_id = lk.category_id AND s.region = lk.region),
{CATEGORIES}""",
}
